"""Operator 1: document quality from random-indexing word vectors and a two-layer network with calibrated probabilities."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.llm.chunks import released, texts_of

#: Word vectors: words share ``BUCKETS`` rows by hash, so the table has a fixed size.
BUCKETS = 1 << 14
DIMS = 64
#: Nonzero entries of a word's random index vector, half of them -1.
NONZERO = 4
#: Neighbours on each side that count as context.
REACH = 2
#: Labelled rows that the network is fitted on at most: those of the smallest id hashes.
SAMPLE_ROWS = 20_000
HIDDEN = 48
EPOCHS = 40
SEED = 17
#: Score from which a document counts as good.
THRESHOLD = 0.3
#: Words handled at once; a longer document is taken in parts.
_STEP = 1 << 17
#: Rows of the word table in one shuffled block.
_BLOCK = 256
#: Words whose buckets are remembered while a batch is read.
_MOST_KNOWN = 1 << 15

_WORD = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")


def word_ids(text: bytes, known: dict[bytes, int] | None = None) -> np.ndarray:
    """Buckets of a text's words: runs of letters, of digits and of other signs. ``known`` remembers words for the next text."""
    known = {} if known is None else known
    words = _WORD.findall(text)
    out = np.empty(len(words), np.int64)
    for k, w in enumerate(words):
        i = known.get(w)
        if i is None:
            if len(known) >= _MOST_KNOWN:
                known.clear()
            i = known[w] = xxhash.xxh3_64_intdigest(w) % BUCKETS
        out[k] = i
    return out


def index_vectors(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the entries 1 and of the entries -1 of each bucket's random index vector; the others are 0."""
    where = np.argsort(np.random.default_rng(seed).random((BUCKETS, DIMS)), axis=1)
    return where[:, : NONZERO // 2], where[:, NONZERO // 2 : NONZERO]


def _contexts(batches):
    """Sums of the index vectors around each word, for the documents of one task."""
    plus, minus = index_vectors()
    total = np.zeros(BUCKETS * DIMS, np.int64)
    count = np.zeros(BUCKETS, np.int64)

    def add(words: np.ndarray, doc: np.ndarray, new: np.ndarray) -> None:
        np.add(count, np.bincount(words[new], minlength=BUCKETS), out=count)
        for step in range(1, REACH + 1):
            same = (doc[step:] == doc[:-step]) & new[step:]
            a, b = words[:-step][same], words[step:][same]
            centre, other = np.concatenate((a, b))[:, None] * DIMS, np.concatenate((b, a))
            for sign, columns in ((1, plus), (-1, minus)):
                np.add(total, sign * np.bincount((centre + columns[other]).ravel(), minlength=BUCKETS * DIMS), out=total)

    held, size = [], 0
    for batch in batches:
        known: dict[bytes, int] = {}
        for number, text in enumerate(texts_of(batch.column(0))):
            ids = word_ids(text, known)
            for begin in range(0, len(ids), _STEP):
                # A later part takes the last words of the one before as context; they are counted there.
                back = min(begin, REACH)
                part = ids[begin - back : begin + _STEP]
                held.append((part, np.full(len(part), number), np.arange(len(part)) >= back))
                size += len(part)
                if size >= _STEP:
                    add(*map(np.concatenate, zip(*held, strict=True)))
                    held, size = [], 0
        if held:
            add(*map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    table = total.reshape(BUCKETS, DIMS)
    for block in range(BUCKETS // _BLOCK):
        rows = slice(block * _BLOCK, (block + 1) * _BLOCK)
        if count[rows].any():
            payload = table[rows].tobytes() + count[rows].tobytes()
            yield pa.record_batch({"block": pa.array([block], pa.int32()), "payload": pa.array([payload], pa.binary())})


def _sum_blocks(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(p.as_buffer(), "<i8") for p in table["payload"])
    return pa.table({"block": table["block"][:1], "payload": pa.array([total.tobytes()], pa.binary())})


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """``BUCKETS`` unit vectors: the contexts of each word over all documents, centred; zero for a word never seen.

    Only this table of fixed size (4 MB) comes to the driver; its parts are summed in Spark.
    """
    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(released(_contexts), "block int, payload binary")
    table = np.zeros((BUCKETS, DIMS))
    count = np.zeros(BUCKETS)
    for block, payload in parts.groupBy("block").applyInArrow(_sum_blocks, "block int, payload binary").collect():
        sums = np.frombuffer(payload, "<i8")
        rows = slice(block * _BLOCK, (block + 1) * _BLOCK)
        table[rows] = sums[: _BLOCK * DIMS].reshape(_BLOCK, DIMS)
        count[rows] = sums[_BLOCK * DIMS :]
    seen = count > 0
    if not seen.any():
        return table.astype(np.float32)
    table[seen] /= np.linalg.norm(table[seen], axis=1, keepdims=True) + 1e-9
    table[seen] -= np.average(table[seen], axis=0, weights=np.log1p(count[seen]))
    table[seen] /= np.linalg.norm(table[seen], axis=1, keepdims=True) + 1e-9
    return table.astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of a document's word vectors, over all its words; zeros without words."""
    out = np.zeros((len(texts), 2 * DIMS))
    known: dict[bytes, int] = {}
    for row, text in zip(out, texts, strict=True):
        words = word_ids(text, known)
        if not len(words):
            continue
        first, second = np.zeros(DIMS), np.zeros(DIMS)
        for begin in range(0, len(words), _STEP):
            v = vectors[words[begin : begin + _STEP]]
            first += v.sum(axis=0, dtype=np.float64)
            second += np.einsum("ij,ij->j", v, v, dtype=np.float64)
        first /= len(words)
        row[:DIMS] = first
        row[DIMS:] = np.sqrt(np.maximum(second / len(words) - first * first, 0))
    return out


@dataclass
class Network:
    """Two layers over scaled inputs; the logit is divided by ``temperature``."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
    """Adam on the log loss of four fifths of the rows; the temperature with the least log loss on the rest."""
    random = np.random.default_rng(seed)
    order = random.permutation(len(x))
    rest, own = order[: len(x) // 5], order[len(x) // 5 :]
    net = Network(x.mean(axis=0), x.std(axis=0) + 1e-6, random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    z = (x - net.shift) / net.scale
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(EPOCHS):
        rate = 3e-3 * (1 - epoch / EPOCHS) + 1e-5
        for rows in np.array_split(random.permutation(own), max(1, len(own) // 128)):
            step += 1
            a = np.tanh(z[rows] @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-np.clip(a @ weights[2] + weights[3], -40, 40))) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - a * a)
            grads = [z[rows].T @ back + 1e-4 * weights[0], back.sum(axis=0), a.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(weights[3][0])
    if len(rest):
        logits, good = net.logits(x[rest]), y[rest]

        def loss(t: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(logits / t, -40, 40))), 1e-9, 1 - 1e-9)
            return float(-(good * np.log(p) + (1 - good) * np.log(1 - p)).mean())

        net.temperature = min(np.exp(np.linspace(np.log(0.25), np.log(8), 200)), key=loss)
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network | None

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), 0.5)
        return self.network.scores(pooled(texts, self.vectors))


def held_out(id_col: str):
    """Rows that no label is learned from: crc32 of the id as text divides by 5. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Word vectors of all documents; the network of at most ``sample_rows`` labelled ones that are not held out.

    The sample (ids and labels, bounded by ``sample_rows``) is broadcast. Without labels of both kinds every score is 0.5.
    An id labelled twice takes the larger label; null labels and ids are left out.
    """
    vectors = word_vectors(docs, text_col)
    usable = labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).alias("label"))
    present = docs.select(F.col(id_col).alias("key")).distinct()
    sample = usable.join(present, "key", "left_semi").orderBy(F.xxhash64("key"), "key").limit(sample_rows)

    def pool(batches):
        for batch in batches:
            rows = pooled(texts_of(batch.column(0)), vectors).astype("<f4")
            yield pa.record_batch({"x": pa.array([r.tobytes() for r in rows], pa.binary()), "key": batch.column(1).cast(pa.int64()), "label": batch.column(2).cast(pa.int32())})

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("key")).join(F.broadcast(sample), "key")
    found = rows.select("text", F.col("key").cast("bigint"), F.col("label").cast("int")).mapInArrow(pool, "x binary, key bigint, label int").collect()
    found.sort(key=lambda r: (r["key"], r["x"], r["label"]))
    y = np.array([r["label"] for r in found], float)
    if len(set(y.tolist())) < 2:
        return QualityModel(vectors, None)
    x = np.stack([np.frombuffer(r["x"], "<f4") for r in found]).astype(float)
    return QualityModel(vectors, fit_network(x, y))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` in a struct ``row``, and ``score`` (0 to 1, higher: better). A null text scores as an empty one.

    The model (4 MB) is the only thing sent to every task; texts are taken whole.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    narrow = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))

    def score(batches):
        for batch in batches:
            found = shared.value.scores(texts_of(batch.column(1)))
            yield pa.record_batch({"row": batch.column(0), "score": pa.array(found, pa.float64())})

    return narrow.mapInArrow(released(score), T.StructType([narrow.schema["row"], T.StructField("score", T.DoubleType())]))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``."""
    model = fit_quality(docs, labels, id_col, text_col)
    return score_quality(docs, model, id_col, text_col).where(F.col("score") >= threshold).select("row.*")
