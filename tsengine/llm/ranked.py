"""Operator 11: the best documents of each query by lexical weights, with MaxScore bounds tightened by pairs of terms."""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsengine.llm import chunks
from tsengine.session import materialize

TOP = 10
#: Bytes of text in a shard of the index, unless one document has more.
SHARD_BYTES = 8 << 20
#: Terms of queries (counted per query) that one pass looks for, unless one query has more; more queries take more passes.
TERMS_AT_ONCE = 200_000

#: Bytes of terms: digits, letters (A-Z lower-cased) and all of other alphabets; all other bytes become blanks.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_SHARDS = "shard bigint, ids binary, lengths binary, n_documents bigint, n_terms bigint, terms array<bigint>, counts array<bigint>, docs binary, occurrences binary"
_INDEX = "shard bigint, ids binary, a array<bigint>, b array<bigint>, sizes array<bigint>, most array<bigint>, docs binary, impacts binary"
_HITS = "item_id bigint, doc_id bigint, score bigint"
_NO_ID = np.iinfo(np.int64).min


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item, term, key)``: the distinct terms of each query; a term's key is its 64-bit hash."""

    def split(batches):
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in chunks.texts_of(batch.column(1))]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            terms = pa.array([t for f in found for t in f], pa.binary()).cast(pa.string())
            yield pa.record_batch({"item": batch.column(0).take(pa.array(rows)), "term": terms})

    rows = items.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(split, "item bigint, term string")
    return rows.distinct().withColumn("key", F.xxhash64("term"))


def _collect_shards(wanted: dict[bytes, int], shard_bytes: int):
    """Documents of a task to shards: lengths of all documents, and the places and occurrences of the wanted terms, by term."""

    def collect(batches):
        number = TaskContext.get().partitionId() << 32
        ids, lengths, size = [], [], 0
        doc, term, occurrences = [], [], []

        def shard():
            nonlocal number
            n = np.array(lengths, np.int64)
            keys, docs, counts = np.array(term, np.int64), np.array(doc, np.int32), np.array(occurrences, np.int32)
            order = np.argsort(keys, kind="stable")
            found, held = np.unique(keys, return_counts=True)
            number += 1
            values = [number - 1, np.array(ids, np.int64).tobytes(), n.tobytes(), int((n > 0).sum()), int(n.sum()), found, held, docs[order].tobytes(), counts[order].tobytes()]
            return _row(values, _SHARDS)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), chunks.texts_of(batch.column(1)), strict=True):
                words = terms_of(text)
                for t, n in Counter(filter(wanted.__contains__, words)).items():
                    doc.append(len(ids))
                    term.append(wanted[t])
                    occurrences.append(n)
                ids.append(_NO_ID if i is None else i)
                lengths.append(len(words))
                size += len(text)
                if size >= shard_bytes:
                    yield shard()
                    ids, lengths, size = [], [], 0
                    doc, term, occurrences = [], [], []
        if ids:
            yield shard()

    return collect


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def _row(values: list, schema: str) -> pa.RecordBatch:
    types = {"bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    fields = [c.split() for c in schema.split(", ")]
    return pa.record_batch([pa.array([v], types[t]) for v, (_, t) in zip(values, fields, strict=True)], [name for name, _ in fields])


def _rows(batches):
    """One shard at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _index(queries: list[tuple], weights: dict[int, int], n_documents: int, n_terms: int):
    """Of each shard a list per term with its documents and impacts, and one per pair of terms that are neighbours in a query with those that hold both.

    ``most`` is the largest weighted impact of a term's list, and of a pair's list the largest sum of both. A pair's documents come by falling sum.
    """
    pairs = sorted({pair for _, keys in queries for pair in zip(keys, keys[1:])})

    def index(batches):
        for row in _rows(batches):
            m = 10 + 90 * np.frombuffer(row["lengths"], np.int64) * n_documents // max(n_terms, 1)
            docs, tf = np.frombuffer(row["docs"], np.int32), np.frombuffer(row["occurrences"], np.int32).astype(np.int64)
            impact = (1_000_000_000 * tf // (1000 * tf + 8 * m[docs])).astype(np.int32)
            ends = np.cumsum([0, *row["counts"]]).tolist()
            lists = {t: (docs[b:e], impact[b:e]) for t, b, e in zip(row["terms"], ends[:-1], ends[1:], strict=True)}
            out = [(t, None, d, weights[t] * int(x.max())) for t, (d, x) in lists.items()]
            for a, b in pairs:
                if a in lists and b in lists:
                    both, i, j = np.intersect1d(lists[a][0], lists[b][0], assume_unique=True, return_indices=True)
                    together = weights[a] * lists[a][1][i].astype(np.int64) + weights[b] * lists[b][1][j].astype(np.int64)
                    out.append((a, b, both[np.argsort(-together, kind="stable")], int(together.max(initial=0))))
            docs, impacts = (b"".join(e.tobytes() for e in part) for part in ((e[2] for e in out), (x for _, x in lists.values())))
            yield _row([row["shard"], row["ids"], [e[0] for e in out], [e[1] for e in out], [len(e[2]) for e in out], [e[3] for e in out], docs, impacts], _INDEX)

    return index


class ShardIndex:
    """Lists of one shard: documents with scores by term, and by pair of terms those that hold both."""

    def __init__(self, row: dict, weights: dict[int, int]):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.most: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        self.joint: dict[tuple[int, int], int] = {}
        self.weights = weights
        docs, x = (np.frombuffer(row[c], np.int32) for c in ("docs", "impacts"))
        begin = 0
        for a, b, n, most in zip(row["a"], row["b"], row["sizes"], row["most"], strict=True):
            own = slice(begin, begin + n)
            begin += n
            if b is None:
                self.lists[a], self.most[a] = (docs[own], x[own]), most
            else:
                self.pairs[a, b], self.joint[a, b] = docs[own], most

    def bounds(self, terms: list[int]) -> list[int]:
        """``bounds[i]``: what ``terms[i:]`` can add to a document at most.

        Two neighbours add at most the largest of either alone and of both together, which the pair's list knows; each suffix is split
        into pairs and single terms so that its bound is least.
        """
        out = [0] * (len(terms) + 1)
        for i in range(len(terms) - 1, -1, -1):
            a = terms[i]
            out[i] = out[i + 1] + self.most[a]
            if i + 1 < len(terms):
                b = terms[i + 1]
                together = max(self.most[a], self.most[b], self.joint.get((a, b), self.most[a] + self.most[b]))
                out[i] = min(out[i], out[i + 2] + together)
        return out

    def scores(self, terms: list[int], docs: np.ndarray) -> np.ndarray:
        """Full scores of ``docs`` (ascending)."""
        total = np.zeros(len(docs), np.int64)
        for t in terms:
            total += self._looked_up(t, docs)
        return total

    def _looked_up(self, term: int, docs: np.ndarray) -> np.ndarray:
        held, x = self.lists[term]
        at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
        return np.where(held[at] == docs, self.weights[term] * x[at].astype(np.int64), 0)

    def best(self, keys: list[int], top: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``top`` documents, equal scores by id.

        The first bar is the ``top``-th full score of documents that lead a pair's or term's list. Terms whose bound together stays
        below the bar cannot lift a document alone, so only documents of the other terms are candidates; these leave as soon as
        their score and the bound of the terms to come stay below the bar, which rises with partial scores.
        """
        terms = [t for t in keys if t in self.lists]
        if not terms:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        bounds = self.bounds(terms)
        leads = [self.pairs[p][:top] for p in zip(terms, terms[1:]) if p in self.pairs]
        leads += [d[np.argpartition(-x, min(top, len(x)) - 1)[:top]] for d, x in (self.lists[t] for t in terms[:3])]
        bar = self._bar(self.scores(terms, np.unique(np.concatenate(leads))), top)
        essential = next((i for i in range(len(terms) + 1) if bounds[i] < bar), len(terms))
        docs = np.unique(np.concatenate([self.lists[t][0] for t in terms[:essential]])) if essential else np.empty(0, np.int32)
        total = self.scores(terms[:essential], docs)
        for i in range(essential, len(terms)):
            bar = max(bar, self._bar(total, top))
            alive = total + bounds[i] >= bar
            docs, total = docs[alive], total[alive]
            total = total + self._looked_up(terms[i], docs)
        found = total > 0
        ids, total = self.ids[docs[found]], total[found]
        order = np.lexsort((ids, -total))[:top]
        return ids[order], total[order]

    @staticmethod
    def _bar(scores: np.ndarray, top: int) -> int:
        return int(np.partition(scores, -top)[-top]) if len(scores) >= top else 0


def _search(queries: list[tuple], weights: dict[int, int], top: int):
    def search(batches):
        for row in _rows(batches):
            shard = ShardIndex(row, weights)
            found = [shard.best(keys, top) for _, keys in queries]
            items = [item for (item, _), (ids, _) in zip(queries, found, strict=True) for _ in ids]
            ids, scores = (np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in (0, 1))
            yield pa.record_batch({"item_id": pa.array(items, pa.int64()), "doc_id": pa.array(ids, mask=ids == _NO_ID), "score": scores})

    return search


def _ranked_part(docs: DataFrame, terms: DataFrame, top: int, shard_bytes: int) -> DataFrame:
    """The best of each shard for the queries of ``terms``, which are few enough for every task to hold."""
    rows = terms.collect()
    wanted = {r["term"].encode(): r["key"] for r in rows}
    shards = materialize(docs.mapInArrow(_collect_shards(wanted, shard_bytes), _SHARDS), "term-shards")
    n_documents, n_terms = shards.agg(F.coalesce(F.sum("n_documents"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = shards.select(F.inline(F.arrays_zip("terms", "counts"))).groupBy("terms").agg(F.sum("counts").alias("df")).collect()
    weights = {r["terms"]: weight(n_documents, r["df"]) for r in df}
    queries: dict = {}
    for r in rows:
        if r["key"] in weights:
            queries.setdefault(r["item"], []).append(r["key"])
    # Falling weight: neighbours in this order are the pairs of the index.
    ordered = [(item, sorted(keys, key=lambda k: (-weights[k], k))) for item, keys in sorted(queries.items(), key=str)]
    index = materialize(shards.mapInArrow(_index(ordered, weights, n_documents, n_terms), _INDEX), "term-index")
    return index.mapInArrow(_search(ordered, weights, top), _HITS)


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of each item by score, equal scores by ascending id.

    Terms are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII. ``score`` sums ``weight * impact`` over the item's distinct terms, with
    ``weight = floor(1000 * ln((2N + 2) / (2df + 1)))``, ``impact = 1000000000 * tf div (1000 * tf + 8 * m)``, ``m = 10 + 90 * n * N div L``; N documents with a term,
    L all terms, n terms of the document, tf and df occurrences in it and documents with the term.

    One pass turns the documents into shards with the places of the items' terms; counts of all shards give the weights. The index then holds for each shard the list of each
    term and, for terms that are neighbours in a query by weight, the list of documents with both and its largest sum. Each shard answers all queries
    exactly (``ShardIndex.best``), and the shards' best are ranked. Queries with more than ``TERMS_AT_ONCE`` terms together take several passes.

    Null texts have no terms; items without terms and documents that score 0 give no row. Repeated documents are ranked each; a null id comes before the others.
    Rows that share an item id, null too, are one item with the terms of all. Empty tables give an empty one.
    Terms are told apart in documents by their bytes, in queries by 64-bit hashes. Other columns are not read.
    """
    terms = materialize(query_terms(items, item_col, item_text), "query-terms")
    passes = max(1, math.ceil(terms.count() / TERMS_AT_ONCE))
    read = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    found = [_ranked_part(read, terms.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == part), top, shard_bytes) for part in range(passes)]
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = functools.reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
