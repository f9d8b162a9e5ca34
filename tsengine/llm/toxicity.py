"""Operator 2: toxicity severity by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.llm.chunks import texts_of
from tsengine.llm.quality import held_out

#: Features share this many weights by hash.
FEATURES = 1 << 18
#: Labelled rows that the regression is fitted on at most: those of the smallest id hashes.
SAMPLE_ROWS = 10_000
EPOCHS = 12
#: Weight of the squared weights against the likelihood of one document.
SHRINK = 2e-2
SEED = 23
#: Expected severity from which a document counts as toxic.
TOXIC_FROM = 0.5
#: Bytes of the word beginnings that are features of their own, so that inflected and compound words share weights.
_STEMS = (4, 5, 6, 7)
#: Sample documents that a feature must occur in to get a weight.
LEAST_DOCS = 8

_WORD = re.compile(rb"[a-z\x80-\xff]+")


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: log2(1 + occurrences) of each word and word beginning in the whole text."""
    counts = Counter(_WORD.findall(text.lower()))
    found: Counter = Counter()
    for word, n in counts.items():
        found[xxhash.xxh3_64_intdigest(word) % FEATURES] += n
        for size in _STEMS:
            if len(word) >= size:
                found[xxhash.xxh3_64_intdigest(word[:size], seed=size) % FEATURES] += n
    numbers = np.fromiter(found, np.int32, len(found))
    return numbers, np.log2(1 + np.fromiter(found.values(), np.float32, len(found)))


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(weights . x - thresholds[k]), thresholds ascending."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, numbers: np.ndarray, values: np.ndarray) -> np.ndarray:
        z = float(self.weights[numbers] @ values) - self.thresholds
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, seed: int = SEED) -> OrdinalModel:
    """Maximum likelihood by Adagrad over documents; all thresholds share the weights.

    The thresholds are a first one and positive steps, so they stay in order. Weights are shrunk towards zero.
    """
    top = int(grades.max()) if len(grades) else 0
    if top == 0:
        return OrdinalModel(np.zeros(FEATURES, np.float32), np.full(max(top, 1), 4.0))
    common = np.bincount(np.concatenate([n for n, _ in rows]), minlength=FEATURES) >= LEAST_DOCS
    rows = [(n[common[n]], v[common[n]]) for n, v in rows]
    weights, squares = np.zeros(FEATURES), np.full(FEATURES, 1e-6)
    share = np.array([np.clip((grades > k).mean(), 1e-4, 1 - 1e-4) for k in range(top)])
    wanted = np.maximum.accumulate(np.log((1 - share) / share))
    first, steps = wanted[0], np.log(np.maximum(np.diff(wanted), 1e-2))
    random = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        rate = 0.1 * (1 - epoch / EPOCHS) + 0.01
        for i in random.permutation(len(rows)).tolist():
            numbers, values = rows[i]
            theta = first + np.concatenate(([0.0], np.cumsum(np.exp(steps))))
            above = 1 / (1 + np.exp(-np.clip(weights[numbers] @ values - theta, -40, 40)))
            grade = int(grades[i])
            # Likelihood of the grade: above[grade - 1] - above[grade], with 1 below the first and 0 beyond the last.
            padded = np.concatenate(([1.0], above, [0.0]))
            slope = padded * (1 - padded)
            likely = max(padded[grade] - padded[grade + 1], 1e-9)
            by_z = -(slope[grade] - slope[grade + 1]) / likely
            by_theta = np.zeros(top)
            if grade > 0:
                by_theta[grade - 1] += slope[grade] / likely
            if grade < top:
                by_theta[grade] -= slope[grade + 1] / likely
            g = by_z * values + SHRINK * weights[numbers]
            squares[numbers] += g * g
            weights[numbers] -= rate * g / np.sqrt(squares[numbers])
            first -= 0.02 * by_theta.sum() / (1 + epoch)
            tail = np.cumsum(by_theta[::-1])[::-1][1:]
            steps = np.clip(steps - 0.02 * tail * np.exp(steps) / (1 + epoch), -5, 3)
    return OrdinalModel(weights.astype(np.float32), first + np.concatenate(([0.0], np.cumsum(np.exp(steps)))))


def severity_grades(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 of documents that are only marked toxic or not.

    Features at least 20 times as frequent in toxic documents are marks; a toxic document that has more marks than half of the
    toxic ones is graded 2.
    """
    if not toxic.any():
        return toxic.astype(int)
    hits = np.zeros((2, FEATURES))
    for (numbers, _), t in zip(rows, toxic.astype(int).tolist(), strict=True):
        hits[t, numbers] += 1
    rate = (hits + 0.5) / (np.array([[(toxic == 0).sum()], [toxic.sum()]]) + 1)
    marks = (hits[1] >= 5) & (rate[1] > 20 * rate[0])
    found = np.array([float(values[marks[numbers]].sum()) for numbers, values in rows])
    return toxic.astype(int) + ((toxic > 0) & (found > np.median(found[toxic > 0])))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Ordinal regression on at most ``sample_rows`` labelled documents that are not held out.

    Labels are ordered grades from 0; if there are only 0 and 1, toxic documents are graded by ``severity_grades`` first.
    An id labelled twice takes the larger label; null labels and ids are left out. Without a positive label nothing is toxic.
    The sample (bounded by ``sample_rows``) is broadcast and its sparse features come to the driver.
    """
    usable = labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).alias("label"))
    sample = usable.join(docs.select(F.col(id_col).alias("key")).distinct(), "key", "left_semi").orderBy(F.xxhash64("key"), "key").limit(sample_rows)

    def extract(batches):
        for batch in batches:
            found = [features(t) for t in texts_of(batch.column(0))]
            yield pa.record_batch(
                {
                    "numbers": pa.array([n.astype("<i4").tobytes() for n, _ in found], pa.binary()),
                    "values": pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                    "key": batch.column(1).cast(pa.int64()),
                    "label": batch.column(2).cast(pa.int32()),
                }
            )

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("bigint").alias("key")).join(F.broadcast(sample), "key")
    got = rows.select("text", "key", F.col("label").cast("int")).mapInArrow(extract, "numbers binary, values binary, key bigint, label int").collect()
    got.sort(key=lambda r: (r["key"], r["numbers"], r["values"]))
    sparse = [(np.frombuffer(r["numbers"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in got]
    grades = np.array([r["label"] for r in got], int)
    if len(grades) and grades.max() == 1:
        grades = severity_grades(sparse, grades)
    return fit_ordinal(sparse, grades)


def score_toxicity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` in a struct ``row``, with ``severity`` (expected grade), ``grade`` (the likeliest) and ``toxic``.

    Whole texts are scored. A null text scores as an empty one. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    narrow = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))

    def score(batches):
        for batch in batches:
            above = [shared.value.above(*features(t)) for t in texts_of(batch.column(1))]
            severity = [float(a.sum()) for a in above]
            grade = [int(np.argmax(np.concatenate(([1.0], a)) - np.concatenate((a, [0.0])))) for a in above]
            toxic = [s >= TOXIC_FROM for s in severity]
            yield pa.record_batch({"row": batch.column(0), "severity": pa.array(severity, pa.float64()), "grade": pa.array(grade, pa.int32()), "toxic": pa.array(toxic, pa.bool_())})

    fields = [T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType()), T.StructField("toxic", T.BooleanType())]
    return narrow.mapInArrow(score, T.StructType([narrow.schema["row"], *fields]))
