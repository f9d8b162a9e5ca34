import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tsengine.llm import quality, toxicity
from tsengine.llm.queries import op1_quality_classifier, op2_toxicity

FOLDER = "/root/testdata/sf0.01"


def area(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return float((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2)


def labelled(spark, out, label):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    return out.join(labels, "doc_id").where("held_out").toPandas()


def test_quality_of_held_out_documents(spark):
    out = op1_quality_classifier(spark, FOLDER)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = labelled(spark, out, "quality")
    assert area(rows["score"].to_numpy(), rows["label"].to_numpy()) > 0.93
    assert ((rows["score"] >= 0.3) == (rows["label"] == 1)).mean() > 0.9


def test_toxicity_of_held_out_documents(spark):
    rows = labelled(spark, op2_toxicity(spark, FOLDER), "toxic")
    assert area(rows["severity"].to_numpy(), rows["label"].to_numpy()) > 0.75
    assert rows["toxic"][rows["label"] == 0].mean() < 0.05


def test_labels_of_held_out_rows_are_not_used(spark, documents):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["good", "fine", "well"] if i % 2 else ["bad", "%%%", "!!"]) for _ in range(30))) for i in range(200)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, quality int")
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (quality.fit_quality(docs, table).scores([b"good fine", b"!! bad"]) for table in (labels, flipped))
    assert first.tolist() == second.tolist() and first[0] > 0.9 and first[1] < 0.1


def test_quality_of_odd_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = documents([(1, None), (2, ""), (None, "word " * 200_000), (2, "é\x00 ퟿")])
    model = quality.fit_quality(docs, none)
    out = quality.score_quality(docs, model).select("row.*", "score")
    assert out.columns == [*docs.columns, "score"] and [r["score"] for r in out.collect()] == [0.5] * 4
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (None, 1), (3, 0), (99, 0)], "doc_id bigint, quality int")
    assert quality.good_documents(docs, labels).count() == 4
    assert quality.good_documents(documents([]), labels).count() == 0
    got = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)).collect()
    assert not any(r["toxic"] for r in got) and len(got) == 4


def test_word_vectors_are_sums_of_neighbours(spark, documents):
    """Against a loop over word pairs."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(40))) for _ in range(30)]
    vectors = quality.word_vectors(documents(list(enumerate(texts))).repartition(3))
    plus, minus = quality.index_vectors()
    table, count = np.zeros((quality.BUCKETS, quality.DIMS)), np.zeros(quality.BUCKETS)
    for t in texts:
        ids = quality.word_ids(t.encode())
        for i, a in enumerate(ids):
            count[a] += 1
            for b in [*ids[max(0, i - 2) : i], *ids[i + 1 : i + 3]]:
                table[a, plus[b]] += 1
                table[a, minus[b]] -= 1
    seen = count > 0
    table[seen] /= np.linalg.norm(table[seen], axis=1, keepdims=True)
    table[seen] -= np.average(table[seen], axis=0, weights=np.log1p(count[seen]))
    table[seen] /= np.linalg.norm(table[seen], axis=1, keepdims=True)
    assert np.allclose(vectors, table, atol=1e-5)


def test_words_of_a_long_document_count_once(monkeypatch):
    """A document in several parts gives the contexts of the same document in one."""
    texts = [" ".join(f"w{i % 50}" for i in range(3000)), "a b", " ".join(f"v{i % 7}" for i in range(1500))]
    batch = pa.record_batch({"text": texts})
    want = {b["block"][0].as_py(): b["payload"][0].as_py() for b in quality._contexts([batch])}
    monkeypatch.setattr(quality, "_STEP", 700)
    got = {b["block"][0].as_py(): b["payload"][0].as_py() for b in quality._contexts([batch])}
    assert want and got == want
    assert sum(np.frombuffer(p, "<i8")[quality._BLOCK * quality.DIMS :].sum() for p in got.values()) == 9002


def test_quality_scores_equal_a_plain_version(spark, documents):
    """Pooling, network and temperature row by row."""
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("red green blue grey".split() if i % 2 else "x1 y2 ## good".split()) for _ in range(rng.randrange(1, 60)))) for i in range(120)]
    docs = documents([*rows, (500, None), (501, "")])
    model = quality.fit_quality(docs, spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id bigint, quality int"))
    net = model.network
    got = {r["row"]["doc_id"]: r["score"] for r in quality.score_quality(docs, model).collect()}
    for i, t in [*rows, (500, "")]:
        ids = quality.word_ids(t.encode())
        x = np.zeros(2 * quality.DIMS)
        if len(ids):
            vectors = [[float(v) for v in model.vectors[k]] for k in ids]
            for d in range(quality.DIMS):
                mean = sum(v[d] for v in vectors) / len(ids)
                x[d], x[quality.DIMS + d] = mean, max(sum(v[d] ** 2 for v in vectors) / len(ids) - mean * mean, 0) ** 0.5
        hidden = [np.tanh(sum((x[k] - net.shift[k]) / net.scale[k] * net.w1[k, h] for k in range(len(x))) + net.b1[h]) for h in range(quality.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, net.w2)) + net.b2
        assert abs(got[i] - 1 / (1 + np.exp(-logit / net.temperature))) < 1e-5
    assert abs(got[500] - got[501]) < 1e-9


def test_severity_equals_a_plain_version(spark, documents):
    """Expected grade from word counts, by loops."""
    from collections import Counter

    import xxhash

    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["nice", "calm", "tree", *(["awful", "hateful"] * 3 if i % 3 == 0 else [])]) for _ in range(rng.randrange(5, 40)))) for i in range(300)]
    docs = documents([*rows, (900, None), (901, "awful " * 50)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    got = {r["row"]["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    for i, t in [*rows, (900, ""), (901, "awful " * 50)]:
        found = Counter()
        for w in t.split():
            found[xxhash.xxh3_64_intdigest(w.encode()) % toxicity.FEATURES] += 1
            for size in (4, 5, 6, 7):
                if len(w) >= size:
                    found[xxhash.xxh3_64_intdigest(w[:size].encode(), seed=size) % toxicity.FEATURES] += 1
        z = sum(float(model.weights[k]) * np.log2(1 + n) for k, n in found.items())
        above = [1 / (1 + np.exp(-(z - b))) for b in model.thresholds]
        assert abs(got[i]["severity"] - sum(above)) < 1e-4
        assert got[i]["toxic"] == (sum(above) >= toxicity.TOXIC_FROM) or abs(sum(above) - toxicity.TOXIC_FROM) < 1e-4
    assert got[901]["toxic"] and not got[900]["toxic"]
    assert toxicity.score_toxicity(documents([]), model).count() == 0
    assert toxicity.score_toxicity(docs, model).select("row.*").columns == docs.columns


def test_ordinal_grades_come_in_order():
    rng = np.random.default_rng(3)
    rows, grades = [], []
    for _ in range(1500):
        grade = int(rng.integers(0, 4))
        rows.append((np.array([1, 2 + grade % 2], np.int32), np.array([grade + rng.normal(0, 0.3), 1], np.float32)))
        grades.append(grade)
    rows = [(n, v) for n, v in rows]
    model = toxicity.fit_ordinal(rows, np.array(grades))
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    means = [np.mean([model.above(*r).sum() for r, g in zip(rows, grades) if g == k]) for k in range(4)]
    assert all(a < b for a, b in zip(means, means[1:]))
    above = model.above(*rows[0])
    assert (np.diff(above) <= 0).all()


def test_temperature_lowers_the_loss_of_overconfident_scores():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 5))
    y = (rng.random(600) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    net = quality.fit_network(np.hstack([x, rng.normal(size=(600, 60))]), y)
    assert net.temperature > 1
