import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tsengine.llm import fingerprints


def fingerprint(df):
    return fingerprints.fingerprint_documents(df).collect()


def edited(rows):
    """[(id, characters, hash of the edited text)] by loops, for rows with distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        half = len(t) // 2
        text = t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half]
        out.append((i, len(t), hashlib.sha256(text.encode()).hexdigest()))
    return out


def corpus():
    rng = random.Random(3)
    rows = [(i * 7 % 1009, " ".join(rng.choice(["ab", "é", "𝔘x", "longword" * 3, "\n", "  "]) + str(rng.randrange(50)) for _ in range(rng.randrange(90)))) for i in range(150)]
    return rows + [(2000, None), (2001, ""), (2002, "x"), (None, "no id " * 30), (2003, "y" * 40_000), (2004, "word " * 30_000), (-5, "first of all " * 20)]


@pytest.mark.parametrize("chunk_bytes", [300, 4000, 2 << 20])
def test_edited_texts_equal_loops(documents, monkeypatch, chunk_bytes):
    monkeypatch.setattr(fingerprints, "_CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(fingerprints, "_PARTITION_BYTES", 4 * chunk_bytes)
    monkeypatch.setattr(fingerprints, "_RANGES", 70)
    monkeypatch.setattr(fingerprints, "_STEP", 8)
    rows = corpus()
    got = fingerprint(documents(rows).repartition(5))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == sorted(edited(rows), key=str)
    by_id = {r["doc_id"]: r for r in got}
    order = [i for i, _, _ in edited(rows)]

    def like(a, b):
        return sum(a[k : k + 8] == b[k : k + 8] for k in range(0, len(a), 8)) / fingerprints.COMPONENTS

    for k, i in enumerate(order):
        r, following = by_id[i], by_id[order[(k + 1) % len(order)]]
        assert r["near_edited"] == like(r["fingerprint"], r["edited_fingerprint"]) and r["near_next"] == like(r["fingerprint"], following["fingerprint"])
    assert by_id[2000]["fingerprint"] == by_id[2001]["fingerprint"] != by_id[2002]["fingerprint"] and by_id[2000]["near_next"] == 1


def plain(text, spark, components=fingerprints.COMPONENTS):
    """Components by loops; only the hash function is Spark's."""
    import re

    tokens = [m.group() for m in re.finditer(r"[^ \t-\r]{1,12}[ \t-\r]{0,4}|[ \t-\r]{1,4}", text)]
    assert "".join(tokens) == text
    runs = [tuple(tokens[k : k + 3]) for k in range(max(len(tokens) - 2, 1 if tokens else 0))]
    rows = []
    for k, run in enumerate(runs):
        rows.append((k, *[*run, None, None][:3], runs[:k].count(run) + 1))
    df = spark.createDataFrame(rows, "at int, a string, b string, c string, occurrence int").select("at", F.xxhash64(F.xxhash64("a", "b", "c"), "occurrence").alias("h"))
    df = df.select("at", "h", *[F.xxhash64(F.lit(j), "h").alias(f"v{j}") for j in range(components)])
    kmers = df.collect()
    chosen = []
    for j in range(components):
        best = []
        for side in (0, 1):
            of = [(r[f"v{j}"] >> 24, r["at"]) for r in kmers if (r["h"] >> j) & 1 == side]
            best.append(min(of, default=(None, None)))
        chosen.append(best)
    out = []
    for j, (a, b) in enumerate(chosen):
        first = None in (a[1], b[1]) or a[1] <= b[1]
        out.append((j, a[0], b[0], True) if first else (j, b[0], a[0], False))
    hashed = spark.createDataFrame(out, "j int, x bigint, y bigint, first boolean").select("j", F.xxhash64("j", "x", "y", "first").alias("c")).collect()
    return "".join(f"{r['c'] >> 32 & 0xFFFFFFFF:08X}" for r in sorted(hashed))


def test_fingerprints_equal_loops(spark, documents):
    texts = ["one two three four five six seven", "a a a a b a a a a a a", "x", "two  words", "é" * 50 + " \n\n\n\n\n\n end", "the cat sat on the mat and the cat sat on the hat " * 3]
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprint(documents(list(enumerate(texts))))}
    assert got == {i: plain(t, spark) for i, t in enumerate(texts)}


def test_order_and_edits_count(documents):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10_000)}" for _ in range(600)]
    swapped = words[300:] + words[:300]
    few = list(words)
    for k in (100, 350, 500):
        few[k] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(few)), (4, " ".join(words)), (5, " ".join(swapped)), (6, " ".join(f"v{rng.randrange(10_000)}" for _ in range(600)))]
    r = {r["doc_id"]: r for r in fingerprint(documents(rows))}
    assert r[1]["near_next"] == 1 and r[1]["fingerprint"] == r[4]["fingerprint"]
    assert 0.85 < r[2]["near_next"] < 1  # three words of 600
    assert 0.3 < r[4]["near_next"] < 0.8  # the same k-mers, halves exchanged: half of the pairs change order
    assert r[5]["near_next"] == 0
    assert 0.02 <= r[5]["near_edited"] < 0.4  # half is replaced


def test_rows_that_share_an_id_or_have_none(documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "_CHUNK_BYTES", 100)
    rows = [(None, f"n{i} " * 5) for i in range(60)] + [(4, f"h{i} " * 5) for i in range(60)] + [(4, "same")] * 20 + [(9, "z z z")]
    got = fingerprint(documents(rows))
    assert len(got) == len(rows) and sum(r["doc_id"] is None for r in got) == 60
    same = [r for r in got if r["doc_id"] == 4 and r["n_chars"] == 4]
    assert len(same) == 20 and sum(r["near_next"] == 1 for r in same) >= 19
    assert fingerprint(documents([])) == []
    (alone,) = fingerprint(documents([(1, "only one here")]))
    assert alone["near_next"] == 1


def test_plan_has_no_python(documents):
    plan = fingerprints.fingerprint_documents(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
