import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from brute import components, equal_texts, shingles, without_repeats
from pyspark.sql import functions as F

from tsengine.llm import chunks, components as links, exact, jaccard, substrings

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "One  two"), (7, LONG), (8, LONG + " tail"), (9, LONG),
    (10, "é É ß  x " * 30), (11, " "), (12, "a" * 50_000), (None, "null id"), (13, "null id"),
]


def edited(words, share, rng):
    return [rng.choice("pqrstuv") * 3 + str(rng.randrange(999)) if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies at all distances around the threshold, shared passages, repeated lines and short texts."""
    rng, rows = random.Random(4), []
    passage = " ".join(f"shared{i}" for i in range(60))
    for base in range(12):
        words = [f"v{rng.randrange(400)}" for _ in range(rng.choice([6, 30, 80, 200]))]
        for copy in range(rng.choice([1, 3, 9])):
            rows.append(" ".join(edited(words, rng.choice([0, 0.01, 0.03, 0.05, 0.08]), rng)))
        if base % 3 == 0:
            rows.append(passage + " " + " ".join(words[:40]))
    rows += [("tick tock " * 40).strip()] * 2 + ["x " * 70, "a b", "A  B", "a b c"]
    rng.shuffle(rows)
    return list(enumerate(rows)) + [(i + 1000, t) for i, t in EDGES if i is not None]


def test_window_hashes_agree_with_equality_of_windows():
    rng = random.Random(1)
    words = [rng.choice([b"a", b"b"]) for _ in range(400)]
    hashes = chunks.window_hashes(words, 7).tolist()
    windows = [tuple(words[i : i + 7]) for i in range(394)]
    assert len(set(hashes)) == len(set(windows))
    assert all((hashes[i] == hashes[j]) == (windows[i] == windows[j]) for i in range(0, 394, 5) for j in range(394))
    assert len(chunks.window_hashes(words[:6], 7)) == 0


def test_packed_hashes_come_back():
    rng = random.Random(2)
    for n in (1, 2, 1000):
        values = sorted({rng.randrange(2**64) for _ in range(n)})
        array = chunks.np.array(values, chunks.np.uint64)
        assert chunks.unpack(chunks.pack(array)).tolist() == values
        parts = [(b, array[s].tolist()) for b, s in chunks.by_bucket(array, 8)]
        assert [v for _, p in parts for v in p] == values and all(v >> 61 == b for b, p in parts for v in p)


def test_repeated_passages(documents, corpus):
    got = substrings.remove_repeated_passages(documents(corpus))
    rows = got.withColumn("h", F.sha2("kept_text", 256)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["h"]) for r in rows} == without_repeats(corpus)
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_repeated_passages_of_rows_that_share_an_id_or_have_none(documents):
    text = " ".join(f"z{i}" for i in range(25))
    got = substrings.remove_repeated_passages(documents([(7, text), (7, text), (None, text), (9, "a " + text)])).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["n_removed"]) for r in got) == [(False, None, 0), (True, 7, 25), (True, 7, 25), (True, 9, 25)]
    assert substrings.remove_repeated_passages(documents([])).count() == 0


def test_chunks_keep_the_order_and_split_a_hot_id(documents, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 400)
    rows = [(None, f"null {i} " * 5) for i in range(80)] + [(50, f"hot {i} " * 6) for i in range(80)] + [(i, f"own {i} " * 5) for i in range(100)]
    for ranges in (10_000, 8):
        monkeypatch.setattr(chunks, "_RANGES", ranges)
        places = chunks.chunks_of(documents(rows), "doc_id", "text")
        texts = [t.encode() for _, t in rows]
        got = places.of(chunks.pa.array([i for i, _ in rows], chunks.pa.int64()), texts).tolist()
        order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, xxhash.xxh3_64_intdigest(texts[k])))
        assert [got[k] for k in order] == sorted(got)
        assert max(got.count(c) for c in set(got)) < 50 and len(set(got[80:160])) > 4 and len(set(got[:80])) > 4
    found = substrings.remove_repeated_passages(documents([(r, t * 10) for r, t in rows]))
    assert found.count() == len(rows)


def test_repeats_across_chunks_of_one_id(documents, monkeypatch):
    """Rows without an id in many chunks: each window stays once in all."""
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 500)
    text = " ".join(f"z{i}" for i in range(25))
    rows = [(None, f"n{i} {text} m{i}") for i in range(40)]
    got = substrings.remove_repeated_passages(documents(rows)).collect()
    assert sorted(r["n_removed"] for r in got) == [0] + [25] * 39


def test_equal_texts(documents, corpus):
    rows = corpus + [(i + 2000 if i else None, t) for i, t in EDGES]
    got = exact.mark_equal_texts(documents(rows)).collect()
    assert {tuple(r) for r in got} == equal_texts(rows) and len(got) == len(rows)


def test_one_row_of_equal_texts_stays(documents):
    rows = [(3, "a b"), (1, "a  b"), (1, "a\tb"), (2, "c"), (2, "d"), (None, "c"), (5, None), (4, "")]
    docs = documents(rows)
    got = exact.drop_equal_texts(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], exact_text(r["text"]), r["row"], r["key"]) for r in got.collect()) == [(1, "a b", "x", 1), (2, "c", "x", 1), (2, "d", "x", 1), (4, "", "x", 1)]
    assert exact.drop_equal_texts(documents([])).count() == 0 and exact.mark_equal_texts(documents([])).count() == 0


def exact_text(text):
    return " ".join((text or "").split())


def test_exact_plan_has_no_python(documents):
    plan = exact.mark_equal_texts(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shingles_equal_the_plain_ones(corpus):
    for _, t in corpus:
        assert len(jaccard.shingles((t or "").encode())) == len(shingles(t))


def test_all_links_are_found(documents, corpus):
    got = jaccard.similar_documents(documents(corpus)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == components(corpus)


def test_links_do_not_depend_on_how_documents_are_grouped(documents, corpus):
    rows = corpus[:70]
    got = jaccard.similar_documents(documents(rows), group_docs=1).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == components(rows)


def test_similar_rows_that_share_an_id_or_have_none(documents):
    rows = [(5, "a b c d e f"), (5, "x y"), (None, "A b C d e f"), (3, "x Y"), (2, ""), (2, None)]
    got = jaccard.similar_documents(documents(rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == [("2", 0, 2), ("2", 0, 2), ("3", 1, 3), ("5", 1, 3), ("5", 2, 5), ("None", 2, 5)]
    assert jaccard.similar_documents(documents([])).count() == 0
    kept = jaccard.one_of_each(documents([(4, "p q r s t u"), (6, "P q r s t u"), (7, None)]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 7] and "text_hash" in kept.columns


def test_connected_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(200, 200), (rng.randrange(300, 400), rng.randrange(300, 400))]
    pairs += [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in links.connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = {n: n for p in pairs for n in p if p[0] != p[1]}
    for _ in range(100):
        for a, b in pairs:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert links.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_texts_are_opened_a_piece_at_a_time(monkeypatch):
    """Batches of any size: the emitted sets are those of the whole batch, of whose texts only a piece is Python objects at a time."""
    rng = random.Random(8)
    texts = [None if i % 50 == 7 else " ".join(rng.choice("abcdef") for _ in range(rng.randrange(60))) for i in range(400)]
    batch = pa.record_batch({"id": pa.array(range(400), pa.int64()), "text": pa.array(texts, pa.string())})
    places = chunks.Chunks(np.array([100, 250], np.int64), 0, 399, 1, 4)
    opened, texts_of = [], chunks.texts_of
    monkeypatch.setattr(chunks, "_PIECE_BYTES", 500, raising=False)
    monkeypatch.setattr(chunks, "texts_of", lambda column: opened.append(sum(map(len, found := texts_of(column)))) or found)
    signed = pa.Table.from_batches(jaccard._sign(places, 5)([batch]))
    emitted = pa.Table.from_batches(jaccard._emit(places, 5)([batch]))
    assert max(opened) <= 500 + 120 and sum(opened) == 2 * sum(len(t or "") for t in texts)
    sets = [set(jaccard.shingles((t or "").encode(), 5).tolist()) for t in texts]
    assert signed["id"].to_pylist() == list(range(400)) and signed["n_shingles"].to_pylist() == [len(s) for s in sets]
    held = defaultdict(Counter)
    for i, s in enumerate(sets):
        held[(i > 100) + (i > 250)].update(s)
    got = defaultdict(dict)
    for number, hashes, counts in zip(*(emitted[c].to_pylist() for c in ("chunk", "hashes", "counts"))):
        got[number].update(zip(chunks.unpack(hashes).tolist(), counts))
    assert got == {number: {v: min(n, 255) for v, n in found.items()} for number, found in held.items()}


def test_memory_is_given_back_after_each_batch_and_at_the_end(monkeypatch):
    calls = []
    monkeypatch.setattr(chunks, "release", lambda: calls.append(1))
    assert list(chunks.released(lambda batches: (b + 1 for b in batches))([1, 2, 3])) == [2, 3, 4]
    assert len(calls) == 4
    assert chunks.released_group(len)([1, 2]) == 2 and chunks.released_pair(max)(3, 5) == 5
    assert len(calls) == 6
