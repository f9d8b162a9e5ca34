import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tsengine.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    big_n, big_l = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(w for _, c in counts for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in asked.items():
        found = []
        for (i, c), n in zip(counts, lengths):
            score = 0
            for w in words:
                if c[w]:
                    m = 100 - 90 + 90 * n * big_n // big_l
                    score += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out += [(item, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def corpus(seed, n=250):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "-X", "'é", " Ü9"]) for _ in range(rng.randrange(80)))) for i in range(n)]
    docs += [(i + 1000, t) for i, t in docs[:40]]  # equal scores
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(12)))) for k in range(30)]
    return docs + [(5000, None), (5001, ""), (5002, "w1 " * 30_000), (None, "w1 w2"), (None, "w1 w2"), (5003, " .,;")], items + [(90, None), (91, "unknownword"), (92, "W1 w1 w2"), (92, "w3"), (None, "w2 w5")]


@pytest.mark.parametrize("shard_bytes", [400, 1 << 24])
def test_best_documents_equal_loops(spark, documents, monkeypatch, shard_bytes):
    docs, items = corpus(1)
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, term int, key string")
    got = ranked.rank_documents(documents(docs).repartition(4), table, shard_bytes=shard_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)
    monkeypatch.setattr(ranked, "TERMS_AT_ONCE", 40)
    got = ranked.rank_documents(documents(docs), table, top=3, shard_bytes=shard_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items, 3)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert ranked.rank_documents(documents([]), items).count() == 0
    assert ranked.rank_documents(documents([(1, "a")]), items.where("false")).count() == 0
    assert ranked.rank_documents(documents([(1, None), (2, "c")]), items).count() == 0


def shard_index(rng, docs=400, terms=8):
    lists = {t: np.sort(rng.choice(docs, rng.integers(1, docs), replace=False)).astype(np.int32) for t in range(terms)}
    impacts = {t: rng.integers(1, 50, len(d)).astype(np.int32) for t, d in lists.items()}
    weights = {t: int(rng.integers(1, 90)) for t in lists}
    order = sorted(lists, key=lambda t: (-weights[t], t))
    row = {"ids": rng.permutation(docs).astype(np.int64).tobytes(), "a": [], "b": [], "sizes": [], "most": [], "docs": b"", "impacts": b""}

    def add(a, b, d, x, most):
        for name, v in (("a", a), ("b", b), ("sizes", len(d)), ("most", most)):
            row[name].append(v)
        row["docs"] += d.tobytes()
        row["impacts"] += x.tobytes()

    for t in lists:
        add(t, None, lists[t], impacts[t], weights[t] * int(impacts[t].max()))
    for a, b in zip(order, order[1:]):
        both, i, j = np.intersect1d(lists[a], lists[b], return_indices=True)
        together = weights[a] * impacts[a][i] + weights[b] * impacts[b][j]
        add(a, b, both[np.argsort(-together)].astype(np.int32), np.empty(0, np.int32), int(together.max(initial=0)))
    return ranked.ShardIndex(row, weights), order


def test_bounds_hold_and_pairs_tighten_them():
    rng = np.random.default_rng(2)
    tighter = 0
    for _ in range(20):
        shard, order = shard_index(rng)
        bounds = shard.bounds(order)
        for i in range(len(order)):
            docs = np.arange(400, dtype=np.int32)
            assert shard.scores(order[i:], docs).max() <= bounds[i] <= sum(shard.most[t] for t in order[i:])
            tighter += bounds[i] < sum(shard.most[t] for t in order[i:])
        full = shard.scores(order, np.arange(400, dtype=np.int32))
        want = sorted(((-s, i) for s, i in zip(full.tolist(), shard.ids.tolist()) if s > 0))[:10]
        ids, scores = shard.best(order, 10)
        assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want
    assert tighter > 20


def test_bound_of_a_pair_passes_32_bits():
    weights, docs = {1: 4897, 2: 4387}, np.arange(3, dtype=np.int32)
    values = [0, np.arange(3).tobytes(), np.array([20, 30, 40]).tobytes(), 200, 80_000, [1, 2], [3, 3], np.tile(docs, 2).tobytes(), np.array([1, 2, 3, 9, 8, 7], np.int32).tobytes()]
    (index,) = ranked._index([(7, [1, 2])], weights, 200, 80_000)([ranked._row(values, ranked._SHARDS)])
    shard = ranked.ShardIndex(index.to_pylist()[0], weights)
    full = shard.scores([1, 2], docs)
    assert shard.most[2] > 2**31 and shard.joint[1, 2] == full.max()
    assert shard.pairs[1, 2].tolist() == np.argsort(-full, kind="stable").tolist()
