import hashlib
import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from brute import WORD, nearest
from pyspark.sql import functions as F

from check import TABLES, difference
from tsengine.llm import mixture, neighbours, queries, sharding

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert difference(got, db.execute(queries.ORACLES[name]).fetchdf()) == ""


def bits(text):
    return bin(int(hashlib.md5(text.encode()).hexdigest()[:16], 16))[2:].zfill(64)


def test_shards_fit_and_follow_the_hash(documents):
    rng = random.Random(1)
    rows = [(i, "ä" * rng.randrange(200)) for i in range(500)] + [(900, "x" * 5000), (901, None), (None, "y"), (None, None)] + [(77, "z" * 90)] * 40
    got = sharding.assign_shards(documents(rows).repartition(4), max_bytes=1000).collect()
    assert len(got) == len(rows)
    members = defaultdict(list)
    for r in got:
        members[r["shard"]].append(r)
        assert len(r["shard"]) == r["depth"] and (bits("" if r["doc_id"] is None else str(r["doc_id"]))).startswith(r["shard"][:64])
    for shard, inside in members.items():
        size = sum(r["n_bytes"] for r in inside)
        assert {(r["shard_bytes"], r["shard_rows"]) for r in inside} == {(size, len(inside))}
        assert size <= 1000 or len(inside) == 1
    names = sorted(members)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    start = math.ceil(math.log2(sum(r["n_bytes"] for r in got) / 1000))
    for shard in names:  # split only if the shard above was too large
        if len(shard) > start:
            above = [r for r in got if r["shard"].startswith(shard[:-1])]
            assert sum(r["n_bytes"] for r in above) > 1000 or any(len(r["shard"]) == len(shard) for r in above) and len(above) < 2
    assert sharding.assign_shards(documents([])).count() == 0
    assert sharding.directory(sharding.assign_shards(documents(rows), max_bytes=10**9)).collect()[0]["shard_rows"] == len(rows)


def shared_out(budget, children):
    """Water filling by repeated rounds: {name: amount}."""
    given = dict.fromkeys(children, 0.0)
    open_ = {n for n, (w, c) in children.items() if w > 0 and c > 0}
    while budget > 1e-9 and open_:
        weights = sum(children[n][0] for n in open_)
        step = min([budget / weights] + [(children[n][1] - given[n]) / children[n][0] for n in open_])
        for n in open_:
            given[n] += step * children[n][0]
        budget -= step * weights
        open_ = {n for n in open_ if children[n][1] - given[n] > 1e-9}
    return given


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = {("a", "en", "s1"): 10, ("a", "en", "s2"): 1000, ("a", "de", "s1"): 30, ("b", "en", "s3"): 500, ("b", None, None): 200, ("c", "en", "s9"): 0}
    mix = mixture.Mixture({"domain": {"a": 3, "b": 1}, "lang": {"de": 2, "en": 1}}, share=0.5, epochs=2)
    frame = spark.createDataFrame([(*k, n) for k, n in leaves.items()], "domain string, lang string, source string, tokens bigint")
    got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixture.leaf_budgets(frame, mix).collect()}

    def below(prefix):
        return sum(2 * n for k, n in leaves.items() if k[: len(prefix)] == prefix)

    def down(prefix, budget):
        if len(prefix) == 3:
            return {prefix: math.floor(round(budget, 3))}
        names = {k[len(prefix)] for k in leaves if k[: len(prefix)] == prefix}
        weights = mix.weights.get(mixture.LEVELS[len(prefix)], {})
        shares = shared_out(budget, {n: (weights.get(n, mix.other), below((*prefix, n))) for n in names})
        return {k: v for n in names for k, v in down((*prefix, n), math.floor(round(shares[n], 3))).items()}

    assert got == down((), sum(leaves.values()) // 2)
    assert got["a", "de", "s1"] == 60 and got["a", "en", "s1"] == 20  # filled up; the sibling s2 takes the rest of en


def test_mixture_draws_a_prefix_of_each_leaf(documents):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(30)) for i in range(300)] + [(400, None), (401, "")]
    mix = mixture.Mixture({"source": {"src0": 5, "src1": 1, "src2": 0.2}}, share=0.8, epochs=3, seed=9)
    docs = documents(rows)
    got = mixture.mix_sources(docs, mix, F.lit("all")).collect()
    drawn = defaultdict(int)
    for r in got:
        drawn[r["row"]["doc_id"]] += 1
        assert r["row"].asDict().keys() == set(docs.columns)
    words = {i: len(WORD.findall(t or "")) for i, t in rows}
    leaf = {s: [i for i in words if i % 3 == s] for s in range(3)}
    supply = {s: sum(words[i] for i in ids) for s, ids in leaf.items()}
    budget = shared_out(math.floor(sum(supply.values()) * 0.8), {s: (w, 3 * supply[s]) for s, w in ((0, 5), (1, 1), (2, 0.2))})
    for s, ids in leaf.items():
        epochs, part = divmod(math.floor(round(budget[s], 3)), supply[s])
        order = sorted(ids, key=lambda i: hashlib.md5(f"9:{epochs}:{i}".encode()).hexdigest())
        want, before = {}, 0
        for i in order:
            want[i] = epochs + (before < part)
            before += words[i]
        assert {i: drawn[i] for i in ids} == want
    assert mixture.mix_sources(documents([]), mix, F.lit("all")).count() == 0


def embeddings(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id bigint, embedding array<float>, code string, block int")


def test_neighbours_are_found(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 24))
    data = (centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 24))).astype(np.float32)
    got = neighbours.nearest(embeddings(spark, list(enumerate(data.tolist()))), F.col("vec_id") % 20 == 0, k=20)
    found = defaultdict(dict)
    for r in got.collect():
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    exact = data.astype(float)
    hits = 0
    for q in range(0, 3000, 20):
        scores = exact @ exact[q]
        want = [i for i in np.lexsort((np.arange(3000), -scores)) if i != q][:20]
        assert sorted(found[q]) == list(range(1, 21))
        hits += len({i for i, _ in found[q].values()} & set(want))
        assert np.allclose([s for _, s in found[q].values()], [scores[i] for i, _ in found[q].values()], rtol=1e-12)
    assert hits >= 0.99 * 20 * 150


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (5, [1.0, 2.0]), (4, [1.0, 2.0]), (7, [-1.0, 0.0]), (40, None), (60, []), (80, [0.0, 0.0]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [None, 1.0]), (12, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (13, [0.5, 0.0])]
    got = neighbours.nearest(embeddings(spark, vectors), F.col("vec_id") % 20 == 0, k=3)
    want = nearest([0, 20, 5, 4, 7, 13], [[1, 2], [1, 2], [1, 2], [1, 2], [-1, 0], [0.5, 0]], [0, 20], 3)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()) == want
    assert neighbours.nearest(embeddings(spark, vectors), F.col("vec_id") % 20 == 0, k=50).where("query_id = 0").count() == 5
    assert neighbours.nearest(embeddings(spark, []), F.lit(True)).count() == 0
    repeated = neighbours.nearest(embeddings(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0])]), F.col("vec_id") == 0, k=9)
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in repeated.collect()) == [(1, 1, 2.0), (2, 1, 2.0)]


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(2)
    data, queries_ = rng.normal(size=(500, 48)), rng.normal(size=(70, 48))
    turn, centre = neighbours.rotation(48), data.mean(axis=0)
    assert np.allclose(turn @ turn.T, np.eye(48))
    about, error = neighbours.estimates(*neighbours.codes(data, centre, turn), queries_, centre, turn, 4.0)
    off = np.abs(about - data @ queries_.T)
    assert (off <= error + 1e-4).mean() > 0.999 and off.mean() < error.mean() / 3


def test_nearest_of_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(60)] + [(i, rng.normal(size=2).tolist()) for i in range(60, 100)] + [(100, [1.0]), (101, None), (102, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()}
    want = set()
    for low, high in ((0, 60), (60, 100)):
        ids, vectors = zip(*rows[low:high])
        want |= set(nearest(list(ids), [np.array(v) for v in vectors], [i for i in ids if i % 20 == 0], 20))
    assert got == want
