import random
import re
from collections import Counter

import numpy as np
import pytest

from tsengine.llm import phrases


def counted(texts, most=3):
    """{words: occurrences} by loops."""
    out = Counter()
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, most + 1):
                out.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return out


def report(rows, least, most=3, inside=50, top=2000):
    out = []
    for lang in {r[0] or "und" for r in rows}:
        f = counted([t for g, t in rows if (g or "und") == lang], most)
        n = sum(c for w, c in f.items() if len(w) == 1)
        often = {w: c for w, c in f.items() if c >= least and len(w) > 1}
        found = []
        for w, a in often.items():
            cuts = [(10**6 * a * a // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            around = [c for v, c in often.items() if len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
            if not any(100 * c >= inside * a for c in around):
                found.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus():
    rng = random.Random(5)
    words = "New york The of und é Ü x\x00y a-b 'q' 3.5".split(" ")
    rows = [(rng.choice(["en", "de", None]), rng.choice([" ", "  ", "\t"]).join(rng.choice(words) + rng.choice(["", "", "", ",", ".", "\n", "!?"]) for _ in range(rng.randrange(60)))) for _ in range(80)]
    return rows + [("en", None), ("en", ""), (None, " \n. ,"), ("fr", "mon ami " * 4000), ("en", "New York city " * 30), ("it", "...")]


@pytest.mark.parametrize("most", [1, 2, 3, 5])
def test_index_counts_all_phrases(most):
    for seed, vocabulary in ((1, 3), (2, 40)):
        rng = random.Random(seed)
        texts = [" ".join(rng.choice([f"w{rng.randrange(vocabulary)}", "."]) for _ in range(rng.randrange(50))) for _ in range(12)]
        fm = phrases.FMIndex.build([phrases.words_of(t.encode()) for t in texts], most)
        got = {}
        for ids, n in fm.phrases(most):
            got |= dict(zip((tuple(t.split(" ")) for t in fm.texts(ids).to_pylist()), n.tolist(), strict=True))
        assert got == counted(texts, most)
    empty = phrases.FMIndex.build([[b"."]], most)
    assert all(len(n) == 0 for _, n in empty.phrases(most))


def test_intervals_of_both_sides_stay_together():
    """An interval of one transform and that of the other name the same phrase: ranks of each agree with a scan."""
    fm = phrases.FMIndex.build([[b"a", b"b", b"a", b"b", b".", b"b", b"a"]], 3)
    ranks = fm.ranks(fm.after)
    starts = np.concatenate(([0], np.cumsum(np.bincount(fm.after))))
    for c in range(3):
        for row in range(len(fm.after) + 1):
            assert np.searchsorted(ranks, c * len(fm.after) + row) == starts[c] + (fm.after[:row] == c).sum()


@pytest.mark.parametrize("shard_bytes", [300, 1 << 23])
def test_collocations_equal_loops(spark, shard_bytes):
    rows = corpus()
    docs = spark.createDataFrame([(g, t, "x", 1, "r") for g, t in rows], "lang string, text string, phrase string, n int, row string").repartition(3)
    got = phrases.best_collocations(phrases.collocations(docs, shard_bytes=shard_bytes)).collect()
    assert sorted(map(tuple, got)) == report(rows, 10)
    few = phrases.best_collocations(phrases.collocations(docs, least=3, shard_bytes=shard_bytes), top=7).collect()
    assert sorted(map(tuple, few)) == report(rows, 3, top=7)


def test_products_beyond_64_bits_and_empty_tables(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).count() == 0
    with pytest.raises(ValueError):
        phrases.frequent_phrases(phrases.shards_of(empty), least=300)
    big = spark.createDataFrame([("en", "a b " * 6_000_000)], "lang string, text string")
    got = phrases.best_collocations(phrases.collocations(big)).collect()
    a = 6_000_000
    want = [("en", 1, "a b a", a - 1, a, a - 1, 2 * a, 999_999), ("en", 2, "b a b", a - 1, a, a, 2 * a, 999_999)]
    assert sorted(map(tuple, got)) == want
