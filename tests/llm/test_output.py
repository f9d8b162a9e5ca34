import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tsengine.llm import packing, token_output, tokens
from tsengine.llm.queries import vocabulary

TEXTS = ["Hello  world\n", "", None, "it's 12 o'clock…\t\t", "naïve ß 漢字 🙂", "a" * 3000, " ".join(f"word{i}" for i in range(4000)), "<|endoftext|> x", "\x00\x1f"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    long = [" ".join(rng.choice(["the", "quick", "Brown", "fox,", "ÄÖ", "42"]) for _ in range(rng.choice([3, 90, 400, 900, 2500]))) for _ in range(120)]
    return list(enumerate(TEXTS + long)) + [(3, "again"), (None, "null id")]


def test_ids_equal_the_tokenizer_s(reference, rows):
    for _, t in rows:
        assert tokens.token_ids(t, vocabulary()).tolist() == reference(t)


def test_packed_documents(documents, reference, rows):
    got = packing.pack_documents(documents(rows).repartition(5), vocabulary(), keep_ids=True).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append((r["start"], r["piece"], ids.tolist()))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 1024
    for i, t in rows:
        if i == 3:  # two rows
            continue
        pieces = sorted(docs[i])
        assert [x for p in pieces for x in p[2]] == reference(t)
        assert [p[1] for p in pieces] == list(range(len(pieces))) and all(len(p[2]) == 1024 for p in pieces[1:])
    total = sum(len(reference(t)) for _, t in rows)
    assert len(sequences) <= 1.03 * total / 1024 + 1
    assert packing.pack_documents(documents([]), vocabulary()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_and_wastes_little(seed):
    rng = random.Random(seed)
    kind = [lambda: rng.randrange(1, 1024), lambda: rng.choice([341, 342, 512, 513]), lambda: rng.randrange(300, 700), lambda: rng.randrange(1, 50), lambda: 1023, lambda: rng.choice([1, 600])][seed]
    counts = Counter(kind() for _ in range(4000))
    plan = packing.plan_sequences(counts)
    filled, given = defaultdict(list), defaultdict(list)
    for length, first, end, sequence, offset in plan.rules:
        given[length] += range(first, end)
        for i in range(end - first):
            filled[sequence + i].append((offset, length))
    assert {n: sorted(g) for n, g in given.items()} == {n: list(range(c)) for n, c in counts.items()}
    for members in filled.values():
        ends = [o + n for o, n in sorted(members)]
        assert [o for o, _ in sorted(members)] == [0, *ends[:-1]] and ends[-1] <= 1024
    simple = packing.Plan(1024)
    for length in sorted(counts, reverse=True):
        simple.fit(length, counts[length])
    assert len(filled) == plan.sequences <= 1.01 * simple.sequences + 1
    assert packing.plan_sequences({}).sequences == 0


def test_groups_hold_equally_many():
    counts = Counter({100: 5, 200: 50, 300: 7, 400: 38})
    parts = packing.grouped(counts, 10)
    assert [c for _, _, c in parts] == [10] * 10 and parts[0][1] == 400 and parts[-1][0] == 100


def test_best_fit_with_the_tree_equals_a_plain_search():
    rng = random.Random(5)
    for _ in range(50):
        lengths = [rng.randrange(1, 101) for _ in range(rng.randrange(60))]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 100) - n)
        got = token_output.best_fit_decreasing(lengths, 100)
        assert sorted(100 - sum(lengths[i] for i in s) for s in got) == sorted(rooms)
        assert sorted(i for s in got for i in s) == list(range(len(lengths)))


def test_matrices_read_back_whole(documents, reference, rows):
    got = token_output.write_matrices(documents(rows).repartition(3), vocabulary()).collect()
    docs = defaultdict(list)
    for m in got:
        ids = np.frombuffer(m["ids"], "<u4").reshape(m["n_rows"], 1024)
        positions = np.frombuffer(m["positions"], "<u4").reshape(m["n_rows"], 1024)
        ends, k = m["cu_seqlens"], 0
        assert ends[0] == 0 and ends[-1] == m["n_tokens"] and sum(m["row_segments"]) == len(m["doc_ids"]) == len(ends) - 1
        for row, segments in enumerate(m["row_segments"]):
            at = 0
            for _ in range(segments):
                n = ends[k + 1] - ends[k]
                assert positions[row, at : at + n].tolist() == list(range(n))
                docs[m["doc_ids"][k]].append((m["starts"][k], m["pieces"][k], ids[row, at : at + n].tolist()))
                at, k = at + n, k + 1
            assert not ids[row, at:].any() and not positions[row, at:].any()
    for i, t in rows:
        if i != 3:
            assert [x for p in sorted(docs[i]) for x in p[2]] == reference(t)
    assert len({m["matrix_id"] for m in got}) == len(got)
    assert token_output.write_matrices(documents([]), vocabulary()).count() == 0


def test_a_file_of_matrices_is_opened_one_at_a_time(documents, tmp_path):
    rows = [(i, " a" * (token_output.BLOCK_TOKENS // 2)) for i in range(5)]
    got = token_output.write_matrices(documents(rows).coalesce(1), vocabulary(), str(tmp_path / "matrices"))
    files = [pq.ParquetFile(f).metadata for f in sorted((tmp_path / "matrices").glob("*.parquet"))]
    assert [[m.row_group(g).num_rows for g in range(m.num_row_groups)] for m in files if m.num_rows] == [[1, 1, 1]]
    assert sorted(tuple(r) for r in got.select("matrix_id", "n_tokens").collect()) == [(f"000000-{i:06d}", n * (token_output.BLOCK_TOKENS // 2 + 1)) for i, n in enumerate((2, 2, 1))]
