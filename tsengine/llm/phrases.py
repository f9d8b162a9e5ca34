"""Operator 12: phrases that occur more often than their parts suggest, from an FM-index per shard over word ids."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsengine.llm import chunks
from tsengine.session import materialize

#: Words of a phrase at most, and occurrences from which it is a candidate.
MOST_WORDS = 3
LEAST = 10
#: A phrase goes if a longer one around it occurs at least this often, in percent of its own occurrences.
INSIDE_PERCENT = 50
#: Phrases in the report of each language.
TOP = 2000
#: Language of rows without one.
NO_LANG = "und"
#: Bytes of one language's texts in a shard, unless one document has more.
SHARD_BYTES = 6 << 20
#: Bits of a phrase's hash. Equal hashes only bring a phrase to the exact count that needs none; no phrase is lost.
_HASH_BITS = 48
_BUCKET_BYTES = 32 << 20

_PIECE_ENDS = re.compile(rb"[.,;:!?\n-\r]+")
_SHARDS = "shard bigint, lang string, n bigint, rows bigint, words binary, before binary, after binary"
_BLOBS = "bucket int, shard bigint, hashes binary, counts binary"
_REPLY = "shard bigint, hashes binary"
_FOUND = "lang string, phrase string, size int, found bigint"


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased words between blanks; ``.`` stands between pieces."""
    return _PIECE_ENDS.sub(b" . ", text.lower()).split()


def _order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``ids`` in the order of their first ``depth`` symbols or more: ranks of one length give those of twice the length."""
    rank, span = ids.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -span) if span < depth else rank
        order = np.argsort(key, kind="stable")
        span *= 2
        if span >= depth:
            return order
        rank[order] = np.cumsum(np.diff(key[order], prepend=-1) != 0)


@dataclass
class FMIndex:
    """Both Burrows-Wheeler transforms of a sequence of word ids, sorted as deep as phrases are long.

    Id 0 ends a piece; ``words[i - 1]`` is the word of id ``i``. ``before`` has for each row of the sorted sequence the id in front of it, ``after`` for
    each row of the sorted reversed sequence the id that follows in the text. A phrase is an interval of rows of the same size in both.
    """

    words: list[bytes]
    before: np.ndarray
    after: np.ndarray

    @classmethod
    def build(cls, texts: Iterable[list[bytes]], depth: int = MOST_WORDS) -> FMIndex:
        known: dict[bytes, int] = {b".": 0}
        ids = [0]
        for words in texts:
            ids += [known.setdefault(w, len(known)) for w in words]
            ids.append(0)
        s = np.array(ids, np.int32)
        # Ids by falling frequency: most are small, and their higher bytes pack well.
        falling = 1 + np.argsort(-np.bincount(s, minlength=len(known))[1:], kind="stable")
        new = np.zeros(len(known), np.int32)
        new[falling] = np.arange(1, len(known))
        s, words = new[s], list(known)
        r = s[::-1]
        return cls([words[i] for i in falling.tolist()], s[_order(s, depth) - 1], r[_order(r, depth) - 1])

    def ranks(self, transform: np.ndarray) -> np.ndarray:
        """``(id, row)`` of the transform in order: how often an id stands above a row is one search."""
        rows = np.argsort(transform, kind="stable")
        return transform[rows].astype(np.int64) * len(rows) + rows

    def phrases(self, most: int = MOST_WORDS):
        """``(ids, counts)`` of all phrases of 1 to ``most`` words: one row of word ids and how often they occur in a row within a piece.

        An interval grows by one word on one side: the ids in its rows of that side's transform are the extensions with their counts,
        the rank of an id gives the new interval there, and the number of smaller ids moves the interval of the other side. Words grow
        to the right and left in turn.
        """
        sizes = np.bincount(self.before, minlength=len(self.words) + 1)
        starts = np.cumsum(sizes) - sizes
        ids = np.arange(1, len(sizes))[:, None]
        size, front, back = sizes[1:], starts[1:], starts[1:]
        yield ids, size
        for length in range(2, most + 1):
            right = length % 2 == 0
            transform = self.after if right else self.before
            near, far = (back, front) if right else (front, back)
            parent, symbol, smaller, size = _extensions(transform, near, size, len(sizes))
            ids = np.column_stack((ids[parent], symbol) if right else (symbol, ids[parent]))
            yield ids, size
            if length < most:
                near = np.searchsorted(self.ranks(transform), symbol * len(transform) + near[parent])
                far = far[parent] + smaller
                front, back = (far, near) if right else (near, far)

    def texts(self, ids: np.ndarray) -> pa.Array:
        words = pa.array(self.words, pa.binary())
        return pc.binary_join_element_wise(*[words.take(pa.array(c - 1)) for c in ids.T], b" ").cast(pa.string())


def _extensions(transform: np.ndarray, low: np.ndarray, size: np.ndarray, symbols: int):
    """Of each interval ``(parent, id, rows with a smaller id, count)`` of the ids in it but 0."""
    ends = np.cumsum(size)
    begins = ends - size
    parent = np.repeat(np.arange(len(size)), size)
    rows = np.arange(len(parent)) + np.repeat(low - begins, size)
    key = np.sort(parent * symbols + transform[rows])
    first = np.flatnonzero(np.diff(key, prepend=-1))
    count = np.diff(np.append(first, len(key)))
    parent, symbol = np.divmod(key[first], symbols)
    word = symbol > 0
    return parent[word], symbol[word], (first - begins[parent])[word], count[word]


def _packed(a: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next, compressed."""
    return pa.compress(a.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _build(shard_bytes: int, depth: int):
    """Documents ``(lang, text)`` of a task to one index per language and ``shard_bytes`` of text."""

    def build(batches):
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def index(lang: str):
            nonlocal number
            fm = FMIndex.build(map(words_of, held.pop(lang)), depth)
            number += 1
            row = {"shard": [number - 1], "lang": [lang], "n": [int(np.count_nonzero(fm.before))], "rows": [len(fm.before)], "words": [b"\n".join(fm.words)], "before": [_packed(fm.before)], "after": [_packed(fm.after)]}
            sizes[lang] = 0
            return pa.record_batch([pa.array(v, pa.binary() if isinstance(v[0], bytes) else None) for v in row.values()], list(row))

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, chunks.texts_of(batch.column(1)), strict=True):
                if text:
                    held.setdefault(lang, []).append(text)
                    sizes[lang] = sizes.get(lang, 0) + len(text)
                    if sizes[lang] >= shard_bytes:
                        yield index(lang)
        for lang in sorted(held):
            yield index(lang)

    return build


def _opened(row: dict) -> FMIndex:
    words = row["words"].split(b"\n") if row["words"] else []
    return FMIndex(words, _unpacked(row["before"], row["rows"]), _unpacked(row["after"], row["rows"]))


def _hashes(lang: str, fm: FMIndex, ids: np.ndarray) -> np.ndarray:
    own = np.array([xxhash.xxh3_64_intdigest(w) for w in fm.words], np.uint64)
    total = np.full(len(ids), xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
    for column in ids.T:
        total = chunks.mix(total + np.uint64(0x9E3779B97F4A7C15)) ^ own[column - 1]
    return chunks.mix(total) >> np.uint64(64 - _HASH_BITS)


def _counted(buckets: int, most: int, least: int):
    """Of each shard the hashes of its phrases, packed by hash range, and how often each occurs, up to ``least``."""

    def count(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                fm = _opened(row)
                parts = [(_hashes(row["lang"], fm, ids), np.minimum(n, least).astype(np.uint8)) for ids, n in fm.phrases(most)]
                values, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
                order = np.argsort(values)
                values, counts = values[order] << np.uint64(64 - _HASH_BITS), counts[order]
                first = np.flatnonzero(np.diff(values, prepend=values[:1] + np.uint64(1)))
                if len(first) < len(values):  # equal hashes of one shard
                    counts = np.minimum(np.add.reduceat(counts, first, dtype=np.int64), least).astype(np.uint8)
                    values = values[first]
                blobs = [(b, chunks.pack(values[s] >> np.uint64(64 - _HASH_BITS)), counts[s].tobytes()) for b, s in chunks.by_bucket(values, buckets)]
                yield pa.record_batch(
                    {
                        "bucket": pa.array([b[0] for b in blobs], pa.int32()),
                        "shard": pa.array([row["shard"]] * len(blobs), pa.int64()),
                        "hashes": pa.array([b[1] for b in blobs], pa.binary()),
                        "counts": pa.array([b[2] for b in blobs], pa.binary()),
                    }
                )

    return count


def _frequent(least: int):
    """Of one hash range: for each shard its hashes that occur ``least`` times in all shards together."""

    def pick(table: pa.Table) -> pa.Table:
        parts = [chunks.unpack(b) for b in table["hashes"].to_pylist()]
        shard = np.repeat(table["shard"].to_numpy(), [len(p) for p in parts])
        values = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(b, np.uint8) for b in table["counts"].to_pylist()])
        del parts
        order = np.argsort(values, kind="stable")
        values, shard, counts = values[order], shard[order], counts[order]
        first = np.flatnonzero(np.diff(values, prepend=values[:1] + np.uint64(1)))
        often = np.add.reduceat(counts, first, dtype=np.int64) >= least
        keep = np.repeat(often, np.diff(np.append(first, len(values))))
        values, shard = values[keep], shard[keep]
        order = np.argsort(shard, kind="stable")
        values, shard = values[order], shard[order]
        numbers, begin = np.unique(shard, return_index=True)
        blobs = [chunks.pack(v) for v in np.split(values, begin[1:])] if len(numbers) else []
        return pa.table({"shard": pa.array(numbers, pa.int64()), "hashes": pa.array(blobs, pa.binary())})

    return pick


def _spelled(most: int):
    """Of one shard its phrases whose hash is frequent, with their counts."""

    def spell(shard: pa.Table, reply: pa.Table) -> pa.Table:
        out = []
        known = np.sort(np.concatenate([chunks.unpack(b) for b in reply["hashes"].to_pylist()] or [np.empty(0, np.uint64)]))
        for i in range(shard.num_rows if len(known) else 0):
            row = shard.slice(i, 1).to_pylist()[0]
            fm = _opened(row)
            for ids, n in fm.phrases(most):
                values = _hashes(row["lang"], fm, ids)
                chosen = known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values
                ids, n = ids[chosen], n[chosen]
                if len(n):
                    out.append([pa.array([row["lang"]] * len(n)), fm.texts(ids), pa.array(np.full(len(n), ids.shape[1], np.int32)), pa.array(n.astype(np.int64))])
        names, types = [c.split()[0] for c in _FOUND.split(", ")], [pa.string(), pa.string(), pa.int32(), pa.int64()]
        return pa.Table.from_batches([pa.record_batch(columns, names) for columns in out], pa.schema(list(zip(names, types, strict=True))))

    return spell


def shards_of(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", shard_bytes: int = SHARD_BYTES, most: int = MOST_WORDS) -> DataFrame:
    """The written index: one row per shard, a share of one language's documents of one task."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    return materialize(rows.mapInArrow(_build(shard_bytes, most), _SHARDS), "phrase-index")


def frequent_phrases(shards: DataFrame, least: int = LEAST, most: int = MOST_WORDS) -> DataFrame:
    """``(lang, phrase, size, found)`` of all phrases of 1 to ``most`` words that occur ``least`` times (at most 255).

    Each shard sends hashes of its phrases with counts; ranges of hashes add them up and tell each shard which of its hashes are frequent. These the shard
    spells out of its index, and their counts are added up by the words themselves, so equal hashes change nothing.
    """
    if not 1 <= least <= 255:
        raise ValueError("least must lie between 1 and 255")
    words = shards.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = chunks.buckets_of(max(1, math.ceil(9 * most * words / _BUCKET_BYTES)))
    blobs = shards.mapInArrow(_counted(buckets, most, least), _BLOBS)
    reply = blobs.groupBy("bucket").applyInArrow(_frequent(least), _REPLY)
    spelled = shards.groupBy("shard").cogroup(reply.groupBy("shard")).applyInArrow(_spelled(most), _FOUND)
    return spelled.groupBy("lang", "phrase", "size").agg(F.sum("found").alias("found")).where(F.col("found") >= least)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, most: int = MOST_WORDS, inside_percent: int = INSIDE_PERCENT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(lang, phrase, size, a, l, r, n, score)`` of the phrases of 2 to ``most`` words that occur ``least`` times and are not part of a longer one.

    A text is cut at ``.,;:!?`` and line ends into pieces, these at blanks into words. ``a`` counts all occurrences of the phrase within pieces, ``l`` and ``r``
    those of its two parts at the cut where ``floor(1000000 * a * a / (l * r))`` is least (of equal scores the earliest cut), ``n`` all words of the language.
    A phrase is left out if its words lie in a row inside a longer frequent phrase with ``100 * found >= inside_percent * a``, left out or not.
    Products are decimals of 38 digits.

    Null texts and texts without words count nothing; a null language is ``und``. Repeated rows count each. An empty table gives no row.
    Other columns are not read. Scores are by language, so the same phrase may be in several.
    """
    shards = shards_of(docs, lang_col, text_col, shard_bytes, most)
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    counted = materialize(frequent_phrases(shards, least, most), "phrase-counts")
    candidates = counted.where("size > 1").withColumnRenamed("found", "a")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    words = F.split("phrase", " ")
    cuts = cuts.withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counted.select("lang", F.col("phrase").alias(side), F.col("found").alias(name)), ["lang", side])
    wide = [f"cast({c} as decimal(19,0))" for c in ("a", "l", "r")]
    score = F.expr(f"cast({wide[0]} * {wide[0]} as decimal(31,0)) * 1000000 div ({wide[1]} * {wide[2]})").alias("score")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score, "k", "l", "r")).alias("cut"))
    longer = counted.where("size > 2").withColumn("words", words)
    spans = longer.select("lang", "words", "found", F.col("size").alias("of"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("size"))
    spans = spans.select("lang", "words", "found", "size", F.explode(F.expr("sequence(1, of - size + 1)")).alias("at"))
    around = spans.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), "found").groupBy("lang", "phrase").agg(F.max("found").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.expr(f"around is null or 100 * around < {inside_percent} * a"))
    return kept.join(totals, "lang").select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def best_collocations(found: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language, by score, occurrences and the bytes of the phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
