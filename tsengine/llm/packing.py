"""Operator 9: documents into as few sequences as possible, by linear grouping of lengths and configurations of few sizes."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsengine.llm.tokens import END_ID, MAX_TOKENS, token_pieces
from tsengine.session import materialize

#: Lengths over this share of a sequence are large: grouped, rounded up and set in configurations.
LARGE = 1 / 16
#: Groups of equally many large pieces; each group counts as its longest length.
GROUPS = 96
#: Columns that the configuration problem may take in; it ends sooner when no column helps.
_ROUNDS = 4000


class Lengths:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.left = {n: c for n, c in counts.items() if c}
        self.sorted = sorted(self.left)

    def give_back(self, length: int, n: int) -> None:
        if length not in self.left:
            insort(self.sorted, length)
            self.left[length] = 0
        self.left[length] += n

    def take(self, least: int, most: int, n: int) -> list[tuple[int, int]]:
        """The longest ``n`` pieces of ``least`` to ``most`` tokens, as runs of one length; fewer if there are no more."""
        out = []
        while n and (at := bisect_right(self.sorted, most)) and self.sorted[at - 1] >= least:
            length = self.sorted[at - 1]
            used = min(n, self.left[length])
            out.append((length, used))
            n -= used
            self.left[length] -= used
            if not self.left[length]:
                del self.left[length]
                self.sorted.pop(at - 1)
        return out


def grouped(counts: dict[int, int], groups: int) -> list[tuple[int, int, int]]:
    """``(shortest length, longest length, pieces)`` of ``groups`` parts of equally many pieces, longest first (the first ones may hold one more)."""
    pool, left, out = Lengths(counts), sum(counts.values()), []
    for i in range(groups):
        size = -(-left // (groups - i))
        left -= size
        if part := pool.take(1, max(counts), size):
            out.append((part[-1][0], part[0][0], size))
    return out


def _best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack: how often each size, so that the sizes fit and their prices sum to the most."""
    best, used = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    least = int(sizes.min())
    for room in range(least, capacity + 1):
        rest = room - sizes
        value = np.where(rest >= 0, best[np.maximum(rest, 0)] + prices, -1.0)
        at = int(value.argmax())
        best[room], used[room] = best[room - 1], -1
        if value[at] > best[room] + 1e-12:
            best[room], used[room] = value[at], at
    pattern, room = np.zeros(len(sizes)), capacity
    while room >= least:
        if used[room] < 0:
            room -= 1
            continue
        pattern[used[room]] += 1
        room -= int(sizes[used[room]])
    return pattern


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """``(pattern, times)``: how often to use each pattern of sizes, from the relaxed cutting problem, rounded down.

    Columns come from a knapsack over the current prices until none is worth more than a sequence.
    """
    size, need = np.array(sizes), np.array(demand, float)
    basis = np.diag(np.maximum(1, capacity // size).astype(float))
    amount = np.linalg.solve(basis, need)
    for _ in range(_ROUNDS):
        prices = np.linalg.solve(basis.T, np.ones(len(size)))
        pattern = _best_pattern(size, np.maximum(prices, 0), capacity)
        if pattern @ prices <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, pattern)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = pattern
        amount = np.maximum(np.linalg.solve(basis, need), 0)
    return [(basis[:, i].astype(int).tolist(), int(amount[i] + 1e-6)) for i in range(len(size)) if amount[i] >= 1 - 1e-6]


class Plan:
    """Runs of equal sequences, and where the pieces of each length go.

    ``rules`` has ``(length, first, end, sequence, offset)``: of the pieces of a length, numbered from 0, those from
    ``first`` to before ``end`` go to the sequences from ``sequence`` on, one each, at ``offset``.
    """

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.rules: list[tuple[int, int, int, int, int]] = []
        self.given: dict[int, int] = defaultdict(int)
        self.open: dict[int, list[list[int]]] = defaultdict(list)  # room: [first sequence, sequences]
        self.rooms: list[int] = []

    def _room(self, room: int, first: int, times: int) -> None:
        if room and times:
            if room not in self.open:
                insort(self.rooms, room)
            self.open[room].append([first, times])

    def _place(self, length: int, first: int, times: int, offset: int) -> None:
        start = self.given[length]
        self.rules.append((length, start, start + times, first, offset))
        self.given[length] += times

    def add(self, lengths: list[int], times: int) -> None:
        """``times`` new sequences that hold ``lengths``."""
        offset = 0
        for length in lengths:
            self._place(length, self.sequences, times, offset)
            offset += length
        self._room(self.capacity - offset, self.sequences, times)
        self.sequences += times

    def fit(self, length: int, count: int) -> None:
        """Best fit: into the fullest sequence that has room, again and again; new sequences where none has."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                times, rest = divmod(count, each)
                if times:
                    self.add([length] * each, times)
                if rest:
                    self.add([length] * rest, 1)
                return
            room = self.rooms[at]
            first, times = self.open[room].pop()
            if not self.open[room]:
                del self.open[room]
                self.rooms.pop(at)
            each = room // length
            full = min(times, count // each)
            for k in range(each if full else 0):
                self._place(length, first, full, self.capacity - room + k * length)
            self._room(room - each * length, first, full)
            count -= full * each
            first, times = first + full, times - full
            if times and count < each:
                for k in range(count):
                    self._place(length, first, 1, self.capacity - room + k * length)
                self._room(room - count * length, first, 1)
                first, times, count = first + 1, times - 1, 0
            self._room(room, first, times)


def _substituted(slots: list[tuple[int, int]], times: int, capacity: int, pool: Lengths) -> list[tuple[list[int], int]]:
    """Actual lengths for at most ``times`` sequences whose ``slots`` are the shortest and longest length of a group.

    A slot takes the longest piece that fits it and what the slots before have left over, the last one what fits the sequence.
    A sequence with a slot for which nothing is left is not opened; its pieces go back.
    """
    done, at = [([], times)], 0
    for i, (least, most) in enumerate(slots):
        at = capacity if i == len(slots) - 1 else at + most
        after = []
        for lengths, n in done:
            runs = pool.take(least, at - sum(lengths), n)
            after += [([*lengths, x], c) for x, c in runs]
            for x in lengths if (rest := n - sum(c for _, c in runs)) else ():
                pool.give_back(x, rest)
        done = after
    return done


def plan_sequences(counts: dict[int, int], capacity: int = MAX_TOKENS, groups: int = GROUPS) -> Plan:
    """Sequences for ``counts`` pieces of each length below ``capacity``. The work depends on the lengths, not on how many pieces there are."""
    plan = Plan(capacity)
    large = {n: c for n, c in counts.items() if n > LARGE * capacity and c}
    pool = Lengths(large)
    if large:
        parts = grouped(large, min(groups, sum(large.values())))
        sizes = sorted({most for _, most, _ in parts}, reverse=True)
        demand = [sum(c for _, most, c in parts if most == size) for size in sizes]
        least = {most: least for least, most, _ in parts}
        for pattern, times in sorted(configurations(sizes, demand, capacity), reverse=True):
            slots = [(least[sizes[g]], sizes[g]) for g, k in enumerate(pattern) for _ in range(k)]
            for lengths, n in _substituted(slots, times, capacity, pool):
                plan.add(lengths, n)
    rest = pool.left | {n: c for n, c in counts.items() if n not in large}
    for length in sorted(rest, reverse=True):
        plan.fit(length, rest[length])
    return plan


def pack_pieces(pieces: DataFrame, capacity: int = MAX_TOKENS, groups: int = GROUPS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` for ``part`` and ``number``.

    The driver sees one count per length (``capacity`` rows at most); the rules it makes from them are as few, whatever the
    number of pieces. Full pieces are sequences by themselves, with negative ids.
    """
    spark = pieces.sparkSession
    counted = pieces.where(F.col("length") < capacity).groupBy("part", "length").agg(F.count(F.lit(1)).alias("pieces"))
    counted = materialize(counted, "piece-counts")
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}
    plan = plan_sequences(counts, capacity, groups)
    rules = spark.createDataFrame(plan.rules, "r_length bigint, first bigint, end bigint, sequence bigint, offset bigint")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("part", "length", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base"))
    short = pieces.where(F.col("length") < capacity).join(base, ["part", "length"])
    place = F.col("base") + F.col("number")
    short = short.join(F.broadcast(rules), (F.col("length") == F.col("r_length")) & (place >= F.col("first")) & (place < F.col("end")))
    kept = [c for c in pieces.columns if c not in ("part", "number")]
    short = short.select(*kept, (F.col("sequence") + place - F.col("first")).alias("sequence_id"), "offset")
    full = pieces.where(F.col("length") >= capacity)
    full = full.select(*kept, (-1 - F.col("part").cast("bigint") * (1 << 32) - F.col("number")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return short.union(full)


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_TOKENS, end_id: int | None = END_ID, keep_ids: bool = False) -> DataFrame:
    """All documents as pieces in sequences of at most ``most`` tokens: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``.

    Documents longer than a sequence are cut into full pieces and a first one with the remainder. Lengths over ``LARGE`` of a
    sequence are put into ``GROUPS`` groups of equally many pieces and count as the longest of their group; patterns of these
    sizes are optimised and then filled with actual pieces, whose own lengths leave more room; the rest goes by best fit.

    A null or empty text has only the closing id. Rows that share an id are packed each. A null id stays null.
    Other columns are not read. An empty table gives an empty one.
    """
    pieces = materialize(token_pieces(docs, path, id_col, text_col, most, end_id, keep_ids), "token-pieces")
    return pack_pieces(pieces, most)
