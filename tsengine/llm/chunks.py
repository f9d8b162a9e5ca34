"""Hash values of all documents met in Spark: ranges of document ids, and sorted hashes packed for the shuffle.

A *chunk* is a range of document ids (of one id's texts, if it has very many rows) with a bounded share of the text. What a document's words hash to travels as one packed row per chunk and hash
bucket, so a shuffled value costs about six bytes, and a value that one chunk holds a million times travels once.
"""

from __future__ import annotations

import ctypes
import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Multiplier of the polynomial hash. Odd, so that a window's factor can be divided out modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
#: Bytes of text in a chunk, and hash values in a bucket: what one task holds of either, whatever the size of the table.
CHUNK_BYTES = 24 << 20
_BUCKET_BYTES = 32 << 20
#: Ranges of ids that are found by quantiles; more chunks than that divide each range evenly.
_RANGES = 10_000
#: Words up to which the powers of the hash are kept for the next text.
_KEPT_POWERS = 1 << 16
_INVERSE = pow(_BASE, -1, 2**64)
_NULL_ID = -(2**63)
#: Bytes of text that a packed row of documents holds at most, unless one document is longer.
_PAYLOAD_BYTES = 8 << 20

#: Bytes of text that are Python objects at a time, unless one document is longer.
_PIECE_BYTES = 2 << 20

DOCS_SCHEMA = "chunk int, payload binary"


def parts_of(spark) -> int:
    """Tasks of a shuffle: the session's own measure of the cluster."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class Chunks:
    """Ranges of (id, hash of the text), in ascending order; a null id counts as the smallest.

    ``bounds`` are the upper ends of ranges of ids with about as many rows each. An id at several bounds holds the rows of several ranges;
    these are told apart by the hash of the text. Each range is cut into ``split`` even parts.
    """

    bounds: np.ndarray
    lowest: int
    highest: int
    split: int
    buckets: int

    def of(self, ids: pa.Array, texts: list[bytes]) -> np.ndarray:
        """The chunk of each row. Rows equal in id and text share one."""
        keys = ids.fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
        at = np.searchsorted(self.bounds, keys, side="left")
        held = np.searchsorted(self.bounds, keys, side="right") - at
        if self.split > 1:
            ends = np.concatenate(([float(self.lowest)], self.bounds.astype(float), [float(self.highest)]))
            share = (keys.astype(float) - ends[at]) / np.maximum(ends[at + 1] - ends[at], 1)
            within = np.clip(share * self.split, 0, self.split - 1).astype(np.int64)
        else:
            within = np.zeros(len(keys), np.int64)
        for i in np.flatnonzero(held > 1).tolist():
            within[i] = xxhash.xxh3_64_intdigest(texts[i]) * int(held[i]) * self.split >> 64
        return at * self.split + within


def chunks_of(docs: DataFrame, id_col: str, text_col: str) -> Chunks:
    """Chunks of about ``CHUNK_BYTES`` of text and hash buckets of about ``_BUCKET_BYTES``, so their number follows the table, not the cluster."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
    parts = max(1, math.ceil(size / CHUNK_BYTES))
    ranges = min(parts, _RANGES)
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL_ID))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    bounds, lowest, highest = docs.agg(F.percentile_approx(key, shares, max(10_000, 20 * ranges)), F.min(key), F.max(key)).first()
    hashes = math.ceil(size * 1.5 / _BUCKET_BYTES)
    return Chunks(np.array((bounds or []) if ranges > 1 else [], np.int64), lowest or 0, highest or 0, math.ceil(parts / ranges), buckets_of(max(1, hashes)))


def buckets_of(parts: int) -> int:
    return 1 << (parts - 1).bit_length()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse; only those of texts of common length are kept."""
    if n <= _KEPT_POWERS:
        power, inverse = _kept_powers()
        return power[:n], inverse[:n]
    return tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base, np.uint64))), dtype=np.uint64) for base in (_BASE, _INVERSE))


@functools.cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(_KEPT_POWERS - 1, base, np.uint64))), dtype=np.uint64) for base in (_BASE, _INVERSE))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits; different values stay different."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive words, by start; empty if there are fewer words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, inverse = _powers(len(words))
    values = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) * power
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix((sums[width:] - sums[:n]) * inverse[:n] + np.uint64(width))


def pack(values: np.ndarray) -> bytes:
    """Ascending distinct values: the first, then the gaps in as few bytes each as the widest needs."""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return bytes([width]) + values[:1].astype("<u8").tobytes() + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(raw) + 1, 8), np.uint8)
    wide[0] = np.frombuffer(data, np.uint8, count=8, offset=1)
    wide[1:, :width] = raw
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def by_bucket(values: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The part of ascending ``values`` in each of ``buckets`` equal ranges of hashes, empty ones left out."""
    shift = 64 - (buckets.bit_length() - 1)
    which = np.zeros(len(values), np.int64) if shift == 64 else (values >> np.uint64(shift)).astype(np.int64)
    ends = np.flatnonzero(np.diff(which, append=-1)) + 1
    begin = 0
    for end in ends.tolist():
        yield int(which[begin]), slice(begin, end)
        begin = end


def runs(chunk: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Row numbers of each chunk."""
    order = np.argsort(chunk, kind="stable")
    for number, rows in groupby(order.tolist(), key=chunk.__getitem__):
        yield int(number), np.fromiter(rows, np.int64)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def pieces(column: pa.Array) -> Iterator[slice]:
    """Runs of rows with a bounded share of the text of ``column``."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // _PIECE_BYTES)) + 1).tolist(), len(ends)]
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        if begin < end:
            yield slice(begin, end)


def each_text(column: pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 bytes of one row after the other; null is empty."""
    for part in column.chunks:
        for s in pieces(part):
            yield from texts_of(part[s])


def release() -> None:
    """Gives free memory back to the system: Python workers stay, and what one keeps for itself the next stage's tasks lack."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def released(function):
    """``function`` over batches, with ``release`` after each batch it gives and at its end."""

    @functools.wraps(function)
    def run(batches):
        for out in function(batches):
            yield out
            del out
            release()
        release()

    return run


def released_group(function):
    """``function`` of a group's table, with ``release`` at its end."""

    @functools.wraps(function)
    def run(table):
        try:
            return function(table)
        finally:
            release()

    return run


def released_pair(function):
    """``function`` of the two tables of a group, with ``release`` at its end."""

    @functools.wraps(function)
    def run(left, right):
        try:
            return function(left, right)
        finally:
            release()

    return run


def dealt_documents(docs: DataFrame, id_col: str, text_col: str, places: Chunks) -> DataFrame:
    """Documents as compressed rows ``(chunk, payload)``; ``read_documents`` opens a chunk's payloads."""

    def deal(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.large_string())
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)) if len(texts) else []
            numbers = [places.of(ids[s], texts_of(batch.column(1)[s])) for s in pieces(batch.column(1))]
            for number, rows in runs(np.concatenate(numbers)) if numbers else ():
                part = np.cumsum(np.asarray(sizes)[rows]) // _PAYLOAD_BYTES
                for piece in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
                    table = pa.table({"id": ids.take(pa.array(piece)), "text": texts.take(pa.array(piece))})
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                        writer.write_table(table)
                    yield pa.record_batch({"chunk": pa.array([number], pa.int32()), "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(released(deal), DOCS_SCHEMA)


def read_documents(payloads: pa.ChunkedArray) -> pa.Table:
    """The documents of one chunk as ``id``, ``text``."""
    tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for p in payloads]
    return pa.concat_tables(tables) if tables else pa.table({"id": pa.array([], pa.int64()), "text": pa.array([], pa.large_string())})
