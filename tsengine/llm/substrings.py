"""Operator 3: passages that repeat, found by Rabin-Karp hashes of every window of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.llm import chunks

WIDTH = 20
_BLOBS = "bucket int, chunk int, hashes binary"
_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_text string"


def _emit(places: chunks.Chunks, width: int):
    def emit(batches):
        for batch in batches:
            texts = chunks.texts_of(batch.column(1))
            for number, rows in chunks.runs(places.of(batch.column(0), texts)):
                found = [chunks.window_hashes(texts[i].split(), width) for i in rows.tolist()]
                values = np.unique(np.concatenate(found))
                parts = [(b, chunks.pack(values[s])) for b, s in chunks.by_bucket(values, places.buckets)]
                yield pa.record_batch(
                    {
                        "bucket": pa.array([b for b, _ in parts], pa.int32()),
                        "chunk": pa.array([number] * len(parts), pa.int32()),
                        "hashes": pa.array([p for _, p in parts], pa.binary()),
                    }
                )

    return emit


def _later(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk the hashes that an earlier chunk holds too."""
    blobs = sorted(zip(table["chunk"].to_pylist(), table["hashes"].to_pylist(), strict=True), key=lambda b: b[0])
    parts = [chunks.unpack(b) for _, b in blobs]
    values = np.concatenate(parts)
    chunk = np.repeat([c for c, _ in blobs], [len(p) for p in parts])
    del parts, blobs
    order = np.argsort(values, kind="stable")
    values, chunk = values[order], chunk[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    earliest = np.repeat(chunk[first], np.diff(np.append(first, len(values))))
    again = chunk > earliest
    values, chunk = values[again], chunk[again]
    numbers = np.unique(chunk).tolist()
    return pa.table({"chunk": pa.array(numbers, pa.int32()), "hashes": pa.array([chunks.pack(np.unique(values[chunk == c])) for c in numbers], pa.binary())})


def _remove(width: int):
    def remove(documents: pa.Table, later: pa.Table) -> pa.Table:
        docs = chunks.read_documents(documents["payload"])
        known = np.sort(np.concatenate([chunks.unpack(b) for b in later["hashes"].to_pylist()] or [np.empty(0, np.uint64)]))
        ids, texts = docs["id"].to_pylist(), chunks.texts_of(docs["text"].combine_chunks())
        del docs
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, xxhash.xxh3_64_intdigest(texts[i]), texts[i]))
        # Words are objects many times the size of their text: those of one document at a time, split again when it is written.
        found = [chunks.window_hashes(texts[i].split(), width) for i in order]
        sizes = [len(f) for f in found]
        values = np.concatenate(found) if found else np.empty(0, np.uint64)
        del found
        repeated = np.ones(len(values), bool)
        repeated[np.unique(values, return_index=True)[1]] = False
        if len(known):
            at = np.minimum(np.searchsorted(known, values), len(known) - 1)
            repeated |= known[at] == values
            del at
        del values, known
        out, begin = [], 0
        for i, size in zip(order, sizes, strict=True):
            w, texts[i] = texts[i].split(), b""
            starts = np.flatnonzero(repeated[begin : begin + size])
            begin += size
            edges = np.zeros(len(w) + 1, np.int64)
            edges[starts] += 1
            np.subtract.at(edges, starts + width, 1)
            covered = np.cumsum(edges[:-1]) > 0
            turns = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8))).reshape(-1, 2)
            kept = w if not len(turns) else [x for x, gone in zip(w, covered.tolist(), strict=True) if not gone]
            out.append((ids[i], len(w), int(covered.sum()), [{"start": a, "end": b} for a, b in turns.tolist()], b" ".join(kept)))
        columns = list(zip(*out, strict=True)) or [()] * 5
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.int64(), span, pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        arrays[4] = arrays[4].cast(pa.string())
        return pa.table(arrays, ["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return remove


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Per document: words, words removed, the removed intervals of word numbers, and the words kept.

    A word goes if some window of ``width`` words over it also starts earlier: in a document with a smaller id, or
    earlier in its own. Windows are those of the input. The hashes of all windows meet by hash range; a range answers
    each chunk of ids with the hashes that an earlier chunk has, and within a chunk the order is known. Overlapping
    windows merge into the longest intervals. Hashes have 64 bits: among n windows a wrong match is expected n**2 / 2**65 times.

    Null text: no words. Fewer words than ``width``: nothing goes. A null id counts as the smallest. Rows that share
    an id are ordered by text, so of equal rows the second loses its windows. Other columns of ``docs`` are not read.
    An empty table gives an empty table.
    """
    places = chunks.chunks_of(docs, id_col, text_col)
    read = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    hashes = read.mapInArrow(_emit(places, width), _BLOBS)
    later = hashes.groupBy("bucket").applyInArrow(_later, "chunk int, hashes binary")
    dealt = chunks.dealt_documents(docs, id_col, text_col, places)
    return dealt.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(_remove(width), _RESULT)
