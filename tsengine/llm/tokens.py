"""Token ids of whole texts by a byte-level BPE vocabulary, and pieces that fit a sequence."""

from __future__ import annotations

import json
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 1024
#: Closes every document.
END_ID = 2
#: Fixed value: how byte-level vocabularies of this family split a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, tiktoken.Encoding] = {}


def _byte_letters() -> dict[str, int]:
    """Byte of each letter that a byte-level vocabulary file uses: printable Latin-1 as it is, the others from U+0100 up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of a ``tokenizers`` file, whose ids are its merge ranks; special strings in a text are ordinary text."""
    if path not in _encoders:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, special = _byte_letters(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _encoders[path] = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_ids(text: str | None, path: str, end_id: int | None = END_ID) -> np.ndarray:
    """Little-endian unsigned 32-bit ids; a null text has only the closing id."""
    ids = encoder(path).encode_to_numpy(text, allowed_special=set(), disallowed_special=()) if text else np.empty(0, "<u4")
    return ids.astype("<u4") if end_id is None else np.append(ids, end_id).astype("<u4")


def piece_bounds(length: int, most: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document: all of ``most`` tokens but the first, which takes the remainder."""
    first = (length - 1) % most + 1
    return [(0, first)] + [(s, most) for s in range(first, length, most)]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, number bigint"


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_TOKENS, end_id: int | None = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``most`` ids: place in its document, checksum of the ids, and with ``keep_ids`` the ids.

    ``part`` and ``number`` say which task made the row and how many of that length the task had made before.
    """

    def cut(batches):
        part, made = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "number", "ids")}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = token_ids(text, path, end_id)
                for number, (start, length) in enumerate(piece_bounds(len(ids), most) if len(ids) else ()):
                    own = ids[start : start + length].tobytes()
                    for name, value in zip(rows, (doc, number, start, length, zlib.crc32(own), made[length], own if keep_ids else None), strict=True):
                        rows[name].append(value)
                    made[length] += 1
            n = len(rows["piece"])
            columns = [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["piece"], pa.int32()), *[pa.array(rows[c], pa.int64()) for c in ("start", "length", "ids_crc32")], pa.array([part] * n, pa.int32()), pa.array(rows["number"], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]
            if keep_ids:
                columns.append(pa.array(rows["ids"], pa.binary()))
                names.append("ids")
            yield pa.record_batch(columns, names)

    narrow = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return narrow.mapInArrow(cut, PIECES + (", ids binary" if keep_ids else ""))
