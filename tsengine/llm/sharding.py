"""Operator 4: shards by extendible hashing on the bits of a document's hash."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsengine.session import materialize

SHARD_BYTES = 16 << 20
_BITS = 64


def _bits(text: Column) -> Column:
    return F.lpad(F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 2), _BITS, "0")


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` of its text, and ``shard``, the hash bits that name its shard, with the
    shard's ``depth`` (bits), ``shard_bytes`` and ``shard_rows``.

    The directory starts with as many bits as the total needs. Only shards over ``max_bytes`` are split, on their next bit, and
    only their rows are counted again, until every shard fits. Bits come from the id; rows that share an id go on with
    bits of their own. A shard of one row is never split, so a document over ``max_bytes`` is a shard by itself.

    A null text has 0 bytes; null ids hash like an empty one. An empty table gives an empty one. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("bigint").alias("n_bytes"))
    rows = rows.withColumn("twin", F.monotonically_increasing_id())
    rows = materialize(rows, "shard-rows")
    rows = rows.select("id", "n_bytes", F.concat(_bits(F.coalesce(F.col("id").cast("string"), F.lit(""))), _bits(F.concat(F.lit("row "), F.col("twin").cast("string")))).alias("bits"))
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(total / max_bytes))) if total > max_bytes else 0
    done = []
    while True:
        rows = rows.withColumn("shard", F.substring("bits", 1, depth))
        shards = materialize(rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows")), "shards")
        final = depth >= 2 * _BITS
        fits = (F.col("shard_bytes") <= max_bytes) | (F.col("shard_rows") == 1) | F.lit(final)
        closed = rows.join(shards.where(fits), "shard").select("id", "n_bytes", "shard", F.lit(depth).alias("depth"), "shard_bytes", "shard_rows")
        done.append(materialize(closed, "closed-shards"))
        over = shards.where(~fits).select("shard")
        if over.isEmpty():
            return reduce(DataFrame.union, done).withColumnRenamed("id", id_col)
        rows = materialize(rows.join(over, "shard", "left_semi").select("id", "n_bytes", "bits"), "shard-rows")
        depth += 1


def directory(assigned: DataFrame) -> DataFrame:
    """``(shard, depth, shard_bytes, shard_rows)``: an entry stands for all hashes that begin with its bits."""
    return assigned.select("shard", "depth", "shard_bytes", "shard_rows").distinct()
