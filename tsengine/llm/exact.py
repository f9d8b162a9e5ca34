"""Operator 8: equal texts by length, then a prefix hash, then the full hash. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsengine.session import materialize

PREFIX_CHARS = 64
#: White space as the text columns have it.
BLANKS = "[\\x20\\x09-\\x0D]+"


def normalised(text_col: str) -> Column:
    """Text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), BLANKS, " ")


def text_hash(text_col: str) -> Column:
    return F.sha2(normalised(text_col), 256)


def equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text_hash, keep_id, group_size, copies)`` of the rows whose normalised text some other row has too.

    Groups are refined: by length, then by a hash of the first characters, and only rows that still share both are
    read again for the full hash. Rows travel without their text until then. ``copies`` counts the rows
    that agree in id and text; they give one row here. A null id is never kept before a number.
    """
    text = normalised(text_col)
    narrow = materialize(
        docs.select(F.col(id_col).alias("id"), F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix")),
        "text-lengths",
    )
    prefixes = narrow.groupBy("length", "prefix").agg(F.count(F.lit(1)).alias("rows"))
    lengths = prefixes.groupBy("length").agg(F.sum("rows").alias("same_length")).where("same_length > 1").select("length")
    open_groups = materialize(prefixes.join(lengths, "length", "left_semi").where("rows > 1").select("length", "prefix"), "text-prefixes")
    survivors = narrow.join(open_groups, ["length", "prefix"], "left_semi").select("id")
    full = materialize(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(survivors.withColumnRenamed("id", "survivor"), F.expr("id <=> survivor"), "left_semi")
        .select("id", text_hash("text").alias("text_hash")),
        "text-hashes",
    )
    groups = materialize(full.groupBy("text_hash").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "text-groups")
    rows = full.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    return rows.join(groups, "text_hash").select("id", "text_hash", "keep_id", "group_size", "copies")


def mark_equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of the normalised text.

    Of equal texts the smallest id stays. A null text is an empty one. Repeated rows (same id, same text) share one
    verdict, as nothing tells them apart. A null id stays only if all ids of its group are null. Other columns are not read.
    """
    groups = equal_texts(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("_id"), text_hash(text_col).alias("text_sha256"))
    joined = rows.join(groups, F.expr("text_hash = text_sha256 and id <=> _id"), "left")
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.expr("group_size is null or keep_id <=> _id").alias("kept"),
        "text_sha256",
    )


def drop_equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: that of the smallest id; of repeated rows any one."""
    groups = materialize(equal_texts(docs, id_col, text_col).select("id", "text_hash", F.expr("keep_id <=> id").alias("stays"), "copies"), "text-verdicts")
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("key"), text_hash(text_col).alias("hash"))
    match = F.expr("hash = text_hash and key <=> id")
    out = keyed.join(groups.where("not stays or copies > 1"), match, "left_anti").select("row.*")
    repeated = groups.where("stays and copies > 1")
    if repeated.isEmpty():
        return out
    return out.union(keyed.join(repeated, match, "left_semi").dropDuplicates(["key", "hash"]).select("row.*"))
