"""Landed feeds: JSON payloads with parallel arrays, and CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.functions.scalars import format_time, parse_time
from tsengine.series import period_date
from tsengine.session import materialize

CORRUPT = "_corrupt_record"


def payload_schema(measures: dict[str, str], carry: dict[str, str], block: str = "hourly") -> T.StructType:
    """``{carry…, block: {time: [text], measure: [type]…}}``."""
    arrays = ", ".join(["time: array<string>", *[f"`{m}`: array<{t}>" for m, t in measures.items()]])
    fields = [f"`{c}` {t}" for c, t in carry.items()] + [f"`{block}` struct<{arrays}>"]
    return T.StructType.fromDDL(", ".join(fields))


def read_payloads(
    spark: SparkSession, path: str, measures: dict[str, str], carry: dict[str, str] | None = None, block: str = "hourly"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected payloads). One row per array position; a payload without the block is rejected.

    Payload files are read with a given schema, so nothing is inferred and unused arrays are not parsed.
    """
    carry = carry or {}
    raw = spark.read.schema(payload_schema(measures, carry, block)).json(path)
    good = raw.where(F.col(block).isNotNull() & F.col(f"{block}.time").isNotNull())
    zipped = F.arrays_zip(F.col(f"{block}.time").alias("time"), *[F.col(f"{block}.{m}").alias(m) for m in measures])
    rows = good.select(*carry, F.inline(zipped))
    rows = rows.select(*carry, parse_time(F.col("time")).alias("time"), *measures).where(F.col("time").isNotNull())
    rejected = raw.where(F.col(block).isNull() | F.col(f"{block}.time").isNull()).select(*carry)
    return rows, rejected


def _field(name: str):
    return lambda row: row[name]


def to_payloads(df: DataFrame, time: str, measures: Sequence[str], per: Sequence[str | Column], block: str = "hourly") -> DataFrame:
    """Rows packed into one JSON text per ``per`` group, which must be bounded, such as one series and day."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(time).alias("_t"), *measures)))
    packed = df.groupBy(*per).agg(rows.alias("_rows"))
    keys = [c for c in packed.columns if c != "_rows"]
    times = F.transform("_rows", lambda r: F.date_format(r["_t"], "yyyy-MM-dd'T'HH:mm"))
    arrays = [F.transform("_rows", _field(m)).alias(m) for m in measures]
    body = F.struct(*keys, F.struct(times.alias("time"), *arrays).alias(block))
    return packed.select(F.to_json(body).alias("value"))


def read_csv(spark: SparkSession, path: str, schema: str, time: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt lines) of headed CSV files; ``time`` is parsed from text in mixed formats.

    Columns are found by the names in the header, in any order; others are not read, and a declared one that is absent is an error. All files must have
    the same header, which Spark checks. Parsed rows are written once, as the CSV source refuses to return corrupt lines alone.
    """
    wanted = T.StructType.fromDDL(schema)
    types = {f.name: f.dataType for f in wanted}
    header = spark.read.option("header", True).csv(path).columns
    if missing := [n for n in types if n not in header]:
        raise ValueError(f"columns not in the header: {missing}")
    full = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header]).add(CORRUPT, T.StringType())
    reader = spark.read.schema(full).option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT)
    parsed = materialize(reader.csv(path), "csv")
    rows = parsed.where(F.col(CORRUPT).isNull()).select(*types)
    if time:
        rows = rows.withColumn(time, parse_time(F.col(time))).where(F.col(time).isNotNull())
    return rows, parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def write_csv(df: DataFrame, path: str, time: str) -> None:
    """Headed CSV, time as ``yyyy-MM-dd HH:mm:ss``."""
    df.withColumn(time, format_time(F.col(time))).write.mode("overwrite").option("header", True).csv(path)


def write_series(df: DataFrame, path: str, keys: Sequence[str], time: str, unit: str = "day") -> None:
    """Parquet by calendar ``unit``, rows sorted by series and time within a file, so that scans prune by both.

    The rebalance hint splits a busy period over several tasks and joins quiet ones: no hot file, no tiny files.
    """
    dated = df.withColumn("period", period_date(F.col(time), unit)).hint("rebalance", "period")
    dated.sortWithinPartitions("period", *keys, time).write.mode("overwrite").partitionBy("period").parquet(path)
