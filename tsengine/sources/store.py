"""Versioned feature groups: an append-only commit log with snapshots, read as latest or as of a commit."""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.operators.clean import picked_rows, require_columns
from tsengine.operators.profile import duplicate_count, null_counts, order_breaks
from tsengine.series import SeriesKeys, period_date
from tsengine.session import delete_folder, folder_names


class GateError(ValueError):
    """A table that must not enter the store; ``found`` counts what is wrong by kind."""

    def __init__(self, found: dict[str, int]):
        super().__init__(f"rejected: {found}")
        self.found = found


def gate(df: DataFrame, ks: SeriesKeys, required: Sequence[str], seq: str | None = None) -> dict[str, int]:
    """Raises unless there are no nulls, no duplicate keys and, given ``seq``, the stored order follows time."""
    require_columns(df, [*ks.columns, *required])
    nulls = null_counts(df, [*ks.columns, *required]).agg(F.sum("nulls")).first()[0] or 0
    found = {"nulls": nulls, "duplicates": duplicate_count(df, ks.columns).first()[0]}
    if seq:
        found["order_breaks"] = order_breaks(df, ks.keys, seq, ks.time).agg(F.sum("order_breaks")).first()[0] or 0
    if any(found.values()):
        raise GateError(found)
    return found


MARKERS = "commit_id bigint, attempt string, attempt_no int, batch string, schema string"
HEADS = "through bigint, attempt string, schema string, retired boolean"
#: Commits whose markers share a folder.
BLOCK = 100


@dataclass(frozen=True)
class FeatureGroup:
    """A named, versioned table with a primary key, kept as commits under ``root``.

    A commit writes its rows to a folder of its own, by event date (truncated to ``unit``), with the first and last time of each series
    and date beside them, and is then published by a marker row that holds its number, its folder and its columns. Readers see published
    commits only, so a half-written one is invisible; a rerun of a commit number replaces the earlier folder whole. Columns are those of
    all commits together: one that a later commit adds is null before it.

    ``snapshot`` folds all commits so far into one row per key and their markers into one file. A read as of a commit opens the newest
    snapshot up to it and the commits that follow, so its cost does not grow with the number of commits. Folders are opened by name, and
    dates outside the requested span are pruned. A group has one writer at a time.
    """

    root: str
    name: str
    version: int
    ks: SeriesKeys
    unit: str = "day"

    @property
    def path(self) -> str:
        return f"{self.root}/{self.name}/v{self.version}"

    # --- what is published ---

    def heads(self, spark: SparkSession) -> list:
        """The snapshots by number, one row each; ``retired`` where what it replaces is given up."""
        rows = _stored(spark, HEADS, [f"{self.path}/heads"])
        found = {r["through"]: r for r in sorted(rows.collect() if rows is not None else [], key=lambda r: r["retired"])}
        return [found[k] for k in sorted(found)]

    def retired(self, spark: SparkSession) -> int:
        """The snapshot that took the place of all commits up to it, or 0."""
        return max((r["through"] for r in self.heads(spark) if r["retired"]), default=0)

    def head(self, spark: SparkSession, as_of: int | None = None):
        """The newest snapshot up to a commit, or None."""
        known = [r for r in self.heads(spark) if as_of is None or r["through"] <= as_of]
        return known[-1] if known else None

    def marked(self, spark: SparkSession, after: int = 0) -> DataFrame:
        """The markers of commits beyond ``after`` as a table; the folded ones come from the newest snapshot's file."""
        heads = self.heads(spark)
        folded = heads[-1]["through"] if heads else 0
        blocks = [int(n.split("=")[1]) for n in folder_names(spark, f"{self.path}/commits")]
        paths = [f"{self.path}/commits/block={b}" for b in sorted(blocks) if b >= (max(after, folded) + 1) // BLOCK]
        tail = _stored(spark, MARKERS, paths)
        parts = [] if tail is None else [tail.where(F.col("commit_id") > folded)]
        if after < folded:
            parts.append(spark.read.schema(MARKERS).parquet(f"{self.path}/marked/through={folded}"))
        every = functools.reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], MARKERS)
        newest = picked_rows(every.where(F.col("commit_id") > after), ["commit_id"], "attempt_no", F.max_by)
        return newest.select(*[f.split()[0] for f in MARKERS.split(", ")])

    def markers(self, spark: SparkSession, after: int = 0) -> list:
        """The newest marker of each commit beyond ``after``, by number: one row per commit."""
        return sorted(self.marked(spark, after).collect(), key=lambda r: r["commit_id"])

    def last_commit(self, spark: SparkSession, before: int | None = None) -> int | None:
        """The last published number, or the last one less than ``before``."""
        marked = self.marked(spark)
        return (marked if before is None else marked.where(F.col("commit_id") < before)).agg(F.max("commit_id")).first()[0]

    def next_commit(self, spark: SparkSession, batch: str | None = None) -> int:
        """The number after the last one, or the one under which ``batch`` was committed before."""
        own = F.min(F.when(F.col("batch") == F.lit(batch), F.col("commit_id")))
        known, last = self.marked(spark).agg(own, F.max("commit_id")).first()
        return known or 1 + (last or 0)

    # --- writing ---

    def commit(self, df: DataFrame, commit_id: int, batch: str | None = None) -> None:
        """Writes and publishes ``df``. A number that a snapshot has folded is final: its own batch, replayed, changes nothing; anything else raises."""
        spark, attempt = df.sparkSession, uuid.uuid4().hex
        known = self.marked(spark).where(F.col("commit_id") == commit_id).first()
        head = self.head(spark)
        if head and commit_id <= head["through"]:
            if known and batch is not None and known["batch"] == batch:
                return
            raise ValueError(f"commit {commit_id} is within the snapshot through {head['through']}")
        place = f"commit_id={commit_id}/attempt={attempt}"
        out = df.withColumn("event_date", period_date(F.col(self.ks.time), self.unit))
        self._write(out, f"{self.path}/rows/{place}")
        stored = spark.read.schema(out.schema).parquet(f"{self.path}/rows/{place}")
        self._write_days(stored.groupBy(*self.ks.keys, "event_date"), F.min(self.ks.time), F.max(self.ks.time), F.count(F.lit(1)), f"{self.path}/days/{place}")
        marker = [(commit_id, attempt, 1 + (known["attempt_no"] if known else 0), batch, df.schema.json())]
        spark.createDataFrame(marker, MARKERS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits/block={commit_id // BLOCK}")

    def _write(self, out: DataFrame, path: str) -> None:
        out.hint("rebalance", "event_date").sortWithinPartitions("event_date", *self.ks.columns).write.partitionBy("event_date").parquet(path)

    def _write_days(self, grouped, first: Column, last: Column, rows: Column, path: str) -> None:
        grouped.agg(first.alias("first"), last.alias("last"), rows.alias("rows")).hint("rebalance").write.parquet(path)

    def snapshot(self, spark: SparkSession) -> int:
        """Folds all commits so far, each key's latest row with its commit number, and returns the last number folded.

        Dates are folded on their own: rows of two dates never share a key. Half a snapshot is invisible: its line in ``heads`` comes last.
        Commits it covers stay for earlier as-of reads until ``retire``.
        """
        marked = self.marked(spark)
        through, attempt = marked.agg(F.max("commit_id")).first()[0], uuid.uuid4().hex
        head = self.head(spark)
        if through is None or (head and head["through"] == through):
            return through or 0
        place = f"through={through}/attempt={attempt}"
        rows = latest(self._folded(spark), [*self.ks.columns, "event_date"], "commit_id")
        schema = T.StructType([f for f in rows.schema.fields if f.name not in ("event_date", "commit_id")])
        self._write(rows.withColumnRenamed("commit_id", "_commit"), f"{self.path}/snapshots/{place}")
        days = self.days(spark).groupBy(*self.ks.keys, "event_date")
        self._write_days(days, F.min("first"), F.max("last"), F.sum("rows"), f"{self.path}/folded_days/{place}")
        marked.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marked/through={through}")
        line = [(through, attempt, schema.json(), False)]
        spark.createDataFrame(line, HEADS).coalesce(1).write.mode("append").parquet(f"{self.path}/heads")
        return through

    def retire(self, spark: SparkSession, before: int) -> int:
        """Gives up as-of reads before the newest snapshot up to ``before``: deletes the commits and snapshots it replaces and returns its number."""
        kept = self.head(spark, before)
        if kept is None:
            return 0
        old = [r for r in self.heads(spark) if r["through"] < kept["through"]]
        spark.createDataFrame([(kept["through"], kept["attempt"], kept["schema"], True)], HEADS).coalesce(1).write.mode("append").parquet(f"{self.path}/heads")
        for folder in ("rows", "days"):
            for n in folder_names(spark, f"{self.path}/{folder}"):
                if int(n.split("=")[1]) <= kept["through"]:
                    delete_folder(spark, f"{self.path}/{folder}/{n}")
        for r in old:
            for folder in ("snapshots", "folded_days"):
                delete_folder(spark, f"{self.path}/{folder}/through={r['through']}")
        return kept["through"]

    def compact(self, spark: SparkSession, into: "FeatureGroup", commit_id: int) -> None:
        """Latest rows written as one commit of another version."""
        into.commit(self.read(spark), commit_id)

    # --- reading ---

    def _between(self, spark: SparkSession, after: int, as_of: int | None) -> list:
        return [r for r in self.markers(spark, after) if as_of is None or r["commit_id"] <= as_of]

    def _commit_rows(self, spark: SparkSession, marked: list, fields: dict) -> DataFrame:
        """Rows of the folders of ``marked``, opened by name."""
        places = [T.StructField("event_date", T.DateType()), T.StructField("commit_id", T.LongType()), T.StructField("attempt", T.StringType())]
        names = [*fields, "event_date", "commit_id"]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()] + places)
        paths = [f"{self.path}/rows/commit_id={r['commit_id']}/attempt={r['attempt']}" for r in marked]
        rows = spark.read.schema(schema).option("basePath", f"{self.path}/rows")
        return rows.parquet(*paths).select(*names)

    def _missing(self, as_of: int | None) -> ValueError:
        return ValueError(f"{self.path} has no commit" + ("" if as_of is None else f" up to {as_of}"))

    def log(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        """Rows of all published commits with ``commit_id`` and ``event_date``, folded or not; reads every commit."""
        marked = self._between(spark, 0, as_of)
        if not marked:
            raise self._missing(as_of)
        self._check_kept(spark, marked[0]["commit_id"])
        return self._commit_rows(spark, marked, _fields([r["schema"] for r in marked]))

    def _check_kept(self, spark: SparkSession, commit_id: int) -> None:
        if self.retired(spark) >= commit_id:
            raise ValueError(f"{self.path} keeps no commit up to {self.retired(spark)}")

    def _folded(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        """Rows of the newest snapshot up to ``as_of`` and of the commits after it."""
        head = self.head(spark, as_of)
        marked = self._between(spark, head["through"] if head else 0, as_of)
        if not head and not marked:
            raise self._missing(as_of)
        if not head:
            self._check_kept(spark, marked[0]["commit_id"])
        elif head["through"] < self.retired(spark):
            raise ValueError(f"{self.path} keeps no commit up to {self.retired(spark)}")
        fields = _fields([*([head["schema"]] if head else []), *[r["schema"] for r in marked]])
        parts = [self._commit_rows(spark, marked, fields)] if marked else []
        if head:
            known = [T.StructField(f.name, f.dataType) for f in T.StructType.fromJson(json.loads(head["schema"])).fields]
            schema = T.StructType([*known, T.StructField("_commit", T.LongType()), T.StructField("event_date", T.DateType())])
            base = spark.read.schema(schema).parquet(f"{self.path}/snapshots/through={head['through']}/attempt={head['attempt']}")
            added = [F.lit(None).cast(f.dataType).alias(n) for n, f in fields.items() if n not in schema.names]
            base = base.select("*", *added).withColumnRenamed("_commit", "commit_id")
            parts.append(base.select(*fields, "event_date", "commit_id"))
        return functools.reduce(DataFrame.unionByName, parts)

    def read(self, spark: SparkSession, as_of: int | None = None, since=None, until=None) -> DataFrame:
        """Latest row of each key, optionally as of a commit and within event times; both ends count."""
        log = self._folded(spark, as_of)
        t, day = F.col(self.ks.time), F.col("event_date")
        for bound, inside in ((since, lambda c, b: c >= b), (until, lambda c, b: c <= b)):
            if bound is not None:
                bound = F.lit(bound).cast("timestamp_ntz")
                log = log.where(inside(day, period_date(bound, self.unit)) & inside(t, bound))
        return latest(log, self.ks.columns, "commit_id").drop("event_date", "commit_id")

    def days(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        """(series, event_date, first, last, rows): first and last time of each series and date, and how often rows were written.

        Comes from the summaries written with commits and snapshots; no rows are read. Of a series and date there are several lines
        where several commits wrote it. A group without a commit raises.
        """
        head = self.head(spark, as_of)
        marked = self._between(spark, head["through"] if head else 0, as_of)
        paths = [f"{self.path}/days/commit_id={r['commit_id']}/attempt={r['attempt']}" for r in marked]
        if head:
            paths.append(f"{self.path}/folded_days/through={head['through']}/attempt={head['attempt']}")
        if not paths:
            raise self._missing(as_of)
        fields = _fields([*([head["schema"]] if head else []), *[r["schema"] for r in marked]])
        series = [T.StructField(k, fields[k].dataType) for k in self.ks.keys]
        times = [T.StructField(n, fields[self.ks.time].dataType) for n in ("first", "last")]
        schema = T.StructType([*series, T.StructField("event_date", T.DateType()), *times, T.StructField("rows", T.LongType())])
        return spark.read.schema(schema).parquet(*paths)

    def times(self, spark: SparkSession, dates: Sequence[date]) -> DataFrame:
        """Keys of the rows of some event dates, possibly repeated; no measure is read."""
        return self._folded(spark).where(F.col("event_date").isin(list(dates))).select(*self.ks.columns)

    def ends(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        """(series, first, last) of the whole group, from the summaries."""
        return self.days(spark, as_of).groupBy(*self.ks.keys).agg(F.min("first").alias("first"), F.max("last").alias("last"))

    def edge_dates(self, changes: DataFrame) -> list[date]:
        """The dates that hold the first or last change of a series: one value per date."""
        t = F.col(self.ks.time)
        ends = changes.groupBy(*self.ks.keys).agg(F.min(t).alias("_a"), F.max(t).alias("_b"))
        found = ends.select(F.explode(F.array(*[period_date(F.col(c), self.unit) for c in ("_a", "_b")])).alias("d")).distinct()
        return [r["d"] for r in found.collect()]


def _stored(spark: SparkSession, schema: str, paths: Sequence[str]) -> DataFrame | None:
    """A metadata table, or None where nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(*paths) if paths else None
    except AnalysisException:
        return None


def _fields(schemas: Sequence[str]) -> dict[str, T.StructField]:
    """Columns of all commits together; raises where two disagree on a type."""
    fields: dict[str, T.StructField] = {}
    for text in dict.fromkeys(schemas):
        for f in T.StructType.fromJson(json.loads(text)).fields:
            known = fields.setdefault(f.name, f)
            if known.dataType != f.dataType:
                raise ValueError(f"{f.name} is {known.dataType.simpleString()} and {f.dataType.simpleString()} in different commits")
    return fields


def latest(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` per key (one row per key and ``order``); partial aggregation keeps one row per key and task."""
    return picked_rows(log, keys, order, F.max_by)


def feature_view(df: DataFrame, excluded: Sequence[str], labels: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(the group's query without the excluded columns, label metadata)."""
    view = df.drop(*excluded)
    require_columns(view, labels)
    named = df.sparkSession.createDataFrame([(i, n) for i, n in enumerate(labels)], "pos int, label string")
    return view, named
