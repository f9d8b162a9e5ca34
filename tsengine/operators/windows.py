"""Ordered column expressions over a chunk window. Rows of the window are whole grid steps.

Spark re-aggregates every sliding frame, so a frame of 168 rows costs 168 updates per row and statistic. Long
windows are therefore put together from short ones: a first pass fetches the last rows, at most ``DIRECT_LIMIT``, a
projection aggregates them, a second pass (same partitions and order, hence neither shuffle nor sort) lags those partial
results, and a projection merges them. A part is null unless all its rows have a value, so rows without a full window cost
next to nothing. Sums add, extremes compare, squared deviations merge around the joint mean, medians sort the
joined arrays; nothing is subtracted, so no precision is lost.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def lag(column: str, steps: int, w: WindowSpec) -> Column:
    return F.lag(column, steps).over(w)


def lead(column: str, steps: int, w: WindowSpec) -> Column:
    return F.lead(column, steps).over(w)


DIRECT_LIMIT = 24
MAX_PARTS = 16


def part_size(size: int) -> int:
    """Frame length to aggregate directly: ``size`` itself, or an even part of a long window."""
    if size <= DIRECT_LIMIT:
        return size
    part = next(d for d in range(DIRECT_LIMIT, 0, -1) if size % d == 0)
    return part if size // part <= MAX_PARTS else size


#: Types whose sum a chain of additions gives as the aggregate does, and that sum's type.
SUM_TYPES = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "bigint": "bigint", "float": "double", "double": "double"}


@dataclass
class WindowPasses:
    """Columns of the first window pass, of the second (over results of the first), and of the projection after both.

    ``parts`` are the partial results ``(column, statistic, rows, window)`` that the second pass lags.
    """

    first: dict[str, Column] = field(default_factory=dict)
    parts: dict[str, tuple[str, str, int, WindowSpec]] = field(default_factory=dict)
    second: dict[str, Column] = field(default_factory=dict)
    sorted: dict[str, Column] = field(default_factory=dict)
    row: dict[str, Column] = field(default_factory=dict)

    def add_run(self, column: str, w: WindowSpec) -> str:
        """How many rows in a row, the current one last, have a value; decides whether a window is full."""
        name = f"_run_{column}"
        if name not in self.first:
            so_far = w.rowsBetween(Window.unboundedPreceding, 0)
            missing = F.max(F.when(F.col(column).isNull(), F.col("_pos"))).over(so_far)
            before = F.first("_pos").over(so_far) - 1
            self.first[name] = F.col("_pos") - F.coalesce(missing, before)
        return name

    def add_part(self, column: str, stat: str, size: int, w: WindowSpec) -> str:
        """The statistic of the ``size`` rows ending at the current one; null unless all have a value."""
        name = f"_{stat}_{size}_{column}"
        if stat in ("min", "max", "list"):
            self.add_run(column, w)
        self.parts[name] = (column, stat, size, w)
        return name

    def shifted(self, name: str, steps: int, w: WindowSpec) -> Column:
        """A first-pass column ``steps`` rows back (ahead when negative)."""
        if steps == 0:
            return F.col(name)
        moved = f"{name}_at_{steps}".replace("-", "m")
        self.second[moved] = F.lag(name, steps).over(w)
        return F.col(moved)

    def shifted_parts(self, column: str, stat: str, size: int, w: WindowSpec) -> list[Column]:
        part = part_size(size)
        name = self.add_part(column, stat, part, w)
        return [self.shifted(name, k, w) for k in range(size - part, -1, -part)]

    def add_rolling(self, column: str, size: int, stats: tuple[str, ...], w: WindowSpec, name) -> None:
        """``name(stat)`` columns over the ``size`` rows ending at the current one, null unless all have a value."""
        for stat in stats:
            self.row[name(stat)] = self._merged(column, stat, size, w)

    def _merged(self, column: str, stat: str, size: int, w: WindowSpec) -> Column:
        if stat in ("min", "max"):
            found = self.shifted_parts(column, stat, size, w)
            if len(found) == 1:
                return found[0]
            # These two skip nulls, unlike sums and joined arrays.
            return F.when(F.col(self.add_run(column, w)) >= size, (F.least if stat == "min" else F.greatest)(*found))
        if stat == "median":
            # Sorting a joined array is far cheaper than the built-in percentile, which fills a hash map per frame.
            ordered = f"_sorted_{size}_{column}"
            self.sorted[ordered] = F.sort_array(F.concat(*self.shifted_parts(column, "list", size, w)))
            return middle(F.col(ordered), size)
        sums = self.shifted_parts(column, "sum", size, w)
        mean = _total(sums) / size
        if stat == "mean":
            return mean
        part = part_size(size)
        squares = _total(self.shifted_parts(column, "m2", size, w))
        if len(sums) > 1:
            squares = squares + _total([(s / part - mean) * (s / part - mean) for s in sums]) * part
        return F.sqrt(F.try_divide(squares, F.lit(size - 1)))

    def add_forward_sum(self, column: str, steps: int, w: WindowSpec, name: str) -> None:
        """Sum of the next ``steps`` rows, the current one excluded; null unless all have a value."""
        part = part_size(steps)
        total = self.add_part(column, "sum", part, w)
        self.row[name] = _total([self.shifted(total, -k, w) for k in range(part, steps + 1, part)])

    def over(self, df: DataFrame) -> DataFrame:
        """Both window passes over the chunks' core and halo rows; keeps the core rows.

        The ``row`` columns are left to the caller's own select. Arrays are sorted in a projection of their own because
        an even median reads two entries of them.
        """
        types, first, parts = dict(df.dtypes), dict(self.first), {}
        for name, (column, stat, size, w) in self.parts.items():
            if size > DIRECT_LIMIT or types[column] not in SUM_TYPES:
                first[name] = _framed(column, stat, size, w)
                continue
            rows = [F.col(column)]
            for k in range(1, size):
                first.setdefault(f"_back_{k}_{column}", lag(column, k, w))
                rows.append(F.col(f"_back_{k}_{column}"))
            if stat in ("sum", "m2"):
                total = _total([r.cast(SUM_TYPES[types[column]]) for r in rows])
                parts[name] = total if stat == "sum" else _total([F.pow(r - total / size, F.lit(2.0)) for r in rows])
                continue
            full = F.col(f"_run_{column}") >= size
            if stat == "list":  # an array that can't hold nulls sorts as plain numbers
                zero = F.lit(0).cast(types[column])
                parts[name] = F.when(full, F.array(*[F.coalesce(r, zero) for r in reversed(rows)]))
            else:
                parts[name] = F.when(full, (F.least if stat == "min" else F.greatest)(*rows)) if size > 1 else rows[0]
        if first:
            df = df.select("*", *[c.alias(n) for n, c in first.items()])
        if parts:
            # Spark keeps a projection with a lambda out of whole-stage code, where it would be one method, too long for the JIT
            # compiler; as a projection of its own it is split.
            core = F.exists(F.array("_core"), lambda core: core).alias("_core")
            passed = [n for n in (*types, *first) if n != "_core" and not n.startswith("_back_")]
            df = df.select(core, *passed, *[c.alias(n) for n, c in parts.items()])
        if self.second:
            df = df.select("*", *[c.alias(n) for n, c in self.second.items()])
        df = df.where("_core")
        return df.select("*", *[c.alias(n) for n, c in self.sorted.items()]) if self.sorted else df


def _framed(column: str, stat: str, size: int, w: WindowSpec) -> Column:
    """A part by Spark's own sliding frame."""
    frame = w.rowsBetween(-(size - 1), 0)
    value = {
        "sum": lambda: F.sum(column).over(frame),
        "min": lambda: F.min(column).over(frame),
        "max": lambda: F.max(column).over(frame),
        "m2": lambda: F.var_samp(column).over(frame) * (size - 1),
        "list": lambda: F.collect_list(column).over(frame),
    }[stat]()
    return _full(column, frame, size, value)


def _total(columns: list[Column]) -> Column:
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return total


def middle(ordered: Column, size: int) -> Column:
    """Interpolated median of a sorted array of ``size`` values."""
    high = F.get(ordered, F.lit(size // 2))
    return high if size % 2 else (F.get(ordered, F.lit(size // 2 - 1)) + high) / 2


def _full(column: str, frame: WindowSpec, size: int, value: Column) -> Column:
    """The aggregate, or null unless all ``size`` values of the frame are present."""
    return F.when(F.count(column).over(frame) == size, value)


ROLLING = {"mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp}


def rolling(column: str, size: int, stat: str, w: WindowSpec, by_time: bool = False) -> Column:
    """Statistic of the ``size`` rows ending at the current one, null unless all have a value.

    ``by_time`` reads the frame as a range of the integer step column the window is ordered by, which needs no dense grid.
    """
    frame = w.rangeBetween(-(size - 1), 0) if by_time else w.rowsBetween(-(size - 1), 0)
    if stat == "median":
        return _full(column, frame, size, middle(F.sort_array(F.collect_list(column).over(frame)), size))
    return _full(column, frame, size, ROLLING[stat](column).over(frame))


