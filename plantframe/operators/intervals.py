"""Set algebra on half-open intervals ``[start, end)`` held in tables.

Intervals become +1/-1 steps at their ends. Steps at one position are summed before the shuffle, and
the running sum tells how many intervals cover each stretch. The running sum is taken slice by slice
with the state carried across, so neither a hot group nor an ungrouped table is sorted in one task.
Where no group is hot, groups are dealt once and each is solved where it lies.
A null start or end is unbounded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .skew import SLICE_ROWS, has_hot_key, quantile_bounds, slice_of

LOWEST, HIGHEST = -(2**63), 2**63 - 1


def _position(column: Column, data_type: T.DataType, default: int) -> Column:
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        column = F.unix_micros(column.cast("timestamp"))
    return F.coalesce(column.cast("long"), F.lit(default).cast("long"))


def _bounds(df: DataFrame, start: str, end: str, by: Sequence[str]) -> DataFrame:
    """Intervals as long positions, without empty ones."""
    return df.select(
        *by,
        _position(F.col(start), df.schema[start].dataType, LOWEST).alias("_s"),
        _position(F.col(end), df.schema[end].dataType, HIGHEST).alias("_e"),
    ).filter(F.col("_s") < F.col("_e"))


def _steps(intervals: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """At every start what the columns ``names`` hold, at every end its negative."""
    at = [
        F.struct(F.col(end).alias("p"), *[(F.col(n) * sign).alias(n) for n in names])
        for end, sign in (("_s", 1), ("_e", -1))
    ]
    return intervals.select(*by, F.explode(F.array(*at)).alias("_x")).select(
        *by, F.col("_x.p").alias("_p"), *[F.col(f"_x.{n}").alias(n) for n in names]
    )


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join where null is a group like others."""
    named = right.withColumnsRenamed({k: f"_j_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys])
    return left.join(named, same).drop(*[f"_j_{k}" for k in keys])


def _running(intervals: DataFrame, by: Sequence[str], names: Sequence[str], slices: int | None) -> DataFrame:
    """Per position, for each kind of interval, which counts by its column of ``names``, the number of covering intervals after it (``c_``) and
    before it (``b_``), and the slice of the position; no slices where no group needs them."""
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    rows, hot = (0, True) if slices else has_hot_key(intervals, by, SLICE_ROWS // 2)
    if not hot:
        # The number of parts follows the rows, so that the memory of a task does not. With more than 200 parts a
        # task holds what it sends: whole intervals, which become steps where they arrive.
        dealt = intervals.repartition(max(1, -(-2 * rows // SLICE_ROWS)), *by)
        counted = (
            _steps(dealt, by, names).groupBy(*by, "_p").agg(*sums)
            .select(*by, "_p", *names, *[F.sum(n).over(Window.partitionBy(*by).orderBy("_p")).alias(f"c_{n}") for n in names])
        )
        return counted.select("*", *[(F.col(f"c_{n}") - F.col(n)).alias(f"b_{n}") for n in names])
    summed = cut_lineage(_steps(intervals, by, names).groupBy(*by, "_p").agg(*sums))
    bounds = quantile_bounds(summed, "_p", slices)
    summed = summed.withColumn("_slice", slice_of(F.col("_p"), bounds))
    inside = Window.partitionBy(*by, "_slice").orderBy("_p")
    if bounds:
        before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carry = (
            summed.groupBy(*by, "_slice")
            .agg(*[F.sum(n).alias(f"n_{n}") for n in names])
            .select(*by, "_slice", *[F.coalesce(F.sum(f"n_{n}").over(before), F.lit(0)).alias(f"k_{n}") for n in names])
        )
        summed = _join(summed, carry, [*by, "_slice"])
    carried = {n: F.col(f"k_{n}") if bounds else F.lit(0) for n in names}
    counted = summed.select(
        *by, "_p", "_slice", *names, *[(F.sum(n).over(inside) + carried[n]).alias(f"c_{n}") for n in names]
    )
    return counted.select("*", *[(F.col(f"c_{n}") - F.col(n)).alias(f"b_{n}") for n in names])


def _stretches(
    edges: DataFrame, by: Sequence[str], start: str, end: str, data_type: T.DataType
) -> DataFrame:
    """Pair each opening edge with the closing edge that follows it."""
    if "_slice" not in edges.columns:
        paired = edges.withColumn("_next", F.lead("_p").over(Window.partitionBy(*by).orderBy("_p"))).filter("_open")
    else:
        inside = Window.partitionBy(*by, "_slice").orderBy("_p")
        after = Window.partitionBy(*by).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
        next_slice = (
            edges.groupBy(*by, "_slice")
            .agg(F.min("_p").alias("_head"))
            .select(*by, "_slice", F.min("_head").over(after).alias("_next_head"))
        )
        paired = (
            _join(edges.withColumn("_next", F.lead("_p").over(inside)), next_slice, [*by, "_slice"])
            .filter("_open")
            .withColumn("_next", F.coalesce("_next", "_next_head"))
        )

    def value(name: str, unbounded: int) -> Column:
        found = F.when(F.col(name) != unbounded, F.col(name))
        if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
            return F.timestamp_micros(found)
        return found.cast(data_type)

    return paired.select(*by, value("_p", LOWEST).alias(start), value("_next", HIGHEST).alias(end))


def _grouped(by: Sequence[str]) -> list[str]:
    return list(by) if by else ["_all"]


def _with_group(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if by else df.withColumn("_all", F.lit(0))


def _covered_by_all(
    intervals: DataFrame, names: Sequence[str], start: str, end: str, by: Sequence[str], data_type: T.DataType, slices: int | None
) -> DataFrame:
    """Stretches where every kind of interval covers."""
    keys = _grouped(by)
    counted = _running(intervals, keys, names, slices)
    now, was = F.lit(True), F.lit(True)
    for n in names:
        now, was = now & (F.col(f"c_{n}") > 0), was & (F.col(f"b_{n}") > 0)
    edges = counted.filter(now != was).withColumn("_open", now)
    return _stretches(edges, keys, start, end, data_type).select(*by, start, end)


def merge_intervals(
    df: DataFrame, start: str = "start", end: str = "end", by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Union of the intervals per group as disjoint intervals; touching ones are joined."""
    keys = _grouped(by)
    intervals = _bounds(_with_group(df, by), start, end, keys).withColumn("_d", F.lit(1))
    return _covered_by_all(intervals, ["_d"], start, end, by, df.schema[start].dataType, slices)


def intersect_intervals(
    left: DataFrame,
    right: DataFrame,
    start: str = "start",
    end: str = "end",
    by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Stretches covered by both tables, from one running pass over both."""
    keys = _grouped(by)
    sides = [
        _bounds(_with_group(side, by), start, end, keys).withColumn(name, F.lit(1))
        for side, name in ((left, "_l"), (right, "_r"))
    ]
    intervals = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return _covered_by_all(intervals, ["_l", "_r"], start, end, by, left.schema[start].dataType, slices)


def complement_intervals(
    df: DataFrame,
    start: str = "start",
    end: str = "end",
    by: Sequence[str] = (),
    low: int | None = None,
    high: int | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Stretches of ``[low, high)`` that no interval covers; without limits they are unbounded."""
    keys = _grouped(by)
    first = LOWEST if low is None else low
    last = HIGHEST if high is None else high
    bounds = _bounds(_with_group(df, by), start, end, keys)
    clipped = bounds.select(
        *keys, F.greatest("_s", F.lit(first)).alias("_s"), F.least("_e", F.lit(last)).alias("_e")
    ).filter(F.col("_s") < F.col("_e"))
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select(F.lit(0).alias("_all"))
    frame = groups.select(*keys, F.lit(first).cast("long").alias("_s"), F.lit(last).cast("long").alias("_e"), F.lit(0).alias("_d"))
    counted = _running(clipped.withColumn("_d", F.lit(1)).unionByName(frame), keys, ["_d"], slices)
    now = (F.col("c__d") == 0) & (F.col("_p") < F.lit(last))
    was = (F.col("b__d") == 0) & (F.col("_p") > F.lit(first))
    edges = counted.filter(now != was).withColumn("_open", now)
    return _stretches(edges, keys, start, end, df.schema[start].dataType).select(*by, start, end)
