"""Reading and downsampling data points.

Input rows are (series columns, timestamp, value). Buckets are aligned to the epoch, a bucket exists
when it holds a point, and a time range selects buckets by their start.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import PlantError
from ..functions.granularity import parse_all
from .skew import previous_across_slices

# The ten aggregate names.
AGGREGATES = (
    "average",
    "max",
    "min",
    "count",
    "sum",
    "interpolation",
    "stepInterpolation",
    "totalVariation",
    "continuousVariance",
    "discreteVariance",
)
_ORDERED = {"totalVariation", "continuousVariance"}
_LEFT_NEIGHBOUR = {"interpolation", "stepInterpolation"}

# Microseconds that no timestamp reaches, for a time range that is left open.
OPEN_START, OPEN_END = -(1 << 62), 1 << 62
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# One series is sorted in slices of this length, so a task holds an hour of a series at most.
SLICE_MICROS = 3_600_000_000
# Buckets of one series are chained in runs of this many.
BUCKETS_PER_RUN = 100_000
# Up to this many rows per series and task travel to the rank filter (Spark's window group limit).
GROUP_LIMIT = 100


def _utc(moment: datetime | str) -> datetime:
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _micros(moment: datetime) -> int:
    return (moment - EPOCH) // timedelta(microseconds=1)


def inclusive_exclusive(
    start: datetime | str | None, end: datetime | str | None, closed: str = "left"
) -> tuple[int, int]:
    """A time range as ``[start, end)`` in microseconds; open and closed ends differ by 1 ms."""
    if closed not in ("left", "right", "both", "neither"):
        raise PlantError(f"closed must be left, right, both or neither, not {closed}")
    given = [_utc(m) for m in (start, end) if m is not None]
    if any(m < EPOCH for m in given):
        raise PlantError("time limits before 1970-01-01 are not supported")
    step = 1000
    low = OPEN_START if start is None else _micros(_utc(start)) + (step if closed in ("right", "neither") else 0)
    high = OPEN_END if end is None else _micros(_utc(end)) + (step if closed in ("right", "both") else 0)
    return low, high


def _moment(micros: int) -> Column:
    return F.lit(EPOCH + timedelta(microseconds=micros))


def in_time_range(
    column: str | Column,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    closed: str = "left",
) -> Column:
    """Predicate for a timestamp column, in a form that reaches the parquet scan. An open end adds no limit."""
    low, high = inclusive_exclusive(start, end, closed)
    moment = F.col(column) if isinstance(column, str) else column
    inside = moment.isNotNull()
    if start is not None:
        inside = inside & (moment >= _moment(low))
    if end is not None:
        inside = inside & (moment < _moment(high))
    return inside


def datapoints(
    dp: DataFrame,
    *,
    ids: Sequence[int] = (),
    external_ids: Sequence[str] = (),
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    closed: str = "left",
) -> DataFrame:
    """Points of the named series; a row carries the identifier kind it was asked by, the other is null."""
    if not ids and not external_ids:
        raise PlantError("data points are read by at least one id or externalId")
    by_id = F.col("id").isin(list(ids)) if ids else F.lit(False)
    by_name = F.col("externalId").isin(list(external_ids)) if external_ids else F.lit(False)
    points = dp.filter(in_time_range("timestamp", start, end, closed))
    if ids and external_ids:
        # A series asked for by both kinds is returned once for each.
        asked = F.filter(
            F.array(
                F.when(by_id, F.struct(F.col("id").alias("id"), F.lit(None).cast("string").alias("externalId"))),
                F.when(by_name, F.struct(F.lit(None).cast("long").alias("id"), F.col("externalId").alias("externalId"))),
            ),
            lambda x: x.isNotNull(),
        )
        found = points.filter(by_id | by_name).withColumn("_asked", F.explode(asked))
        return found.select("_asked.id", "_asked.externalId", "timestamp", "value")
    return points.filter(by_id | by_name).select(
        F.when(by_id, F.col("id")).alias("id"),
        F.when(by_name, F.col("externalId")).alias("externalId"),
        "timestamp",
        "value",
    )


def check_series_kind(series: DataFrame, requested: DataFrame, is_string: bool) -> DataFrame:
    """Requested series of the other kind, each with the message to raise. Empty when all is well."""
    other = "stringdatapoints" if not is_string else "datapoints"
    kind = "string" if not is_string else "numeric"
    return (
        series.filter(F.col("isString") != F.lit(is_string))
        .join(requested.select("id").distinct(), "id", "left_semi")
        .select(
            "id",
            F.concat(
                F.lit("series "), F.col("id").cast("string"), F.lit(f" holds {kind} points, read it with {other}")
            ).alias("error"),
        )
    )


def _check_aggregations(aggregations: Sequence[str], granularities: Sequence[str]) -> dict[str, int]:
    unknown = [a for a in aggregations if a not in AGGREGATES]
    if unknown:
        raise PlantError(f"unknown aggregation {', '.join(unknown)}")
    if aggregations and not granularities:
        raise PlantError("aggregations need a granularity")
    if granularities and not aggregations:
        raise PlantError("a granularity needs an aggregation")
    if not aggregations:
        raise PlantError("nothing to aggregate")
    return parse_all(granularities)


def aggregate_datapoints(
    dp: DataFrame,
    aggregations: Sequence[str],
    granularities: Sequence[str],
    *,
    series: Sequence[str] = ("id",),
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    closed: str = "left",
    is_step: str | bool = False,
    slice_micros: int = SLICE_MICROS,
) -> DataFrame:
    """Long-form aggregates: one row per (series, bucket, aggregation, granularity).

    Points become states of the largest bucket length that divides all granularities, in one shuffle with map-side
    partials; the buckets of every granularity are combined from these states. Order-dependent aggregates are solved per
    time slice and joined at slice borders. Interpolation needs only the first point of a bucket and the last point
    of the bucket before it. ``is_step`` is a constant or the name of a boolean column.
    """
    parsed = _check_aggregations(aggregations, granularities)
    wanted = list(dict.fromkeys(aggregations))
    step = F.col(is_step).cast("boolean") if isinstance(is_step, str) else F.lit(bool(is_step))
    neighbour = bool(_LEFT_NEIGHBOUR & set(wanted))
    series = list(series)

    low, high = inclusive_exclusive(start, end, closed)
    names: dict[int, list[str]] = {}
    for name, size in parsed.items():
        names.setdefault(size, []).append(name)
    limits = {size: (-(-low // size) * size, -(-high // size) * size) for size in names}
    earliest, latest = min(first for first, _ in limits.values()), max(last for _, last in limits.values())
    points = dp.filter(F.col("timestamp").isNotNull())
    inside = points if end is None else points.filter(F.col("timestamp") < _moment(latest))
    inside = inside if start is None else inside.filter(F.col("timestamp") >= _moment(earliest))

    states = _states(_measured(inside, series, step), series, math.gcd(*names), wanted, slice_micros)
    buckets = _rolled_up(states, series, math.gcd(*names), list(names), wanted)

    def of_size(values: dict[int, Column]) -> Column:
        return F.coalesce(*[F.when(F.col("_g") == size, value) for size, value in values.items()])

    first = of_size({size: F.lit(limit[0]) for size, limit in limits.items()})
    last = of_size({size: F.lit(limit[1]) for size, limit in limits.items()})
    if neighbour:
        history = None
        if start is not None:
            # All history before the range matters as one left neighbour only.
            before = _measured(points.filter(F.col("timestamp") < _moment(earliest)), series, step)
            before = before.groupBy(*series).agg(*_edge("last", F.max, F.max_by))
            history = before.withColumn("_g", F.explode(F.array(*[F.lit(size).cast("long") for size in names])))
        buckets = _with_left(buckets, history, series, first)
    values = F.array(*[F.struct(F.lit(n).alias("aggregation"), _value(n).alias("value")) for n in wanted])
    asked = of_size({size: F.array(*[F.lit(n) for n in own]) for size, own in names.items()})
    chosen = buckets.filter((F.col("_bucket") >= first) & (F.col("_bucket") < last))
    long = chosen.select(*series, "_g", F.timestamp_micros("_bucket").alias("timestamp"), F.explode(values).alias("_a"))
    long = long.filter(F.col("_a.value").isNotNull()).withColumn("granularity", F.explode(asked))
    return long.select(*series, "timestamp", F.col("_a.value").alias("value"), F.col("_a.aggregation").alias("aggregation"), "granularity")


def _measured(points: DataFrame, series: Sequence[str], step: Column) -> DataFrame:
    return points.select(
        *series, F.unix_micros("timestamp").alias("_t"), F.col("value").cast("double").alias("_v"), step.alias("_step")
    )


def _point(t: str, v: str) -> Column:
    return F.struct(F.col(t).alias("t"), F.col(v).alias("v"))


def _edge(name: str, extreme: Callable, at_extreme: Callable, t: str = "_t", v: str = "_v") -> list[Column]:
    """Time and value of the first or last point, as two numbers so that the aggregate stays hash-based."""
    return [extreme(t).alias(f"_{name}_t"), at_extreme(v, t).alias(f"_{name}_v")]


def _segments(t0: Column, v0: Column, t1: Column, v1: Column, step: Column) -> dict[str, Column]:
    """Contribution of the stretch between two neighbouring points."""
    seconds = (t1 - t0) / F.lit(1e6)
    return {
        "tv": F.abs(v1 - v0),
        "dt": seconds,
        "i1": F.when(step, seconds * v0).otherwise(seconds * (v0 + v1) / 2),
        "i2": F.when(step, seconds * v0 * v0).otherwise(seconds * (v0 * v0 + v0 * v1 + v1 * v1) / 3),
    }


def _states(rows: DataFrame, series: Sequence[str], base: int, wanted: Sequence[str], slice_micros: int) -> DataFrame:
    """What is known of each bucket of ``base``: number, sum, extremes, moment, first and last point, and, for aggregates
    that follow the order, stretches inside. Aggregates that are not asked for are pruned by the optimizer."""
    rows = rows.withColumn("_bucket", F.col("_t") - F.pmod("_t", F.lit(base)))
    keys, parts = [*series, "_bucket"], {}
    ordered = bool(_ORDERED & set(wanted))
    sliced = ordered and base > slice_micros
    if ordered:
        rows = rows.withColumn("_slice", F.floor(F.col("_t") / slice_micros) if sliced else F.lit(0))
        keys.append("_slice")
        inside = Window.partitionBy(*keys).orderBy("_t")
        rows = rows.withColumns({"_t0": F.lag("_t").over(inside), "_v0": F.lag("_v").over(inside)})
        parts = _segments(F.col("_t0"), F.col("_v0"), F.col("_t"), F.col("_v"), F.col("_step"))
    # The group-by reuses the partitioning of the window, so this is one shuffle of the points.
    states = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_v").alias("s"),
        F.min("_v").alias("mn"),
        F.max("_v").alias("mx"),
        (F.var_pop("_v") * F.count(F.lit(1))).alias("m2"),
        F.bool_or("_step").alias("_step"),
        *_edge("first", F.min, F.min_by),
        *_edge("last", F.max, F.max_by),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(k) for k, c in parts.items()],
    )
    return _combined(states, [*series, "_bucket"], "_slice", wanted) if sliced else states.drop("_slice")


def _combined(states: DataFrame, keys: Sequence[str], position: str, wanted: Sequence[str]) -> DataFrame:
    """States of ``keys`` from those of their parts, which follow each other by ``position``."""
    ordered, moments = bool(_ORDERED & set(wanted)), "discreteVariance" in wanted
    whole = {"n": F.sum("n"), "s": F.sum("s"), "mn": F.min("mn"), "mx": F.max("mx")}
    if moments:
        everything = Window.partitionBy(*keys)
        states = states.withColumn("_mean", F.sum("s").over(everything) / F.sum("n").over(everything))
        whole["m2"] = F.sum("m2") + F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("_mean"), 2))
    if ordered:
        chain = Window.partitionBy(*keys).orderBy(position)
        states = states.withColumn("_before", F.lag(_point("_last_t", "_last_v")).over(chain))
        border = _segments(F.col("_before.t"), F.col("_before.v"), F.col("_first_t"), F.col("_first_v"), F.col("_step"))
        whole |= {k: F.sum(k) + F.coalesce(F.sum(c), F.lit(0.0)) for k, c in border.items()}
    return states.groupBy(*keys).agg(
        *[c.alias(k) for k, c in whole.items()],
        F.bool_or("_step").alias("_step"),
        *_edge("first", F.min, F.min_by, "_first_t", "_first_v"),
        *_edge("last", F.max, F.max_by, "_last_t", "_last_v"),
    )


def _rolled_up(states: DataFrame, series: Sequence[str], base: int, sizes: Sequence[int], wanted: Sequence[str]) -> DataFrame:
    """States of the buckets of all sizes, ``_g`` long. States of ``base`` are dealt once, by series and a stretch of time
    that holds whole buckets of every size, so that they are combined where they lie and no shuffle has them twice."""
    if list(sizes) == [base]:
        return states.withColumn("_g", F.lit(base).cast("long"))
    stretch = math.lcm(*sizes)
    slab = F.floor(F.col("_bucket") / stretch) if stretch < OPEN_END else F.lit(0)
    dealt = states.withColumn("_slab", slab).repartition(*series, "_slab").withColumnRenamed("_bucket", "_part")
    each = dealt.withColumn("_g", F.explode(F.array(*[F.lit(size).cast("long") for size in sizes])))
    each = each.withColumn("_bucket", F.col("_part") - F.pmod("_part", "_g"))
    return _combined(each, [*series, "_slab", "_g", "_bucket"], "_part", wanted).drop("_slab")


def _with_left(buckets: DataFrame, history: DataFrame | None, series: Sequence[str], first: Column) -> DataFrame:
    """Buckets from ``first`` on with ``_left``, the last point before them. Buckets of a series are chained run by run."""
    keys = [*series, "_g"]
    run = F.when(F.col("_bucket") >= first, F.floor((F.col("_bucket") - first) / (F.col("_g") * BUCKETS_PER_RUN))).otherwise(-1)
    buckets = buckets.withColumn("_run", run)
    known = buckets.select(*keys, "_run", "_last_t", "_last_v")
    if history is not None:
        known = known.unionByName(history.withColumn("_run", F.lit(-1).cast("long")))
    ends = known.groupBy(*keys, "_run").agg(*_edge("end", F.max, F.max_by, "_last_t", "_last_v"))
    ends = ends.select(*keys, "_run", _point("_end_t", "_end_v").alias("last"))
    later = buckets.filter(F.col("_bucket") >= first).withColumn("_last_point", _point("_last_t", "_last_v"))
    return previous_across_slices(later, ends, keys, "_run", "_bucket", "_last_point", "_left")


def _value(name: str) -> Column:
    if name == "continuousVariance":
        mean1, mean2 = F.col("i1") / F.col("dt"), F.col("i2") / F.col("dt")
        return F.when(F.col("dt") > 0, mean2 - mean1 * mean1).otherwise(0.0)
    if name not in _LEFT_NEIGHBOUR:
        stated = {
            "count": F.col("n").cast("double"),
            "sum": F.col("s"),
            "min": F.col("mn"),
            "max": F.col("mx"),
            "average": F.col("s") / F.col("n"),
            "discreteVariance": F.col("m2") / F.col("n"),
            "totalVariation": F.col("tv"),
        }
        return stated[name]
    first, left = _point("_first_t", "_first_v"), F.col("_left")
    at_start = first["t"] == F.col("_bucket")
    as_step = F.when(at_start, first["v"]).otherwise(left["v"])
    if name == "stepInterpolation":
        return as_step
    share = (F.col("_bucket") - left["t"]) / (first["t"] - left["t"])
    straight = left["v"] + (first["v"] - left["v"]) * share
    return F.when(at_start | F.col("_step"), as_step).otherwise(straight)


def first_latest(
    dp: DataFrame,
    series: Sequence[str] = ("id",),
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    closed: str = "left",
) -> DataFrame:
    """First and latest point of each series in a range."""
    return (
        dp.filter(in_time_range("timestamp", start, end, closed))
        .groupBy(*series)
        .agg(
            F.min("timestamp").alias("firstTimestamp"),
            F.min_by("value", "timestamp").alias("firstValue"),
            F.max("timestamp").alias("latestTimestamp"),
            F.max_by("value", "timestamp").alias("latestValue"),
        )
    )


def first_rows(
    df: DataFrame, series: Sequence[str], n: int, position: str = "timestamp", slice_micros: int = SLICE_MICROS
) -> DataFrame:
    """The first ``n`` rows per series by time.

    Small ``n`` is a rank filter, which Spark applies before the shuffle too. For a large ``n`` the rows
    per time slice are counted first, so that only slices that can contribute are read and no task
    sorts a whole series. Both give the same rows: those without a time come first, ties go by the other columns.
    """
    series = list(series)
    order = _total_order(df, position)
    if n <= GROUP_LIMIT:
        ranked = Window.partitionBy(*series).orderBy(*order)
        return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n).drop("_rank")
    # Rows without a position come first, in a slice of their own, as they do in the rank filter.
    sliced = df.withColumn("_slice", F.coalesce(F.floor(F.unix_micros(position) / slice_micros), F.lit(-(1 << 62))))
    before = Window.partitionBy(*series).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        sliced.groupBy(*series, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .filter(F.col("_offset") < n)
        .select(*[F.col(c).alias(f"_of_{c}") for c in series], F.col("_slice").alias("_of_slice"), "_offset")
    )
    same = F.col("_slice") == F.col("_of_slice")
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    inside = Window.partitionBy(*series, "_slice").orderBy(*order)
    return (
        sliced.join(counts, same)
        .withColumn("_rank", F.col("_offset") + F.row_number().over(inside))
        .filter(F.col("_rank") <= n)
        .select(*df.columns)
    )


def _total_order(df: DataFrame, position: str) -> list[str]:
    """The position, then every other column that can be ordered, so that ties are settled by the rows alone."""
    unordered = ("map", "variant")
    return [position, *[c for c, kind in df.dtypes if c != position and not any(u in kind for u in unordered)]]


def page_after(dp: DataFrame, after: datetime | str, n: int, series: Sequence[str] = ("id",)) -> DataFrame:
    """The next page: up to ``n`` points per series, at least 1 ms after ``after``."""
    low, _ = inclusive_exclusive(after, None, "right")
    return first_rows(dp.filter(F.col("timestamp") >= _moment(low)), series, n)
