"""Writes keyed by series and time, or by sequence and row number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlantError
from ..session import cut_lineage
from .datapoints import SLICE_MICROS
from .intervals import merge_intervals
from .skew import keep_greatest

# A delete list of up to this many range days is copied to every executor, a longer one is swept.
MAX_BROADCAST_RANGES = 100_000
DAY_MICROS = 86_400_000_000


def resolve_series(rows: DataFrame, series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give each row its series ``id``: a positive id is taken as it is, else the external id is looked up.

    Returns the resolved rows and the rows without a usable identifier. ``series`` has id and externalId.
    """
    named = series.filter(F.col("externalId").isNotNull()).select("externalId", F.col("id").alias("_series"))
    rest = [c for c in rows.columns if c not in ("id", "externalId")]
    given = F.when(F.col("id") > 0, F.col("id")) if "id" in rows.columns else F.lit(None).cast("long")
    work = rows.withColumn("_given", given)
    if "externalId" not in rows.columns:
        work = work.withColumn("externalId", F.lit(None).cast("string"))
    # Only rows without an id need the name; the series list is one row per series.
    found = work.withColumn("_name", F.when(F.col("_given").isNull(), F.col("externalId")))
    found = found.drop("externalId").join(named.withColumnRenamed("externalId", "_name"), "_name", "left")
    found = found.withColumn("_id", F.coalesce("_given", "_series"))
    good = found.filter("_id is not null").select(F.col("_id").alias("id"), *rest)
    error = F.when(F.col("_name").isNull(), F.lit("either id or externalId must be set")).otherwise(
        F.concat(F.lit("unknown externalId "), F.col("_name"))
    )
    return good, found.filter("_id is null").select(error.alias("error"), *rest)


def upsert_points(target: DataFrame, source: DataFrame, keys: Sequence[str] = ("id", "timestamp")) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same key; among source rows the greatest wins.

    The cleaned source is written once, so that its size is known: a small one is copied to the
    executors and the large target is not shuffled.
    """
    fresh = cut_lineage(keep_greatest(source.select(*target.columns), list(keys)))
    return target.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def delete_range_bounds(ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delete requests as ``[begin, end)`` per identifier, and the refused requests.

    Exactly one begin and one end; an exclusive begin and an inclusive end move by 1 ms.
    """
    step = F.expr("interval 1 millisecond")
    has = set(ranges.columns)

    def col(name: str, kind: str) -> Column:
        return F.col(name) if name in has else F.lit(None).cast(kind)

    ib, eb = col("inclusiveBegin", "timestamp"), col("exclusiveBegin", "timestamp")
    ie, ee = col("inclusiveEnd", "timestamp"), col("exclusiveEnd", "timestamp")
    begin = F.coalesce(ib, eb + step)
    end = F.coalesce(ee, ie + step)
    error = (
        F.when(col("id", "long").isNull() & col("externalId", "string").isNull(), "a range needs an id or externalId")
        .when(ib.isNotNull() & eb.isNotNull(), "a range has both inclusiveBegin and exclusiveBegin")
        .when(ib.isNull() & eb.isNull(), "a range needs inclusiveBegin or exclusiveBegin")
        .when(ie.isNotNull() & ee.isNotNull(), "a range has both inclusiveEnd and exclusiveEnd")
        .when(ie.isNull() & ee.isNull(), "a range needs inclusiveEnd or exclusiveEnd")
        .when(end <= begin, "the range is empty")
    )
    checked = ranges.select(
        col("id", "long").alias("id"),
        col("externalId", "string").alias("externalId"),
        begin.alias("begin"),
        end.alias("end"),
        error.alias("error"),
    )
    good = checked.filter("error is null").drop("error")
    return good, checked.filter("error is not null")


def delete_ranges(
    dp: DataFrame, ranges: DataFrame, max_broadcast: int = MAX_BROADCAST_RANGES
) -> tuple[DataFrame, DataFrame]:
    """Points that stay after the ranges are deleted, and the refused requests.

    Requests may name the series by id or by external id (id first). Ranges of a series are first made
    disjoint. A short list is cut by day and copied to every executor; with a long one the points and
    the ends of the ranges are swept together, hour by hour, so neither a series with many points nor
    one with many ranges is handled in one task.
    """
    good, errors = delete_range_bounds(ranges)
    kept = dp
    for key, chosen in (("id", good.filter("id is not null")), ("externalId", good.filter("id is null"))):
        wanted = chosen.select(F.col(key).alias("_series"), F.col("begin"), F.col("end"))
        kept = _without(kept, wanted, key, max_broadcast)
    return kept, errors


def _day(column: Column) -> Column:
    return F.floor(F.unix_micros(column) / DAY_MICROS)


def _without(dp: DataFrame, ranges: DataFrame, key: str, max_broadcast: int) -> DataFrame:
    if ranges.isEmpty():
        return dp
    disjoint = cut_lineage(merge_intervals(ranges, "begin", "end", by=["_series"]))
    last_day = _day(F.col("end") - F.expr("interval 1 microsecond"))
    first_day = _day(F.col("begin"))
    size = disjoint.agg(F.sum(last_day - first_day + 1).alias("n")).first()["n"]
    if size > max_broadcast:
        return _swept(dp, disjoint, key)
    by_day = disjoint.withColumn("_range_day", F.explode(F.sequence(first_day, last_day)))
    moment = F.col("timestamp")
    within = (
        (F.col(key) == F.col("_series"))
        & (F.col("_day") == F.col("_range_day"))
        & (moment >= F.col("begin"))
        & (moment < F.col("end"))
    )
    dated = dp.withColumn("_day", _day(moment))
    return dated.join(F.broadcast(by_day), within, "left_anti").drop("_day")  # size computed above


def _swept(dp: DataFrame, disjoint: DataFrame, key: str) -> DataFrame:
    """Points outside the ranges, from a running count of open ranges in the order of time."""
    point = F.struct(*[F.col(f"`{c}`") for c in dp.columns])
    # No range covers a point without a series or a time; both ways of deleting keep it.
    placed = F.col(key).isNotNull() & F.col("timestamp").isNotNull()
    named = dp.filter(placed).select(
        F.col(key).alias("_series"), F.unix_micros("timestamp").alias("_at"), F.lit(0).alias("_step"), point.alias("_point")
    )
    ends = F.explode(
        F.array(
            F.struct(F.unix_micros("begin").alias("at"), F.lit(1).alias("step")),
            F.struct(F.unix_micros("end").alias("at"), F.lit(-1).alias("step")),
        )
    )
    steps = disjoint.select("_series", ends.alias("_e")).select(
        "_series", F.col("_e.at").alias("_at"), F.col("_e.step").alias("_step")
    )
    both = named.unionByName(steps, allowMissingColumns=True).withColumn("_slice", F.floor(F.col("_at") / SLICE_MICROS))
    before = Window.partitionBy("_series").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        both.groupBy("_series", "_slice")
        .agg(F.sum("_step").alias("_n"))
        .select("_series", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"))
    )
    # At one moment the ends come before the points: a range holds its begin and not its end.
    inside = Window.partitionBy("_series", "_slice").orderBy("_at", F.col("_point").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = both.withColumn("_open", F.sum("_step").over(inside)).join(carry, ["_series", "_slice"])
    kept = counted.filter(F.col("_point").isNotNull() & (F.col("_open") + F.col("_carry") == 0)).select("_point.*")
    return kept.unionByName(dp.filter(~placed))


# Value types of sequence columns.
SEQUENCE_TYPES = {"STRING": T.StringType(), "DOUBLE": T.DoubleType(), "LONG": T.LongType()}
_ACCEPTED = {
    "STRING": (T.StringType,),
    "DOUBLE": (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.DecimalType),
    "LONG": (T.IntegerType, T.LongType),
}


def sequence_row_schema(columns: Sequence[tuple[str, str]]) -> T.StructType:
    """Row schema of a sequence from its (external id, value type) column list."""
    fields = [T.StructField("rowNumber", T.LongType(), False)]
    for name, value_type in columns:
        if not name:
            raise PlantError("a sequence column has no externalId")
        if value_type not in SEQUENCE_TYPES:
            raise PlantError(f"Unknown sequence column type {value_type}")
        fields.append(T.StructField(name, SEQUENCE_TYPES[value_type]))
    return T.StructType(fields)


def sequence_rows(rows: DataFrame, columns: Sequence[tuple[str, str]], select: Sequence[str] | None = None) -> DataFrame:
    """Stored rows with the declared types, in any projected order."""
    schema = sequence_row_schema(columns)
    return rows.select(*[F.col(f"`{n}`").cast(schema[n].dataType).alias(n) for n in select or schema.fieldNames()])


def upsert_sequence_rows(
    target: DataFrame, source: DataFrame, columns: Sequence[tuple[str, str]], key: str = "id"
) -> DataFrame:
    """Upsert by (sequence, rowNumber). Columns that the source lacks keep their values."""
    known = dict(columns)
    if "rowNumber" not in source.columns:
        raise PlantError("sequence rows need a rowNumber")
    if key not in source.columns:
        raise PlantError("sequence rows need an id or externalId")
    for field in source.schema.fields:
        if field.name in ("rowNumber", "id", "externalId"):
            continue
        if field.name not in known:
            raise PlantError(f"column {field.name} does not exist in the sequence")
        if not isinstance(field.dataType, (*_ACCEPTED[known[field.name]], T.NullType)):
            raise PlantError(f"Column `{field.name}` has type {field.dataType.simpleString()}, expected {known[field.name]}")
    keys = [key, "rowNumber"]
    given = [c for c in target.columns if c in source.columns]
    typed = source.select(*[F.col(f"`{c}`").cast(target.schema[c].dataType).alias(c) for c in given])
    fresh = cut_lineage(keep_greatest(typed, keys))
    new = F.struct(*[F.col(f"`{c}`") for c in given]).alias("_new")
    joined = target.join(fresh.select(*keys, new), keys, "left")
    replaced = joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new").getField(c)).otherwise(F.col(f"`{c}`")).alias(c)
            if c in given and c not in keys
            else F.col(f"`{c}`")
            for c in target.columns
        ]
    )
    present = target.select(*keys).join(fresh.select(*keys), keys, "left_semi")
    return replaced.unionByName(fresh.join(present, keys, "left_anti"), allowMissingColumns=True)


def delete_sequence_rows(target: DataFrame, source: DataFrame, keys: Sequence[str] = ("id", "rowNumber")) -> DataFrame:
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti")


def diff_sequence_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Column changes per sequence: add, remove, modify, or an error for a changed value type.

    Both sides have ``externalId`` and ``columns``. A null or empty column list asks for no change.
    """
    asked = source.filter(F.size(F.coalesce("columns", F.array().cast(source.schema["columns"].dataType))) > 0)
    new = asked.select("externalId", F.explode("columns").alias("c")).select(
        "externalId", F.col("c.externalId").alias("column"), F.col("c.valueType").alias("newType")
    )
    old = (
        target.join(asked.select("externalId"), "externalId", "left_semi")
        .select("externalId", F.explode("columns").alias("c"))
        .select("externalId", F.col("c.externalId").alias("column"), F.col("c.valueType").alias("oldType"))
    )
    known = target.select("externalId")
    joined = new.withColumn("_new", F.lit(True)).join(known, "externalId", "left_semi").join(
        old.withColumn("_old", F.lit(True)), ["externalId", "column"], "full"
    )
    change = (
        F.when(F.col("_old").isNull(), "add")
        .when(F.col("_new").isNull(), "remove")
        .when(F.col("newType").isNotNull() & (F.col("newType") != F.col("oldType")), "error")
        .otherwise("modify")
    )
    value_type = F.when(change == "add", F.coalesce("newType", F.lit("STRING"))).otherwise(F.col("oldType"))
    return joined.select("externalId", "column", change.alias("change"), value_type.alias("valueType"))


