"""Building blocks that keep one hot key from landing in one task.

Order-dependent work (previous row, running sum, rank) normally sorts a whole key in one task.
Here a key is cut into slices whose size does not depend on how often the key occurs. Each slice is
solved alone, and a small table with one row per (key, slice) carries state across slice borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Aimed size and largest number of the slices that a table is cut into by value.
SLICE_ROWS = 500_000
MAX_SLICES = 1024
HASH_BUCKETS = 65_536


def orderable(df: DataFrame) -> list[Column]:
    """All columns of ``df`` in a form that can be compared: maps become sorted entries."""
    return [
        F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]


def keep_greatest(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the one with the greatest ``order``, ties settled by the whole row.

    It is an aggregate, so copies collapse before the shuffle; a window would gather all copies
    of a key in one task.
    """
    prefix = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    if not any(_has_map(df, c) for c in df.columns):
        best = F.max(F.struct(*prefix, *[F.col(f"`{c}`") for c in df.columns]))
    else:
        rank = F.struct(*prefix, *[c.alias(f"_c{i}") for i, c in enumerate(orderable(df))])
        best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), rank)
    picked = df.groupBy(*keys).agg(best.alias("_row"))
    return picked.select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def has_hot_key(df: DataFrame, keys: Sequence[str], copies: int = SLICE_ROWS) -> tuple[int, bool]:
    """The number of rows, and whether a key may have more than ``copies`` of them, from counts of hash buckets."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS))
    counted = df.groupBy(bucket.alias("_bucket")).count().agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    rows = counted["n"] or 0
    return rows, (counted["most"] or 0) > copies + 2 * rows // HASH_BUCKETS


def previous_across_slices(
    rows: DataFrame, ends: DataFrame, keys: Sequence[str], slice_: str, position: str, value: str, out: str
) -> DataFrame:
    """``value`` of the previous row per key, where a key is sorted slice by slice.

    ``ends`` holds one row per (key, slice) with ``last``, the value of the slice's last row.
    """
    local = Window.partitionBy(*keys, slice_).orderBy(position)
    across = Window.partitionBy(*keys).orderBy(slice_)
    carry = ends.select(*keys, slice_, F.lag("last").over(across).alias("_carry"))
    return (
        rows.withColumn(out, F.lag(value).over(local))
        .join(carry, [*keys, slice_], "left")
        .withColumn(out, F.coalesce(out, "_carry"))
        .drop("_carry")
    )


def quantile_bounds(df: DataFrame, column: str, slices: int | None = None) -> list[int]:
    """Cut points that split ``column`` evenly; none when the table is small enough for one slice.

    Without ``slices`` there is one slice per ``SLICE_ROWS`` rows, ``MAX_SLICES`` at most.
    """
    needed = slices or min(MAX_SLICES, -(-df.count() // SLICE_ROWS))
    if needed <= 1:
        return []
    fractions = [i / needed for i in range(1, needed)]
    found = df.agg(F.percentile_approx(column, fractions, 10_000).alias("q")).first()["q"] or []
    return sorted(set(found))


def slice_of(column: Column, bounds: Sequence[int]) -> Column:
    """Index of the slice holding a value, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(0)

    def branch(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column < bounds[middle], branch(low, middle)).otherwise(branch(middle + 1, high))

    return branch(0, len(bounds))


def dense_rank_ids(df: DataFrame, order_key: Column, out: str, slices: int = 8192) -> DataFrame:
    """Number the rows 0, 1, 2, ... without sorting them all in one task.

    Rows fall into hash slices of ``order_key``; a row's number is the size of the slices before its
    own plus its rank inside it. The number depends on the rows only, so a retried task repeats it.
    ``order_key`` should be unique.
    """
    marked = df.withColumn("_key", order_key).withColumn("_slice", F.pmod(F.xxhash64("_key"), F.lit(slices)))
    sizes = marked.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_slice").orderBy("_key")
    return (
        marked.join(F.broadcast(offsets), "_slice")  # at most `slices` rows
        .withColumn(out, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_key", "_slice", "_offset")
    )


def _has_map(df: DataFrame, column: str) -> bool:
    return "map" in df.schema[column].dataType.simpleString()
