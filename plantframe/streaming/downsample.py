"""The same downsampling and upserts over a stream of data points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..errors import PlantError
from ..functions.granularity import to_micros
from ..operators.datapoints import aggregate_datapoints
from ..operators.skew import keep_greatest
from ..session import cut_lineage
from ..sources.sink import read_points, upsert_points_at, write_points

_BY_WINDOW = {
    "count": lambda: F.count(F.lit(1)).cast("double"),
    "sum": lambda: F.sum("value"),
    "min": lambda: F.min("value"),
    "max": lambda: F.max("value"),
    "average": lambda: F.avg("value"),
    "discreteVariance": lambda: F.var_pop("value"),
}


def stream_aggregates(
    points: DataFrame, aggregations: Sequence[str], granularity: str, watermark: str, series: Sequence[str] = ("id",)
) -> DataFrame:
    """Epoch-aligned buckets over a stream. Points later than the watermark are dropped."""
    unknown = [a for a in aggregations if a not in _BY_WINDOW]
    if unknown:
        raise PlantError(f"Aggregation {', '.join(unknown)} needs ordered points and is not streamed")
    width = f"{to_micros(granularity) // 1_000_000} seconds"
    grouped = (
        points.withWatermark("timestamp", watermark)
        .groupBy(*series, F.window("timestamp", width).alias("_w"))
        .agg(*[_BY_WINDOW[a]().alias(f"_{a}") for a in aggregations])
    )
    long = grouped.select(
        *series,
        F.col("_w.start").alias("timestamp"),
        F.explode(
            F.array(*[F.struct(F.lit(a).alias("aggregation"), F.col(f"_{a}").alias("value")) for a in aggregations])
        ).alias("_a"),
    )
    return long.select(
        *series, "timestamp", "_a.value", "_a.aggregation", F.lit(granularity).alias("granularity")
    )


def _exists(path: str, batch: DataFrame) -> bool:
    jvm = batch.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(batch.sparkSession._jsc.hadoopConfiguration()).exists(target)


def _store(batch: DataFrame, path: str) -> None:
    if _exists(path, batch):
        upsert_points_at(batch.sparkSession, path, batch, batch.schema)
    else:
        write_points(keep_greatest(batch, ["id", "timestamp"]), path)


def stream_upserts(points: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch into a day-partitioned table; a repeated batch changes nothing."""
    return (
        points.writeStream.foreachBatch(lambda batch, _: _store(batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_DAY = 86_400_000_000
_INSIDE_BUCKETS = {*_BY_WINDOW, "totalVariation", "continuousVariance"}


def _bucket_day(width: int) -> Column:
    micros = F.unix_micros("timestamp")
    return F.to_date(F.timestamp_micros(micros - F.pmod(micros, F.lit(width))))


def stream_corrected(
    points: DataFrame, path: str, checkpoint: str, aggregations: Sequence[str], granularities: Sequence[str]
) -> StreamingQuery:
    """Aggregates of a stream of (id, timestamp, value) in which late points correct the buckets written before.

    A micro-batch is merged into ``path/points``. The buckets that start on the days it touches are computed again from
    there, by the same operator as in a batch, and replace those days of ``path/aggregates``. Nothing waits for a
    watermark and nothing is dropped: the table is that of all points so far, in whatever order files arrive. Where
    batches hold several values for one time the last batch counts. A batch that died midway is repeated as a whole and
    leaves the same tables. Rows without an id or a time are no points.
    """
    outside = [a for a in aggregations if a not in _INSIDE_BUCKETS]
    if outside:
        raise PlantError(f"Aggregation {', '.join(outside)} looks beyond its bucket and is not streamed")
    widths = {g: to_micros(g) for g in granularities}

    def write(batch: DataFrame, _: int) -> None:
        rows = cut_lineage(batch.filter("id is not null and timestamp is not null"))
        if rows.isEmpty():
            return
        _store(rows, f"{path}/points")
        stored = read_points(rows.sparkSession, f"{path}/points", rows.schema)
        for granularity, width in widths.items():
            days = rows.select(_bucket_day(width).alias("_bucket_day")).distinct()
            low, high = days.agg(F.min("_bucket_day"), F.max("_bucket_day")).first()
            # Points of a bucket lie on the day it starts or after it, by no more than its length.
            near = stored.filter(F.col("day").between(F.lit(low), F.date_add(F.lit(high), -(-width // _DAY))))
            touched = near.withColumn("_bucket_day", _bucket_day(width)).join(days, "_bucket_day", "left_semi")
            found = aggregate_datapoints(touched, aggregations, [granularity]).withColumn("day", F.to_date("timestamp"))
            (
                found.repartitionByRange("day", "id", "timestamp")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("granularity", "day")
                .parquet(f"{path}/aggregates")
            )

    return points.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_corrected(spark: SparkSession, path: str) -> DataFrame:
    """The aggregates that ``stream_corrected`` keeps."""
    schema = "id long, timestamp timestamp, value double, aggregation string, granularity string, day date"
    return spark.read.schema(schema).parquet(f"{path}/aggregates").drop("day")


def stream_to_table(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Append finished buckets to a parquet table until the source is read through."""
    return (
        rows.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


