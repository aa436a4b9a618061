"""Writing result tables. A table is written next to its inputs, never over them while they are read,
except for the days of a data-point table, which are replaced one partition at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.series_writes import upsert_points


def write_table(df: DataFrame, path: str) -> None:
    """Write a whole resource table to a new folder."""
    df.write.mode("errorifexists").parquet(path)


def _day() -> Column:
    return F.to_date("timestamp").alias("day")


def _arranged(points: DataFrame) -> DataFrame:
    """Points by day, series and time. Ranges split a hot series or day over several files."""
    dated = points.select("*", _day())
    return dated.repartitionByRange("day", "id", "timestamp").sortWithinPartitions("day", "id", "timestamp")


def write_points(points: DataFrame, path: str) -> None:
    """Write a data-point table with one folder per day, sorted by series and time."""
    _arranged(points).write.mode("errorifexists").partitionBy("day").parquet(path)


def read_points(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A data-point table. With the columns of a point named, a folder that has no file yet is an empty table."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)


def upsert_points_at(spark: SparkSession, path: str, source: DataFrame, schema: T.StructType | None = None) -> None:
    """Upsert points into a stored table: only the days that ``source`` touches are read and replaced.

    Running it again with the same source gives the same table.
    """
    days = [r["day"] for r in source.select(_day()).distinct().collect()]  # one value per day
    if not days:
        return
    stored = read_points(spark, path, schema)
    touched = stored.filter(F.col("day").isin(days)).drop("day")
    merged = upsert_points(touched, source.select(*touched.columns))
    (
        _arranged(merged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
