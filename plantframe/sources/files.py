"""Content of files with one JSON object or one text per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The largest file in bytes and the longest line in characters.
FILE_LIMIT = 5 * 1024**3
LINE_LIMIT = 1_250_000


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes`` per file, from the listing: the content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def limit_errors(
    spark: SparkSession, path: str, file_limit: int = FILE_LIMIT, line_limit: int = LINE_LIMIT
) -> DataFrame:
    """Files over the size limit and files with a line over the length limit."""
    large = file_sizes(spark, path).filter(F.col("bytes") > file_limit).select(
        "file", F.lit(f"file is larger than {file_limit} bytes").alias("error")
    )
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.length("value").alias("n"))
    long = lines.groupBy("file").agg(F.max("n").alias("n")).filter(F.col("n") > line_limit).select(
        "file", F.lit(f"line is longer than {line_limit} characters").alias("error")
    )
    return large.unionByName(long)


def read_file_content(spark: SparkSession, path: str, infer_schema: bool = True) -> DataFrame:
    """Lines as rows with an inferred schema, or as one text column ``value``."""
    return spark.read.json(path) if infer_schema else spark.read.text(path)
