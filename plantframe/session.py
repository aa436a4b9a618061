"""Session settings the engine is designed for, and lineage cuts on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .errors import PlantError

# Settings recommended for a cluster: adaptive re-planning with skew-join splitting, also where
# the split costs one more shuffle, and UTC so that epoch buckets and stored times agree.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables, as the session names it."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise PlantError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="plantframe-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to shared storage and go on from there, so that a lost executor costs no recomputation.

    Unlike a checkpoint the table keeps its size and columns known to the optimizer. A reader holds a row group at once,
    and Parquet measures one, and its pages, only every 100 rows: for rows of much data, ``group_bytes`` bounds a row
    group (one row at least) and has every row measured.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/cut-{uuid.uuid4().hex}"
    every = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
    df.write.options(**({"parquet.block.size": str(group_bytes), **every} if group_bytes else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
