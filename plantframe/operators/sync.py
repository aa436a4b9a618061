"""Incremental reads of a changing table with a cursor, and applying the changes.

The cursor is (last update time, id), so rows with equal times are neither lost nor repeated.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .datapoints import _micros, _utc
from .skew import keep_greatest

log = logging.getLogger(__name__)


def format_cursor(micros: int, item: object) -> str:
    return f"{micros}:{item}"


def parse_cursor(cursor: str) -> tuple[int, str]:
    micros, item = cursor.split(":", 1)
    return int(micros), item


def _after(time: str, item: str, cursor: str, df: DataFrame) -> Column:
    micros, value = parse_cursor(cursor)
    moment = F.timestamp_micros(F.lit(micros))
    last = F.lit(value).cast(df.schema[item].dataType)
    # The first condition alone reaches the files; the second settles ties.
    return (F.col(time) >= moment) & ((F.col(time) > moment) | (F.col(item) > last))


def sync(
    table: DataFrame,
    cursor: str | None = None,
    until: datetime | str | None = None,
    *,
    where: Column | str | None = None,
    retained_since: datetime | str | None = None,
    time: str = "lastUpdatedTime",
    item: str = "id",
) -> tuple[DataFrame, str | None]:
    """Rows changed after ``cursor``, and the cursor to go on from, also in ``metadata.cursor``.

    Without a cursor, or with one older than ``retained_since``, everything is read and the cursor is
    taken before the read. ``until`` (default: now) ends a feed that keeps changing.
    """
    stop = F.lit(_utc(until)) if until is not None else F.lit(datetime.now(timezone.utc))
    if cursor and retained_since is not None and parse_cursor(cursor)[0] < _micros(_utc(retained_since)):
        log.warning("cursor has expired, reading everything")
        cursor = None
    changed = table.filter(F.col(time) < stop)
    if cursor:
        changed = changed.filter(_after(time, item, cursor, table))
    # One row comes to the driver: the greatest (time, id).
    newest = changed.agg(F.max(F.struct(F.unix_micros(time).alias("t"), F.col(item).alias("i"))).alias("m")).first()["m"]
    following = format_cursor(newest["t"], newest["i"]) if newest else cursor
    rows = changed.filter(where) if where is not None else changed
    return rows.withColumn("metadata.cursor", F.lit(following)), following


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    time: str = "lastUpdatedTime",
    deleted: str = "deletedTime",
) -> DataFrame:
    """The target after a change feed: the latest change per key counts, a deleted item goes."""
    latest = cut_lineage(keep_greatest(changes, list(keys), [F.col(time)]))
    alive = latest.filter(F.coalesce(F.col(deleted), F.lit(0)) == 0).select(*target.columns)
    return target.join(latest.select(*keys), list(keys), "left_anti").unionByName(alive)


def save_cursor(spark: SparkSession, path: str, name: str, cursor: str) -> bool:
    """Keep a cursor after the rows are safely written. A failure is reported, never raised."""
    try:
        row = spark.createDataFrame([(name, cursor, datetime.now(timezone.utc))], "name string, cursor string, saved timestamp")
        row.coalesce(1).write.mode("append").parquet(path)
        return True
    except Exception as error:  # noqa: BLE001
        log.warning("cursor %s was not saved: %s", name, error)
        return False


def load_cursor(spark: SparkSession, path: str, name: str) -> str | None:
    found = spark.read.parquet(path).filter(F.col("name") == name).agg(F.max_by("cursor", "saved").alias("c")).first()
    return found["c"]
