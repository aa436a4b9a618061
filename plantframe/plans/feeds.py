"""Incremental sync and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sync import apply_changes, format_cursor, sync
from ..session import scratch_dir
from ..sources.sink import read_points
from ..sources.star import TABLES, Star
from ..streaming.downsample import read_corrected, stream_aggregates, stream_corrected, stream_to_table, stream_upserts
from .oracle import with_views
from .registry import query
from .timeseries import FIVE, H6, PLAIN_SQL, plain_sql, rounded

# 2024-01-15 00:00:00 in microseconds, with an id below all others.
MIDDLE = format_cursor(1_705_276_800_000_000, -1)


def _feed(s: Star) -> DataFrame:
    """Events as changes: errors delete their item."""
    return s.base("events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("lastUpdatedTime"), F.col("user_id").alias("item"), "value",
        F.when(F.col("event_type") == "error", F.unix_millis("ts")).otherwise(0).alias("deletedTime"),
    )


_FEED = """
    feed AS (
        SELECT event_id AS id, ts AS lastUpdatedTime, user_id AS item, value, event_type = 'error' AS deleted,
               epoch_us(ts) AS us
        FROM events)"""
_CURSOR = "(SELECT max({'t': us, 'i': id}).t || ':' || max({'t': us, 'i': id}).i FROM feed %s)"


def _with_cursor(rows: DataFrame) -> DataFrame:
    return rows.select("id", "lastUpdatedTime", "item", F.col("`metadata.cursor`").alias("next"))


@query(
    "sync_backfill",
    f"WITH {_FEED} SELECT id, lastUpdatedTime, item, {_CURSOR % ''} AS next FROM feed",
)
def sync_backfill(s: Star) -> DataFrame:
    return _with_cursor(sync(_feed(s))[0])


@query(
    "sync_incremental",
    f"WITH {_FEED} SELECT id, lastUpdatedTime, item, {_CURSOR % ''} AS next FROM feed WHERE lastUpdatedTime >= TIMESTAMP '2024-01-15'",
)
def sync_incremental(s: Star) -> DataFrame:
    return _with_cursor(sync(_feed(s), MIDDLE)[0])


_UNTIL = "WHERE lastUpdatedTime < TIMESTAMP '2024-01-20'"


@query(
    "sync_bounded",
    f"""
    WITH {_FEED} SELECT id, lastUpdatedTime, item, {_CURSOR % _UNTIL} AS next FROM feed
    {_UNTIL} AND lastUpdatedTime >= TIMESTAMP '2024-01-15'""",
)
def sync_bounded(s: Star) -> DataFrame:
    return _with_cursor(sync(_feed(s), MIDDLE, until="2024-01-20")[0])


@query(
    "sync_resumed",
    f"WITH {_FEED} SELECT id, count(*) AS n FROM feed GROUP BY id",
)
def sync_resumed(s: Star) -> DataFrame:
    """Two runs, the second from the cursor of the first: every row comes once."""
    first, cursor = sync(_feed(s), until="2024-01-20")
    second, _ = sync(_feed(s), cursor)
    return first.unionByName(second).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sync_expired",
    f"WITH {_FEED} SELECT id, lastUpdatedTime, item, {_CURSOR % ''} AS next FROM feed",
)
def sync_expired(s: Star) -> DataFrame:
    return _with_cursor(sync(_feed(s), MIDDLE, retained_since="2024-01-20")[0])


@query(
    "sync_filtered",
    f"""
    WITH {_FEED} SELECT id, lastUpdatedTime, item, {_CURSOR % ''} AS next FROM feed
    WHERE lastUpdatedTime >= TIMESTAMP '2024-01-15' AND value > 100 AND item < 75""",
)
def sync_filtered(s: Star) -> DataFrame:
    return _with_cursor(sync(_feed(s), MIDDLE, where="value > 100 and item < 75")[0])


@query(
    "sync_apply_changes",
    f"""
    WITH {_FEED},
    old AS (SELECT item, max(value) AS value FROM feed GROUP BY item),
    latest AS (SELECT item, arg_max({{'v': value, 'd': deleted}}, {{'us': us, 'id': id}}) AS r FROM feed
               WHERE lastUpdatedTime >= TIMESTAMP '2024-01-30' GROUP BY item)
    SELECT item, CASE WHEN r IS NULL THEN value ELSE r.v END AS value FROM old LEFT JOIN latest USING (item)
    WHERE r IS NULL OR NOT r.d""",
)
def sync_apply_changes(s: Star) -> DataFrame:
    """The last day of the feed applied to a table of items."""
    feed = _feed(s)
    target = feed.groupBy("item").agg(F.max("value").alias("value"))
    changes, _ = sync(feed, format_cursor(1_706_572_800_000_000, -1))
    return apply_changes(target, changes, ["item"])


def _stream(s: Star) -> DataFrame:
    reader = s.spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet")
    return reader.parquet(s.root).select(F.col("user_id").alias("id"), F.col("ts").alias("timestamp"), "value")


@query(
    "stream_aggregates",
    with_views("dp")
    + plain_sql(
        {a: PLAIN_SQL[a] for a in FIVE}, "6h", H6,
        "timestamp + INTERVAL 6 HOUR <= (SELECT max(timestamp) - INTERVAL 1 HOUR FROM dp)",
    ),
)
def stream_aggregates_query(s: Star) -> DataFrame:
    """Finished six-hour buckets of a stream; the last buckets wait for the watermark."""
    path = f"{scratch_dir(s.spark)}/stream-{uuid.uuid4().hex}"
    rows = stream_aggregates(_stream(s), FIVE, "6h", "1 hour")
    stream_to_table(rows, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    schema = "id long, timestamp timestamp, value double, aggregation string, granularity string"
    return rounded(s.spark.read.schema(schema).parquet(f"{path}/table"))


@query(
    "stream_upserts",
    with_views("dp") + "SELECT id, timestamp, value, timestamp::DATE AS day FROM dp",
)
def stream_upserts_query(s: Star) -> DataFrame:
    path = f"{scratch_dir(s.spark)}/points-{uuid.uuid4().hex}"
    stream_upserts(_stream(s), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return read_points(s.spark, f"{path}/table").select("id", "timestamp", "value", "day")


@query(
    "stream_late_rows",
    with_views("dp") + plain_sql({a: PLAIN_SQL[a] for a in FIVE}, "6h", H6),
)
def stream_late_rows(s: Star) -> DataFrame:
    """Points dealt over files without regard to time, a file a batch: late ones correct buckets, none waits or is lost."""
    path = f"{scratch_dir(s.spark)}/late-{uuid.uuid4().hex}"
    points = s.base("events").select(F.col("user_id").alias("id"), F.col("ts").alias("timestamp"), "value")
    points.repartition(3, F.xxhash64("id", "timestamp")).write.parquet(f"{path}/source")
    stream = s.spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/source")
    stream_corrected(stream, path, f"{path}/checkpoint", FIVE, ["6h"]).awaitTermination()
    return rounded(read_corrected(s.spark, path))
