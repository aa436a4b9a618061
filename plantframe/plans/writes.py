"""Inserts, updates, upserts and deletes of resources."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.merge import merge
from ..operators.mixed_rows import check_mixed_rows, mixed_cells, upsert_mixed_rows
from ..operators.series_writes import (
    delete_range_bounds,
    delete_ranges,
    delete_sequence_rows,
    diff_sequence_columns,
    resolve_series,
    upsert_points,
    upsert_sequence_rows,
)
from ..operators.skew import keep_greatest
from ..session import scratch_dir
from ..sources.star import Star, text
from ..sources.store import create_store, merge_at, open_store
from .oracle import with_views
from .registry import query
from .scans import sequence_columns

NOW = datetime(2030, 1, 1, tzinfo=timezone.utc)


def _order_id(factor: int = 1):
    return text("order-", F.col("o_orderkey") * factor)


@query(
    "insert_conflicts",
    """
    SELECT 'order-' || c_custkey * 20 AS externalId, 'externalId already exists: order-' || c_custkey * 20 AS error
    FROM customer WHERE c_custkey * 20 IN (SELECT o_orderkey FROM orders)""",
)
def insert_conflicts(s: Star) -> DataFrame:
    source = s.base("customer").select(text("order-", F.col("c_custkey") * 20).alias("externalId"), F.lit("x").alias("type"))
    return merge(s.catalog.scan("events"), source, "events").errors.select("externalId", "error")


@query(
    "merge_insert",
    with_views("ev")
    + """
    SELECT externalId, type, startTime, false AS created FROM ev
    UNION ALL
    SELECT 'visit-' || c_custkey, c_mktsegment, NULL, true FROM customer""",
)
def merge_insert(s: Star) -> DataFrame:
    source = s.base("customer").select(text("visit-", F.col("c_custkey")).alias("externalId"), F.col("c_mktsegment").alias("type"))
    result = merge(s.catalog.scan("events"), source, "events", now=NOW).raise_for_errors()
    return result.table.select("externalId", "type", "startTime", (F.col("createdTime") == F.lit(NOW)).alias("created"))


def _event_changes(s: Star) -> DataFrame:
    """Changes by external id for every second order and as many new ones, and by id for some."""
    by_name = s.base("orders").select(
        F.lit(None).cast("long").alias("id"), _order_id(2).alias("externalId"),
        text("changed ", F.col("o_orderkey")).alias("description"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("subtype"),
    )
    by_id = s.base("customer").select(
        (F.col("c_custkey") * 3 + 1).alias("id"), F.lit(None).cast("string").alias("externalId"),
        F.col("c_mktsegment").alias("description"), F.lit("by id").alias("subtype"),
    )
    return by_name.unionByName(by_id)


_EVENT_CHANGES = """
    by_name AS (SELECT o_orderkey * 2 AS k, 'changed ' || o_orderkey AS description, nullif(o_orderstatus, 'F') AS subtype FROM orders),
    by_id AS (SELECT c_custkey * 3 + 1 AS k, c_mktsegment AS description, 'by id' AS subtype FROM customer)"""


def _upsert_sql(kept_subtype: str) -> str:
    return (
        with_views("ev")
        + f""",{_EVENT_CHANGES},
    both_ AS (SELECT * FROM by_id UNION ALL SELECT * FROM by_name WHERE k NOT IN (SELECT k FROM by_id))
    SELECT ev.externalId, ev.type, c.description, {kept_subtype} AS subtype, c.k IS NOT NULL AS touched
    FROM ev LEFT JOIN both_ c ON c.k = ev.id
    UNION ALL
    SELECT 'order-' || k, NULL, description, subtype, true FROM by_name WHERE k NOT IN (SELECT o_orderkey FROM orders)"""
    )


def _touched(df: DataFrame) -> DataFrame:
    return df.select(
        "externalId", "type", "description", "subtype", (F.col("lastUpdatedTime") == F.lit(NOW)).alias("touched")
    )


@query("merge_upsert", _upsert_sql("coalesce(c.subtype, ev.subtype)"))
def merge_upsert(s: Star) -> DataFrame:
    return _touched(merge(s.catalog.scan("events"), _event_changes(s), "events", "upsert", now=NOW).raise_for_errors().table)


@query(
    "merge_write_nulls",
    _upsert_sql("CASE WHEN c.k IS NULL THEN ev.subtype ELSE c.subtype END"),
)
def merge_write_nulls(s: Star) -> DataFrame:
    """Nulls in the source clear the clearable fields."""
    changes = _event_changes(s).withColumn(
        "externalId", F.coalesce("externalId", F.when(F.col("id").isNotNull(), text("order-", F.col("id"))))
    )
    result = merge(s.catalog.scan("events"), changes, "events", "upsert", ignore_null_fields=False, now=NOW)
    return _touched(result.raise_for_errors().table)


@query(
    "merge_partial",
    with_views("ev")
    + """
    SELECT externalId, type, subtype, startTime, 'customer ' || c_custkey AS description FROM ev
    LEFT JOIN customer ON c_custkey = ev.id""",
)
def merge_partial(s: Star) -> DataFrame:
    """Only the columns that the source has are written."""
    source = s.base("customer").select(F.col("c_custkey").alias("id"), text("customer ", F.col("c_custkey")).alias("description"))
    source = source.withColumn("externalId", text("order-", F.col("id")))
    result = merge(s.catalog.scan("events"), source, "events", "update").raise_for_errors()
    return result.table.select("externalId", "type", "subtype", "startTime", "description")


@query(
    "merge_update",
    with_views("ev")
    + f""",{_EVENT_CHANGES},
    both_ AS (SELECT * FROM by_id UNION ALL SELECT * FROM by_name WHERE k NOT IN (SELECT k FROM by_id))
    SELECT 'row' AS part, ev.externalId, c.description, coalesce(c.subtype, ev.subtype) AS subtype, NULL AS error
    FROM ev LEFT JOIN both_ c ON c.k = ev.id
    UNION ALL
    SELECT 'error', 'order-' || k, NULL, NULL, 'unknown externalId order-' || k FROM by_name WHERE k NOT IN (SELECT o_orderkey FROM orders)""",
)
def merge_update(s: Star) -> DataFrame:
    result = merge(s.catalog.scan("events"), _event_changes(s), "events", "update")
    rows = result.table.select(F.lit("row").alias("part"), "externalId", "description", "subtype")
    errors = result.errors.select(F.lit("error").alias("part"), "externalId", "error")
    return rows.unionByName(errors, allowMissingColumns=True)


@query(
    "merge_insert_into",
    with_views("assets")
    + """
    SELECT a.externalId, a.id, CASE WHEN c.c_custkey IS NULL THEN a.name ELSE 'renamed ' || c.c_custkey END AS name
    FROM assets a LEFT JOIN customer c ON a.externalId = 'customer-' || c.c_custkey * 2
    UNION ALL
    SELECT 'customer-' || c_custkey * 2, NULL, 'renamed ' || c_custkey FROM customer
    WHERE c_custkey * 2 NOT IN (SELECT c_custkey FROM customer)""",
)
def merge_insert_into(s: Star) -> DataFrame:
    """The id of the source does not matter, the external id does. New rows get ids above the old ones."""
    source = s.base("customer").select(
        F.lit(1).cast("long").alias("id"), text("customer-", F.col("c_custkey") * 2).alias("externalId"),
        text("renamed ", F.col("c_custkey")).alias("name"),
    )
    assets = s.catalog.scan("assets")
    highest = assets.agg(F.max("id")).scalar()
    table = merge(assets, source, "assets", "insert_into").raise_for_errors().table
    return table.select("externalId", F.when(F.col("id") <= highest, F.col("id")).alias("id"), "name")


@query(
    "merge_new_ids",
    """
    SELECT 'order-' || o_orderkey AS externalId, o_orderkey AS id FROM orders WHERE false
    UNION ALL
    SELECT 'distinct ids', (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)
    UNION ALL
    SELECT 'highest id', (SELECT max(o_orderkey) FROM orders) + (SELECT count(*) FROM customer)""",
)
def merge_new_ids(s: Star) -> DataFrame:
    """Ids of created rows follow the highest id without gaps."""
    source = s.base("customer").select(text("visit-", F.col("c_custkey")).alias("externalId"))
    table = merge(s.catalog.scan("events"), source, "events").table
    counted = table.agg(F.countDistinct("id").alias("distinct ids"), F.max("id").alias("highest id"))
    return counted.unpivot([], ["distinct ids", "highest id"], "externalId", "id")


@query(
    "merge_upsert_no_name",
    with_views("assets")
    + """
    SELECT 'row' AS part, a.externalId, a.name, CASE WHEN c.c_custkey IS NULL THEN a.source ELSE 'nameless' END AS source
    FROM assets a LEFT JOIN customer c ON a.externalId = 'customer-' || c.c_custkey * 2
    UNION ALL
    SELECT 'error', 'customer-' || c_custkey * 2, 'unknown externalId customer-' || c_custkey * 2, NULL
    FROM customer WHERE c_custkey * 2 NOT IN (SELECT c_custkey FROM customer)""",
)
def merge_upsert_no_name(s: Star) -> DataFrame:
    """Without a name a row can only be an update."""
    source = s.base("customer").select(
        text("customer-", F.col("c_custkey") * 2).alias("externalId"), F.lit("nameless").alias("source")
    )
    result = merge(s.catalog.scan("assets"), source, "assets", "upsert")
    rows = result.table.select(F.lit("row").alias("part"), "externalId", "name", "source")
    errors = result.errors.select(F.lit("error").alias("part"), "externalId", F.col("error").alias("name"))
    return rows.unionByName(errors, allowMissingColumns=True)


@query(
    "delete_by_id",
    "SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey * 7 FROM customer)",
)
def delete_by_id(s: Star) -> DataFrame:
    gone = s.base("customer").select((F.col("c_custkey") * 7).alias("id"))
    return merge(s.catalog.scan("events"), gone, "events", "delete").raise_for_errors().table.select("id")


@query(
    "delete_by_external_id",
    """
    SELECT 'row' AS part, 'order-' || o_orderkey AS what FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey * 20 FROM customer)
    UNION ALL
    SELECT 'error', 'unknown externalId order-' || c_custkey * 20 FROM customer WHERE c_custkey * 20 NOT IN (SELECT o_orderkey FROM orders)""",
)
def delete_by_external_id(s: Star) -> DataFrame:
    gone = s.base("customer").select(text("order-", F.col("c_custkey") * 20).alias("externalId"))
    result = merge(s.catalog.scan("events"), gone, "events", "delete", ignore_unknown_ids=False)
    rows = result.table.select(F.lit("row").alias("part"), F.col("externalId").alias("what"))
    return rows.unionByName(result.errors.select(F.lit("error").alias("part"), F.col("error").alias("what")))


@query(
    "files_delete",
    "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def files_delete(s: Star) -> DataFrame:
    gone = s.spark.read.parquet(f"{s.root}/labels.parquet").select(F.col("doc_id").alias("id"))
    return merge(s.catalog.scan("files"), gone, "files", "delete").raise_for_errors().table.select("id")


@query(
    "create_required",
    """
    SELECT 'site-' || s_suppkey AS externalId, 'name is missing on a new item' AS error FROM supplier WHERE s_acctbal < 0
    UNION ALL
    SELECT 'r-' || s_suppkey, 'sourceType is missing on a new item; targetType is missing on a new item' FROM supplier
    UNION ALL
    SELECT 'd-' || s_suppkey, 'writeProtected is missing on a new item' FROM supplier""",
)
def create_required(s: Star) -> DataFrame:
    supplier = s.base("supplier")
    assets = supplier.select(
        text("site-", F.col("s_suppkey")).alias("externalId"), F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("name")
    )
    relations = supplier.select(
        text("r-", F.col("s_suppkey")).alias("externalId"), F.lit("a").alias("sourceExternalId"), F.lit("b").alias("targetExternalId")
    )
    datasets = supplier.select(text("d-", F.col("s_suppkey")).alias("externalId"), F.col("s_name").alias("name"))
    errors = [
        merge(s.catalog.scan("assets"), assets, "assets").errors,
        merge(s.catalog.scan("relationships"), relations, "relationships", "upsert").errors,
        merge(s.catalog.scan("datasets"), datasets, "datasets", "upsert").errors,
    ]
    return errors[0].unionByName(errors[1]).unionByName(errors[2]).select("externalId", "error")


@query(
    "create_defaults",
    """
    SELECT 'new-' || s_suppkey AS externalId, s_name AS name, s_acctbal < 0 AS isStep, false AS isString FROM supplier""",
)
def create_defaults(s: Star) -> DataFrame:
    source = s.base("supplier").select(
        text("new-", F.col("s_suppkey")).alias("externalId"), F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") < 0, F.lit(True)).alias("isStep"),
    )
    created = merge(s.catalog.scan("timeseries"), source, "timeseries", "upsert").raise_for_errors().created
    return created.select("externalId", "name", "isStep", "isString")


@query(
    "labels_delete",
    """
    SELECT DISTINCT p_brand AS externalId FROM part WHERE p_brand NOT IN (SELECT 'Brand#' || s_nationkey FROM supplier)""",
)
def labels_delete(s: Star) -> DataFrame:
    gone = s.base("supplier").select(text("Brand#", F.col("s_nationkey")).alias("externalId"))
    return merge(s.catalog.scan("labels"), gone, "labels", "delete").raise_for_errors().table.select("externalId")


@query(
    "relationships_upsert",
    """
    WITH old AS (
        SELECT l_orderkey || ':' || l_linenumber AS externalId, max({'t': l_shipdate, 'p': l_partkey, 's': l_suppkey}) AS r
        FROM lineitem GROUP BY ALL),
    new AS (SELECT o_orderkey || ':1' AS externalId, o_custkey AS c FROM orders)
    SELECT coalesce(old.externalId, new.externalId) AS externalId,
           CASE WHEN c IS NULL THEN 'part-' || r.p ELSE 'order-of-' || c END AS sourceExternalId,
           CASE WHEN c IS NULL THEN 'supplier-' || r.s ELSE 'customer-' || c END AS targetExternalId,
           r.t AS startTime
    FROM old FULL JOIN new ON old.externalId = new.externalId""",
)
def relationships_upsert(s: Star) -> DataFrame:
    lines = s.base("lineitem").select(
        text(F.col("l_orderkey"), ":", F.col("l_linenumber")).alias("externalId"), "l_shipdate", "l_partkey", "l_suppkey"
    )
    latest = keep_greatest(lines, ["externalId"], [F.col("l_shipdate")])
    target = latest.select(
        "externalId", text("part-", F.col("l_partkey")).alias("sourceExternalId"), F.lit("asset").alias("sourceType"),
        text("supplier-", F.col("l_suppkey")).alias("targetExternalId"), F.lit("asset").alias("targetType"),
        F.col("l_shipdate").alias("startTime"),
    )
    source = s.base("orders").select(
        text(F.col("o_orderkey"), ":1").alias("externalId"), text("order-of-", F.col("o_custkey")).alias("sourceExternalId"),
        F.lit("event").alias("sourceType"), text("customer-", F.col("o_custkey")).alias("targetExternalId"),
        F.lit("asset").alias("targetType"),
    )
    table = merge(target, source, "relationships", "upsert").raise_for_errors().table
    return table.select("externalId", "sourceExternalId", "targetExternalId", "startTime")


@query(
    "datasets_upsert",
    """
    SELECT 'nation-' || n_nationkey AS externalId, 'nation ' || n_name AS name, n_regionkey = 0 AS writeProtected FROM nation
    UNION ALL
    SELECT 'region-' || r_regionkey, r_name, true FROM region""",
)
def datasets_upsert(s: Star) -> DataFrame:
    renamed = s.base("nation").select(
        text("nation-", F.col("n_nationkey")).alias("externalId"), text("nation ", F.col("n_name")).alias("name"),
        F.lit(None).cast("boolean").alias("writeProtected"),
    )
    added = s.base("region").select(
        text("region-", F.col("r_regionkey")).alias("externalId"), F.col("r_name").alias("name"), F.lit(True).alias("writeProtected")
    )
    table = merge(s.catalog.scan("datasets"), renamed.unionByName(added), "datasets", "upsert").raise_for_errors().table
    return table.select("externalId", "name", "writeProtected")


@query(
    "merge_counts",
    f"""
    WITH {_EVENT_CHANGES},
    touched AS (SELECT k FROM by_name UNION SELECT k FROM by_id)
    SELECT 'read' AS outcome, (SELECT count(*) FROM by_name) + (SELECT count(*) FROM by_id) AS n
    UNION ALL SELECT 'created', count(*) FROM by_name WHERE k NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'updated', count(*) FROM touched WHERE k IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'deleted', 0
    UNION ALL SELECT 'errors', 0""",
)
def merge_counts(s: Star) -> DataFrame:
    return merge(s.catalog.scan("events"), _event_changes(s), "events", "upsert").counts()


@query(
    "datapoints_upsert",
    with_views("dp")
    + """,
    changed AS (SELECT id, timestamp, -value AS value FROM dp WHERE value > 50),
    shifted AS (SELECT id, timestamp + INTERVAL 1 SECOND AS timestamp, value FROM dp WHERE value <= 50)
    SELECT id, timestamp, value FROM dp WHERE value <= 50
    UNION ALL SELECT * FROM changed UNION ALL SELECT * FROM shifted""",
)
def datapoints_upsert(s: Star) -> DataFrame:
    """Large values are overwritten through either identifier; small ones get a new point a second later."""
    points = s.catalog.scan("datapoints")
    none = F.lit(None).cast("long")
    changed = points.filter("value > 50").select(
        F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(none).alias("id"), "externalId", "timestamp", (-F.col("value")).alias("value")
    )
    shifted = points.filter("value <= 50").select(
        "id", "externalId", (F.col("timestamp") + F.expr("interval 1 second")).alias("timestamp"), "value"
    )
    resolved, _ = resolve_series(changed.unionByName(shifted), s.catalog.scan("timeseries"))
    return upsert_points(points.select("id", "timestamp", "value"), resolved)


def _ranges(s: Star) -> DataFrame:
    """Two days after the first point of every series by id, two more days later by external id."""
    first = s.catalog.scan("datapoints").groupBy("id", "externalId").agg(F.min("timestamp").alias("t"))
    none, no_time = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    by_id = first.select(
        "id", none.alias("externalId"), (F.col("t") + F.expr("interval 1 day")).alias("inclusiveBegin"),
        no_time.alias("exclusiveBegin"), (F.col("t") + F.expr("interval 3 days")).alias("exclusiveEnd"), no_time.alias("inclusiveEnd"),
    )
    by_name = first.select(
        F.lit(None).cast("long").alias("id"), "externalId", no_time.alias("inclusiveBegin"),
        (F.col("t") + F.expr("interval 10 days")).alias("exclusiveBegin"), no_time.alias("exclusiveEnd"),
        (F.col("t") + F.expr("interval 12 days")).alias("inclusiveEnd"),
    )
    return by_id.unionByName(by_name)


_KEPT = """,
    first AS (SELECT id, min(timestamp) AS t FROM dp GROUP BY id)
    SELECT dp.id, dp.timestamp, dp.value FROM dp JOIN first USING (id)
    WHERE NOT (timestamp >= t + INTERVAL 1 DAY AND timestamp < t + INTERVAL 3 DAY)
      AND NOT (timestamp >= t + INTERVAL 10 DAY + INTERVAL 1 MILLISECOND AND timestamp < t + INTERVAL 12 DAY + INTERVAL 1 MILLISECOND)"""


@query("delete_ranges", with_views("dp") + _KEPT)
def delete_ranges_query(s: Star) -> DataFrame:
    return delete_ranges(s.catalog.scan("datapoints"), _ranges(s))[0].select("id", "timestamp", "value")


@query("delete_ranges_swept", with_views("dp") + _KEPT)
def delete_ranges_swept(s: Star) -> DataFrame:
    """The way for long delete lists: points and range ends are swept together."""
    return delete_ranges(s.catalog.scan("datapoints"), _ranges(s), max_broadcast=0)[0].select("id", "timestamp", "value")


@query(
    "delete_range_errors",
    """
    SELECT error, count(*) AS n FROM (
        SELECT CASE event_type
            WHEN 'error' THEN 'a range has both inclusiveBegin and exclusiveBegin'
            WHEN 'click' THEN 'a range needs inclusiveBegin or exclusiveBegin'
            WHEN 'view' THEN 'the range is empty'
            WHEN 'signup' THEN 'a range needs an id or externalId' END AS error
        FROM events)
    WHERE error IS NOT NULL GROUP BY error""",
)
def delete_range_errors(s: Star) -> DataFrame:
    kind, moment = F.col("event_type"), F.col("ts")
    requests = s.base("events").select(
        F.when(kind != "signup", F.col("user_id")).alias("id"),
        F.when(kind != "click", moment).alias("inclusiveBegin"),
        F.when(kind == "error", moment).alias("exclusiveBegin"),
        F.when(kind == "view", moment).otherwise(moment + F.expr("interval 1 hour")).alias("exclusiveEnd"),
    )
    return delete_range_bounds(requests)[1].groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sequence_column_diff",
    """
    WITH s AS (SELECT DISTINCT user_id AS u, 'seq-' || user_id AS externalId FROM events)
    SELECT externalId, 'value' AS "column", CASE WHEN u % 3 = 0 THEN 'error' ELSE 'modify' END AS change, 'DOUBLE' AS valueType FROM s WHERE u % 5 <> 0
    UNION ALL SELECT externalId, 'kind', 'remove', 'STRING' FROM s WHERE u % 5 <> 0
    UNION ALL SELECT externalId, 'k', 'modify', 'LONG' FROM s WHERE u % 5 <> 0
    UNION ALL SELECT externalId, 'extra', 'add', 'STRING' FROM s WHERE u % 5 <> 0""",
)
def sequence_column_diff(s: Star) -> DataFrame:
    """Every sequence is asked to change its columns; some ask with an empty list, which changes nothing."""
    sequences = s.catalog.scan("sequences")

    def column(name: str, value_type) -> F.Column:
        return F.struct(F.lit(name).alias("externalId"), value_type.cast("string").alias("valueType"))

    asked = F.array(
        column("value", F.when(F.col("id") % 3 == 0, F.lit("LONG")).otherwise(F.lit("DOUBLE"))),
        column("k", F.lit(None)), column("extra", F.lit(None)),
    )
    nothing = F.array().cast("array<struct<externalId:string,valueType:string>>")
    source = sequences.select("externalId", F.when(F.col("id") % 5 == 0, nothing).otherwise(asked).alias("columns"))
    return diff_sequence_columns(sequences, source)


@query(
    "sequence_rows_upsert",
    with_views("seqrows")
    + """
    SELECT id, rowNumber, CASE WHEN kind = 'error' THEN -value ELSE value END AS value, kind, k FROM seqrows
    UNION ALL
    SELECT user_id, event_id + 100000000, value, NULL, NULL FROM events WHERE event_type = 'error'""",
)
def sequence_rows_upsert(s: Star) -> DataFrame:
    target = s.catalog.scan("sequencerows").drop("externalId")
    errors = target.filter("kind = 'error'")
    changed = errors.select("id", "rowNumber", (-F.col("value")).alias("value"))
    added = errors.select("id", (F.col("rowNumber") + 100_000_000).alias("rowNumber"), "value")
    return upsert_sequence_rows(target, changed.unionByName(added), sequence_columns(s))


@query(
    "sequence_rows_delete",
    with_views("seqrows") + "SELECT id, rowNumber, k FROM seqrows WHERE kind <> 'error'",
)
def sequence_rows_delete(s: Star) -> DataFrame:
    target = s.catalog.scan("sequencerows")
    return delete_sequence_rows(target, target.filter("kind = 'error'")).select("id", "rowNumber", "k")


def _stored(s: Star, resource: str) -> str:
    """The folder of a stored copy of a resource, in 16 files by key."""
    path = f"{scratch_dir(s.spark)}/store-{uuid.uuid4().hex}"
    create_store(s.catalog.scan(resource), path, resource, 16)
    return path


@query(
    "merge_touched_files",
    with_views("ev")
    + f""",{_EVENT_CHANGES},
    visits AS (SELECT 'visit-' || c_custkey AS externalId, c_mktsegment AS description FROM customer)
    SELECT ev.externalId, ev.type, c.description, coalesce(c.subtype, ev.subtype) AS subtype, c.k IS NOT NULL AS touched
    FROM ev LEFT JOIN by_id c ON c.k = ev.id
    UNION ALL
    SELECT externalId, NULL, description, NULL, true FROM visits""",
)
def merge_touched_files(s: Star) -> DataFrame:
    """An upsert into a stored table that leaves the files without a named row as they are."""
    visits = s.base("customer").select(
        text("visit-", F.col("c_custkey")).alias("externalId"), F.col("c_mktsegment").alias("description")
    )
    changes = _event_changes(s).filter("id is not null").unionByName(visits, allowMissingColumns=True)
    path = _stored(s, "events")
    merge_at(s.spark, path, changes, "events", "upsert", now=NOW)
    return _touched(open_store(s.spark, path))


@query(
    "delete_touched_files",
    with_views("rel") + "SELECT externalId, sourceExternalId, confidence FROM rel WHERE NOT starts_with(externalId, '1')",
)
def delete_touched_files(s: Star) -> DataFrame:
    """A delete by externalId that only rewrites the files in which such rows lie."""
    named = s.catalog.scan("relationships").filter(F.col("externalId").startswith("1")).select("externalId")
    path = _stored(s, "relationships")
    merge_at(s.spark, path, named, "relationships", "delete")
    return open_store(s.spark, path).select("externalId", "sourceExternalId", F.round("confidence", 6).alias("confidence"))


@query(
    "merge_validated",
    """
    SELECT 'row' AS part, 'call-' || o_orderkey AS externalId, o_custkey + 1000000 AS asset, NULL AS error
    FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL
    SELECT 'error', 'call-' || o_orderkey, NULL,
           'Row call-' || o_orderkey || ' in column endTime: expected timestamp, got string ' || o_orderpriority
           || '; Row call-' || o_orderkey || ' in column type: expected string, got bigint ' || o_custkey
    FROM orders WHERE o_orderstatus = 'F'""",
)
def merge_validated(s: Star) -> DataFrame:
    """Values of a type that their column does not take refuse the row; the others are stored, arrays without nulls."""
    closed = F.col("o_orderstatus") == "F"
    calls = s.base("orders").select(
        text("call-", F.col("o_orderkey")).alias("externalId"),
        F.when(closed, F.col("o_orderpriority")).alias("endTime"),
        F.when(closed, F.col("o_custkey")).alias("type"),
        F.array(F.lit(None).cast("long"), F.col("o_custkey") + 1_000_000).alias("assetIds"),
    )
    result = merge(s.catalog.scan("events"), calls, "events", "upsert", now=NOW)
    rows = result.created.select(F.lit("row").alias("part"), "externalId", F.col("assetIds")[0].alias("asset"))
    errors = result.errors.select(F.lit("error").alias("part"), "externalId", "error")
    return rows.unionByName(errors, allowMissingColumns=True)


def _mixed(s: Star) -> tuple[DataFrame, DataFrame]:
    """Sequences of three kinds by their number, and rows of all of them with a value and a kind each."""
    sequences = s.catalog.scan("sequences")
    wanted = F.when(F.col("id") % 3 == 0, F.array(F.lit("value"), F.lit("kind"))).when(F.col("id") % 3 == 1, F.array(F.lit("k")))
    wanted = wanted.otherwise(F.array(F.lit("value"), F.lit("kind"), F.lit("k")))
    sequences = sequences.withColumn("columns", F.filter("columns", lambda c: F.array_contains(wanted, c["externalId"])))
    return sequences, s.catalog.scan("sequencerows")


_MIXED_CELLS = """
    cells AS (
        SELECT externalId, rowNumber, 'value' AS "column", 'DOUBLE' AS valueType, NULL AS text, value AS number, NULL::BIGINT AS whole FROM {rows} WHERE id % 3 <> 1
        UNION ALL SELECT externalId, rowNumber, 'kind', 'STRING', kind, NULL, NULL FROM {rows} WHERE id % 3 <> 1
        UNION ALL SELECT externalId, rowNumber, 'k', 'LONG', NULL, NULL, k FROM {rows} WHERE id % 3 <> 0)"""


@query(
    "sequence_rows_mixed",
    with_views("seqrows")
    + ","
    + _MIXED_CELLS.format(rows="seqrows")
    + """
    SELECT 'cell' AS part, externalId, rowNumber, "column", valueType, text, number, whole, NULL AS error FROM cells
    UNION ALL
    SELECT 'error', externalId, rowNumber, NULL, NULL, NULL, NULL, NULL, CASE id % 3
        WHEN 0 THEN 'column k of sequence ' || externalId || ' does not exist; column value of sequence ' || externalId || ' has type STRING, expected DOUBLE'
        WHEN 1 THEN 'column k of sequence ' || externalId || ' has type STRING, expected LONG; column value of sequence ' || externalId || ' does not exist'
        ELSE 'column k of sequence ' || externalId || ' has type STRING, expected LONG; column value of sequence ' || externalId || ' has type STRING, expected DOUBLE' END
    FROM seqrows WHERE kind = 'error'""",
)
def sequence_rows_mixed(s: Star) -> DataFrame:
    """Rows of sequences with different columns in one frame: typed cells of those that fit, errors of the others."""
    sequences, rows = _mixed(s)
    given = _given(rows).unionByName(
        rows.filter("kind = 'error'").select("externalId", "rowNumber", F.to_variant_object(F.struct(F.lit("x").alias("value"), F.col("kind").alias("k"))).alias("values"))
    )
    good, errors = check_mixed_rows(given, sequences)
    cells = mixed_cells(good, sequences).withColumn("part", F.lit("cell"))
    return cells.unionByName(errors.withColumn("part", F.lit("error")), allowMissingColumns=True)


def _given(rows: DataFrame) -> DataFrame:
    """Each row with the cells that its sequence has columns for."""
    shapes = {0: ["value", "kind"], 1: ["k"], 2: ["value", "kind", "k"]}
    values = F.coalesce(*[F.when(F.col("id") % 3 == n, F.to_variant_object(F.struct(*names))) for n, names in shapes.items()])
    return rows.select("externalId", "rowNumber", values.alias("values"))


@query(
    "sequence_rows_mixed_upsert",
    with_views("seqrows")
    + """,
    changed AS (
        SELECT id, externalId, rowNumber, CASE WHEN kind = 'error' THEN -value ELSE value END AS value, kind, k FROM seqrows),"""
    + _MIXED_CELLS.format(rows="changed")
    + """
    SELECT externalId, rowNumber, "column", text, number, whole FROM cells
    UNION ALL
    SELECT externalId, rowNumber + 100000000, 'value', NULL, -value, NULL FROM seqrows WHERE kind = 'error' AND id % 3 <> 1""",
)
def sequence_rows_mixed_upsert(s: Star) -> DataFrame:
    """An upsert of one column into rows of many sequences: other cells stay, rows of sequences without it are refused."""
    sequences, rows = _mixed(s)
    negative = rows.filter("kind = 'error'").select("externalId", "rowNumber", F.to_variant_object(F.struct((-F.col("value")).alias("value"))).alias("values"))
    added = negative.withColumn("rowNumber", F.col("rowNumber") + 100_000_000)
    table, _ = upsert_mixed_rows(_given(rows), negative.unionByName(added), sequences)
    return mixed_cells(table, sequences).drop("valueType")


@query(
    "sequences_upsert",
    """
    WITH s AS (SELECT DISTINCT user_id AS u, 'seq-' || user_id AS externalId FROM events)
    SELECT externalId, CASE WHEN u % 4 = 0 THEN 'value:value:DOUBLE:,kind:kind:STRING:,k:k:LONG:'
        ELSE 'k:k:LONG:counter ' || u || ',extra::STRING:,value:amount:DOUBLE:' END AS columns FROM s
    UNION ALL SELECT 'error ' || externalId, 'the value type of a sequence column can not change' FROM s WHERE u % 4 = 1""",
)
def sequences_upsert(s: Star) -> DataFrame:
    """Column lists written over those of all sequences: open fields stay, some lists are empty and change nothing."""
    sequences = s.catalog.scan("sequences")
    kind = "array<struct<externalId:string,name:string,description:string,valueType:string>>"

    def column(name: str, label=None, about=None, value_type=None) -> F.Column:
        values = {"externalId": F.lit(name), "name": F.lit(label), "description": F.lit(None) if about is None else about, "valueType": F.lit(None) if value_type is None else value_type}
        return F.struct(*[v.cast("string").alias(k) for k, v in values.items()])

    asked = F.array(column("k", about=text("counter ", F.col("id"))), column("extra"), column("value", "amount"))
    source = sequences.select("externalId", F.when(F.col("id") % 4 == 0, F.array().cast(kind)).otherwise(asked).alias("columns"))
    wrong = sequences.filter("id % 4 = 1").select("externalId", F.array(column("value", value_type=F.lit("LONG"))).alias("columns"))
    described = F.transform("columns", lambda c: F.concat_ws(":", *[F.coalesce(c[f], F.lit("")) for f in ("externalId", "name", "valueType", "description")]))
    table = merge(sequences, source, "sequences", "upsert").raise_for_errors().table
    errors = merge(sequences, wrong, "sequences", "update").errors
    return table.select("externalId", F.array_join(described, ",").alias("columns")).unionByName(
        errors.select(text("error ", F.col("externalId")).alias("externalId"), F.col("error").alias("columns"))
    )
