"""JSON tables, and the conversion rules for written rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import (
    clean_metadata,
    json_is_valid,
    narrow_exact,
    normalise_labels,
    parse_date,
    parse_timestamp,
    read_cast,
    validate,
)
from ..functions.rawjson import drop_null_fields, infer_json_schema, insert_rows, read_json_table, to_json_table, unrename_reserved
from ..sources.star import Star, text
from .oracle import with_views
from .registry import query


def _fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@query(
    "raw_infer_schema",
    """
    SELECT field, CASE WHEN bool_and(kind IN ('UBIGINT', 'BIGINT')) THEN 'bigint' ELSE 'string' END AS type
    FROM (SELECT k AS field, json_type(props, '$.' || k) AS kind
          FROM (SELECT props, unnest(json_keys(props)) AS k FROM events))
    GROUP BY field""",
)
def raw_infer_schema(s: Star) -> DataFrame:
    schema = infer_json_schema(s.catalog.scan("raw"))
    return s.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "field string, type string")


@query(
    "raw_infer_schema_wide",
    """
    SELECT * FROM (VALUES ('_key', 'string'), ('amount', 'string'), ('bin', 'string'), ('cents', 'bigint'),
        ('empty', 'string'), ('flag', 'boolean'), ('flagText', 'string'), ('key', 'string'),
        ('lastUpdatedTime', 'string'), ('mixed', 'string'), ('nested', 'struct<part:bigint,tags:array<string>>'),
        ('note', 'string'), ('num', 'bigint'), ('numText', 'string')) t(field, type)""",
)
def raw_infer_schema_wide(s: Star) -> DataFrame:
    schema = infer_json_schema(s.raw_lines(), limit=None)
    return s.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "field string, type string")


@query(
    "raw_rename",
    with_views("lines")
    + """
    SELECT key, lastUpdatedTime, 'inner-' || num AS _key, 'deep-' || supp AS __key, 'never' AS _lastUpdatedTime FROM lines""",
)
def raw_rename(s: Star) -> DataFrame:
    schema = _fields("key string, _key string, lastUpdatedTime string")
    return read_json_table(s.raw_lines(), schema, on_error="raise")


@query(
    "raw_unrename",
    with_views("lines")
    + """
    SELECT key, 'inner-' || num AS f_key, 'deep-' || supp AS f_deep, 'never' AS f_time, NULL AS f_deeper FROM lines""",
)
def raw_unrename(s: Star) -> DataFrame:
    schema = _fields("key string, _key string, lastUpdatedTime string")
    written = to_json_table(read_json_table(s.raw_lines(), schema, on_error="raise"))
    return written.select(
        "key",
        F.get_json_object("columns", "$.key").alias("f_key"),
        F.get_json_object("columns", "$._key").alias("f_deep"),
        F.get_json_object("columns", "$.lastUpdatedTime").alias("f_time"),
        F.get_json_object("columns", "$.__key").alias("f_deeper"),
    )


@query(
    "raw_typed_cast",
    with_views("lines")
    + """
    SELECT key, num, num::BIGINT AS numText, NULL::DOUBLE AS empty, returned AS flag, returned AS flagText, cents,
           num::DOUBLE AS ratio
    FROM lines""",
)
def raw_typed_cast(s: Star) -> DataFrame:
    schema = _fields("num int, numText long, empty double, flag boolean, flagText boolean, cents long, ratio double")
    return read_json_table(s.raw_lines(), schema, on_error="raise", sources={"ratio": "numText"}).drop("lastUpdatedTime")


@query(
    "raw_cast_errors",
    with_views("lines")
    + """
    SELECT key, CASE WHEN NOT returned THEN supp::INTEGER END AS mixed, cents,
           CASE WHEN returned THEN 'row ' || key || ': wrong type in column mixed' END AS error,
           CASE WHEN returned THEN 2 ELSE 1 END AS n
    FROM lines""",
)
def raw_cast_errors(s: Star) -> DataFrame:
    typed = read_json_table(s.raw_lines(), _fields("mixed int, cents long, nested int"))
    return typed.select(
        "key", "mixed", "cents", F.when(F.size("_errors") > 1, F.col("_errors")[0]).alias("error"),
        F.size("_errors").alias("n"),
    )


@query(
    "raw_string_of_json",
    with_views("lines")
    + """
    SELECT key, '{"part":' || part || ',"tags":["' || rf || '","' || ls || '"]}' AS nested,
           CASE WHEN returned THEN 'true' ELSE 'false' END AS flag, num::VARCHAR AS num, NULLIF(CASE WHEN returned THEN 'back' ELSE '' END, '') AS note
    FROM lines""",
)
def raw_string_of_json(s: Star) -> DataFrame:
    schema = _fields("nested string, flag string, num string, note string")
    return read_json_table(s.raw_lines(), schema, on_error="raise").drop("lastUpdatedTime")


@query(
    "raw_nested",
    with_views("lines") + "SELECT key, part, rf AS tag0, ls AS tag1, 2 AS tags, part::VARCHAR AS mapped FROM lines",
)
def raw_nested(s: Star) -> DataFrame:
    schema = _fields("nested struct<part:long,tags:array<string>>, mapped map<string,string>")
    return read_json_table(s.raw_lines(), schema, on_error="raise", sources={"mapped": "nested"}).select(
        "key", "nested.part", F.col("nested.tags")[0].alias("tag0"), F.col("nested.tags")[1].alias("tag1"),
        F.size("nested.tags").alias("tags"), F.col("mapped")["part"].alias("mapped"),
    )


@query(
    "raw_decimal",
    with_views("lines")
    + "SELECT key, cents AS amountCents, num::DOUBLE AS num, rf || ls AS bin FROM lines",
)
def raw_decimal(s: Star) -> DataFrame:
    schema = _fields("amount decimal(18,2), num decimal(10,0), bin binary")
    return read_json_table(s.raw_lines(), schema, on_error="raise").select(
        "key", (F.col("amount") * 100).cast("long").alias("amountCents"), F.col("num").cast("double").alias("num"),
        F.decode("bin", "utf-8").alias("bin"),
    )


@query(
    "raw_to_json",
    with_views("ev")
    + """
    SELECT externalId AS key, id::VARCHAR AS id, strftime(startTime, '%Y-%m-%d %H:%M:%S') || '.0' AS startTime,
           type, subtype, status, '[' || assetId || ']' AS assetIds, 'NaN' AS odd
    FROM ev""",
)
def raw_to_json(s: Star) -> DataFrame:
    events = s.catalog.scan("events").withColumn("key", F.col("externalId")).withColumn("odd", F.lit(float("nan")))
    names = ["id", "startTime", "type", "subtype", "assetIds", "odd"]
    written = to_json_table(events)
    return written.select(
        "key", *[F.get_json_object("columns", f"$.{n}").alias(n) for n in names],
        F.get_json_object("columns", "$.metadata.status").alias("status"),
    )


@query(
    "raw_filter_nulls",
    with_views("lines")
    + """
    SELECT key, CASE WHEN returned THEN 14 ELSE 13 END AS fields, CASE WHEN returned THEN 'back' END AS note FROM lines""",
)
def raw_filter_nulls(s: Star) -> DataFrame:
    filtered = s.raw_lines().withColumn("columns", drop_null_fields())
    return filtered.select(
        "key", F.size(F.json_object_keys("columns")).alias("fields"), F.get_json_object("columns", "$.note").alias("note")
    )


@query("raw_prune", with_views("lines") + "SELECT num, count(*) AS n, max(cents) AS cents FROM lines GROUP BY num")
def raw_prune(s: Star) -> DataFrame:
    schema = _fields("num long, cents long, nested struct<part:long,tags:array<string>>, mixed string")
    typed = read_json_table(s.raw_lines(), schema).select("num", "cents")
    return typed.groupBy("num").agg(F.count(F.lit(1)).alias("n"), F.max("cents").alias("cents"))


@query(
    "raw_insert",
    """
    SELECT event_id::VARCHAR AS key, CASE WHEN event_id % 2 = 0 AND event_id < 2 * (SELECT count(*) FROM supplier)
        THEN (event_id // 2)::VARCHAR ELSE json_extract_string(props, '$.k') END AS value,
        event_id % 2 = 0 AND event_id < 2 * (SELECT count(*) FROM supplier) AS written
    FROM events
    UNION ALL
    SELECT 's' || s_suppkey, s_name, true FROM supplier""",
)
def raw_insert(s: Star) -> DataFrame:
    """Every supplier is written twice: over an existing row, and as a new one."""
    supplier = s.base("supplier")
    over = supplier.select(
        (F.col("s_suppkey") * 2).cast("string").alias("key"), F.col("s_suppkey").cast("string").alias("k"),
        F.current_timestamp().alias("lastUpdatedTime"),
    )
    new = supplier.select(
        text("s", F.col("s_suppkey")).alias("key"), F.col("s_name").alias("k"),
        F.current_timestamp().alias("lastUpdatedTime"),
    )
    stamp = F.lit("2030-01-01 00:00:00").cast("timestamp")
    merged = insert_rows(s.catalog.scan("raw"), over.unionByName(new), stamp)
    return merged.select(
        "key", F.get_json_object("columns", "$.k").alias("value"), (F.col("lastUpdatedTime") == stamp).alias("written")
    )


@query(
    "assets_to_raw",
    with_views("assets")
    + """
    SELECT externalId AS key, id::VARCHAR AS id, name, parentExternalId, segment, label,
           '2020-01-01 00:00:00.0' AS createdTime
    FROM assets""",
)
def assets_to_raw(s: Star) -> DataFrame:
    assets = s.catalog.scan("assets", where="externalId is not null").withColumn("key", F.col("externalId"))
    written = to_json_table(assets)
    return written.select(
        "key", *[F.get_json_object("columns", f"$.{n}").alias(n) for n in ("id", "name", "parentExternalId", "createdTime")],
        F.get_json_object("columns", "$.metadata.segment").alias("segment"),
        F.get_json_object("columns", "$.labels[0]").alias("label"),
    )


@query(
    "coerce_numbers",
    """
    SELECT l_orderkey AS id, l_linenumber::DOUBLE AS fromInt, l_partkey::DOUBLE AS fromLong, l_quantity AS fromDouble,
           l_tax AS fromDecimal, l_suppkey AS toLong
    FROM lineitem""",
)
def coerce_numbers(s: Star) -> DataFrame:
    source = s.base("lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("fromInt"), F.col("l_partkey").alias("fromLong"),
        F.col("l_quantity").alias("fromDouble"), F.col("l_tax").cast("decimal(10,4)").alias("fromDecimal"),
        F.col("l_suppkey").cast("int").alias("toLong"), F.lit("x").alias("unknown"),
    )
    schema = _fields("id long, fromInt double, fromLong double, fromDouble double, fromDecimal double, toLong long")
    return validate(source, schema, row_id="id")[0]


@query(
    "validation_errors",
    """
    SELECT 'order-' || o_orderkey AS row, 'dataSetId' AS "column",
           'Row order-' || o_orderkey || ' in column dataSetId: expected bigint, got string ' || o_orderstatus AS error
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT 'order-' || o_orderkey, 'name', 'Row order-' || o_orderkey || ': ''name'' is null'
    FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def validation_errors(s: Star) -> DataFrame:
    source = s.base("orders").select(
        text("order-", F.col("o_orderkey")).alias("externalId"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("dataSetId"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("name"),
    )
    schema = _fields("externalId string, dataSetId long, name string, description string")
    return validate(source, schema, required=["name"])[1]


@query(
    "metadata_clean",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS entries, o_orderpriority AS priority,
           nullif(o_orderstatus, 'P') AS status
    FROM orders""",
)
def metadata_clean(s: Star) -> DataFrame:
    metadata = F.create_map(
        F.lit("priority"), F.col("o_orderpriority"), F.lit("status"), F.nullif(F.col("o_orderstatus"), F.lit("P"))
    )
    cleaned = s.base("orders").select(F.col("o_orderkey").alias("id"), clean_metadata(metadata).alias("m"))
    return cleaned.select(
        "id", F.size("m").alias("entries"), F.col("m")["priority"].alias("priority"), F.col("m")["status"].alias("status")
    )


@query(
    "array_compact",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN o_custkey::VARCHAR ELSE o_custkey || ',' || o_orderkey END AS ids
    FROM orders""",
)
def array_compact(s: Star) -> DataFrame:
    ids = F.array(F.col("o_custkey"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")), F.lit(None))
    source = s.base("orders").select(F.col("o_orderkey").alias("id"), ids.alias("ids"))
    good, _ = validate(source, _fields("id long, ids array<long>"), row_id="id")
    return good.select("id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(
    "labels_normalise",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus || '+' || o_orderpriority END AS labels
    FROM orders""",
)
def labels_normalise(s: Star) -> DataFrame:
    status = F.col("o_orderstatus")
    labels = F.when(status == "P", F.array(F.lit(None).cast("string"))).otherwise(F.array(status, F.lit(None), "o_orderpriority"))
    return s.base("orders").select(
        F.col("o_orderkey").alias("id"), F.array_join(normalise_labels(labels), "+").alias("labels")
    )


@query(
    "narrow_exact",
    """
    SELECT l_orderkey AS id, l_linenumber AS n, l_quantity::INTEGER AS quantity, false AS quantityBad,
           CASE WHEN l_tax = 0 THEN 0 END AS tax, l_tax <> 0 AS taxBad,
           CASE WHEN cents % 100 = 0 THEN cents // 100 END AS price, cents % 100 <> 0 AS priceBad
    FROM (SELECT *, round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem)""",
)
def narrow_exact_query(s: Star) -> DataFrame:
    quantity, quantity_bad = narrow_exact(F.col("l_quantity"), "int")
    tax, tax_bad = narrow_exact(F.col("l_tax"), "int")
    price, price_bad = narrow_exact(F.col("l_extendedprice"), "long")
    return s.base("lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"),
        quantity.alias("quantity"), quantity_bad.alias("quantityBad"), tax.alias("tax"), tax_bad.alias("taxBad"),
        price.alias("price"), price_bad.alias("priceBad"),
    )


@query(
    "instance_casts",
    """
    SELECT l_orderkey AS id, l_linenumber AS n, trunc(l_extendedprice)::INTEGER AS asInt, l_partkey::INTEGER AS lowInt,
           l_linenumber::DOUBLE AS asDouble, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000Z') AS asText,
           strftime(l_shipdate, '%Y-%m-%d') AS dateText, trunc(l_quantity)::INTEGER || ',' || trunc(l_discount)::INTEGER AS list
    FROM lineitem""",
)
def instance_casts(s: Star) -> DataFrame:
    integer, double, string, timestamp = T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()
    pair = F.array("l_quantity", "l_discount")
    ints = read_cast(pair, T.ArrayType(double), T.ArrayType(integer))
    return s.base("lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"),
        read_cast(F.col("l_extendedprice"), double, integer).alias("asInt"),
        read_cast(F.col("l_partkey"), T.LongType(), integer).alias("lowInt"),
        read_cast(F.col("l_linenumber"), integer, double).alias("asDouble"),
        read_cast(F.col("l_shipdate"), timestamp, string).alias("asText"),
        read_cast(F.to_date("l_shipdate"), T.DateType(), string).alias("dateText"),
        F.array_join(ints.cast("array<string>"), ",").alias("list"),
    )


@query(
    "parse_dates",
    """
    SELECT o_orderkey AS id,
           CASE o_orderpriority
               WHEN '1-URGENT' THEN o_orderdate WHEN '2-HIGH' THEN o_orderdate - INTERVAL 2 HOUR + INTERVAL 5 HOUR
               WHEN '3-MEDIUM' THEN o_orderdate END AS moment,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::DATE::VARCHAR END AS day
    FROM orders""",
)
def parse_dates(s: Star) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    form = F.col("o_orderpriority")
    written = (
        F.when(form == "1-URGENT", F.concat(day, F.lit("T00:00:00Z")))
        .when(form == "2-HIGH", F.concat(day, F.lit("T05:00:00.000+02:00")))
        .when(form == "3-MEDIUM", F.concat(day, F.lit("T00:00")))
        .when(form == "4-NOT SPECIFIED", day)
        .otherwise(F.lit("yesterday"))
    )
    return s.base("orders").select(
        F.col("o_orderkey").alias("id"), parse_timestamp(written).alias("moment"),
        parse_date(written).cast("string").alias("day"),
    )


@query(
    "json_valid",
    """
    SELECT event_id AS id, event_type <> 'error' AS valid FROM events""",
)
def json_valid(s: Star) -> DataFrame:
    broken = F.when(F.col("event_type") == "error", F.concat("props", F.lit("}{"))).otherwise(F.col("props"))
    return s.base("events").select(F.col("event_id").alias("id"), json_is_valid(broken).alias("valid"))


@query(
    "required_props",
    """
    SELECT 'order-' || o_orderkey AS externalId, o_orderpriority AS name FROM orders WHERE o_orderstatus <> 'P'""",
)
def required_props(s: Star) -> DataFrame:
    source = s.base("orders").select(
        text("order-", F.col("o_orderkey")).alias("externalId"), F.col("o_orderpriority").alias("name"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), F.lit(1).alias("notInTheView"),
    )
    schema = _fields("externalId string, name string, status string")
    return validate(source, schema, required=["name", "status"])[0].drop("status")


@query(
    "raw_key_columns",
    with_views("lines")
    + """SELECT key, num AS "key_value", 'never' AS "lastUpdatedTime_value" FROM lines""",
)
def raw_key_columns(s: Star) -> DataFrame:
    """Columns that look reserved go back to their JSON names all at once."""
    schema = _fields("key string, num long, lastUpdatedTime string")
    typed = read_json_table(s.raw_lines(), schema, on_error="raise").withColumn("row", F.col("key")).drop("key", "lastUpdatedTime")
    back = unrename_reserved(typed)
    inner = F.regexp_extract("key", "inner-(.*)", 1).cast("long")
    return back.select(
        F.col("row").alias("key"), F.when(inner == F.col("num"), F.col("num")).alias("key_value"),
        F.col("lastUpdatedTime").alias("lastUpdatedTime_value"),
    )
