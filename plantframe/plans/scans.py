"""Scans of every resource."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rawjson import infer_json_schema, read_json_table
from ..errors import PlantError
from ..operators.datapoints import check_series_kind, datapoints
from ..operators.graph import has_data, scan_instances, scan_model
from ..operators.series_writes import sequence_rows
from ..session import scratch_dir
from ..operators.skew import SLICE_ROWS, has_hot_key
from ..sources.files import limit_errors, read_file_content
from ..sources.star import Star
from .oracle import with_views
from .registry import query


@query(
    "scan_assets",
    with_views("assets")
    + """
    SELECT id, externalId, name, parentId, parentExternalId, description, segment, source, rootId, dataSetId, label,
           TIMESTAMP '2020-01-01' AS createdTime
    FROM assets""",
)
def scan_assets(s: Star) -> DataFrame:
    return s.catalog.scan("assets").select(
        "id", "externalId", "name", "parentId", "parentExternalId", "description",
        F.col("metadata")["segment"].alias("segment"), "source", "rootId", "dataSetId",
        F.array_join("labels", ",").alias("label"), "createdTime",
    )


@query(
    "assets_subtree",
    with_views("assets", recursive=True)
    + """,
    below(externalId) AS (
        SELECT externalId FROM assets WHERE externalId = 'region-1' OR id = 1010
        UNION
        SELECT a.externalId FROM assets a JOIN below b ON a.parentExternalId = b.externalId)
    SELECT id, externalId, name FROM assets WHERE externalId IN (SELECT externalId FROM below)""",
)
def assets_subtree(s: Star) -> DataFrame:
    return s.catalog.scan("assets", asset_subtree_ids='["region-1", 1010]', columns=["id", "externalId", "name"])


@query(
    "scan_events",
    with_views("ev") + "SELECT id, externalId, startTime, endTime, type, subtype, status, assetId FROM ev",
)
def scan_events(s: Star) -> DataFrame:
    return s.catalog.scan("events").select(
        "id", "externalId", "startTime", "endTime", "type", "subtype", F.col("metadata")["status"].alias("status"),
        F.col("assetIds")[0].alias("assetId"),
    )


@query(
    "scan_timeseries",
    with_views("series") + "SELECT id, externalId, isString, isStep, unit, assetId FROM series",
)
def scan_timeseries(s: Star) -> DataFrame:
    return s.catalog.scan("timeseries", columns=["id", "externalId", "isString", "isStep", "unit", "assetId"])


@query(
    "datapoints_raw",
    with_views("dp")
    + """
    SELECT id, NULL::VARCHAR AS externalId, timestamp, value FROM dp WHERE id IN (3, 7, 11)
    UNION ALL
    SELECT NULL, externalId, timestamp, value FROM dp WHERE externalId IN ('user-7', 'user-20')""",
)
def datapoints_raw(s: Star) -> DataFrame:
    return datapoints(s.catalog.scan("datapoints"), ids=[3, 7, 11], external_ids=["user-7", "user-20"])


@query(
    "string_datapoints",
    with_views("sdp")
    + """
    SELECT NULL::BIGINT AS id, externalId, timestamp, value FROM sdp
    WHERE externalId IN ('text-5', 'text-9') AND timestamp >= TIMESTAMP '2024-01-05'""",
)
def string_datapoints(s: Star) -> DataFrame:
    points = s.catalog.scan("stringdatapoints")
    return datapoints(points, external_ids=["text-5", "text-9"], start="2024-01-05")


@query(
    "datapoints_type_guard",
    with_views("series")
    + """
    SELECT id, 'series ' || id || ' holds string points, read it with stringdatapoints' AS error
    FROM series WHERE isString""",
)
def datapoints_type_guard(s: Star) -> DataFrame:
    series = s.catalog.scan("timeseries")
    return check_series_kind(series, series, is_string=False)


@query(
    "datapoints_needs_id",
    with_views("dp", "series")
    + """
    SELECT 'points' AS part, id, count(*) AS n, NULL AS error FROM dp WHERE id BETWEEN 3 AND 40 GROUP BY id
    UNION ALL
    SELECT 'refused', NULL, NULL, 'data points are read by at least one id or externalId'
    UNION ALL
    SELECT 'refused', NULL, NULL, 'series ' || id || ' holds ' || CASE WHEN isString THEN 'string points, read it with stringdatapoints'
           ELSE 'numeric points, read it with datapoints' END
    FROM series WHERE externalId IN ('text-5', 'user-7')""",
)
def datapoints_needs_id(s: Star) -> DataFrame:
    """Reads of named series, and the reads that are refused: no series named, or one of the other kind."""
    found = s.catalog.points(ids=list(range(3, 41))).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    found = found.select(F.lit("points").alias("part"), "id", "n", F.lit(None).cast("string").alias("error"))
    refused = []
    for kind, names in (("datapoints", []), ("datapoints", ["text-5", "user-6"]), ("stringdatapoints", ["user-7"])):
        try:
            s.catalog.points(kind, external_ids=names)
        except PlantError as error:
            refused.append(("refused", None, None, str(error)))
    return found.unionByName(s.spark.createDataFrame(refused, "part string, id long, n long, error string"))


@query(
    "scan_files",
    """
    SELECT doc_id AS id, 'doc-' || doc_id || '.txt' AS name, source, '/' || lang AS directory,
           'doc-' || doc_id AS externalId, 'text/plain' AS mimeType, lang AS labels
    FROM documents""",
)
def scan_files(s: Star) -> DataFrame:
    return s.catalog.scan("files").select(
        "id", "name", "source", "directory", "externalId", "mimeType", F.array_join("labels", ",").alias("labels")
    )


def _staged(s: Star, kind: str) -> str:
    return f"{scratch_dir(s.spark)}/{kind}-{uuid.uuid4().hex}"


@query(
    "filecontent_json",
    """
    SELECT doc_id, lang, source, n_chars, length(text) AS characters, md5(text) AS digest FROM documents""",
)
def filecontent_json(s: Star) -> DataFrame:
    path = _staged(s, "ndjson")
    s.base("documents").write.json(path)
    return read_file_content(s.spark, path).select(
        "doc_id", "lang", "source", "n_chars", F.length("text").alias("characters"), F.md5("text").alias("digest")
    )


@query(
    "filecontent_text",
    """
    SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS value FROM documents""",
)
def filecontent_text(s: Star) -> DataFrame:
    path = _staged(s, "text")
    s.base("documents").select("text").write.text(path)
    return read_file_content(s.spark, path, infer_schema=False)


@query(
    "filecontent_limits",
    """
    SELECT lang, 'line is longer than 6000 characters' AS error
    FROM (SELECT lang, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
    GROUP BY lang HAVING max(length(line)) > 6000""",
)
def filecontent_limits(s: Star) -> DataFrame:
    path = _staged(s, "by-lang")
    s.base("documents").select("lang", "text").write.partitionBy("lang").text(path)
    found = limit_errors(s.spark, path, line_limit=6000)
    return found.select(F.regexp_extract("file", "lang=([a-z]+)", 1).alias("lang"), "error").distinct()


@query(
    "scan_sequences",
    """
    SELECT DISTINCT user_id AS id, 'seq-' || user_id AS externalId, 'sequence ' || user_id AS name,
           'value:DOUBLE,kind:STRING,k:LONG' AS columns
    FROM events""",
)
def scan_sequences(s: Star) -> DataFrame:
    described = F.transform("columns", lambda c: F.concat_ws(":", c["externalId"], c["valueType"]))
    return s.catalog.scan("sequences").select("id", "externalId", "name", F.array_join(described, ",").alias("columns"))


def sequence_columns(s: Star) -> list[tuple[str, str]]:
    """The column list of one sequence, as its definition states it."""
    found = s.catalog.scan("sequences", where="externalId = 'seq-1'", columns=["columns"]).first()["columns"]
    return [(c["externalId"], c["valueType"]) for c in found]


@query("sequence_rows", with_views("seqrows") + "SELECT k, rowNumber, value, kind FROM seqrows")
def sequence_rows_scan(s: Star) -> DataFrame:
    return sequence_rows(s.catalog.scan("sequencerows"), sequence_columns(s), ["k", "rowNumber", "value", "kind"])


@query("scan_labels", "SELECT DISTINCT p_brand AS externalId, lower(p_brand) AS name FROM part")
def scan_labels(s: Star) -> DataFrame:
    return s.catalog.scan("labels", columns=["externalId", "name"])


@query(
    "scan_relationships",
    with_views("rel") + "SELECT externalId, sourceExternalId, targetExternalId, startTime, confidence, label FROM rel",
)
def scan_relationships(s: Star) -> DataFrame:
    return s.catalog.scan("relationships").select(
        "externalId", "sourceExternalId", "targetExternalId", "startTime", F.round("confidence", 6).alias("confidence"),
        F.array_join("labels", ",").alias("label"),
    )


@query(
    "scan_datasets",
    """
    SELECT n_nationkey::BIGINT AS id, n_name AS name, n_regionkey = 0 AS writeProtected,
           'nation-' || n_nationkey AS externalId
    FROM nation""",
)
def scan_datasets(s: Star) -> DataFrame:
    return s.catalog.scan("datasets", columns=["id", "name", "writeProtected", "externalId"])


@query(
    "raw_untyped",
    "SELECT event_id::VARCHAR AS key, ts AS lastUpdatedTime, props AS columns FROM events",
)
def raw_untyped(s: Star) -> DataFrame:
    return s.catalog.scan("raw")


@query(
    "raw_typed",
    """
    SELECT event_id::VARCHAR AS key, ts AS lastUpdatedTime, json_extract(props, '$.k')::BIGINT AS k FROM events""",
)
def raw_typed(s: Star) -> DataFrame:
    raw = s.catalog.scan("raw")
    return read_json_table(raw, infer_json_schema(raw), on_error="raise")


@query("scan_3dmodels", "SELECT p_partkey AS id, p_name AS name FROM part")
def scan_3dmodels(s: Star) -> DataFrame:
    return s.catalog.scan("3dmodels", columns=["id", "name"])


@query(
    "scan_3dmodelrevisions",
    "SELECT p_partkey * 100 + p_size AS id, p_partkey AS modelId, 'Done' AS status, p_size::BIGINT AS mappings FROM part",
)
def scan_3dmodelrevisions(s: Star) -> DataFrame:
    return s.catalog.scan("3dmodelrevisions").select(
        "id", "modelId", "status", F.col("assetMappingCount").alias("mappings")
    )


@query(
    "scan_3dmodelrevisionnodes",
    """
    SELECT l_orderkey * 10 + l_linenumber AS id, l_linestatus AS name FROM lineitem WHERE l_partkey = 42""",
)
def scan_3dmodelrevisionnodes(s: Star) -> DataFrame:
    return s.catalog.scan("3dmodelrevisionnodes", model_id=42, revision_id=42, columns=["id", "name"])


@query(
    "scan_3dmodelrevisionmappings",
    """
    SELECT l_partkey AS modelId, l_suppkey + 1000000 AS assetId, count(*) AS n, count(DISTINCT l_orderkey * 10 + l_linenumber) AS nodes
    FROM lineitem GROUP BY ALL""",
)
def scan_3dmodelrevisionmappings(s: Star) -> DataFrame:
    """Mappings are dealt by their pair in parts that follow the rows, unless a pair is hot, so that a task's memory does not."""
    mappings, pair = s.catalog.scan("3dmodelrevisionmappings", columns=["modelId", "assetId", "nodeId"]), ["modelId", "assetId"]
    rows, hot = has_hot_key(mappings, pair)
    if not hot:
        mappings = mappings.repartition(max(1, -(-rows // SLICE_ROWS)), *pair)
    return mappings.groupBy("modelId", "assetId").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("nodeId").alias("nodes")
    )


@query(
    "nodes_view",
    """
    SELECT 'parts' AS space, 'part-' || p_partkey AS externalId, p_name AS name, p_brand AS brand, p_size AS size,
           p_retailprice AS price, p_size::BIGINT AS version, 0::BIGINT AS deleted, p_type AS typeId
    FROM part""",
)
def nodes_view(s: Star) -> DataFrame:
    return scan_instances(s.graph(), "node", "Part").select(
        "space", "externalId", "name", "brand", "size", "price", F.col("`node.version`").alias("version"),
        F.col("`node.deletedTime`").alias("deleted"), F.col("_type.externalId").alias("typeId"),
    )


@query(
    "edges_view",
    with_views("edges") + "SELECT externalId, typeId, startId, endId, quantity, discount, version FROM edges",
)
def edges_view(s: Star) -> DataFrame:
    return scan_instances(s.graph(), "edge", "Supply").select(
        "externalId", F.col("type.externalId").alias("typeId"), F.col("startNode.externalId").alias("startId"),
        F.col("endNode.externalId").alias("endId"), "quantity", "discount", F.col("`edge.version`").alias("version"),
    )


@query(
    "edges_connection",
    with_views("edges") + "SELECT externalId, startId, endId FROM edges WHERE typeId = 'flag-R'",
)
def edges_connection(s: Star) -> DataFrame:
    return scan_instances(s.graph(), edge_type=("types", "flag-R")).select(
        "externalId", F.col("startNode.externalId").alias("startId"), F.col("endNode.externalId").alias("endId")
    )


@query(
    "instances_by_model",
    with_views("edges")
    + """
    SELECT 'view' AS part, 'supplier-' || s_suppkey AS externalId, s_name AS name, 'part-' || s_suppkey AS ref
    FROM supplier
    UNION ALL
    SELECT 'connection', externalId, NULL, endId FROM edges WHERE typeId = 'flag-A'""",
)
def instances_by_model(s: Star) -> DataFrame:
    graph, model = s.graph(), ("models", "Trade", "1")
    suppliers = scan_model(graph, model, "Supplier").select(
        F.lit("view").alias("part"), "externalId", "name", F.col("favourite.externalId").alias("ref")
    )
    supplied = scan_model(graph, model, "Part", "suppliedBy").select(
        F.lit("connection").alias("part"), "externalId", F.lit(None).cast("string").alias("name"),
        F.col("endNode.externalId").alias("ref"),
    )
    return suppliers.unionByName(supplied)


@query(
    "instances_has_data",
    with_views("nodes") + "SELECT space, externalId FROM nodes WHERE space = 'suppliers'",
)
def instances_has_data(s: Star) -> DataFrame:
    graph = s.graph()
    return has_data(graph.nodes, graph.properties["Supplier"]).select("space", "externalId")


@query(
    "instances_all",
    with_views("nodes", "edges")
    + """
    SELECT space, externalId, coalesce(version, -1) AS nodeVersion, NULL::BIGINT AS edgeVersion, NULL AS endId FROM nodes
    UNION ALL
    SELECT space, externalId, NULL, version, endId FROM edges""",
)
def instances_all(s: Star) -> DataFrame:
    return scan_instances(s.graph(), "all").select(
        "space", "externalId", F.col("`node.version`").alias("nodeVersion"),
        F.col("`edge.version`").alias("edgeVersion"), F.col("endNode.externalId").alias("endId"),
    )
