"""Instances read and written through versioned data models, and assets with their aggregates."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.star import Star, ref, text
from ..workspace import Workspace
from .oracle import with_views
from .registry import query


def _options(version: str, view: str = "Part", **more: object) -> dict[str, object]:
    model = {"modelSpace": "models", "modelExternalId": "Trade", "modelVersion": version, "viewExternalId": view}
    return {"type": "instances", **model, **more}


@query(
    "instances_by_version",
    """
    SELECT '1' AS version, 'part-' || p_partkey AS externalId, p_name AS title, p_size::BIGINT AS size, p_retailprice AS price,
           NULL::INTEGER AS cost FROM part
    UNION ALL
    SELECT '2', 'part-' || p_partkey, p_name, p_size, NULL, trunc(p_retailprice)::INTEGER FROM part
    UNION ALL
    SELECT 'referred', 'supplier-' || s_suppkey, s_name, NULL, s_acctbal, NULL FROM supplier""",
)
def instances_by_version(s: Star) -> DataFrame:
    """Two versions of a view over one table, and a view that a model refers to."""
    space = Workspace(s.catalog, s.graph())
    first = space.read(**_options("1")).select(
        F.lit("1").alias("version"), "externalId", F.col("name").alias("title"), F.col("size").cast("long").alias("size"), "price"
    )
    second = space.read(**_options("2")).select(F.lit("2").alias("version"), "externalId", "title", "size", "cost")
    third = space.read(**_options("2", "Supplier")).select(
        F.lit("referred").alias("version"), "externalId", F.col("name").alias("title"), F.col("balance").alias("price")
    )
    return first.unionByName(second, allowMissingColumns=True).unionByName(third, allowMissingColumns=True)


@query(
    "model_upsert",
    """
    WITH src AS (SELECT 'part-' || p_partkey * 2 AS externalId, p_partkey * 2 AS k, CASE WHEN p_size > 25 THEN 'new ' || p_name END AS title,
                        p_size + 1 AS size, p_size AS cost,
                        CASE WHEN p_size = 24 THEN 'bad value of ''size''' WHEN p_size = 25 THEN 'bad value of ''cost''' END AS error FROM part),
    good AS (SELECT * FROM src WHERE error IS NULL)
    SELECT coalesce(externalId, 'part-' || p_partkey) AS externalId, coalesce(title, p_name) AS name, p_brand AS brand,
           coalesce(size, p_size)::INTEGER AS size, coalesce(cost, p_retailprice)::DOUBLE AS price, NULL AS error
    FROM part FULL JOIN good ON k = p_partkey
    UNION ALL
    SELECT externalId, NULL, NULL, NULL, NULL, error FROM src WHERE error IS NOT NULL""",
)
def model_upsert(s: Star) -> DataFrame:
    """Parts written through version 2 of their view land in the table that version 1 reads."""
    size = F.when(F.col("p_size") == 24, F.lit(3_000_000_000)).otherwise(F.col("p_size").cast("long") + 1)
    source = s.base("part").select(
        text("part-", F.col("p_partkey") * 2).alias("externalId"),
        F.when(F.col("p_size") > 25, text("new ", F.col("p_name"))).alias("title"), size.alias("size"),
        F.when(F.col("p_size") == 25, 2.5).otherwise(F.col("p_size").cast("double")).alias("cost"),
    )
    done = Workspace(s.catalog, s.graph()).write(source, onconflict="upsert", **_options("2", instanceSpace="parts"))
    rows = done.properties.drop("space")
    return rows.unionByName(done.errors.select("externalId", "error"), allowMissingColumns=True)


@query(
    "model_connection",
    with_views("edges")
    + """
    SELECT space, externalId, startId, endId FROM edges WHERE typeId = 'flag-R'
    UNION ALL
    SELECT 'trade', 'order-' || o_orderkey, 'part-' || o_orderkey, 'supplier-' || o_custkey FROM orders""",
)
def model_connection(s: Star) -> DataFrame:
    """Edges written through a connection get its type; the same connection reads them with the stored ones."""
    graph = s.graph()
    source = s.base("orders").select(
        text("order-", F.col("o_orderkey")).alias("externalId"), ref("parts", text("part-", F.col("o_orderkey"))).alias("startNode"),
        ref("suppliers", text("supplier-", F.col("o_custkey"))).alias("endNode"),
    )
    options = _options("2", connectionPropertyName="suppliedBy")
    done = Workspace(s.catalog, graph).write(source, onconflict="upsert", instanceSpace="trade", **options)
    after = Workspace(s.catalog, replace(graph, edges=done.instances))
    return after.read(**options).select(
        "space", "externalId", F.col("startNode.externalId").alias("startId"), F.col("endNode.externalId").alias("endId")
    )


@query(
    "model_sync",
    """
    SELECT 'part-' || p_partkey AS externalId, p_name AS title, p_size::BIGINT AS version, true AS resumable FROM part""",
)
def model_sync(s: Star) -> DataFrame:
    """A cursor comes before a connection: the view is read, every row with a cursor to go on from."""
    found = Workspace(s.catalog, s.graph()).read(**_options("2", connectionPropertyName="suppliedBy", cursor=""))
    return found.select(
        "externalId", "title", F.col("`node.version`").alias("version"), F.col("`metadata.cursor`").isNotNull().alias("resumable")
    )


@query(
    "assets_with_aggregates",
    with_views("assets")
    + """
    SELECT a.id, coalesce(c.n, 0) AS childCount, CASE source WHEN 'region' THEN 0 WHEN 'nation' THEN 1 ELSE 2 END::BIGINT AS depth,
           CASE source WHEN 'region' THEN '' ELSE a.rootId || '/' END || CASE source WHEN 'customer' THEN a.parentId || '/' ELSE '' END || a.id AS path
    FROM assets a LEFT JOIN (SELECT parentId AS id, count(*) AS n FROM assets WHERE parentId IS NOT NULL GROUP BY parentId) c ON a.id = c.id""",
)
def assets_with_aggregates(s: Star) -> DataFrame:
    return Workspace(s.catalog).read(type="assets", aggregates=True).select(
        "id", "aggregates.childCount", "aggregates.depth", F.array_join("aggregates.path", "/").alias("path")
    )
