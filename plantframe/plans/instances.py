"""Writes to nodes and edges."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import auto_create_nodes, classify_instances, delete_instances, missing_references, upsert_instances, view_schema
from ..sources.star import PART_VIEW, SUPPLIER_VIEW, SUPPLY_VIEW, Star, line_key, ref, text
from .oracle import with_views
from .registry import query

NOW = datetime(2030, 1, 1, tzinfo=timezone.utc)


@query(
    "view_schema",
    """
    SELECT * FROM (VALUES ('Part', 'name', 'string'), ('Part', 'brand', 'string'), ('Part', 'size', 'int'),
        ('Part', 'price', 'double'), ('Supplier', 'name', 'string'), ('Supplier', 'balance', 'double'),
        ('Supplier', 'favourite', 'struct<space:string,externalId:string>'), ('Supply', 'quantity', 'double'),
        ('Supply', 'discount', 'double')) t(view, property, type)""",
)
def view_schemas(s: Star) -> DataFrame:
    """Property columns of every view, as the tables behind the views have them."""
    graph = s.graph()
    rows = []
    for name, view in graph.views.items():
        schema, stored = view_schema(view, view.used_for), graph.properties[name].schema
        rows += [
            (name, p.name, schema[p.name].dataType.simpleString())
            for p in view.properties
            if stored[p.name].dataType.simpleString() == schema[p.name].dataType.simpleString()
        ]
    return s.spark.createDataFrame(rows, "view string, property string, type string")


def _part_changes(s: Star) -> DataFrame:
    """A change for every second part, and as many new parts."""
    return s.base("part").select(
        text("part-", F.col("p_partkey") * 2).alias("externalId"),
        F.when(F.col("p_size") > 25, text("new ", F.col("p_name"))).alias("name"),
        (F.col("p_retailprice") + 1).alias("price"),
    )


_PART_CHANGES = """
    new AS (SELECT p_partkey * 2 AS k, CASE WHEN p_size > 25 THEN 'new ' || p_name END AS name, p_retailprice + 1 AS price FROM part)"""


@query(
    "node_upsert",
    f"""
    WITH {_PART_CHANGES}
    SELECT 'part-' || coalesce(k, p_partkey) AS externalId, coalesce(new.name, p_name) AS name, p_brand AS brand,
           coalesce(new.price, p_retailprice) AS price, p_type AS typeId,
           CASE WHEN p_partkey IS NULL THEN 1
                WHEN k IS NULL OR (coalesce(new.name, p_name) = p_name AND new.price = p_retailprice) THEN p_size
                ELSE p_size + 1 END::BIGINT AS version
    FROM part FULL JOIN new ON k = p_partkey""",
)
def node_upsert(s: Star) -> DataFrame:
    graph = s.graph()
    result = upsert_instances(
        graph.nodes, _part_changes(s), "node", PART_VIEW, graph.properties["Part"], instance_space="parts", now=NOW
    )
    nodes = result.instances.filter("space = 'parts'").select(
        "space", "externalId", "version", F.col("_type.externalId").alias("typeId")
    )
    return nodes.join(result.properties, ["space", "externalId"]).select(
        "externalId", "name", "brand", "price", "typeId", "version"
    )


@query(
    "node_upsert_nulls",
    f"""
    WITH {_PART_CHANGES}
    SELECT 'part-' || coalesce(k, p_partkey) AS externalId, CASE WHEN k IS NULL THEN p_name ELSE new.name END AS name
    FROM part FULL JOIN new ON k = p_partkey""",
)
def node_upsert_nulls(s: Star) -> DataFrame:
    graph = s.graph()
    result = upsert_instances(
        graph.nodes, _part_changes(s), "node", PART_VIEW, graph.properties["Part"], instance_space="parts",
        ignore_null_fields=False, now=NOW,
    )
    return result.properties.select("externalId", "name")


@query(
    "upsert_noop_count",
    """
    SELECT CASE WHEN p_size > 25 THEN 'modified' ELSE 'noop' END AS change, count(*) AS n FROM part GROUP BY ALL""",
)
def upsert_noop_count(s: Star) -> DataFrame:
    """Writing the values that are there already changes nothing."""
    graph = s.graph()
    price = F.col("p_retailprice") + F.when(F.col("p_size") > 25, 1).otherwise(0)
    source = s.base("part").select(text("part-", F.col("p_partkey")).alias("externalId"), price.alias("price"))
    result = upsert_instances(graph.nodes, source, "node", PART_VIEW, graph.properties["Part"], instance_space="parts")
    return result.changes.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def _edge_changes(s: Star) -> DataFrame:
    """Every line again, and one new edge per order; edges without an end are refused."""
    line = s.base("lineitem")
    old = line.select(
        line_key(":").alias("externalId"),
        ref("types", F.lit("flag-X")).alias("type"),
        F.struct(F.lit(None).cast("string").alias("space"), text("part-", F.col("l_partkey")).alias("externalId")).alias("startNode"),
        ref("suppliers", text("supplier-", F.col("l_suppkey"))).alias("endNode"),
        F.when(F.col("l_quantity") > 25, F.lit(0.0)).alias("quantity"),
    )
    new = s.base("orders").select(
        text("order-", F.col("o_orderkey")).alias("externalId"), ref("types", F.lit("flag-X")).alias("type"),
        ref("orders", text("order-", F.col("o_orderkey"))).alias("startNode"),
        ref("customers", F.when(F.col("o_orderstatus") != "P", text("customer-", F.col("o_custkey")))).alias("endNode"),
        F.lit(1.5).alias("quantity"),
    )
    return old.unionByName(new)


@query(
    "edge_upsert",
    with_views("edges")
    + """
    SELECT externalId, 'flag-X' AS typeId, 'supply' AS startSpace, endId, CASE WHEN quantity > 25 THEN 0 ELSE quantity END AS quantity,
           discount, NULL AS error
    FROM edges
    UNION ALL
    SELECT 'order-' || o_orderkey, 'flag-X', 'orders', 'customer-' || o_custkey, 1.5, NULL, NULL FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT 'order-' || o_orderkey, NULL, NULL, NULL, NULL, NULL, '''endNode'' is incomplete' FROM orders WHERE o_orderstatus = 'P'""",
)
def edge_upsert(s: Star) -> DataFrame:
    graph = s.graph()
    result = upsert_instances(
        graph.edges, _edge_changes(s), "edge", SUPPLY_VIEW, graph.properties["Supply"], instance_space="supply", now=NOW
    )
    rows = result.joined.select(
        "externalId", F.col("type.externalId").alias("typeId"), F.col("startNode.space").alias("startSpace"),
        F.col("endNode.externalId").alias("endId"), "quantity", "discount",
    )
    return rows.unionByName(result.errors.select("externalId", "error"), allowMissingColumns=True)


@query(
    "connection_upsert",
    """
    SELECT 'order-' || o_orderkey AS externalId, 'placedBy' AS typeId, 'customer-' || o_custkey AS endId FROM orders""",
)
def connection_upsert(s: Star) -> DataFrame:
    source = s.base("orders").select(
        text("order-", F.col("o_orderkey")).alias("externalId"), ref("orders", text("order-", F.col("o_orderkey"))).alias("startNode"),
        ref("customers", text("customer-", F.col("o_custkey"))).alias("endNode"),
    )
    result = upsert_instances(s.graph().edges, source, "edge", instance_space="trade", edge_type=("types", "placedBy"), now=NOW)
    return result.instances.filter("space = 'trade'").select(
        "externalId", F.col("type.externalId").alias("typeId"), F.col("endNode.externalId").alias("endId")
    )


def _mixed(s: Star) -> DataFrame:
    """Lines as edges, nodes and broken rows, by return flag and line status."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    start = F.when(flag != "N", ref("parts", text("part-", F.col("l_partkey"))))
    end = F.when((flag != "N") & ((flag == "R") | (status == "O")), ref("suppliers", text("supplier-", F.col("l_suppkey"))))
    return s.base("lineitem").select(
        line_key(":").alias("externalId"),
        F.when(flag == "R", ref("types", F.lit("edge"))).otherwise(ref("types", F.lit("other"))).alias("_type"),
        start.alias("startNode"), end.alias("endNode"), "l_quantity",
    )


@query(
    "classify_instances",
    with_views("edges")
    + """
    SELECT CASE WHEN l_returnflag = 'N' THEN 'node' WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN 'edge' ELSE 'error' END AS kind,
           count(*) AS n, round(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 0 ELSE l_quantity END), 4) AS quantity,
           CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F'
                THEN 'neither a node nor an edge, it has only: ''externalId'', ''type'', ''startNode''' END AS error
    FROM lineitem GROUP BY ALL""",
)
def classify(s: Star) -> DataFrame:
    nodes, edges, errors = classify_instances(_mixed(s), instance_space="supply")
    total = F.round(F.sum("l_quantity"), 4).alias("quantity")
    counted = [
        df.agg(F.count(F.lit(1)).alias("n"), total).withColumn("kind", F.lit(kind)) for df, kind in ((nodes, "node"), (edges, "edge"))
    ]
    refused = errors.groupBy("error").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("error")).withColumn("quantity", F.lit(0.0))
    return counted[0].unionByName(counted[1]).unionByName(refused, allowMissingColumns=True)


@query(
    "instance_delete",
    with_views("nodes") + "SELECT space, externalId FROM nodes WHERE externalId NOT IN (SELECT 'part-' || c_custkey * 3 FROM customer)",
)
def instance_delete(s: Star) -> DataFrame:
    gone = s.base("customer").select(text("part-", F.col("c_custkey") * 3).alias("externalId"))
    return delete_instances(s.graph().nodes, gone, instance_space="parts").select("space", "externalId")


def _references(s: Star) -> DataFrame:
    """Edges whose ends exist for some lines only: part numbers are doubled, supplier numbers tripled."""
    return s.base("lineitem").select(
        line_key(":").alias("externalId"),
        ref("parts", text("part-", F.col("l_partkey") * 2)).alias("startNode"),
        ref("suppliers", text("supplier-", F.col("l_suppkey") * 3)).alias("endNode"),
    )


@query(
    "autocreate_nodes",
    with_views("nodes")
    + """
    SELECT space, externalId, version FROM nodes
    UNION ALL
    SELECT DISTINCT 'parts', 'part-' || l_partkey * 2, 1 FROM lineitem WHERE l_partkey * 2 NOT IN (SELECT p_partkey FROM part)
    UNION ALL
    SELECT DISTINCT 'suppliers', 'supplier-' || l_suppkey * 3, 1 FROM lineitem WHERE l_suppkey * 3 NOT IN (SELECT s_suppkey FROM supplier)""",
)
def autocreate_nodes(s: Star) -> DataFrame:
    nodes, _ = auto_create_nodes(_references(s), s.graph().nodes, instance_space="supply", now=NOW)
    return nodes.select("space", "externalId", "version")


@query(
    "missing_nodes",
    """
    SELECT DISTINCT 'suppliers' AS space, 'supplier-' || l_suppkey * 3 AS externalId FROM lineitem
    WHERE l_suppkey * 3 NOT IN (SELECT s_suppkey FROM supplier)""",
)
def missing_nodes(s: Star) -> DataFrame:
    """Start nodes may be created, end nodes may not."""
    return auto_create_nodes(_references(s), s.graph().nodes, end_nodes=False, instance_space="supply")[1]


@query(
    "direct_relation_list",
    """
    SELECT DISTINCT * FROM (
        SELECT 'parts' AS space, 'part-' || o_orderkey AS externalId FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'customers', 'customer-' || o_custkey FROM orders)
    WHERE externalId NOT IN (SELECT 'part-' || p_partkey FROM part)""",
)
def direct_relation_list(s: Star) -> DataFrame:
    """Null list elements are dropped, a missing space is filled in."""
    no_space = F.struct(F.lit(None).cast("string").alias("space"), text("part-", F.col("o_orderkey")).alias("externalId"))
    source = s.base("orders").select(
        text("order-", F.col("o_orderkey")).alias("externalId"),
        F.array(
            F.when(F.col("o_orderstatus") != "P", no_space), ref("customers", text("customer-", F.col("o_custkey")))
        ).alias("related"),
    )
    return missing_references(source, s.graph().nodes, ["related"], instance_space="parts")


@query(
    "direct_relation",
    """
    SELECT 'supplier-' || s_suppkey AS externalId, CASE WHEN s_acctbal < 0 THEN s_name || '!' ELSE s_name END AS name,
           CASE WHEN s_acctbal < 0 THEN 'elsewhere' ELSE 'parts' END AS space,
           'part-' || CASE WHEN s_acctbal < 0 THEN s_suppkey + 1 ELSE s_suppkey END AS favourite
    FROM supplier""",
)
def direct_relation(s: Star) -> DataFrame:
    graph = s.graph()
    changed = s.base("supplier").filter("s_acctbal < 0").select(
        text("supplier-", F.col("s_suppkey")).alias("externalId"), text(F.col("s_name"), "!").alias("name"),
        ref("elsewhere", text("part-", F.col("s_suppkey") + 1)).alias("favourite"),
    )
    result = upsert_instances(
        graph.nodes, changed, "node", SUPPLIER_VIEW, graph.properties["Supplier"], instance_space="suppliers", now=NOW
    )
    return result.properties.select(
        "externalId", "name", F.col("favourite.space").alias("space"), F.col("favourite.externalId").alias("favourite")
    )
