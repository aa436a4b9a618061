"""Asset trees: validation, placement, difference, reconciliation and stored labels."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hierarchy import (
    asset_aggregates,
    delete_subtrees,
    diff_hierarchy,
    hierarchy_roots,
    missing_nodes,
    reconcile_hierarchy,
    resolve_ancestors,
    root_changes,
    validate_hierarchy,
)
from ..operators.labels import below, contained, label_tree, move, write_labelled
from ..session import scratch_dir
from ..sources.star import Star, text
from .oracle import with_views
from .registry import query


@query(
    "asset_aggregates",
    with_views("assets", recursive=True)
    + """,
    t(externalId, depth, path) AS (
        SELECT externalId, 0::BIGINT, externalId FROM assets WHERE parentExternalId IS NULL
        UNION ALL
        SELECT a.externalId, t.depth + 1, t.path || '/' || a.externalId
        FROM assets a JOIN t ON a.parentExternalId = t.externalId),
    c AS (SELECT parentExternalId, count(*) AS n FROM assets GROUP BY ALL)
    SELECT t.externalId, coalesce(c.n, 0) AS childCount, t.depth, t.path
    FROM t LEFT JOIN c ON c.parentExternalId = t.externalId""",
)
def aggregates(s: Star) -> DataFrame:
    return asset_aggregates(s.catalog.scan("assets")).withColumn("path", F.array_join("path", "/"))


def _part_tree(s: Star) -> DataFrame:
    """Parts as a binary tree: the parent of part k is part k / 2, and part 1 hangs under a foreign node."""
    key = F.col("p_partkey")
    parent = F.when(key == 0, F.lit("")).when(key == 1, F.lit("elsewhere")).otherwise(
        text("part-", F.floor(key / 2))
    )
    return s.base("part").select(
        text("part-", key).alias("externalId"), parent.alias("parentExternalId"), F.col("p_name").alias("name"),
        F.col("p_type").alias("description"),
    )


_PART_TREE = """
    tree AS (
        SELECT p_partkey AS k, 'part-' || p_partkey AS externalId,
               CASE p_partkey WHEN 0 THEN '' WHEN 1 THEN 'elsewhere' ELSE 'part-' || p_partkey // 2 END AS parentExternalId,
               p_name AS name
        FROM part),
    placed(externalId, root, depth) AS (
        SELECT externalId, externalId, 0::BIGINT FROM tree WHERE k < 2
        UNION ALL
        SELECT t.externalId, p.root, p.depth + 1 FROM tree t JOIN placed p ON t.parentExternalId = p.externalId)"""


@query(
    "hier_roots",
    f"""
    WITH RECURSIVE {_PART_TREE}
    SELECT externalId, root, CASE root WHEN 'part-0' THEN '' ELSE 'elsewhere' END AS rootParent FROM placed""",
)
def hier_roots(s: Star) -> DataFrame:
    return hierarchy_roots(_part_tree(s)).select("externalId", "root", "rootParent")


@query("hier_levels", f"WITH RECURSIVE {_PART_TREE} SELECT depth, count(*) AS n, min(externalId) AS first FROM placed GROUP BY depth")
def hier_levels(s: Star) -> DataFrame:
    placed = resolve_ancestors(_part_tree(s), "externalId", "parentExternalId")
    return placed.groupBy("depth").agg(F.count(F.lit(1)).alias("n"), F.min("externalId").alias("first"))


@query(
    "hier_duplicates",
    """
    SELECT p_brand AS externalId, 'node occurs several times: ' || p_brand AS error
    FROM part WHERE p_size <> 1 GROUP BY p_brand HAVING count(*) > 1
    UNION ALL
    SELECT '', 'empty externalId for node with name: ' || p_name FROM part WHERE p_size = 1""",
)
def hier_duplicates(s: Star) -> DataFrame:
    source = s.base("part").select(
        F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.col("p_brand")).alias("externalId"),
        F.lit("").alias("parentExternalId"), F.col("p_name").alias("name"),
    )
    return validate_hierarchy(source)


@query(
    "hier_cycles",
    """
    SELECT 'part-' || p_partkey AS externalId, 'node is on or below a cycle' AS error
    FROM part WHERE (p_partkey // 10) % 2 = 0 AND p_partkey // 10 < (SELECT max(p_partkey) // 10 FROM part)""",
)
def hier_cycles(s: Star) -> DataFrame:
    """Chains of ten parts; in every other chain the last part points back into the chain."""
    key = F.col("p_partkey")
    chain, place = F.floor(key / 10), key % 10
    loop = F.when(chain % 2 == 0, text("part-", key - 7)).otherwise(F.lit(""))
    source = s.base("part").select(
        text("part-", key).alias("externalId"),
        F.when(place == 9, loop).otherwise(text("part-", key + 1)).alias("parentExternalId"),
        F.col("p_name").alias("name"), chain.alias("chain"),
    )
    last = source.agg(F.max("chain")).scalar()
    return validate_hierarchy(source.filter(F.col("chain") < last).drop("chain"))


def _target(s: Star) -> DataFrame:
    return s.catalog.scan("assets")


def _changed(s: Star) -> DataFrame:
    """The asset tree as a new input: customers in debt are gone, builders renamed, suppliers added."""
    assets = _target(s).select(
        "externalId", F.coalesce("parentExternalId", F.lit("")).alias("parentExternalId"), "source", "name", "description",
        "metadata", "dataSetId", "labels",
    )
    debtors = s.base("customer").filter("c_acctbal < 0").select(text("customer-", F.col("c_custkey")).alias("externalId"))
    kept = assets.join(debtors, "externalId", "left_anti")
    renamed = F.when(F.col("description") == "BUILDING", F.upper("name")).otherwise(F.col("name"))
    added = s.base("supplier").select(
        text("supplier-", F.col("s_suppkey")).alias("externalId"),
        text("nation-", F.col("s_nationkey")).alias("parentExternalId"), F.col("s_name").alias("name"),
        F.lit("supplier").alias("source"),
    )
    return kept.withColumn("name", renamed).unionByName(added, allowMissingColumns=True)


_CHANGES = """
    changes AS (
        SELECT externalId, CASE WHEN description = 'BUILDING' AND upper(name) <> name THEN 'update' ELSE 'unchanged' END AS change
        FROM assets WHERE externalId NOT IN (SELECT 'customer-' || c_custkey FROM customer WHERE c_acctbal < 0)
        UNION ALL
        SELECT 'supplier-' || s_suppkey, 'insert' FROM supplier),
    gone AS (SELECT 'customer-' || c_custkey AS externalId FROM customer WHERE c_acctbal < 0)"""


@query("hier_diff", with_views("assets") + f",{_CHANGES} SELECT externalId, change FROM changes")
def hier_diff(s: Star) -> DataFrame:
    return diff_hierarchy(_changed(s), _target(s))


@query("hier_delete_missing", with_views("assets") + f",{_CHANGES} SELECT externalId FROM gone")
def hier_delete_missing(s: Star) -> DataFrame:
    return missing_nodes(hierarchy_roots(_changed(s)), _target(s))


@query(
    "hier_reconcile",
    with_views("assets")
    + f""",{_CHANGES}
    SELECT id, a.externalId, parentId, rootId, a.parentExternalId, CASE WHEN change = 'update' THEN upper(name) ELSE name END AS name,
           description, source, dataSetId, label
    FROM assets a JOIN changes c ON c.externalId = a.externalId
    UNION ALL
    SELECT NULL, 'supplier-' || s_suppkey, s_nationkey + 1000, n_regionkey + 1, 'nation-' || s_nationkey, s_name, NULL, 'supplier',
           NULL, NULL
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def hier_reconcile(s: Star) -> DataFrame:
    result = reconcile_hierarchy(_target(s), _changed(s), delete_missing=True).raise_for_errors()
    # Ids of new assets are any unused numbers.
    return result.table.select(
        F.when(F.col("source") != "supplier", F.col("id")).alias("id"), "externalId", "parentId", "rootId",
        "parentExternalId", "name", "description", "source", "dataSetId",
        F.array_join("labels", ",").alias("label"),
    )


@query(
    "hier_ignore_orphans",
    """
    SELECT 'site-' || p_partkey AS externalId, CASE WHEN p_partkey < 25 THEN NULL ELSE 'site-' || p_partkey // 25 END AS parentExternalId,
           p_name AS name
    FROM part WHERE (WITH RECURSIVE up(k) AS (SELECT p_partkey UNION ALL SELECT k // 25 FROM up WHERE k >= 25) SELECT min(k) FROM up) < 10""",
)
def hier_ignore_orphans(s: Star) -> DataFrame:
    """Trees of parts; those of the roots 10 to 24 hang under nodes outside the input and are ignored."""
    key = F.col("p_partkey")
    parent = F.when(key < 10, F.lit("")).when(key < 25, text("elsewhere-", key)).otherwise(text("site-", F.floor(key / 25)))
    source = s.base("part").select(
        text("site-", key).alias("externalId"), parent.alias("parentExternalId"), F.col("p_name").alias("name")
    )
    empty = _target(s).limit(0)
    return reconcile_hierarchy(empty, source, subtrees="ignore").raise_for_errors().table.select(
        "externalId", "parentExternalId", "name"
    )


@query(
    "hier_root_change",
    """
    SELECT 'nation-' || n_nationkey AS externalId, 'region-' || n_regionkey AS oldRoot,
           'region-' || (n_regionkey + n_nationkey) % 5 AS newRoot, 'can not move a node to a different root' AS error
    FROM nation WHERE n_nationkey % 5 <> 0
    UNION ALL
    SELECT 'customer-' || c_custkey, 'region-' || n_regionkey, 'customer-' || c_custkey, 'can not make a root from an inner node'
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0""",
)
def hier_root_change(s: Star) -> DataFrame:
    """Nations move between regions, and customers in debt would become roots."""
    regions = s.base("region").select(text("region-", F.col("r_regionkey")).alias("externalId"), F.lit("").alias("parentExternalId"))
    nations = s.base("nation").select(
        text("nation-", F.col("n_nationkey")).alias("externalId"),
        text("region-", (F.col("n_regionkey") + F.col("n_nationkey")) % 5).alias("parentExternalId"),
    )
    debtors = s.base("customer").filter("c_acctbal < 0").select(
        text("customer-", F.col("c_custkey")).alias("externalId"), F.lit("").alias("parentExternalId")
    )
    source = regions.unionByName(nations).unionByName(debtors)
    return root_changes(hierarchy_roots(source), _target(s))


@query(
    "hier_delete_recursive",
    with_views("assets")
    + """
    SELECT id, externalId FROM assets a
    WHERE externalId <> 'region-2' AND coalesce(parentExternalId, '') <> 'region-2'
      AND NOT EXISTS (SELECT 1 FROM nation WHERE a.parentExternalId = 'nation-' || n_nationkey AND n_regionkey = 2)
      AND externalId NOT IN (SELECT 'customer-' || c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def hier_delete_recursive(s: Star) -> DataFrame:
    debtors = s.base("customer").filter("c_acctbal < 0").select(text("customer-", F.col("c_custkey")).alias("externalId"))
    region = s.base("region").filter("r_regionkey = 2").select(text("region-", F.col("r_regionkey")).alias("externalId"))
    unknown = region.select(F.lit("no such node").alias("externalId"))
    tops = debtors.unionByName(region).unionByName(unknown)
    return delete_subtrees(_target(s), tops).select("id", "externalId")


def _labelled(s: Star) -> DataFrame:
    """The assets with interval labels, stored in the order of the walk and read again."""
    path = f"{scratch_dir(s.spark)}/labelled-{uuid.uuid4().hex}"
    write_labelled(s.catalog.scan("assets"), path)
    return s.spark.read.parquet(path)


@query(
    "assets_subtree_labels",
    with_views("assets", recursive=True)
    + """,
    below(externalId) AS (
        SELECT externalId FROM assets WHERE externalId = 'region-1' OR id = 1010
        UNION
        SELECT a.externalId FROM assets a JOIN below b ON a.parentExternalId = b.externalId)
    SELECT id, externalId, name FROM assets WHERE externalId IN (SELECT externalId FROM below)""",
)
def assets_subtree_labels(s: Star) -> DataFrame:
    """A subtree as a range of one stored column."""
    return below(_labelled(s), (F.col("externalId") == "region-1") | (F.col("id") == 1010)).select("id", "externalId", "name")


@query(
    "tree_sizes",
    with_views("assets", recursive=True)
    + """,
    up(externalId, above) AS (
        SELECT externalId, parentExternalId FROM assets WHERE parentExternalId IS NOT NULL
        UNION ALL
        SELECT up.externalId, a.parentExternalId FROM up JOIN assets a ON a.externalId = up.above WHERE a.parentExternalId IS NOT NULL)
    SELECT a.externalId, count(up.externalId) AS descendants FROM assets a LEFT JOIN up ON up.above = a.externalId GROUP BY a.externalId""",
)
def tree_sizes(s: Star) -> DataFrame:
    """How many assets lie below each one, read off its label."""
    return label_tree(s.catalog.scan("assets")).select("externalId", (F.col("leave") - F.col("enter")).alias("descendants"))


@query(
    "assets_labels_moved",
    with_views("assets", recursive=True)
    + """,
    moved AS (SELECT id, externalId, CASE id WHEN 1003 THEN 3 WHEN 2 THEN 1007 ELSE parentId END AS parentId FROM assets),
    below(id) AS (
        SELECT id FROM moved WHERE id IN (3, 1007)
        UNION
        SELECT m.id FROM moved m JOIN below b ON m.parentId = b.id)
    SELECT id, externalId, parentId FROM moved WHERE id IN (SELECT id FROM below)""",
)
def assets_labels_moved(s: Star) -> DataFrame:
    """Labels repaired after two moves: a nation to another region, and a whole region below a nation."""
    moved = move(move(_labelled(s), 1003, 3), 2, 1007)
    return below(moved, F.col("id").isin(3, 1007)).select("id", "externalId", "parentId")


@query(
    "hier_delete_labels",
    with_views("assets")
    + """
    SELECT id, externalId FROM assets a
    WHERE externalId <> 'region-2' AND coalesce(parentExternalId, '') <> 'region-2'
      AND NOT EXISTS (SELECT 1 FROM nation WHERE a.parentExternalId = 'nation-' || n_nationkey AND n_regionkey = 2)
      AND externalId NOT IN (SELECT 'customer-' || c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def hier_delete_labels(s: Star) -> DataFrame:
    """The recursive delete by labels: which of very many subtrees a node lies in takes no loop and no range join."""
    debtors = s.base("customer").filter("c_acctbal < 0").select(text("customer-", F.col("c_custkey")).alias("externalId"))
    regions = s.base("region").filter("r_regionkey = 2").select(text("region-", F.col("r_regionkey")).alias("externalId"))
    assets = _labelled(s)
    tops = assets.join(debtors.unionByName(regions), "externalId", "left_semi")
    return assets.join(contained(assets, tops), "id", "left_anti").select("id", "externalId")
