"""Trees kept as (externalId, parentExternalId) rows: roots, levels, subtrees and reconciliation.

Ancestors are found by pointer doubling: each round doubles how far every open row looks up, so a tree
of depth ``d`` needs about ``log2(d)`` joins, and each round is cut on shared storage.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlantError
from ..session import cut_lineage
from .skew import dense_rank_ids, keep_greatest

COMPARED = ("description", "metadata", "name", "source", "dataSetId", "labels")
CLEARABLE = ("description", "source", "dataSetId")


def resolve_ancestors(
    df: DataFrame, key: str, parent: str, with_path: bool = False, stored: bool = False
) -> DataFrame:
    """For each node its top-most ancestor inside ``df``: columns key, root, depth, cyclic (and path).

    A node whose parent is missing from ``df`` is a root. Nodes on or below a cycle get ``cyclic``.
    ``path`` lists the keys from the root down to the node. Keys must be unique. ``stored`` says that
    ``df`` is read from storage as it is, so that reading it twice is cheap.
    """
    nodes = df.select(F.col(key).alias("k"), F.col(parent).alias("p"))
    if not stored:
        nodes = cut_lineage(nodes)
    known = nodes.select(F.col("k").alias("p"), F.lit(True).alias("known"))
    linked = nodes.join(known, "p", "left")
    state = cut_lineage(
        linked.select(
            "k",
            F.when(F.col("known"), F.col("p")).otherwise(F.col("k")).alias("up"),
            F.when(F.col("known"), 1).otherwise(0).cast("long").alias("depth"),
            F.col("known").isNull().alias("done"),
            *([F.array("k").alias("path")] if with_path else []),
        )
    )
    finished, pending = [state.filter("done")], state.filter("not done")
    open_rows = pending.count()
    while open_rows:
        above = state.select(
            F.col("k").alias("up"),
            F.col("up").alias("up2"),
            F.col("depth").alias("depth2"),
            F.col("done").alias("done2"),
            *([F.col("path").alias("path2")] if with_path else []),
        )
        moved = cut_lineage(
            pending.join(above, "up").select(
                "k",
                F.col("up2").alias("up"),
                (F.col("depth") + F.col("depth2")).alias("depth"),
                F.col("done2").alias("done"),
                *([F.concat("path2", "path").alias("path")] if with_path else []),
            )
        )
        # Only open rows move on: rows once finished are written once.
        finished.append(moved.filter("done"))
        pending = moved.filter("not done")
        still_open = pending.count()
        state = reduce(DataFrame.unionByName, [*finished, pending])
        if still_open == open_rows:
            break  # a finite chain resolves at least one row per round, so the rest is cyclic
        open_rows = still_open
    return state.select(
        F.col("k").alias(key),
        F.when(F.col("done"), F.col("up")).alias("root"),
        F.when(F.col("done"), F.col("depth")).alias("depth"),
        (~F.col("done")).alias("cyclic"),
        *([F.when(F.col("done"), F.col("path")).alias("path")] if with_path else []),
    )


def asset_aggregates(assets: DataFrame) -> DataFrame:
    """``externalId, childCount, depth, path`` of every asset."""
    placed = resolve_ancestors(assets, "externalId", "parentExternalId", with_path=True)
    children = (
        assets.filter(F.col("parentExternalId").isNotNull())
        .groupBy(F.col("parentExternalId").alias("externalId"))
        .agg(F.count(F.lit(1)).alias("childCount"))
    )
    return placed.join(children, "externalId", "left").select(
        "externalId", F.coalesce("childCount", F.lit(0)).alias("childCount"), "depth", "path"
    )


def with_aggregates(assets: DataFrame) -> DataFrame:
    """Assets with ``aggregates`` filled in: the number of children, the ids from the root down, and the depth.

    Links are those of ``parentId``; an asset on or below a cycle has neither path nor depth.
    """
    placed = resolve_ancestors(assets, "id", "parentId", with_path=True)
    children = assets.filter("parentId is not null").groupBy(F.col("parentId").alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    found = F.struct(
        F.coalesce("_n", F.lit(0)).cast("long").alias("childCount"),
        F.col("_path").cast("array<string>").alias("path"),
        F.col("_depth").alias("depth"),
    )
    extra = placed.select("id", F.col("path").alias("_path"), F.col("depth").alias("_depth")).join(children, "id", "left")
    return assets.join(extra.select("id", found.alias("_found")), "id", "left").select(
        *[F.col("_found").alias(c) if c == "aggregates" else F.col(c) for c in assets.columns]
    )


def _descendants(tree: DataFrame, tops: DataFrame) -> DataFrame:
    """``externalId`` of the tops found in the tree and of everything below them.

    The links above the tops are cut, so that a node below one has it as its root.
    """
    marks = tops.select("externalId").filter(F.col("externalId").isNotNull()).distinct()
    cut = (
        tree.select("externalId", "parentExternalId")
        .join(marks.withColumn("_top", F.lit(True)), "externalId", "left")
        .withColumn("parentExternalId", F.when(F.col("_top"), None).otherwise(F.col("parentExternalId")))
    )
    placed = resolve_ancestors(cut.drop("_top"), "externalId", "parentExternalId").filter("not cyclic")
    return placed.join(marks.withColumnRenamed("externalId", "root"), "root").select("externalId")


def subtree(assets: DataFrame, ids: list[int] = (), external_ids: list[str] = ()) -> DataFrame:
    """Assets of the subtrees below the named assets, the named ones included."""
    named = F.lit(False)
    if ids:
        named = named | F.col("id").isin(list(ids))
    if external_ids:
        named = named | F.col("externalId").isin(list(external_ids))
    return assets.join(_descendants(assets, assets.filter(named)), "externalId", "left_semi").select(*assets.columns)


def delete_subtrees(assets: DataFrame, tops: DataFrame) -> DataFrame:
    """Assets that stay after the subtrees of ``tops`` are deleted; unknown ids are ignored."""
    if "id" in tops.columns:
        by_id = tops.filter("id is not null").select("id").join(assets, "id").select("externalId")
        if "externalId" in tops.columns:
            by_id = by_id.unionByName(tops.filter("id is null").select("externalId"))
        tops = by_id
    return assets.join(_descendants(assets, tops), "externalId", "left_anti").select(*assets.columns)


def validate_hierarchy(source: DataFrame) -> DataFrame:
    """Rows that make an input tree invalid, as (externalId, error)."""
    return _invalid(source, resolve_ancestors(_unique(source), "externalId", "parentExternalId", stored=True))


def _unique(source: DataFrame) -> DataFrame:
    """One row per non-empty key, with the number of rows it stands for."""
    named = source.filter(F.col("externalId") != "")
    return cut_lineage(
        named.groupBy("externalId").agg(F.max("parentExternalId").alias("parentExternalId"), F.count(F.lit(1)).alias("n"))
    )


def _invalid(source: DataFrame, placed: DataFrame) -> DataFrame:
    empty = source.filter((F.col("externalId") == "") | F.col("externalId").isNull()).select(
        F.coalesce("externalId", F.lit("")).alias("externalId"),
        F.concat(F.lit("empty externalId for node with name: "), F.coalesce("name", F.lit("null"))).alias("error"),
    )
    repeated = (
        source.filter(F.col("externalId") != "")
        .groupBy("externalId")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("externalId", F.concat(F.lit("node occurs several times: "), "externalId").alias("error"))
    )
    cycles = placed.filter("cyclic").select("externalId", F.lit("node is on or below a cycle").alias("error"))
    return empty.unionByName(repeated).unionByName(cycles)


def hierarchy_roots(source: DataFrame) -> DataFrame:
    """``externalId, root, depth, rootParent``: top-most node of the input above each node, and its parent.

    A repeated key counts once, with the greatest of its parents.
    """
    nodes = _unique(source)
    return _roots(nodes, resolve_ancestors(nodes, "externalId", "parentExternalId", stored=True))


def _roots(source: DataFrame, placed: DataFrame) -> DataFrame:
    parents = source.select(F.col("externalId").alias("root"), F.col("parentExternalId").alias("rootParent"))
    found = placed.filter("not cyclic").join(parents, "root")
    return found.select("externalId", "root", "depth", "rootParent")


def _has_parent(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) != ""


def missing_parents(source: DataFrame, target: DataFrame) -> DataFrame:
    """Parents of subtree roots that exist nowhere, each with the lowest node that names it."""
    named = (
        source.filter(_has_parent("parentExternalId"))
        .groupBy("parentExternalId")
        .agg(F.min("externalId").alias("referencedFrom"))
    )
    for known in (source, target):
        named = named.join(known.select(F.col("externalId").alias("parentExternalId")), "parentExternalId", "left_anti")
    return named


def _comparable(df: DataFrame, column: str, prefix: str) -> Column:
    value = F.col(f"{prefix}.`{column}`")
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.MapType):
        return F.array_sort(F.map_entries(F.coalesce(value, F.create_map().cast(data_type))))
    if isinstance(data_type, T.ArrayType):
        return F.coalesce(value, F.array().cast(data_type))
    return value


def diff_hierarchy(source: DataFrame, target: DataFrame) -> DataFrame:
    """``externalId, change`` with change insert, update or unchanged for every source node."""
    same = F.coalesce(F.col("s.parentExternalId"), F.lit("")).eqNullSafe(F.coalesce(F.col("t.parentExternalId"), F.lit("")))
    for column in COMPARED:
        if column in source.columns and column in target.columns:
            same = same & _comparable(source, column, "s").eqNullSafe(_comparable(target, column, "t"))
    joined = source.alias("s").join(target.alias("t"), F.col("s.externalId") == F.col("t.externalId"), "left")
    change = F.when(F.col("t.externalId").isNull(), "insert").when(same, "unchanged").otherwise("update")
    return joined.select(F.col("s.externalId").alias("externalId"), change.alias("change"))


def missing_nodes(source_roots: DataFrame, target: DataFrame) -> DataFrame:
    """Target nodes to delete: all below an ingested root that the input lacks."""
    below = _descendants(target, source_roots.select(F.col("root").alias("externalId")))
    return below.join(source_roots.select("externalId"), "externalId", "left_anti")


def root_changes(source_roots: DataFrame, target: DataFrame) -> DataFrame:
    """Nodes that would move to another root, and inner nodes that would become roots."""
    placed = resolve_ancestors(target, "externalId", "parentExternalId").filter("not cyclic")
    old = placed.select("externalId", F.col("root").alias("oldRoot"))
    tops = source_roots.select("root", "rootParent").distinct()
    # The final root of an ingested subtree: the root of the parent it hangs under, or itself.
    new_tops = (
        tops.join(placed.select(F.col("externalId").alias("rootParent"), F.col("root").alias("under")), "rootParent", "left")
        .select("root", F.coalesce("under", "root").alias("newRoot"))
    )
    moved = source_roots.select("externalId", "root", "rootParent").join(new_tops, "root").join(old, "externalId")
    becomes_root = (F.col("externalId") == F.col("root")) & ~_has_parent("rootParent")
    return moved.filter(F.col("oldRoot") != F.col("newRoot")).select(
        "externalId",
        "oldRoot",
        "newRoot",
        F.when(becomes_root, "can not make a root from an inner node")
        .otherwise("can not move a node to a different root")
        .alias("error"),
    )


@dataclass
class HierarchyResult:
    """The tree after reconciliation, and what changed. ``table`` is valid when ``errors`` is empty."""

    table: DataFrame
    changes: DataFrame
    errors: DataFrame

    def raise_for_errors(self) -> HierarchyResult:
        found = [r["error"] for r in self.errors.limit(10).collect()]
        if found:
            raise PlantError("; ".join(found))
        return self


def reconcile_hierarchy(
    target: DataFrame,
    source: DataFrame,
    subtrees: str = "ingest",
    delete_missing: bool = False,
    ignore_null_fields: bool = True,
    now: datetime | None = None,
) -> HierarchyResult:
    """Bring the ingested trees of ``target`` in line with ``source``.

    ``subtrees`` says what happens to input trees whose root has a parent outside the input: ingest them
    under that parent, ignore them, or report an error. The new table has all columns of ``target``: new
    assets get an id, the times, and the ids of their parent and root; changed ones a new time and parent id.
    """
    if subtrees not in ("ingest", "ignore", "error"):
        raise PlantError(f"subtrees must be ingest, ignore or error, not {subtrees}")
    source = cut_lineage(source)
    keys = _unique(source)
    placed = resolve_ancestors(keys, "externalId", "parentExternalId", stored=True)
    invalid = _invalid(source, placed)
    unique = keep_greatest(source.filter(F.col("externalId") != ""), ["externalId"])
    roots = cut_lineage(_roots(keys, placed))
    errors = invalid
    loose = roots.filter(_has_parent("rootParent"))
    if subtrees == "ignore":
        kept = roots.filter(~_has_parent("rootParent"))
        if kept.isEmpty() and not roots.isEmpty():
            raise PlantError('no tree of the input has a root, that is a node with the parentExternalId ""')
        roots = kept
    elif subtrees == "error":
        errors = errors.unionByName(
            loose.filter("externalId = root").select(
                "externalId",
                F.concat(F.lit("subtree hangs under no root of the input: "), "externalId").alias("error"),
            )
        )
    nodes = unique.join(roots.select("externalId"), "externalId", "left_semi")
    absent = missing_parents(nodes, target).select(
        F.col("referencedFrom").alias("externalId"),
        F.concat(F.lit("parent "), "parentExternalId", F.lit(" of "), "referencedFrom", F.lit(" does not exist")).alias("error"),
    )
    errors = errors.unionByName(absent).unionByName(root_changes(roots, target).select("externalId", "error"))
    changes = diff_hierarchy(nodes, target)
    if delete_missing:
        deleted = missing_nodes(roots, target)
        changes = changes.unionByName(deleted.select("externalId", F.lit("delete").alias("change")))
    changes = cut_lineage(changes)
    stamp = F.current_timestamp() if now is None else F.lit(now)
    return HierarchyResult(_apply(target, nodes, roots, changes, ignore_null_fields, stamp), changes, errors)


def _apply(
    target: DataFrame, nodes: DataFrame, roots: DataFrame, changes: DataFrame, ignore_null_fields: bool, stamp: Column
) -> DataFrame:
    has = set(target.columns)
    given = [c for c in ("parentExternalId", *COMPARED) if c in has and c in nodes.columns]
    writes = changes.filter("change in ('insert', 'update')")
    fresh = cut_lineage(
        nodes.join(writes, "externalId").select(
            "externalId",
            "change",
            *[(F.when(F.col(c) != "", F.col(c)) if c == "parentExternalId" else F.col(c)).alias(f"_{c}") for c in given],
        )
    )
    gone = changes.filter("change = 'delete'").select("externalId")
    kept = target.join(gone, "externalId", "left_anti")
    added = fresh.filter("change = 'insert'").select("externalId", *[F.col(f"_{c}").alias(c) for c in given])
    updates = fresh.filter("change = 'update'").withColumn("_parent", F.lit(None).cast("long"))
    if "id" in has:
        highest = target.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
        numbered = dense_rank_ids(added, F.col("externalId"), "_rank")
        added = cut_lineage(numbered.withColumn("id", (highest + 1 + F.col("_rank")).cast("long")).drop("_rank"))
        ids = kept.select("externalId", "id").unionByName(added.select("externalId", "id"))
        if "parentId" in has and "parentExternalId" in given:
            parents = ids.select(F.col("externalId").alias("_of"), F.col("id").alias("_parent"))
            added = added.join(parents, F.col("parentExternalId") == F.col("_of"), "left").drop("_of")
            added = added.withColumnRenamed("_parent", "parentId")
            updates = updates.drop("_parent").join(parents, F.col("_parentExternalId") == F.col("_of"), "left").drop("_of")
        if "rootId" in has:
            # Nodes stay below their root, so only new ones need its id: that of the tree they hang under, or of their top.
            above = target.select(F.col("externalId").alias("rootParent"), F.col("rootId").alias("_under"))
            tops = roots.select("root", "rootParent").distinct().join(above, "rootParent", "left")
            tops = tops.join(ids.select(F.col("externalId").alias("root"), F.col("id").alias("_top")), "root", "left")
            tops = tops.select("root", F.coalesce("_under", "_top").alias("rootId"))
            added = added.join(roots.select("externalId", "root"), "externalId").join(tops, "root").drop("root")
    for time in ("createdTime", "lastUpdatedTime"):
        if time in has:
            added = added.withColumn(time, stamp.cast(target.schema[time].dataType))
    joined = kept.join(updates, "externalId", "left")
    hit = F.col("change").isNotNull()

    def merged(column: str) -> Column:
        old = F.col(column)
        if column == "lastUpdatedTime":
            return F.when(hit, stamp.cast(target.schema[column].dataType)).otherwise(old).alias(column)
        if column == "parentId":
            return F.coalesce("_parent", old).alias(column)
        if column not in given:
            return old
        new = F.col(f"_{column}")
        if ignore_null_fields or column not in CLEARABLE:
            new = F.coalesce(new, old)
        return F.when(hit, new).otherwise(old).alias(column)

    return joined.select(*[merged(c) for c in target.columns]).unionByName(added, allowMissingColumns=True)
