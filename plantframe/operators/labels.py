"""Interval labels of trees: the nodes below one are those whose ``enter`` lies between its ``enter`` and ``leave``.

Labels number the nodes in the order of a walk around the tree (an Euler tour). The walk is a linked list of steps down
into a node and up out of it, and a step's place in it is found by list ranking: some steps are rulers, all others walk
to their next ruler by doubling, and the short list of rulers is ranked the same way. Labels are made once and stored;
reading a subtree is a range of one column, which reaches the files, and a moved subtree is relabelled in one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import PlantError
from ..session import cut_lineage
from .skew import previous_across_slices, quantile_bounds, slice_of

#: A list of at most so many links is ranked by the driver; one link in so many is a ruler of a longer one.
DRIVER_LINKS, RULER_EVERY = 50_000, 16
_LABELS = ("enter", "leave")


def rank_list(links: DataFrame, driver_links: int = DRIVER_LINKS, ruler_every: int = RULER_EVERY) -> DataFrame:
    """(k, rank): the weights from ``k`` to the end of its list, its own included, from all (k, next, w).

    ``next`` is null at the end of a list. Links that run in a circle have no rank.
    """
    links = cut_lineage(links.select("k", "next", "w"))
    spark = links.sparkSession
    n = links.count()
    if n <= driver_links:
        return spark.createDataFrame(_ranked({r.k: (r.next, r.w) for r in links.collect()}), "k long, rank long")
    ruler = F.pmod(F.xxhash64(F.lit(n), "k"), F.lit(ruler_every)) == 0
    beyond = F.pmod(F.xxhash64(F.lit(n), "next"), F.lit(ruler_every)) == 0
    walks = cut_lineage(links.select("k", "next", F.col("w").alias("rank"), (F.col("next").isNull() | beyond).alias("done")))
    finished, pending = [walks.filter("done")], walks.filter("not done")
    state, left = walks, pending.count()
    while left:
        ahead = state.select(F.col("k").alias("next"), F.col("next").alias("_next"), F.col("rank").alias("_rank"), F.col("done").alias("_done"))
        moved = cut_lineage(
            pending.join(ahead, "next").select("k", F.col("_next").alias("next"), (F.col("rank") + F.col("_rank")).alias("rank"), F.col("_done").alias("done"))
        )
        finished.append(moved.filter("done"))
        pending, before = moved.filter("not done"), left
        left = pending.count()
        if left == before:
            break  # a circle without a ruler: every other walk ends
        state = reduce(DataFrame.unionByName, [*finished, pending])
    walks = reduce(DataFrame.unionByName, finished)
    ranked = rank_list(walks.filter(ruler).select("k", "next", F.col("rank").alias("w")), driver_links, ruler_every)
    ahead = ranked.select(F.col("k").alias("next"), F.col("rank").alias("_rank"))
    reached = walks.join(ahead, "next", "left").filter("next is null or _rank is not null")
    return reached.select("k", (F.col("rank") + F.coalesce("_rank", F.lit(0))).alias("rank"))


def _ranked(links: dict[int, tuple[int | None, int]]) -> list[tuple[int, int]]:
    ranks: dict[int | None, int] = {None: 0}
    circles: set[int] = set()
    for k in links:
        walk: dict[int, None] = {}
        while k not in ranks and k not in circles and k not in walk:
            walk[k] = None
            k = links[k][0]
        if k in ranks:
            for step in reversed(walk):
                ranks[step] = ranks[links[step][0]] + links[step][1]
        else:
            circles.update(walk)
    return [(k, rank) for k, rank in ranks.items() if k is not None]


def label_tree(nodes: DataFrame, key: str = "id", parent: str = "parentId", **limits: int) -> DataFrame:
    """``nodes`` with ``enter`` and ``leave``, the numbers of the first and last node of its subtree in the walk.

    Keys are unique whole numbers from 0. A node whose parent is null or missing is the top of a tree; trees and
    siblings follow each other by key. Nodes on or below a circle have null labels. A node with very many children is
    cut into slices by key.
    """
    tree = cut_lineage(nodes.select(F.col(key).cast("long").alias("k"), F.col(parent).cast("long").alias("p")))
    known = tree.select(F.col("k").alias("p"), F.lit(True).alias("_known"))
    tree = tree.join(known, "p", "left").select("k", F.when(F.col("_known"), F.col("p")).otherwise(F.lit(-1)).alias("p"))
    tree = cut_lineage(tree.withColumn("_slice", slice_of(F.col("k"), quantile_bounds(tree, "k"))))
    ends = tree.groupBy("p", "_slice").agg(F.max("k").alias("last"))
    siblings = previous_across_slices(tree.withColumn("_k", F.col("k")), ends, ["p"], "_slice", "k", "_k", "_sibling")
    last_child = ends.groupBy(F.col("p").alias("k")).agg(F.max("last").alias("_child"))
    # Steps down have even numbers, steps up odd ones; each names the step before it.
    down, up = (lambda c: 2 * F.col(c)), (lambda c: 2 * F.col(c) + 1)
    before = F.coalesce(up("_sibling"), F.when(F.col("p") >= 0, down("p")))
    downs = siblings.select(down("k").alias("k"), before.alias("next"), F.lit(1).cast("long").alias("w"))
    ups = tree.join(last_child, "k", "left").select(up("k").alias("k"), F.coalesce(up("_child"), down("k")).alias("next"), F.lit(0).cast("long").alias("w"))
    ranks = cut_lineage(rank_list(downs.unionByName(ups), **limits))
    labels = ranks.groupBy(F.floor(F.col("k") / 2).alias("_key")).agg(*[F.max(F.when(F.col("k") % 2 == i, F.col("rank"))).alias(c) for i, c in enumerate(_LABELS)])
    return nodes.join(labels, F.col(key) == F.col("_key"), "left").drop("_key")


def write_labelled(nodes: DataFrame, path: str, key: str = "id", parent: str = "parentId") -> None:
    """Label a tree and store it in the order of the walk, so that a subtree lies in few files and row groups."""
    label_tree(nodes, key, parent).repartitionByRange("enter").sortWithinPartitions("enter").write.mode("errorifexists").parquet(path)


def ranges(labelled: DataFrame, tops: Column) -> list[tuple[int, int]]:
    """(enter, leave) of the nodes that ``tops`` selects, without those inside others; as many as the caller names."""
    found: list[tuple[int, int]] = []
    for enter, leave in sorted(tuple(r) for r in labelled.filter(tops).filter("enter is not null").select(*_LABELS).collect()):
        if not found or enter > found[-1][1]:
            found.append((enter, leave))
    return found


def below(labelled: DataFrame, tops: Column) -> DataFrame:
    """The nodes of the subtrees below the nodes that ``tops`` selects, those included."""
    return labelled.filter(_inside(ranges(labelled, tops)))


def without(labelled: DataFrame, tops: Column) -> DataFrame:
    """The nodes outside these subtrees; labels stay good, as gaps do no harm. Nodes on a circle stay."""
    return labelled.filter(~_inside(ranges(labelled, tops)) | F.col("enter").isNull())


def _inside(found: list[tuple[int, int]]) -> Column:
    return reduce(Column.__or__, [F.col("enter").between(*one) for one in found], F.lit(False))


def contained(labelled: DataFrame, tops: DataFrame, key: str = "id") -> DataFrame:
    """(key, top): the nodes of many subtrees, from a table of their tops. Subtrees are nested or apart, so a walk over
    both, cut into slices of labels, needs only the outermost open one: no range join. Nested tops count as one."""
    marks = labelled.join(tops.select(key).distinct(), key, "left_semi").filter("enter is not null").select(F.col(key).alias("top"), *_LABELS)
    rows = labelled.filter("enter is not null").select(F.col(key).alias("k"), F.col("enter").alias("at"))
    rows = rows.join(marks.select(F.col("enter").alias("at"), "leave", "top"), "at", "left")
    cut = slice_of(F.col("at"), quantile_bounds(rows, "at"))
    rows = cut_lineage(rows.withColumn("_slice", cut).withColumn("_open", F.when(F.col("top").isNotNull(), F.struct("leave", F.col("at").alias("from"), "top"))))
    # Of the tops so far, the one that reaches furthest, the outermost of those that end together.
    reach = lambda c: F.struct(F.col(f"{c}.leave"), (-F.col(f"{c}.from")).alias("wide"), F.col(f"{c}.top"))
    local = Window.partitionBy("_slice").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.filter("_open is not null").groupBy("_slice").agg(F.max(reach("_open")).alias("_end"))
    across = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    slices = rows.select("_slice").distinct().join(ends, "_slice", "left").withColumn("_carry", F.max("_end").over(across)).drop("_end")
    found = rows.withColumn("_seen", F.max(F.when(F.col("_open").isNotNull(), reach("_open"))).over(local)).join(slices, "_slice")
    best = F.greatest("_seen", "_carry")
    return found.select(F.col("k").alias(key), F.when(best["leave"] >= F.col("at"), best["top"]).alias("top")).filter("top is not null")


def move(labelled: DataFrame, moved: int, new_parent: int, key: str = "id", parent: str = "parentId") -> DataFrame:
    """The tree after ``moved`` with all below it became the last child of ``new_parent``; labels are repaired in one pass.

    Nodes between the old and the new place shift by the size of the subtree, which its ancestors lose or gain.
    """
    ends = {r[0]: (r[1], r[2]) for r in labelled.filter(F.col(key).isin(moved, new_parent)).select(key, *_LABELS).collect()}
    for one in (moved, new_parent):
        if one not in ends or ends[one][0] is None:
            raise PlantError(f"unknown node {one}")
    (a, b), (above, last) = ends[moved], ends[new_parent]
    if a <= above <= b:
        raise PlantError(f"node {moved} can not move below itself")
    size = b - a + 1
    enter, leave = F.col("enter"), F.col("leave")
    inside = enter.between(a, b)
    shift = F.when(inside, last - b if last >= b else last + 1 - a)
    if last >= b:
        shift = shift.when(enter.between(b + 1, last), -size)
    else:
        shift = shift.when(enter.between(last + 1, a - 1), size)
    shift = shift.otherwise(0)
    loses = F.when(~inside & (enter < a) & (leave >= b), size).otherwise(0)
    gains = F.when(~inside & (enter <= above) & (leave >= last) & (leave >= above), size).otherwise(0)
    changed = {"enter": enter + shift, "leave": leave + shift - loses + gains, parent: F.when(F.col(key) == moved, new_parent).otherwise(F.col(parent))}
    return labelled.select(*[changed[c].cast(labelled.schema[c].dataType).alias(c) if c in changed else F.col(f"`{c}`") for c in labelled.columns])
