"""Interval labels of trees against brute force: circles, missing parents, hot parents, long chains, moves."""

from random import Random

import pytest
from pyspark.sql import functions as F
from test_queries import plan

from plantframe import PlantError
from plantframe.operators import labels, skew
from plantframe.operators.labels import below, contained, label_tree, move, rank_list, without, write_labelled

LONG = {"driver_links": 20, "ruler_every": 3}


def tree(spark, rows):
    return spark.createDataFrame(rows, "id long, parentId long, enterprise string")


def lineages(rows):
    """The nodes above each node, itself included; None on or below a circle."""
    up = {k: p for k, p, *_ in rows}
    for k in up:
        path, at = [], k
        while at in up and at not in path:
            path.append(at)
            at = up[at]
        yield k, None if at in path else set(path)


def check(labelled, rows):
    found = {r.id: (r.enter, r.leave) for r in labelled.collect()}
    lines = dict(lineages(rows))
    assert found.keys() == lines.keys() and all((found[k][0] is None) == (line is None) for k, line in lines.items())
    placed = {k: ends for k, ends in found.items() if ends[0] is not None}
    assert len({enter for enter, _ in placed.values()}) == len(placed)
    for k, (enter, leave) in placed.items():
        assert {x for x, (at, _) in placed.items() if enter <= at <= leave} == {x for x in placed if k in lines[x]}


def forest(seed, n):
    rng = Random(seed)
    rows = [(k, rng.choice([None, 999_999, *range(max(0, k - 5), k)]) if k else None, "e") for k in range(n)]
    rows += [(n + i, 3, "hot") for i in range(60)]  # many children of one node
    return [*rows, (9001, 9002, "c"), (9002, 9003, "c"), (9003, 9001, "c"), (9004, 9002, "below"), (9005, 9005, "self")]


@pytest.mark.parametrize("limits", [{}, LONG])
def test_labels(spark, limits, monkeypatch):
    monkeypatch.setattr(skew, "SLICE_ROWS", 40)
    rows = forest(4, 150)
    check(label_tree(tree(spark, rows), **limits), rows)


def test_long_chain_and_nothing(spark):
    rows = [(k, k - 1 if k else None, "x") for k in range(700)]
    ends = {r.id: (r.enter, r.leave) for r in label_tree(tree(spark, rows), driver_links=50, ruler_every=8).collect()}
    assert ends == {k: (k + 1, 700) for k in range(700)}
    assert label_tree(tree(spark, [])).count() == 0


def test_ranks_of_lists(spark):
    links = [(k, k + 1 if k % 100 != 99 else None, k % 3) for k in range(400)] + [(k, 1000 + (k + 1) % 50, 1) for k in range(1000, 1050)]
    found = {r.k: r.rank for r in rank_list(spark.createDataFrame(links, "k long, next long, w long"), **LONG).collect()}
    assert found == {k: sum(x % 3 for x in range(k, k - k % 100 + 100)) for k in range(400)}


def test_subtrees_are_ranges_that_reach_the_files(spark, tmp_path):
    rows = forest(5, 80)
    path = str(tmp_path / "tree")
    write_labelled(tree(spark, rows), path)
    stored, lines = spark.read.parquet(path), dict(lineages(rows))
    for tops in ([3], [3, 17, 60, 77], [9001], [123456]):
        found = below(stored, F.col("id").isin(tops))
        want = {k for k, line in lines.items() if line and line & set(tops)}
        assert {r.id for r in found.collect()} == want
        assert {r.id for r in without(stored, F.col("id").isin(tops)).collect()} == lines.keys() - want
    text = plan(below(stored, F.col("id") == 3))
    assert "PushedFilters: [IsNotNull(enter), GreaterThanOrEqual(enter," in text and "LessThanOrEqual(enter," in text and "Join" not in text


def test_many_subtrees(spark, monkeypatch):
    monkeypatch.setattr(skew, "SLICE_ROWS", 25)
    rows = forest(6, 120)
    labelled, lines = label_tree(tree(spark, rows)), dict(lineages(rows))
    tops = [k for k in range(0, 120, 7)] + [9002, 77777]
    found = {r.id: r.top for r in contained(labelled, spark.createDataFrame([(k,) for k in tops], "id long")).collect()}
    assert found.keys() == {k for k, line in lines.items() if line and line & set(tops)}
    assert all(top in lines[k] and not (lines[top] - {top}) & set(tops) for k, top in found.items())


def test_moves_repair_labels(spark):
    rows = forest(7, 40)
    labelled, rng, moved = label_tree(tree(spark, rows)), Random(2), 0
    labelled.persist()
    while moved < 6:
        lines = dict(lineages(rows))
        a, b = rng.sample(range(40), 2)
        if a in lines[b]:
            with pytest.raises(PlantError, match="below itself"):
                move(labelled, a, b)
            continue
        labelled, moved = move(labelled, a, b), moved + 1
        rows = [(k, b if k == a else p, e) for k, p, e in rows]
        assert {(r.id, r.parentId) for r in labelled.collect()} == {(k, p) for k, p, _ in rows}
        check(labelled, rows)
    for unknown in (123456, 9001):
        with pytest.raises(PlantError, match="unknown node"):
            move(labelled, unknown, 1)
    assert labels.ranges(labelled, F.col("id") == 9001) == []
