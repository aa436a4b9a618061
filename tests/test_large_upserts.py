"""Upserts of many rows, where the written rows and the stored tables are dealt by key once."""

import io
from contextlib import redirect_stdout
from datetime import datetime

import pytest

from plantframe.operators import graph
from plantframe.operators.models import Property, View
from plantframe.operators.skew import has_hot_key

NOW = datetime(2030, 1, 1)
VIEW = View("m", "V", "1", "node", (Property("a", "int64"), Property("b", "text")))
REF = "struct<space:string,externalId:string>"


def upsert(spark, ignore_null_fields):
    stored = "space string, externalId string, version long, createdTime long, lastUpdatedTime long, deletedTime long, _type " + REF
    instances = spark.createDataFrame([("s", f"k{i}", None if i == 1 else i, 1, 2, None, ("t", "old") if i % 2 else None) for i in range(12)], stored)
    # k8 to k11 have no properties, p1 has them without being an instance, more is not part of the view.
    held = [("s", f"k{i}", i, f"b{i}", i) for i in range(8)] + [("s", "p1", 1, "p", 7), ("s", "k20", 5, "left", 8)]
    properties = spark.createDataFrame(held, "space string, externalId string, a long, b string, more long")
    source = [(f"k{i}", i if i % 3 else i + 100, None if i % 2 else f"b{i}", None) for i in range(3, 22)]
    source += [("k5", 70, "later", ("t", "new")), ("k5", 70, "earlier", None), ("k4", None, None, None), (None, 1, "no key", None)]
    rows = spark.createDataFrame(source, "externalId string, a long, b string, _type " + REF)
    return graph.upsert_instances(
        instances, rows, "node", VIEW, properties, instance_space="s", ignore_null_fields=ignore_null_fields, now=NOW
    )


@pytest.mark.parametrize("ignore_null_fields", [True, False])
def test_large_and_small_sources_give_the_same(spark, rows, monkeypatch, ignore_null_fields):
    found = []
    for limit in (100, 0):
        monkeypatch.setattr(graph, "SMALL_SOURCE", limit, raising=False)
        done = upsert(spark, ignore_null_fields)
        found.append([(df.columns, rows(df)) for df in (done.instances, done.properties, done.changes, done.errors, done.joined)])
    assert found[0] == found[1]
    assert {r[2] for r in found[0][2][1]} == {"created", "modified", "noop"}


def test_results_of_a_large_upsert_need_no_further_shuffle(spark, monkeypatch):
    monkeypatch.setattr(graph, "SMALL_SOURCE", 0, raising=False)
    done = upsert(spark, True)
    for df in (done.instances, done.properties, done.changes, done.joined):
        out = io.StringIO()
        with redirect_stdout(out):
            df.explain("simple")
        assert "Exchange" not in out.getvalue()


def test_a_stored_key_that_repeats_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(graph, "SMALL_SOURCE", 0, raising=False)
    table = spark.createDataFrame([("s", "k", 1), ("s", "k", 2)], "space string, externalId string, version long")
    table = table.selectExpr("*", f"cast(null as {REF}) as _type", "0L as createdTime", "0L as lastUpdatedTime")
    with pytest.raises(Exception, match="holds a key twice"):
        graph.upsert_instances(table, table.select("externalId"), "node", instance_space="s", now=NOW)


def test_hot_keys_are_seen(spark):
    rows = spark.range(3000).selectExpr("if(id < 1500, 'hot', cast(id as string)) as k", "id")
    assert has_hot_key(rows, ["k"], copies=1000) == (3000, True)
    assert has_hot_key(rows, ["id"], copies=1000) == (3000, False)
    assert has_hot_key(rows.limit(0), ["k"]) == (0, False)


def test_edges_of_a_large_upsert_are_stored_once(spark, monkeypatch):
    monkeypatch.setattr(graph, "SMALL_SOURCE", 0, raising=False)
    ends = [f"cast(null as {REF}) as type", "named_struct('space', 's', 'externalId', 'a') as startNode", "named_struct('space', 's', 'externalId', 'b') as endNode"]
    stored = ["'s' as space", "concat('e', id) as externalId", "id as version", "0L as createdTime", "0L as lastUpdatedTime"]
    edges = spark.range(5).selectExpr(*stored, *ends)
    written = spark.range(3, 9).selectExpr("concat('e', id) as externalId", *ends[1:])
    done = graph.upsert_instances(edges, written, "edge", instance_space="s", edge_type=("t", "x"), now=NOW)
    assert done.properties is None and done.joined is None
    listed = done.instances.selectExpr("externalId", "version", "type.externalId as x").collect()
    found = {r["externalId"]: (r["version"], r["x"]) for r in listed}
    assert found == {f"e{i}": (i, None) if i < 3 else (i + 1 if i < 5 else 1, "x") for i in range(9)}
    out = io.StringIO()
    with redirect_stdout(out):
        done.instances.explain("simple")
    assert "Exchange" not in out.getvalue()
