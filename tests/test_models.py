"""Views by space, name and version; reads and writes through them."""

import math

import pytest
from pyspark.sql import functions as F

from plantframe import PlantError
from plantframe.operators.graph import Connection, DataModel, Graph, Property, View, ViewRef, scan_model
from plantframe.operators.hierarchy import with_aggregates
from plantframe.operators.models import find_in_model, find_view, written_properties
from plantframe.sources.star import Star
from plantframe.workspace import Workspace

REF = "struct<space:string,externalId:string>"
ONE = View("s", "Pump", "1", "node", (Property("name", "text"), Property("flow", "float64")))
TWO = View(
    "s", "Pump", "2", "node",
    (Property("label", "text", stored="name"), Property("flow", "int32"), Property("when", "text", stored="at"),
     Property("ones", "int64", is_list=True, stored="many"), Property("unset", "int32")),
    (Connection("feeds", "t", "pipe"),),
)
OTHER = View("elsewhere", "Pump", "1", "node", (Property("name", "text"),))


@pytest.fixture(scope="module")
def graph(spark):
    rows = [("s", "a"), ("s", "b"), ("s", "c"), ("s", "d"), ("elsewhere", "x")]
    nodes = spark.createDataFrame(rows, "space string, externalId string").select(
        "*", *[F.lit(1).cast("long").alias(c) for c in ("version", "createdTime", "lastUpdatedTime", "deletedTime")],
        F.lit(None).cast(REF).alias("_type"),
    )
    edges = nodes.limit(0).withColumnRenamed("_type", "type").select("*", F.col("type").alias("startNode"), F.col("type").alias("endNode"))
    table = spark.createDataFrame(
        [("s", "a", "A", 2.9, [1.5, -1.5]), ("s", "b", None, 1e300, None), ("s", "c", "C", math.nan, []), ("s", "d", "D", -1e300, [math.inf])],
        "space string, externalId string, name string, flow double, many array<double>",
    ).withColumn("at", F.timestamp_millis(F.lit(1500)))
    other = spark.createDataFrame([("elsewhere", "x", "X")], "space string, externalId string, name string")
    models = [DataModel("m", "M", "1", (ViewRef("s", "Pump", "1"),)), DataModel("m", "M", "2", (TWO,)), DataModel("m", "M", "3", (OTHER,))]
    return Graph(nodes, edges, {"Pump": table, OTHER.id: other}, {"Pump": ONE}, models)


def test_names_are_resolved_by_space_and_version(graph):
    assert find_view(graph, "Pump") is ONE and find_view(graph, "Pump", version="2") is TWO and find_view(graph, "Pump", "elsewhere") is OTHER
    assert find_in_model(graph, ("m", "M", "1"), "Pump") is ONE and find_in_model(graph, ("m", "M", "2"), "Pump") is TWO
    for call in (lambda: find_view(graph, "Pump", "s"), lambda: find_view(graph, "Pump", "s", "9"), lambda: find_view(graph, "Fan"),
                 lambda: find_in_model(graph, ("m", "M", "9"), "Pump"), lambda: find_in_model(graph, ("m", "M", "2"), "Fan")):
        with pytest.raises(PlantError):
            call()
    twice = Graph(graph.nodes, graph.edges, {}, {"Pump": ONE}, [DataModel("m", "M", "1", (View("s", "Pump", "1", "edge"),))])
    with pytest.raises(PlantError, match="twice"):
        find_view(twice, "Pump", "s")


def test_a_version_reads_the_stored_table_in_its_own_types(graph):
    found = {r.externalId: r for r in scan_model(graph, ("m", "M", "2"), "Pump").collect()}
    assert [found[k].flow for k in "abcd"] == [2, 2**31 - 1, 0, -(2**31)]
    assert [found[k].ones for k in "abcd"] == [[1, -1], None, [], [2**63 - 1]]
    assert found["a"].label == "A" and found["a"].when == "1970-01-01T00:00:01.500Z" and found["a"].unset is None
    assert [r.name for r in scan_model(graph, ("m", "M", "3"), "Pump").collect()] == ["X"]
    odd = View("s", "Pump", "7", "node", (Property("name", "int32"),))
    with pytest.raises(PlantError, match="stored as string"):
        scan_model(Graph(graph.nodes, graph.edges, graph.properties, {}, [DataModel("m", "M", "7", (odd,))]), ("m", "M", "7"), "Pump")


def test_writes_through_a_version(spark, graph):
    space = Workspace(None, graph)
    options = {"type": "instances", "modelSpace": "m", "modelExternalId": "M", "modelVersion": "2", "viewExternalId": "Pump", "instanceSpace": "s"}
    rows = spark.createDataFrame([("a", "new", 7.0), ("b", "x", 1.5), ("n", None, 3.0)], "externalId string, label string, flow double")
    done = space.write(rows, onconflict="upsert", **options)
    found = {r.externalId: r for r in done.properties.collect()}
    assert (found["a"].name, found["a"].flow, found["a"].many) == ("new", 7.0, [1.5, -1.5]) and found["n"].flow == 3.0
    assert [(r.externalId, r.error) for r in done.errors.collect()] == [("b", "bad value of 'flow'")] and found["b"].flow == 1e300
    assert done.properties.schema["flow"].dataType.simpleString() == "double"
    for column, message in (("when", "can not be written"), ("unset", "no column")):
        with pytest.raises(PlantError, match=message):
            space.write(rows.withColumn(column, F.lit(None).cast("string")), onconflict="upsert", **options)
    both = View("s", "P", "1", "node", (Property("a", "text", stored="name"), Property("b", "text", stored="name")))
    with pytest.raises(PlantError, match="twice"):
        written_properties(both, spark.range(1).select(F.lit("x").alias("a"), F.lit("y").alias("b")), None)
    edge = spark.createDataFrame([("e", ("s", "a"), ("s", "z"))], f"externalId string, startNode {REF}, endNode {REF}")
    made = space.write(edge, onconflict="upsert", connectionPropertyName="feeds", **options)
    assert [(r.externalId, r.type.externalId) for r in made.instances.collect()] == [("e", "pipe")] and made.nodes.filter("externalId = 'z'").count() == 1
    gone = space.write(edge.select(F.lit("a").alias("externalId")), onconflict="delete", **options)
    assert gone.filter("externalId = 'a'").count() == 0
    with pytest.raises(PlantError, match="instanceType"):
        space.write(rows, type="instances", onconflict="upsert")


def test_options_name_a_view_by_space_and_version(graph):
    read = lambda **o: Workspace(None, graph).read(type="instances", **o)
    model = {"modelSpace": "m", "modelExternalId": "M", "modelVersion": "2"}
    assert "label" in read(instanceType="node", viewExternalId="Pump", viewSpace="s", viewVersion="2").columns
    assert "label" not in read(instanceType="node", viewExternalId="Pump", viewSpace="s", viewVersion="1", **model).columns
    edge_type = {"edgeTypeSpace": "t", "edgeTypeExternalId": "pipe"}
    assert "label" not in read(viewExternalId="Pump", **model, **edge_type).columns
    synced = read(viewExternalId="Pump", connectionPropertyName="feeds", cursor="", **model)
    assert "label" in synced.columns and "metadata.cursor" in synced.columns


def test_aggregates_of_assets(spark):
    assets = Star(spark, "/root/testdata/sf0.001").assets()
    loop = assets.limit(2).withColumn("id", F.monotonically_increasing_id())
    data = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 3), (5, 9), (6, 7), (7, 6)], "id long, parentId long")
    shaped = data.join(loop.drop("id", "parentId").limit(1).drop("aggregates"), how="left", on=F.lit(True))
    found = {r.id: r.aggregates for r in with_aggregates(shaped.withColumn("aggregates", F.lit(None))).collect()}
    assert [found[k].childCount for k in range(1, 8)] == [2, 0, 1, 0, 0, 1, 1]
    assert found[4].path == ["1", "3", "4"] and found[4].depth == 2 and found[5].path == ["5"] and found[6].depth is None
    whole = Workspace(Star(spark, "/root/testdata/sf0.001").catalog).read(type="assets", aggregates="true")
    assert whole.columns == assets.columns and whole.count() == assets.count()
