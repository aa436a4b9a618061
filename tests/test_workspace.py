import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantframe import PlantError
from plantframe.sources.star import Star
from plantframe.workspace import Workspace

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def space(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("files") / "a.jsonl"
    path.write_text('{"name": "x"}\n{"name": "y"}\n')
    star = Star(spark, ROOT)
    return Workspace(star.catalog, star.graph(), {("db", "raw"): star.raw, ("db", "lines"): star.raw_lines}, {"a": str(path)})


def test_every_resource_can_be_read(space):
    for kind in space.catalog.resources():
        if kind not in ("raw", "sequencerows"):
            assert space.read(type=kind).limit(1).count() == 1, kind
    assert space.read(type="raw", database="db", table="raw").columns == ["key", "lastUpdatedTime", "columns"]
    assert space.read(type="raw", database="db", table="raw", inferSchema="true").columns == ["key", "lastUpdatedTime", "k"]
    typed = space.read(type="raw", database="db", table="lines", schema=T.StructType.fromDDL("num int, key string"))
    assert typed.columns == ["key", "lastUpdatedTime", "num", "_key"]
    assert space.read(type="sequencerows", externalId="seq-1").columns == ["rowNumber", "value", "kind", "k"]
    assert space.read(type="filecontent", externalId="a").count() == 2
    assert space.read(type="filecontent", externalId="a", inferSchema="false").columns == ["value"]
    assert space.read(type="3dmodelrevisions", modelId=3).count() == 1
    assert space.read(type="assets", assetSubtreeIds='["nation-1"]').filter("externalId = 'nation-1'").count() == 1


def test_instance_options_have_an_order(space):
    read = lambda **o: space.read(type="instances", **o)
    edge_type = {"edgeTypeSpace": "types", "edgeTypeExternalId": "flag-R"}
    model = {"modelSpace": "models", "modelExternalId": "Trade", "modelVersion": "1"}
    assert "metadata.cursor" in read(instanceType="node", cursor="", **edge_type).columns
    assert read(instanceType="node", **edge_type).columns == ["space", "externalId", "startNode", "endNode"]
    assert "brand" in read(instanceType="node", viewExternalId="Part", **model).columns
    assert read(viewExternalId="Part", connectionPropertyName="suppliedBy", **model).columns[-1] == "endNode"
    assert "metadata.cursor" in read(viewExternalId="Supply", cursor="", **model).columns
    assert "balance" in read(viewExternalId="Supplier", **model).columns
    assert {r.space for r in read(instanceType="node", instanceSpace="parts").select("space").distinct().collect()} == {"parts"}
    for wrong in ({}, {"instanceType": "all", "cursor": ""}, model):
        with pytest.raises(PlantError):
            read(**wrong)


def test_sync_continues_from_its_cursor(space):
    first = space.read(type="instances", instanceType="node", cursor="")
    cursor = first.first()["metadata.cursor"]
    assert first.count() > 0 and space.read(type="instances", instanceType="node", cursor=cursor).count() == 0


def test_writes(spark, space):
    one = spark.createDataFrame([("order-1", "t")], "externalId string, type string")
    assert space.write(one, type="events").errors.count() == 1
    assert space.write(one, type="events", onconflict="UPSERT").updated.count() == 1
    before = space.read(type="datapoints").count()
    point = spark.createDataFrame([("user-1", 5.0)], "externalId string, value double").withColumn("timestamp", F.current_timestamp())
    table, errors = space.write(point, type="datapoints", onconflict="upsert")
    assert table.count() == before + 1 and errors.count() == 0
    row = spark.createDataFrame([(1, -1, 2.5)], "id long, rowNumber long, value double")
    rows = space.write(row, type="sequencerows", onconflict="upsert", externalId="seq-1")
    assert rows.filter("rowNumber = -1").first().value == 2.5
    keyed = spark.createDataFrame([("0", 7)], "key string, v int")
    assert space.write(keyed, type="raw", database="db", table="raw").filter("key = '0'").first().columns == '{"v":7}'
    node = spark.createDataFrame([("part-1", "renamed")], "externalId string, name string")
    done = space.write(node, type="instances", instanceType="node", viewExternalId="Part", instanceSpace="parts", onconflict="upsert")
    assert [r.change for r in done.changes.collect()] == ["modified"]
    tree = spark.createDataFrame([("new", "nation-1", "N")], "externalId string, parentExternalId string, name string")
    assert space.write(tree, type="assethierarchy").raise_for_errors().table.filter("externalId = 'new'").count() == 1
    gone = space.write(spark.createDataFrame([("region-1",)], "externalId string"), type="assethierarchy", onconflict="delete")
    assert gone.filter("externalId = 'region-1'").count() == 0


REF = "struct<space:string,externalId:string>"


def test_mixed_instances_and_missing_nodes(spark, space):
    data = [("n", None, None, None), ("e", ("t", "x"), ("parts", "part-1"), ("parts", "fresh")), ("half", ("t", "x"), ("parts", "part-1"), None)]
    df = spark.createDataFrame(data, f"externalId string, type {REF}, startNode {REF}, endNode {REF}")
    mixed = {"type": "instances", "instanceType": "all", "instanceSpace": "mine"}
    nodes, edges, errors = space.write(df, onconflict="upsert", **mixed)
    assert [r.externalId for r in nodes.instances.filter("space = 'mine'").collect()] == ["n"]
    assert [(r.externalId, r.endNode.externalId) for r in edges.instances.filter("space = 'mine'").collect()] == [("e", "fresh")]
    assert edges.nodes.filter("externalId = 'fresh'").count() == 1 and edges.errors.count() == 0
    assert [r.externalId for r in errors.collect()] == ["half"]
    strict = space.write(df.filter("externalId = 'e'"), onconflict="upsert", autoCreateEndNodes="false", **{**mixed, "instanceType": "edge"})
    assert [r.externalId for r in strict.errors.collect()] == ["fresh"] and strict.nodes.filter("externalId = 'fresh'").count() == 0
    kept = space.write(spark.createDataFrame([("part-1",)], "externalId string"), onconflict="delete", **{**mixed, "instanceSpace": "parts"})
    assert kept[0].filter("externalId = 'part-1'").count() == 0 and kept[1].count() == space.graph.edges.count()


def test_sequence_columns_and_empty_lists(spark, space):
    old = space.read(type="sequences").filter("externalId = 'seq-1'").first()["columns"]
    full = "array<struct<externalId:string,name:string,description:string,valueType:string>>"
    other = "LONG" if old[0].valueType != "LONG" else "STRING"
    rows = spark.createDataFrame([("seq-1", [(old[0].externalId, None, None, other)]), ("seq-2", [])], f"externalId string, columns {full}")
    done = space.write(rows, type="sequences", onconflict="update")
    assert [(r.externalId, "type" in r.error) for r in done.errors.collect()] == [("seq-1", True)]
    assert len(done.table.filter("externalId = 'seq-2'").first()["columns"]) == len(old)
    empty = spark.createDataFrame([("fresh", [])], f"externalId string, columns {full}")
    assert "columns is missing" in space.write(empty, type="sequences", onconflict="upsert").errors.first().error
    tags = spark.createDataFrame([("region-1", {"a": None, "b": "c"}, [])], "externalId string, metadata map<string,string>, labels array<string>")
    stored = space.write(tags, type="assets", onconflict="update").table.filter("externalId = 'region-1'").first()
    assert stored.metadata == {"b": "c"}


@pytest.mark.parametrize("options, message", [
    ({}, "type"), ({"type": "events", "onconflict": "merge"}, "onconflict"), ({"type": "datapoints", "onconflict": "update"}, "take upsert"),
    ({"type": "sequencerows", "onconflict": "abort"}, "take upsert"), ({"type": "instances", "onconflict": "update", "instanceType": "node"}, "take upsert"),
    ({"type": "assethierarchy", "subtrees": "ignore", "ignoreDisconnectedAssets": "true"}, "exclude"),
    ({"type": "events", "ignoreNullFields": "maybe"}, "true"), ({"type": "raw", "database": "db"}, "table"),
])
def test_wrong_options(spark, space, options, message):
    with pytest.raises(PlantError, match=message):
        space.write(spark.createDataFrame([("a",)], "externalId string"), **options)
