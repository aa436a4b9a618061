import pytest
from pyspark.sql import functions as F

from plantframe import PlantError
from plantframe.operators.graph import (
    Connection,
    DataModel,
    Graph,
    Property,
    View,
    auto_create_nodes,
    classify_instances,
    scan_instances,
    scan_model,
    upsert_instances,
    view_schema,
)
from plantframe.operators.hierarchy import (
    asset_aggregates,
    delete_subtrees,
    hierarchy_roots,
    reconcile_hierarchy,
    resolve_ancestors,
    subtree,
    validate_hierarchy,
)

TREE = "externalId string, parentExternalId string, name string"


def tree(spark, **parents):
    return spark.createDataFrame([(k, p, k.upper()) for k, p in parents.items()], TREE)


def empty(spark):
    return spark.createDataFrame([], TREE)


def as_dict(df, key="externalId", value="parentExternalId"):
    return {r[key]: r[value] for r in df.collect()}


BASE = dict(dad="", son="dad", daughter="dad", daughterSon="daughter")


def test_ancestors_of_a_deep_chain(spark):
    chain = spark.range(300).select(
        F.concat(F.lit("n"), "id").alias("externalId"), F.when(F.col("id") > 0, F.concat(F.lit("n"), F.col("id") - 1)).alias("parentExternalId")
    )
    placed = resolve_ancestors(chain, "externalId", "parentExternalId", with_path=True)
    last = placed.filter("externalId = 'n299'").first()
    assert (last.root, last.depth, len(last.path), last.path[1]) == ("n0", 299, 300, "n1")
    assert placed.filter("cyclic").count() == 0


def test_cycles_of_any_length_end(spark):
    for size in (1, 2, 3, 4, 7):
        nodes = {f"c{i}": f"c{(i + 1) % size}" for i in range(size)} | {"below": "c0", "ok": "", "kid": "ok"}
        placed = resolve_ancestors(tree(spark, **nodes), "externalId", "parentExternalId")
        assert {r.externalId for r in placed.filter("cyclic").collect()} == set(nodes) - {"ok", "kid"}


def test_invalid_trees(spark):
    broken = spark.createDataFrame([("", "dad", "nobody"), ("a", "", "A"), ("a", "", "A"), ("x", "y", "X"), ("y", "x", "Y")], TREE)
    found = validate_hierarchy(broken)
    assert sorted((r.externalId, r.error.split(" ")[0]) for r in found.collect()) == [("", "empty"), ("a", "node"), ("x", "node"), ("y", "node")]
    with pytest.raises(PlantError, match="empty externalId"):
        reconcile_hierarchy(empty(spark), broken).raise_for_errors()


def test_insert_and_no_change(spark):
    first = reconcile_hierarchy(empty(spark), tree(spark, **BASE)).raise_for_errors()
    assert as_dict(first.table) == {**BASE, "dad": None}
    again = reconcile_hierarchy(first.table, tree(spark, **BASE)).raise_for_errors()
    assert as_dict(again.changes, value="change") == dict.fromkeys(BASE, "unchanged")


def test_subtree_modes(spark):
    target = tree(spark, top=None)
    loose = tree(spark, a="top", b="a")
    assert as_dict(reconcile_hierarchy(target, loose).raise_for_errors().table) == {"top": None, "a": "top", "b": "a"}
    with pytest.raises(PlantError, match="has a root"):
        reconcile_hierarchy(target, loose, subtrees="ignore")
    with pytest.raises(PlantError, match="under no root"):
        reconcile_hierarchy(target, loose, subtrees="error").raise_for_errors()
    mixed = reconcile_hierarchy(target, tree(spark, a="top", b="a", r="", s="r"), subtrees="ignore").raise_for_errors()
    assert as_dict(mixed.table) == {"top": None, "r": None, "s": "r"}
    with pytest.raises(PlantError, match="parent nowhere of a does not exist"):
        reconcile_hierarchy(target, tree(spark, a="nowhere", b="a", c="nowhere")).raise_for_errors()
    with pytest.raises(PlantError, match="subtrees"):
        reconcile_hierarchy(target, loose, subtrees="sometimes")


def test_move_update_and_delete(spark):
    target = reconcile_hierarchy(empty(spark), tree(spark, **BASE)).table
    moved = reconcile_hierarchy(target, tree(spark, dad="", son="dad", daughterSon="son"), delete_missing=True).raise_for_errors()
    assert as_dict(moved.changes, value="change") == {"dad": "unchanged", "son": "unchanged", "daughterSon": "update", "daughter": "delete"}
    assert as_dict(moved.table) == {"dad": None, "son": "dad", "daughterSon": "son"}
    kept = reconcile_hierarchy(target, tree(spark, dad="", son="dad")).raise_for_errors()
    assert len(as_dict(kept.table)) == 4


def test_assets_keep_and_get_their_ids(spark):
    data = [("r", None, "R", 5, None, 5, 1), ("a", "r", "A", 6, 5, 5, 2), ("b", "r", "B", 9, 5, 5, 3)]
    target = spark.createDataFrame(data, TREE + ", id long, parentId long, rootId long, extra int")
    source = tree(spark, b="a", c="b", top="", under="top").unionByName(tree(spark, a="r"))
    found = {r.externalId: r for r in reconcile_hierarchy(target, source).raise_for_errors().table.collect()}
    assert (found["a"].id, found["a"].extra, found["b"].id, found["b"].parentId, found["b"].rootId) == (6, 2, 9, 6, 5)
    assert (found["c"].parentId, found["c"].rootId, found["top"].parentId, found["top"].rootId) == (9, 5, None, found["top"].id)
    assert found["under"].parentId == found["top"].id == found["under"].rootId
    assert {found[k].id for k in ("c", "top", "under")} == {10, 11, 12}


def test_only_the_ingested_subtree_loses_nodes(spark):
    target = tree(spark, r=None, a="r", a1="a", a2="a", b="r", b1="b")
    result = reconcile_hierarchy(target, tree(spark, a="r", a1="a"), delete_missing=True).raise_for_errors()
    assert as_dict(result.table) == {"r": None, "a": "r", "a1": "a", "b": "r", "b1": "b"}


def test_roots_can_not_change(spark):
    target = tree(spark, one=None, two=None, kid="one")
    with pytest.raises(PlantError, match="different root"):
        reconcile_hierarchy(target, tree(spark, two="", kid="two")).raise_for_errors()
    with pytest.raises(PlantError, match="make a root"):
        reconcile_hierarchy(target, tree(spark, kid="")).raise_for_errors()


def test_subtrees_and_aggregates(spark):
    target = tree(spark, r=None, a="r", a1="a", b="r", other=None).withColumn("id", F.monotonically_increasing_id())
    assert set(as_dict(subtree(target, [], ["a", "unknown"]))) == {"a", "a1"}
    assert set(as_dict(delete_subtrees(target, spark.createDataFrame([("a",), ("a1",), ("zz",)], "externalId string")))) == {"r", "b", "other"}
    found = {r.externalId: (r.childCount, r.depth, r.path) for r in asset_aggregates(target).collect()}
    assert found["r"] == (2, 0, ["r"]) and found["a1"] == (0, 2, ["r", "a", "a1"])
    assert as_dict(hierarchy_roots(tree(spark, a="elsewhere", b="a")), value="rootParent") == {"a": "elsewhere", "b": "elsewhere"}


REF = "struct<space:string,externalId:string>"
NODE = f"space string, externalId string, version long, createdTime long, lastUpdatedTime long, deletedTime long, _type {REF}"
EDGE = f"space string, externalId string, version long, createdTime long, lastUpdatedTime long, deletedTime long, type {REF}, startNode {REF}, endNode {REF}"
VIEW = View("m", "V", "1", "node", (
    Property("n", "int32"), Property("t", "text", nullable=False), Property("l", "int64", is_list=True), Property("j", "json"),
    Property("d", "date"), Property("r", "direct"), Property("rs", "direct", is_list=True),
), (Connection("links", "s", "linked"),))


def nodes(spark, *ids):
    return spark.createDataFrame([("s", i, 1, 0, 0, None, None) for i in ids], NODE)


def props(spark, *data):
    schema = f"space string, externalId string, n int, t string, l array<long>, j string, d date, r {REF}, rs array<{REF}>"
    return spark.createDataFrame([("s", *d, *[None] * (7 - len(d) + 1)) for d in data], schema)


def test_view_columns():
    node = view_schema(VIEW, "node", sync=True)
    assert node.fieldNames()[7:] == ["space", "externalId", "node.version", "node.createdTime", "node.lastUpdatedTime", "node.deletedTime", "_type", "metadata.cursor"]
    assert node["l"].dataType.simpleString() == "array<bigint>" and not node["t"].nullable
    edge = view_schema(None, "edge")
    assert not edge["startNode"].nullable and edge["type"].nullable and not edge["_type"].nullable
    assert view_schema(None, "all")["startNode"].nullable


def test_scans_check_usage(spark):
    graph = Graph(nodes(spark, "a", "b"), spark.createDataFrame([], EDGE), {"V": props(spark, ("a", 1, "x"))}, {"V": VIEW}, [DataModel("m", "M", "1", (VIEW,))])
    assert [r.externalId for r in scan_instances(graph, view="V").collect()] == ["a"]
    assert scan_instances(graph, "all").count() == 2
    assert scan_model(graph, ("m", "M", "1"), "V", "links").count() == 0
    for call in (lambda: scan_instances(graph, "edge", "V"), lambda: scan_instances(graph, view="W"), lambda: scan_instances(graph),
                 lambda: scan_model(graph, ("m", "M", "2"), "V"), lambda: scan_model(graph, ("m", "M", "1"), "V", "nope")):
        with pytest.raises(PlantError):
            call()


def test_node_upsert(spark, rows):
    source = spark.createDataFrame(
        [("a", 5.0, "x", [1, None], '{"a":1}', "2020-01-02", (None, "z")), ("b", None, "y", None, None, None, None), ("c", 2.5, "x", None, None, None, None),
         ("d", 1.0, None, None, None, None, None), ("e", 1.0, "x", None, "{", None, None), (None, 1.0, "x", None, None, None, None), ("f", 1.0, "x", None, None, "soon", None)],
        f"externalId string, n double, t string, l array<int>, j string, d string, r {REF}",
    )
    result = upsert_instances(nodes(spark, "a", "b"), source, "node", VIEW, props(spark, ("a", 1, "old"), ("b", 7, "y")), instance_space="s")
    found = {r.externalId: r for r in result.properties.collect()}
    assert set(found) == {"a", "b"} and found["a"].l == [1] and found["a"].r == ("s", "z") and str(found["a"].d) == "2020-01-02" and found["b"].n == 7
    assert as_dict(result.changes, value="change") == {"a": "modified", "b": "noop"}
    errors = {r.externalId: r.error for r in result.errors.collect()}
    assert errors == {"c": "bad value of 'n'", "d": "'t' is null", "e": "bad value of 'j'",
                      None: "'externalId' is null", "f": "bad value of 'd'"}
    assert {r.externalId: r.version for r in result.instances.collect()} == {"a": 2, "b": 1}
    with pytest.raises(PlantError, match=r"\[t\]"):
        upsert_instances(nodes(spark), source.drop("t"), "node", VIEW, props(spark))


def test_classify(spark, rows):
    data = [("e", ("s", "t"), (None, "a"), ("q", "b")), ("n", None, None, None), ("typed", ("s", "t"), None, None), ("half", ("s", "t"), (None, "a"), None),
            ("untyped", None, ("s", "a"), ("s", "b")), ("hollow", ("s", "t"), ("s", None), (None, None))]
    mixed = spark.createDataFrame(data, f"externalId string, type {REF}, startNode {REF}, endNode {REF}")
    found_nodes, found_edges, errors = classify_instances(mixed, "s")
    assert {r.externalId for r in found_nodes.collect()} == {"n", "typed", "hollow"}
    assert [(r.externalId, r.startNode.space, r.endNode.space) for r in found_edges.collect()] == [("e", "s", "q")]
    assert {r.externalId: r.error.split("only: ")[1] for r in errors.collect()} == {
        "half": "'externalId', 'type', 'startNode'", "untyped": "'externalId', 'startNode', 'endNode'"}
    assert classify_instances(mixed)[2].count() == 6  # no space at all


@pytest.mark.parametrize("start_exists", [True, False])
@pytest.mark.parametrize("end_exists", [True, False])
@pytest.mark.parametrize("create_start, create_end", [(True, True), (True, False), (False, True), (False, False)])
def test_auto_create(spark, start_exists, end_exists, create_start, create_end):
    have = ["a"] * start_exists + ["b"] * end_exists
    edge = spark.createDataFrame([("x", ("s", "a"), (None, "b"))], f"externalId string, startNode {REF}, endNode {REF}")
    made, refused = auto_create_nodes(edge, nodes(spark, *have), start_nodes=create_start, end_nodes=create_end, instance_space="s")
    expected = set(have) | ({"a"} if create_start else set()) | ({"b"} if create_end else set())
    assert {r.externalId for r in made.collect()} == expected
    assert {r.externalId for r in refused.collect()} == {"a", "b"} - expected


def test_direct_relations_are_created(spark):
    source = spark.createDataFrame([("x", ("s", "a"), [("s", "b"), None])], f"externalId string, r {REF}, rs array<{REF}>")
    made, refused = auto_create_nodes(source, nodes(spark, "a"), direct_relations=["r", "rs"], instance_space="s")
    assert {r.externalId for r in made.collect()} == {"a", "b"} and refused.count() == 0
    _, refused = auto_create_nodes(source, nodes(spark, "a"), direct_relations=["r", "rs"], auto_create_direct_relations=False, instance_space="s")
    assert {r.externalId for r in refused.collect()} == {"b"}
