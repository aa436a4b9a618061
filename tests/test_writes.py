import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantframe import PlantError
from plantframe.operators.merge import merge
from plantframe.operators.series_writes import (
    delete_range_bounds,
    delete_ranges,
    diff_sequence_columns,
    resolve_series,
    sequence_row_schema,
    upsert_points,
    upsert_sequence_rows,
)
from plantframe.sources.schemas import READ_SCHEMAS

NOW = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def events(spark):
    data = [(i, f"e{i}" if i < 4 else None, f"type{i}", "old") for i in range(1, 6)]
    short = spark.createDataFrame(data, "id long, externalId string, type string, description string")
    named = [f.strip().split(" ")[0] for f in READ_SCHEMAS["events"].split(", ")]
    schema = spark.createDataFrame([], READ_SCHEMAS["events"]).schema
    return short.select(*[(F.col(n) if n in short.columns else F.lit(None)).cast(schema[n].dataType).alias(n) for n in named])


def src(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def table(result):
    return {r.id: (r.externalId, r.type, r.description) for r in result.table.collect()}


def messages(result):
    return sorted(r.error for r in result.errors.collect())


def test_insert(spark, events):
    result = merge(events, src(spark, "externalId string, type string", ("new", "t"), (None, "u"), (None, "u")), "events")
    assert messages(result) == [] and len(table(result)) == 8
    assert sorted(set(table(result)) - set(range(1, 6))) == [6, 7, 8]
    taken = merge(events, src(spark, "externalId string", ("e1",), ("x",), ("x",)), "events", "ABORT")
    assert messages(taken) == ["externalId already exists: e1", "externalId occurs several times: x"]
    with pytest.raises(PlantError, match="e1"):
        taken.raise_for_errors()


def test_update(spark, events):
    source = src(spark, "id long, externalId string, type string, description string",
                 (1, "renamed", "a", None), (None, "e2", "b", "new"), (99, None, "c", None), (0, "e3", None, None), (None, None, "d", None), (None, "zz", "d", None))
    result = merge(events, source, "events", "update", now=NOW)
    assert table(result)[1] == ("renamed", "a", "old") and table(result)[2] == ("e2", "b", "new") and table(result)[3] == ("e3", "type3", "old")
    assert messages(result) == ["an update needs an id or externalId", "unknown externalId zz", "unknown id 99"]
    assert result.updated.count() == 2  # the empty update is not one


def test_tri_state(spark, events):
    source = src(spark, "id long, description string", (1, None), (2, "x"))
    kept = merge(events, source, "events", "update")
    assert table(kept)[1][2] == "old" and table(kept)[2] == ("e2", "type2", "x")
    cleared = merge(events, source, "events", "update", ignore_null_fields=False)
    assert table(cleared)[1] == ("e1", "type1", None)
    assets = spark.createDataFrame([(1, "a", "name", "d")], "id long, externalId string, name string, description string")
    both = merge(assets, src(spark, "id long, name string, description string", (1, None, None)), "assets", "update", ignore_null_fields=False)
    assert [(r.name, r.description) for r in both.table.collect()] == [("name", None)]  # a name can not be cleared


def test_upsert(spark, events):
    source = src(spark, "id long, externalId string, type string",
                 (1, None, "by id"), (None, "e1", "by name"), (None, "e2", "u"), (None, "new", "a"), (None, "new", "b"), (None, None, "n"), (77, None, "x"))
    result = merge(events, source, "events", "upsert")
    assert table(result)[1][1] == "by id" and table(result)[2][1] == "u"
    created = {(r.externalId, r.type) for r in result.created.collect()}
    assert created == {("new", "b"), (None, "n")}
    assert messages(result) == ["unknown id 77"]
    counts = {r.outcome: r.n for r in result.counts().collect()}
    assert counts == {"read": 7, "created": 2, "updated": 2, "deleted": 0, "errors": 1}


def test_upsert_twice_changes_nothing_more(spark, events, rows):
    source = src(spark, "externalId string, type string", ("e1", "x"), ("n1", "y"))
    once = merge(events, source, "events", "upsert", now=NOW).table
    twice = merge(once, source, "events", "upsert", now=NOW)
    assert rows(twice.table, "externalId", "type") == rows(once, "externalId", "type") and twice.created.count() == 0


def test_last_row_by_order_wins(spark, events):
    source = src(spark, "externalId string, type string, at int", ("e1", "z", 1), ("e1", "a", 2))
    assert table(merge(events, source, "events", "upsert", order_by="at"))[1][1] == "a"


def test_insert_into_ignores_ids(spark, events):
    result = merge(events, src(spark, "id long, externalId string, type string", (5, "e1", "x"), (5, "q", "y")), "events", "insert_into")
    assert table(result)[1][1] == "x" and table(result)[5][1] == "type5" and result.created.count() == 1


def test_delete(spark, events):
    source = src(spark, "id long, externalId string", (1, "e2"), (None, "e3"), (99, None), (None, "zz"))
    result = merge(events, source, "events", "delete")
    assert sorted(table(result)) == [2, 4, 5] and messages(result) == []
    assert messages(merge(events, source, "events", "delete", ignore_unknown_ids=False)) == ["unknown externalId zz", "unknown id 99"]


def test_resource_rules(spark, events):
    assets = spark.createDataFrame([(1, "a", "n")], "id long, externalId string, name string")
    nameless = merge(assets, src(spark, "externalId string, source string", ("zz", "s")), "assets", "upsert")
    assert messages(nameless) == ["unknown externalId zz"]
    assert messages(merge(assets, src(spark, "externalId string, name string", ("q", None)), "assets")) == ["name is missing on a new item"]
    by_name = src(spark, "externalId string", ("a",))
    with pytest.raises(PlantError, match="needs"):
        merge(assets, by_name, "files", "delete")
    gone = merge(assets, src(spark, "id long", (5,)), "sequences", "delete")
    assert messages(gone) == ["unknown id 5"]  # sequences can not ignore unknown ids
    for resource, mode in ("labels", "upsert"), ("labels", "update"), ("datasets", "delete"), ("events", "replace"):
        with pytest.raises(PlantError, match="not supported"):
            merge(events, by_name, resource, mode)
    with pytest.raises(PlantError, match="can not be written"):
        merge(events, by_name, "raw")


POINTS = "id long, externalId string, timestamp timestamp, value double"
T0 = dt.datetime(2024, 1, 1)


def at(hours, micros=0):
    return T0 + dt.timedelta(hours=hours, microseconds=micros)


def test_upsert_points(spark, rows):
    series = spark.createDataFrame([(1, "a"), (2, "b")], "id long, externalId string")
    target = spark.createDataFrame([(1, at(0), 1.0), (2, at(0), 2.0)], "id long, timestamp timestamp, value double")
    source = spark.createDataFrame([(None, "a", at(0), 5.0), (2, "a", at(1), 6.0), (None, "zz", at(0), 7.0), (None, None, at(0), 8.0)], POINTS)
    good, bad = resolve_series(source, series)
    assert rows(upsert_points(target, good)) == [(1, at(0), 5.0), (2, at(0), 2.0), (2, at(1), 6.0)]
    assert sorted(r.error for r in bad.collect()) == ["either id or externalId must be set", "unknown externalId zz"]


RANGES = "id long, externalId string, inclusiveBegin timestamp, exclusiveBegin timestamp, exclusiveEnd timestamp, inclusiveEnd timestamp"


@pytest.mark.parametrize("limit", [100, 0])
def test_delete_ranges(spark, limit):
    dp = spark.createDataFrame([(1, "a", at(h), float(h)) for h in range(60)] + [(2, "b", at(h), 100.0 + h) for h in range(5)], POINTS)
    ranges = spark.createDataFrame([
        (1, "b", at(0), None, at(10), None), (1, None, at(5), None, at(50), None),
        (None, "b", None, at(0), None, at(2)), (None, "none", at(0), None, at(9), None),
    ], RANGES)
    kept, errors = delete_ranges(dp, ranges, max_broadcast=limit)
    assert sorted(r.value for r in kept.collect()) == [*map(float, range(50, 60)), 100.0, 103.0, 104.0]
    assert errors.count() == 0 and kept.columns == dp.columns


@pytest.mark.parametrize("limit", [100, 0])
def test_delete_ranges_keep_points_without_a_time(spark, limit):
    points = [(1, "a", at(0), 1.0), (1, "a", None, 2.0), (1, None, None, 3.0), (None, "a", None, 4.0), (None, None, at(0), 5.0), (2, "b", None, 6.0)]
    ranges = spark.createDataFrame([(1, None, at(0), None, at(9), None), (None, "a", at(0), None, at(9), None), (None, "b", at(0), None, at(9), None)], RANGES)
    kept, _ = delete_ranges(spark.createDataFrame(points, POINTS), ranges, max_broadcast=limit)
    assert sorted(r.value for r in kept.collect()) == [2.0, 3.0, 4.0, 5.0, 6.0]


@pytest.mark.parametrize("row, message", [
    ((1, None, at(1), None, at(1), None), "empty"),
    ((1, None, at(1), at(1), at(2), None), "both inclusiveBegin"),
    ((1, None, at(1), None, at(2), at(2)), "both inclusiveEnd"),
    ((1, None, None, None, at(2), None), "inclusiveBegin or exclusiveBegin"),
    ((1, None, at(1), None, None, None), "inclusiveEnd or exclusiveEnd"),
    ((None, None, at(1), None, at(2), None), "id or externalId"),
])
def test_refused_ranges(spark, row, message):
    good, errors = delete_range_bounds(spark.createDataFrame([row], RANGES))
    assert good.count() == 0 and message in errors.first().error


COLUMNS = [("num1", "LONG"), ("str1", "STRING"), ("num2", "DOUBLE")]


def test_sequence_rows(spark, rows):
    assert sequence_row_schema(COLUMNS).simpleString() == "struct<rowNumber:bigint,num1:bigint,str1:string,num2:double>"
    for bad in [("", "LONG")], [("x", "BLOB")]:
        with pytest.raises(PlantError):
            sequence_row_schema(bad)
    target = spark.createDataFrame([(1, 1, 5, "a", 0.5), (1, 2, 6, "b", 0.6), (2, 1, 7, "c", 0.7)], "id long, rowNumber long, num1 long, str1 string, num2 double")
    source = spark.createDataFrame([(1, 1, 50), (2, 9, 90)], "id long, rowNumber int, num1 int")
    assert rows(upsert_sequence_rows(target, source, COLUMNS)) == [(1, 1, 50, "a", 0.5), (1, 2, 6, "b", 0.6), (2, 1, 7, "c", 0.7), (2, 9, 90, None, None)]
    for schema, message in (("id long, rowNumber long, other long", "does not exist"), ("id long, rowNumber long, num1 string", "expected LONG"),
                            ("id long, num1 long", "rowNumber"), ("rowNumber long, num1 long", "id")):
        with pytest.raises(PlantError, match=message):
            upsert_sequence_rows(target, spark.createDataFrame([], schema), COLUMNS)


def test_sequence_columns(spark, rows):
    kind = "externalId string, columns array<struct<externalId:string,valueType:string>>"
    target = spark.createDataFrame([("s", [("a", "LONG"), ("b", "STRING")]), ("t", [("a", "LONG")])], kind)
    source = spark.createDataFrame([("s", [("a", "DOUBLE"), ("c", None)]), ("t", []), ("unknown", [("a", "LONG")])], kind)
    assert rows(diff_sequence_columns(target, source)) == [("s", "a", "error", "LONG"), ("s", "b", "remove", "STRING"), ("s", "c", "add", "STRING")]


def test_sources_of_other_types_are_refused_row_by_row(spark, rows):
    target = spark.createDataFrame([(1, "a", 1.5, [1], {"k": "v"})], "id long, externalId string, confidence double, assetIds array<long>, metadata map<string,string>")
    source = spark.createDataFrame(
        [("a", 3, [None, 2], {"x": None, "y": "1"}, None), ("b", 4, [], None, "text"), ("c", None, None, None, None)],
        "externalId string, confidence int, assetIds array<int>, metadata map<string,string>, createdTime string",
    )
    stored = target.withColumns({"createdTime": F.current_timestamp(), "lastUpdatedTime": F.current_timestamp()})
    result = merge(stored, source, "events", "upsert")
    assert rows(result.errors, "externalId", "error") == [("b", "Row b in column createdTime: expected timestamp, got string text")]
    found = {r.externalId: r for r in result.table.collect()}
    assert found.keys() == {"a", "c"} and found["a"].confidence == 3.0 and found["a"].assetIds == [2] and found["a"].metadata == {"y": "1"}


def test_points_are_read_by_name_and_kind(spark):
    from plantframe.sources.catalog import Catalog

    catalog = Catalog(
        spark,
        {
            "timeseries": lambda: spark.createDataFrame([(1, "n", False), (2, "t", True)], "id long, externalId string, isString boolean"),
            "datapoints": lambda: spark.createDataFrame([(1, "n", NOW, 2.0)], "id long, externalId string, timestamp timestamp, value double"),
        },
    )
    assert catalog.points(ids=[1, 77]).count() == 1 and catalog.points(external_ids=["unknown"]).count() == 0
    for wrong in ({}, {"ids": [2]}, {"ids": [1], "external_ids": ["t"]}):
        with pytest.raises(PlantError, match="series 2 holds string points|at least one id"):
            catalog.points(**wrong)
