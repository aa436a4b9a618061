import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from __spark_entry__ import queries
from plantframe import PlantError
from plantframe.functions.convert import json_is_valid, narrow_exact, parse_date, parse_timestamp, read_cast, validate
from plantframe.functions.rawjson import (
    drop_null_fields,
    infer_json_schema,
    insert_rows,
    read_json_table,
    rename_reserved,
    select_keys,
    to_json_table,
    unrename_reserved,
)


def raw(spark, *objects):
    data = [(f"k{i}", o if isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objects)]
    return spark.createDataFrame(data, "key string, columns string").withColumn("lastUpdatedTime", F.current_timestamp())


def ddl(text):
    return T.StructType.fromDDL(text)


@pytest.mark.parametrize("names, renamed", [
    (["notKey", "value"], ["notKey", "value"]),
    (["key", "value"], ["_key", "value"]),
    (["___key", "__key", "key", "value"], ["____key", "___key", "_key", "value"]),
    (["lastUpdatedTime", "_lastUpdatedTime"], ["_lastUpdatedTime", "__lastUpdatedTime"]),
    (["monkey", "keys", "_keyed"], ["monkey", "keys", "_keyed"]),
])
def test_reserved_names(spark, names, renamed):
    df = spark.createDataFrame([tuple("x" * len(names))], names)
    assert rename_reserved(df).columns == renamed
    assert unrename_reserved(rename_reserved(df)).columns == names


def test_inferred_schema(spark):
    df = raw(spark, {"a": 1, "b": "x", "n": {"field": "Ř", "field2": 1}}, {"a": 2.5, "b": None, "c": None, "l": [1, 2]}, {"b": 3, "big": 10**19})
    schema = infer_json_schema(df)
    assert schema.simpleString() == (
        "struct<a:double,b:string,big:decimal(20,0),c:string,l:array<bigint>,n:struct<field:string,field2:bigint>>"
    )
    assert infer_json_schema(df.limit(0)).fields == []
    typed = read_json_table(df, schema, on_error="raise").orderBy("key").collect()
    assert [r.a for r in typed] == [1.0, 2.5, None] and typed[0].n.field == "Ř" and typed[1].l == [1, 2] and typed[2].b == "3"


@pytest.mark.parametrize("kind", "byte short int long float double boolean".split())
def test_empty_text_is_null(spark, kind):
    found = read_json_table(raw(spark, {"v": ""}, {"v": None}, {}), ddl(f"v {kind}")).collect()
    assert [(r.v, r._errors) for r in found] == [(None, [])] * 3


@pytest.mark.parametrize("kind, value, expected", [
    ("int", 12, 12), ("int", "12", 12), ("int", 12.0, 12), ("int", "+7", 7), ("byte", -128, -128), ("long", 2**62, 2**62),
    ("double", 1, 1.0), ("double", "1.5e3", 1500.0), ("float", "0.5", 0.5), ("boolean", True, True), ("boolean", "TRUE", True),
    ("boolean", "yes", False), ("string", 1, "1"), ("string", {"a": [1]}, '{"a":[1]}'), ("string", True, "true"), ("string", "x", "x"),
    ("decimal(10,2)", "12.50", Decimal("12.50")), ("decimal(10,2)", 3, Decimal("3.00")), ("binary", "aGk=", bytearray(b"hi")),
    ("array<int>", ["1", 2, None, ""], [1, 2, None, None]), ("map<string,double>", {"a": "1", "b": 2}, {"a": 1.0, "b": 2.0}),
    ("map<string,string>", {"a": "1", "b": 2}, {"a": "1", "b": "2"}), ("array<string>", [1, "x", None], ["1", "x", None]),
])
def test_values(spark, kind, value, expected):
    found = read_json_table(raw(spark, {"v": value}), ddl(f"v {kind}")).first()
    assert found._errors == [] and found.v == expected


def test_nested_values(spark):
    kind = ddl("v struct<a:int,b:struct<c:array<boolean>>,s:string>")
    good = {"a": "4", "b": {"c": ["true", False, ""]}, "s": {"z": 1}}
    found = read_json_table(raw(spark, {"v": good}, {"v": {"b": {"c": [1]}}}, {"v": [1]}), kind).orderBy("key").collect()
    assert found[0].v.asDict(True) == {"a": 4, "b": {"c": [True, False, None]}, "s": '{"z":1}'}
    assert [len(r._errors) for r in found] == [0, 1, 1]


@pytest.mark.parametrize("kind, value", [
    ("int", "x"), ("int", 2.5), ("int", "12.0"), ("byte", 128), ("int", True), ("int", 2**40), ("boolean", 1), ("double", "abc"),
    ("double", [1]), ("decimal(10,2)", ""), ("binary", 3), ("array<int>", {"a": 1}), ("array<int>", [1, "x"]), ("map<string,int>", [1]),
    ("struct<a:int>", "text"), ("array<string>", "text"), ("map<string,string>", 1),
])
def test_wrong_shapes_are_errors(spark, kind, value):
    df = raw(spark, {"v": value, "w": 1})
    found = read_json_table(df, ddl(f"v {kind}, w int")).first()
    assert found.w == 1 and found._errors == ["row k0: wrong type in column v"]
    with pytest.raises(Exception, match="wrong type in column v"):
        read_json_table(df, ddl(f"v {kind}, w int"), on_error="raise").collect()


def test_broken_json_fails(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_table(raw(spark, '{"a": '), ddl("a int"), on_error="raise").collect()


def test_malformed_rows_are_rows_with_errors(spark):
    found = read_json_table(raw(spark, '{"a": 1, "b": "x"}', '{"a": 2, "b": ', "no json"), ddl("a int, b string")).orderBy("key").collect()
    assert [(r.a, r.b) for r in found] == [(1, "x"), (None, None), (None, None)]
    assert [r._errors for r in found] == [[], ["row k1: malformed JSON"], ["row k2: malformed JSON"]]


def test_whole_numbers_are_not_rounded(spark):
    values = ["1e-12", "5.00000000001", "5.0", "5e2", "-3", "9223372036854775807", "9223372036854775808", "1e30"]
    found = read_json_table(raw(spark, *['{"v": %s}' % v for v in values]), ddl("v long")).orderBy("key").collect()
    assert [r.v for r in found] == [None, None, 5, 500, -3, 9223372036854775807, None, None]
    assert [len(r._errors) for r in found] == [1, 1, 0, 0, 0, 0, 1, 1]


def test_round_trip(spark):
    data = [("1", 1, 2.5, float("nan"), True, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5), [1, None], {"x": "y"}, None)]
    schema = "key string, i int, d double, nan double, b boolean, day date, t timestamp, l array<int>, m map<string,string>, n string"
    written = to_json_table(spark.createDataFrame(data, schema)).first()
    assert json.loads(written.columns) == {
        "i": 1, "d": 2.5, "nan": "NaN", "b": True, "day": "2020-01-02", "t": "2020-01-02 03:04:05.0", "l": [1, None], "m": {"x": "y"}, "n": None,
    }


def test_written_rows_need_a_key_and_no_binary(spark):
    with pytest.raises(PlantError, match="key"):
        to_json_table(spark.range(1))
    with pytest.raises(PlantError, match="base64"):
        to_json_table(spark.createDataFrame([("k", bytearray(b"x"))], "key string, v binary"))
    with pytest.raises(Exception, match="null key"):
        to_json_table(spark.createDataFrame([(None, 1)], "key string, v int")).collect()


def test_null_fields_can_go_without_changing_the_schema(spark):
    df = raw(spark, {"a": None, "b": 1}, {"a": "x", "b": None})
    schema = infer_json_schema(df)
    slim = df.withColumn("columns", drop_null_fields())
    assert sorted(r.columns for r in slim.collect()) == ['{"a":"x"}', '{"b":1}']
    both = [read_json_table(t, schema, on_error="raise").select("key", "a", "b").orderBy("key").collect() for t in (df, slim)]
    assert both[0] == both[1]


def made_beside(df, function):
    """True if the text a JSON function reads is made in another projection than the one that holds the function."""
    lines = [x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "base64" in x.lower() or function in x]
    return len(lines) == 2 and not any("base64" in x.lower() and function in x for x in lines)


def test_text_that_loses_its_null_fields_is_made_beside(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "key string, t string")
    made = df.select("key", F.concat(F.lit('{"n":null,"t":"'), F.base64("t"), F.lit('"}')).alias("columns"))
    slim = made.withColumn("columns", drop_null_fields())
    assert made_beside(slim, "map_filter") and rows(slim) == [("a", '{"t":"eA=="}'), ("b", None)]


def test_text_of_typed_rows_is_made_beside(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "key string, t string")
    made = df.select("key", F.lit(None).cast("timestamp").alias("lastUpdatedTime"), F.concat(F.lit('{"n":"7","t":"'), F.base64("t"), F.lit('"}')).alias("columns"))
    typed = read_json_table(made, ddl("t string, n int, m long, d double"), sources={"m": "n", "d": "n"})
    assert made_beside(typed, "from_json")
    assert typed._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get") == 1
    assert rows(typed, "key", "t", "n", "m", "d", "_errors") == [("a", "eA==", 7, 7, 7.0, []), ("b", None, None, None, None, [])]


def test_insert_replaces_by_key(spark, rows):
    target = raw(spark, {"a": 1}, {"a": 2})
    source = spark.createDataFrame([("k1", "new"), ("k9", "x")], "key string, _key string")
    found = insert_rows(target, source)
    assert rows(found, "key", "columns") == [("k0", '{"a": 1}'), ("k1", '{"key":"new"}'), ("k9", '{"key":"x"}')]


def test_key_sets(spark):
    df = raw(spark, *[{}] * 5)
    keys = lambda found: sorted(r.key for r in found.collect())
    assert keys(select_keys(df, ["k1", "k3", None, "zz"])) == ["k1", "k3"] == keys(select_keys(df, ["k1", "k3", "zz"], limit=1))
    assert keys(select_keys(df, [])) == [] == keys(df.filter("key = 'k1' and key = 'k2'"))


def test_validation(spark, rows):
    df = spark.createDataFrame([("a", 1, "x", {"k": "v", "z": None}, [1, None]), ("b", 2, None, None, None)], "externalId string, n int, s string, m map<string,string>, l array<int>")
    good, errors = validate(df, ddl("externalId string, n double, s string, m map<string,string>, l array<long>, absent int"), required=["s"])
    assert good.dtypes == [("externalId", "string"), ("n", "double"), ("s", "string"), ("m", "map<string,string>"), ("l", "array<bigint>")]
    assert rows(good) == [("a", 1.0, "x", {"k": "v"}, [1])]
    assert rows(errors, "row", "column") == [("b", "s")]
    _, wrong = validate(df, ddl("externalId string, n string, s timestamp, l array<string>"))
    assert rows(wrong, "row", "column") == [("a", "l"), ("a", "n"), ("a", "s"), ("b", "n")]
    with pytest.raises(PlantError, match="missing"):
        validate(df, ddl("externalId string"), required=["missing"])


def test_metadata_must_be_text(spark):
    df = spark.createDataFrame([("a", {"k": 1}), ("b", {"k": None})], "externalId string, m map<string,int>")
    good, errors = validate(df, ddl("externalId string, m map<string,string>"))
    assert [r.externalId for r in good.collect()] == ["b"] and [r.row for r in errors.collect()] == ["a"]


@pytest.mark.parametrize("kind, value, target, expected", [
    ("double", 2.0, "int", 2), ("double", 2.5, "int", None), ("double", 3e9, "int", None), ("double", 3e9, "long", 3 * 10**9),
    ("long", 2**33, "int", None), ("int", 7, "double", 7.0), ("double", 0.5, "float", 0.5), ("decimal(20,10)", Decimal("0.1"), "double", 0.1),
])
def test_narrowing(spark, kind, value, target, expected):
    found, bad = narrow_exact(F.col("v"), target)
    row = spark.createDataFrame([(value,)], f"v {kind}").select(found.alias("v"), bad.alias("bad")).first()
    assert (row.v, row.bad) == (expected, expected is None)


def test_read_casts(spark):
    df = spark.createDataFrame([(2.9, -1e12, 2**31 + 5)], "a double, b double, c long")
    integer = T.IntegerType()
    row = df.select(
        read_cast(F.col("a"), T.DoubleType(), integer).alias("a"), read_cast(F.col("b"), T.DoubleType(), integer).alias("b"),
        read_cast(F.col("c"), T.LongType(), integer).alias("c"),
    ).first()
    assert tuple(row) == (2, -(2**31), -(2**31) + 5)


@pytest.mark.parametrize("text, moment, day", [
    ("2020-01-02T03:04:05Z", dt.datetime(2020, 1, 2, 3, 4, 5), "2020-01-02"),
    ("2020-01-02T03:04:05.123+02:00", dt.datetime(2020, 1, 2, 1, 4, 5, 123000), "2020-01-02"),
    ("2020-01-02T03:04", dt.datetime(2020, 1, 2, 3, 4), "2020-01-02"),
    ("2020-01-02", None, "2020-01-02"),
    ("2020-13-02", None, None),
    ("2020", None, None),
    ("soon", None, None),
])
def test_dates(spark, text, moment, day):
    row = spark.createDataFrame([(text,)], "t string").select(parse_timestamp(F.col("t")).alias("m"), parse_date(F.col("t")).cast("string").alias("d")).first()
    assert (row.m, row.d) == (moment, day)


@pytest.mark.parametrize("text, valid", [
    ('{"a": 1}', True), ("[1, 2]", True), ("null", True), (" 3 ", True), ('{"a": 1}}{', False), ("1, 2", False), ("1],[2", False),
    ('1},"b":{', False), ("", False), ("{a}", False), (None, False),
])
def test_json_validity(spark, text, valid):
    assert spark.createDataFrame([(text,)], "t string").select(json_is_valid("t").alias("v")).first().v is valid


def test_a_nested_value_read_as_a_scalar_is_wrong_and_not_written_as_text(spark):
    frame = spark.createDataFrame([("a", '{"n":{"x":"1"},"m":[1]}'), ("b", '{"n":"7","m":null}')], "key string, columns string")
    typed = read_json_table(frame.withColumn("lastUpdatedTime", F.current_timestamp()), ddl("n int, m double"))
    found = {r.key: r for r in typed.collect()}
    assert found["a"].n is None and found["a"].m is None and len(found["a"]._errors) == 2
    assert found["b"].n == 7 and found["b"].m is None and found["b"]._errors == []
    plan = typed._jdf.queryExecution().analyzed().toString()
    assert plan.count("THEN try_variant_get(_f") == 2 and "StartsWith(schema_of_variant(_f0" in plan


def test_key_columns_take_one_reading_and_no_shuffle(spark):
    plan = queries()["raw_key_columns"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
