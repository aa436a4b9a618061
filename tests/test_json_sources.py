"""One JSON field read as several columns of different types."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry
from plantframe.functions.rawjson import read_json_table


def test_a_field_is_read_as_several_types(spark):
    source = spark.createDataFrame(
        [("1", '{"a":"7","b":{"c":1}}'), ("2", '{"a":["x"],"b":null}'), ("3", "{")], "key string, columns string"
    ).selectExpr("*", "timestamp'2024-01-01' as lastUpdatedTime")
    schema = T.StructType.fromDDL("a int, text string, list array<string>, b string, whole string")
    sources = {"text": "a", "list": "a", "whole": "b"}
    found = {r["key"]: r for r in read_json_table(source, schema, sources=sources).collect()}
    assert (found["1"].a, found["1"].text, found["1"].list, found["1"].b, found["1"].whole) == (7, "7", None, '{"c":1}', '{"c":1}')
    assert found["1"]._errors == ["row 1: wrong type in column list"]
    assert (found["2"].a, found["2"].text, found["2"].list, found["2"].b) == (None, '["x"]', ["x"], None)
    assert found["3"]._errors == ["row 3: malformed JSON"] and found["3"].text is None


@pytest.mark.parametrize("name", ["raw_nested", "raw_typed_cast"])
def test_two_readings_of_a_row_need_no_shuffle(spark, name):
    out = io.StringIO()
    with redirect_stdout(out):
        entry.queries()[name](spark, "/root/testdata/sf0.001").explain("simple")
    assert "Exchange" not in out.getvalue()
