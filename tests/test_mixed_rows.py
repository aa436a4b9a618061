"""Rows of many sequences in one frame: faults by row, null cells, repeated rows, unknown sequences, partial writes."""

import json

from pyspark.sql import functions as F

from plantframe.operators.mixed_rows import check_mixed_rows, mixed_cells, upsert_mixed_rows

COLUMNS = "externalId string, columns array<struct<externalId:string,valueType:string>>"


def sequences(spark):
    return spark.createDataFrame([("a", [("n", "DOUBLE"), ("t", "STRING")]), ("b", [("n", "LONG")]), ("none", None)], COLUMNS)


def frame(spark, rows):
    made = spark.createDataFrame([(s, n, json.dumps(v)) for s, n, v in rows], "externalId string, rowNumber long, text string")
    return made.select("externalId", "rowNumber", F.parse_json("text").alias("values"))


def stored(df):
    return {(r.externalId, r.rowNumber): json.loads(r.text) for r in df.select("externalId", "rowNumber", F.to_json("values").alias("text")).collect()}


def test_faults(spark, rows):
    given = [
        ("a", 1, {"n": 1.5, "t": "x"}), ("a", 2, {"n": 3}), ("a", 3, {"n": None, "t": None}), ("a", 4, {"n": "1", "x": 1}), ("b", 5, {"n": 1.5}), ("b", 6, {"n": 7}),
        ("c", 7, {"n": 1}), (None, 8, {"n": 1}), ("a", None, {"n": 1}), ("none", 9, {"n": 1}), ("b", 10, {}),
    ]
    good, errors = check_mixed_rows(frame(spark, given), sequences(spark))
    assert stored(good).keys() == {("a", 1), ("a", 2), ("a", 3), ("b", 6), ("b", 10)}
    assert {(r.externalId, r.rowNumber): r.error for r in errors.collect()} == {
        ("a", 4): "column n of sequence a has type STRING, expected DOUBLE; column x of sequence a does not exist",
        ("b", 5): "column n of sequence b has type DECIMAL, expected LONG",
        ("c", 7): "unknown sequence c",
        (None, 8): "unknown sequence null",
        ("a", None): "a row of sequence a has no rowNumber",
        ("none", 9): "unknown sequence none",
    }
    cells = {(r.externalId, r.rowNumber, r.column): (r.text, r.number, r.whole) for r in mixed_cells(good, sequences(spark)).collect()}
    assert cells[("a", 2, "n")] == (None, 3.0, None) and cells[("b", 6, "n")] == (None, None, 7) and cells[("a", 3, "t")] == (None, None, None)


def test_upsert(spark):
    target = frame(spark, [("a", 1, {"n": 1.5, "t": "x"}), ("a", 2, {"t": "y"}), ("b", 1, {"n": 4})])
    source = frame(spark, [("a", 1, {"n": 2.5}), ("a", 1, {"n": 1.0}), ("a", 2, {"t": None}), ("b", 2, {"n": 5}), ("b", 3, {"n": "no"}), ("zz", 1, {})])
    table, errors = upsert_mixed_rows(target, source, sequences(spark))
    assert stored(table) == {("a", 1): {"n": 2.5, "t": "x"}, ("a", 2): {"t": None}, ("b", 1): {"n": 4}, ("b", 2): {"n": 5}}
    assert sorted(r.externalId for r in errors.collect()) == ["b", "zz"]
    again, _ = upsert_mixed_rows(table, source, sequences(spark))
    assert stored(again) == stored(table)
    empty = frame(spark, [("a", 1, {})]).limit(0)
    assert stored(upsert_mixed_rows(empty, source, sequences(spark))[0]).keys() == {("a", 1), ("a", 2), ("b", 2)}
    assert stored(upsert_mixed_rows(target, empty, sequences(spark))[0]) == stored(target)
