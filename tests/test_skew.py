from pyspark.sql import functions as F

from plantframe.operators.joins import consecutive_pairs
from plantframe.operators.predicates import lookup_rows, parse_ids
from plantframe.operators.skew import dense_rank_ids, keep_greatest, quantile_bounds, slice_of


def test_keep_greatest(spark):
    df = spark.createDataFrame([(1, 5, {"a": "x"}), (1, 5, {"a": "y"}), (1, 4, {"a": "z"}), (2, None, None)], "k int, o int, m map<string,string>")
    found = {r.k: r.m for r in keep_greatest(df, ["k"], [F.col("o")]).collect()}
    assert found == {1: {"a": "y"}, 2: None}
    plain = df.drop("m")
    assert {(r.k, r.o) for r in keep_greatest(plain, ["k"], [-F.col("o")]).collect()} == {(1, 4), (2, None)}


def test_rank_ids_have_no_gaps_and_repeat(spark):
    df = spark.range(500).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("name"))
    first = {r.name: r.n for r in dense_rank_ids(df, F.col("name"), "n", slices=16).collect()}
    again = {r.name: r.n for r in dense_rank_ids(df.repartition(3), F.col("name"), "n", slices=16).collect()}
    assert sorted(first.values()) == list(range(500)) and first == again


def test_slices_follow_the_order(spark):
    df = spark.range(1000)
    bounds = quantile_bounds(df, "id", 7)
    found = df.withColumn("s", slice_of(F.col("id"), bounds)).groupBy("s").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    parts = sorted((r.lo, r.hi) for r in found.collect())
    assert len(parts) == 7 and all(a[1] < b[0] for a, b in zip(parts, parts[1:]))
    assert quantile_bounds(df, "id") == []


def test_id_lists():
    assert parse_ids("123") == ([123], [])
    assert parse_ids('"123"') == ([], ["123"])
    assert parse_ids('[123, "123"]') == ([123], ["123"])
    for text in ("plain", '{"a": 1}', "[1, 2", "[1.5]", "true"):
        assert parse_ids(text) == ([], [text])


def test_long_id_lists_travel_as_a_table(spark, monkeypatch):
    from plantframe.operators import predicates

    df = spark.range(100).select("id", F.concat(F.lit("e"), F.col("id").cast("string")).alias("externalId"))
    short = lookup_rows(df, [1, 2, 500], ["e2", "e9"], "id > 97")
    monkeypatch.setattr(predicates, "MAX_LITERALS", 2)
    long = lookup_rows(df, [1, 2, 500], ["e2", "e9"], "id > 97")
    assert sorted(r.id for r in short.collect()) == sorted(r.id for r in long.collect()) == [1, 2, 9, 98, 99]


def test_consecutive_pairs(spark, rows):
    stops = spark.createDataFrame([("t", 1, "a"), ("t", 2, "b"), ("t", 4, "c"), ("u", 3, "d")], "trip string, seq int, stop string")
    assert rows(consecutive_pairs(stops, ["trip"], "seq", ["stop"])) == [("t", 1, "a", "b")]
