"""Every registered query against its SQL, and rules that hold for all plans."""

import io
import os
from contextlib import redirect_stdout

import oracle
import pytest

import __spark_entry__ as entry

ROOT = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(ROOT)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert oracle.compare(con, SQL[name], QUERIES[name](spark, ROOT)) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "timestamp", "value", "aggregation", "granularity"]
    assert df.count() > 0


def plan(df, mode="formatted"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_filters_and_columns_reach_the_files(spark):
    text = plan(QUERIES["filter_range"](spark, ROOT))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp>" in text


def test_time_range_reaches_the_files(spark):
    text = plan(QUERIES["multi_agg"](spark, ROOT))
    assert "GreaterThanOrEqual(ts,2024-01-02 06:00:00" in text and "LessThan(ts,2024-01-28 18:00:00" in text
    assert "ReadSchema: struct<ts:timestamp,user_id:bigint,value:double>" in text


@pytest.mark.parametrize(
    "name", ["multi_agg", "agg_total_variation", "agg_interpolation", "edge_endpoints", "merge_upsert", "delete_ranges_swept"]
)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, ROOT))
    assert "Python" not in text and "Cartesian" not in text


def test_one_shuffle_for_plain_aggregates(spark):
    assert plan(QUERIES["multi_agg"](spark, ROOT), "simple").count("Exchange") == 1


def test_small_sources_leave_the_target_unshuffled(spark):
    from plantframe.operators.merge import merge
    from plantframe.operators.series_writes import upsert_points
    from plantframe.sources.star import Star

    star = Star(spark, ROOT)
    points = star.catalog.scan("datapoints").select("id", "timestamp", "value")
    change = spark.createDataFrame([(1, 2.0)], "id long, value double").selectExpr("id", "timestamp'2024-01-01' as timestamp", "value")
    assert "Exchange hashpartitioning" not in plan(upsert_points(points, change), "simple")
    event = spark.createDataFrame([("order-1", "t"), ("new", "t")], "externalId string, type string")
    result = merge(star.catalog.scan("events"), event, "events", "upsert")
    text = plan(result.table, "simple")
    assert "BroadcastHashJoin" in text
    # The part before the ids of the new rows is the target with its updates.
    assert "Exchange hashpartitioning" not in text.split("Subquery")[0]
    assert result.table.count() == star.catalog.scan("events").count() + 1
