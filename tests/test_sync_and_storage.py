import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plantframe import PlantError, cut_lineage
from plantframe.operators.datapoints import aggregate_datapoints
from plantframe.operators.sync import apply_changes, format_cursor, load_cursor, parse_cursor, save_cursor, sync
from plantframe.sources.catalog import Catalog
from plantframe.sources.files import file_sizes, limit_errors, read_file_content
from plantframe.sources.sink import read_points, upsert_points_at, write_points, write_table
from plantframe.streaming.downsample import read_corrected, stream_aggregates, stream_corrected, stream_to_table, stream_upserts

T0 = dt.datetime(2024, 1, 1)
FEED = "id long, lastUpdatedTime timestamp, v int"


def feed(spark, n=10):
    # Three rows share every time stamp.
    return spark.createDataFrame([(i, T0 + dt.timedelta(seconds=i // 3), i) for i in range(n)], FEED)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_sync_resumes_between_equal_times(spark):
    table = feed(spark)
    rows, cursor = sync(table)
    assert ids(rows) == list(range(10)) and parse_cursor(cursor)[1] == "9"
    middle = format_cursor(parse_cursor(cursor)[0] - 2_000_000, 4)
    later, following = sync(table, middle)
    assert ids(later) == [5, 6, 7, 8, 9] and following == cursor
    assert {r["metadata.cursor"] for r in later.collect()} == {cursor}
    nothing, same = sync(table, cursor)
    assert ids(nothing) == [] and same == cursor
    more = table.unionByName(spark.createDataFrame([(50, T0 + dt.timedelta(seconds=3), 0), (60, T0 + dt.timedelta(hours=1), 0)], FEED))
    assert ids(sync(more, cursor)[0]) == [50, 60]


def test_sync_limits(spark):
    table = feed(spark)
    until = T0 + dt.timedelta(seconds=2)
    assert ids(sync(table, until=until)[0]) == [0, 1, 2, 3, 4, 5]
    old = format_cursor(0, 0)
    assert ids(sync(table, format_cursor(int((T0 + dt.timedelta(seconds=2)).replace(tzinfo=dt.timezone.utc).timestamp()) * 10**6, 7), retained_since=T0 + dt.timedelta(days=1))[0]) == list(range(10))
    assert ids(sync(table, old, where="v > 7")[0]) == [8, 9]
    assert sync(table.limit(0)) [1] is None


def test_changes_apply_latest_per_key(spark, rows):
    target = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id long, v int")
    changes = spark.createDataFrame([(1, 11, T0, 0), (1, 12, T0 + dt.timedelta(seconds=1), None), (2, 0, T0, 5), (9, 90, T0, 0), (8, 80, T0, 3)],
                                    "id long, v int, lastUpdatedTime timestamp, deletedTime long")
    assert rows(apply_changes(target, changes, ["id"])) == [(1, 12), (3, 30), (9, 90)]


def test_cursor_storage_never_fails_a_job(spark, tmp_path):
    path = str(tmp_path / "cursors")
    assert save_cursor(spark, path, "job", "1:a") and save_cursor(spark, path, "job", "2:b") and save_cursor(spark, path, "other", "x:y")
    assert load_cursor(spark, path, "job") == "2:b"
    (tmp_path / "file").write_text("not a folder")
    assert save_cursor(spark, str(tmp_path / "file"), "job", "3:c") is False


POINTS = "id long, timestamp timestamp, value double"


def test_points_on_disk(spark, tmp_path, rows):
    path = str(tmp_path / "points")
    first = spark.createDataFrame([(i % 2, T0 + dt.timedelta(hours=i), float(i)) for i in range(60)], POINTS)
    write_points(first, path)
    before = {r.day: r.n for r in read_points(spark, path).groupBy("day").agg(F.count("*").alias("n")).collect()}
    untouched = sorted((tmp_path / "points" / "day=2024-01-03").iterdir())
    change = spark.createDataFrame([(0, T0, -1.0), (7, T0 + dt.timedelta(hours=30), 7.0)], POINTS)
    for _ in range(2):  # again with the same rows
        upsert_points_at(spark, path, change)
    found = read_points(spark, path)
    assert found.count() == 61 and found.filter("value = -1").count() == 1 and len(before) == 3
    assert sorted((tmp_path / "points" / "day=2024-01-03").iterdir()) == untouched
    with pytest.raises(Exception, match="(?i)exists"):
        write_points(first, path)


def test_catalog_over_a_folder(spark, tmp_path):
    labels = spark.createDataFrame([("a", "A"), ("b", "B")], "externalId string, name string")
    write_table(labels, str(tmp_path / "labels"))
    catalog = Catalog.from_directory(spark, str(tmp_path), ["labels"])
    assert catalog.scan("labels", where="name = 'A'").first().externalId == "a"
    assert catalog.scan("labels").columns == ["externalId", "name", "description", "createdTime", "dataSetId"]
    catalog.register_views("my_")
    assert spark.sql("select count(*) as n from my_labels").first().n == 2
    with pytest.raises(PlantError, match="Unknown resource"):
        catalog.scan("nothing")


def test_file_content(spark, tmp_path):
    lines = [{"name": "a", "age": 1}, {"name": "b", "age": 2, "test": "test"}, {"name": "c", "test": ["x"]}]
    (tmp_path / "f.jsonl").write_text("\n".join(json.dumps(x) for x in lines))
    path = str(tmp_path / "f.jsonl")
    found = read_file_content(spark, path)
    assert found.dtypes == [("age", "bigint"), ("name", "string"), ("test", "string")] and found.count() == 3
    assert read_file_content(spark, path, infer_schema=False).columns == ["value"]
    assert limit_errors(spark, path).count() == 0
    size = file_sizes(spark, path).first().bytes
    assert [r.error for r in limit_errors(spark, path, file_limit=size - 1).collect()] == [f"file is larger than {size - 1} bytes"]
    assert [r.error for r in limit_errors(spark, path, line_limit=30).collect()] == ["line is longer than 30 characters"]


def test_late_points_are_dropped_from_streams(spark, tmp_path):
    source = tmp_path / "in"
    batches = [[(1, T0, 1.0), (1, T0 + dt.timedelta(hours=5), 2.0)], [(1, T0 + dt.timedelta(minutes=1), 50.0), (1, T0 + dt.timedelta(hours=9), 3.0)], [(1, T0 + dt.timedelta(hours=20), 4.0)]]
    out = str(tmp_path / "out")
    for batch in batches:
        spark.createDataFrame(batch, POINTS).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(POINTS).parquet(str(source))
        rows = stream_aggregates(stream, ["sum", "count"], "1h", "30 minutes")
        stream_to_table(rows, out, str(tmp_path / "check")).awaitTermination()
    found = {(r.timestamp.hour, r.aggregation): r.value for r in spark.read.parquet(out).collect()}
    assert found == {(0, "sum"): 1.0, (0, "count"): 1.0, (5, "sum"): 2.0, (5, "count"): 1.0, (9, "sum"): 3.0, (9, "count"): 1.0}
    with pytest.raises(PlantError):
        stream_aggregates(stream, ["interpolation"], "1h", "1 hour")


def test_stream_upserts(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "points")
    for value in (1.0, 2.0):
        spark.createDataFrame([(1, T0, value), (2, T0 + dt.timedelta(days=value), value)], POINTS).write.mode("append").parquet(source)
        stream_upserts(spark.readStream.schema(POINTS).parquet(source), path, str(tmp_path / "check")).awaitTermination()
    assert sorted((r.id, r.value) for r in read_points(spark, path).collect()) == [(1, 2.0), (2, 1.0), (2, 2.0)]


def test_cut_lineage_keeps_types(spark):
    df = spark.createDataFrame([(1, T0, [1], {"a": "b"}, (2,))], "a.b int, t timestamp, l array<int>, m map<string,string>, s struct<x:int>".replace("a.b", "`a.b`"))
    again = cut_lineage(df)
    assert again.schema == df.schema and again.collect() == df.collect()


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_late_points_correct_streamed_buckets(spark, rows, tmp_path, order):
    start = dt.datetime(2024, 1, 3, 23, 30)
    data = [(i % 2, start + dt.timedelta(minutes=37 * i), float(i * i % 17)) for i in range(90)]
    parts = [data[0::3], data[1::3], [*data[2::3], (None, start, 1.0), (1, None, 1.0)]]
    source, path, kinds, sizes = str(tmp_path / "source"), str(tmp_path), ["count", "sum", "max", "totalVariation", "continuousVariance"], ["1h", "1d", "2w"]
    for i in order:  # a file a run, each run goes on from the checkpoint
        spark.createDataFrame(parts[i], POINTS).coalesce(1).write.mode("append").parquet(source)
        stream_corrected(spark.readStream.schema(POINTS).parquet(source), path, f"{path}/check", kinds, sizes).awaitTermination()
    whole = aggregate_datapoints(spark.createDataFrame(data, POINTS), kinds, sizes)
    columns = ["id", "timestamp", "aggregation", "granularity", F.round("value", 6).alias("value")]
    assert rows(read_corrected(spark, path), *columns) == rows(whole, *columns)
    with pytest.raises(PlantError, match="interpolation"):
        stream_corrected(None, path, path, ["interpolation"], ["1h"])


def test_a_first_batch_that_died_is_repeated(spark, tmp_path):
    (tmp_path / "points" / "_temporary").mkdir(parents=True)
    source, path = str(tmp_path / "source"), str(tmp_path / "points")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 2.0)], POINTS).write.parquet(source)
    stream_upserts(spark.readStream.schema(POINTS).parquet(source), path, str(tmp_path / "check")).awaitTermination()
    assert read_points(spark, path).count() == 1
