from datetime import datetime, timedelta, timezone
from random import Random

import pytest
from pyspark.sql import functions as F

from plantframe import PlantError
from plantframe.functions.granularity import UNIT_SECONDS, parse_all, to_micros
from plantframe.operators import datapoints as dpm
from plantframe.operators.datapoints import aggregate_datapoints, datapoints, first_rows, page_after

T0 = datetime(2022, 9, 1)


def points(spark, data):
    return spark.createDataFrame(data, "id long, externalId string, timestamp timestamp, value double")


@pytest.mark.parametrize("unit", UNIT_SECONDS)
def test_good_granularities(unit):
    assert to_micros(unit) == to_micros(f"1{unit}") == UNIT_SECONDS[unit] * 1_000_000
    assert [to_micros(f"{n}{unit}") for n in (4, 17, 250)] == [n * to_micros(unit) for n in (4, 17, 250)]


@pytest.mark.parametrize("unit", UNIT_SECONDS)
def test_bad_granularities(unit):
    for text in f"0{unit}", f"04{unit}", f"-3{unit}", f"2.5{unit}", f"{unit}6", f"{unit}x", f"3 {unit}", "", "5":
        with pytest.raises(PlantError):
            to_micros(text)


def test_all_granularity_errors_are_reported():
    with pytest.raises(PlantError, match=r"(?s)1\.2d.*dd"):
        parse_all(["1.2d", "1h", "dd"])


def test_request_errors(spark):
    dp = points(spark, [])
    for aggregations, granularities in ([], ["1d"]), (["max"], []), (["median"], ["1d"]), ([], []):
        with pytest.raises(PlantError):
            aggregate_datapoints(dp, aggregations, granularities)
    with pytest.raises(PlantError, match="id or externalId"):
        datapoints(dp)
    with pytest.raises(PlantError, match="before 1970"):
        datapoints(dp, ids=[1], start="1969-12-31")


@pytest.mark.parametrize("closed", ["left", "right", "neither", "both"])
def test_open_and_closed_ranges(spark, closed):
    end = T0 + timedelta(minutes=60)
    data = [(1, "pump", T0 + timedelta(minutes=10 * i), float(i)) for i in range(-1, 8)]
    found = datapoints(points(spark, data), external_ids=["pump"], start=str(T0), end=str(end), closed=closed)
    low, high = (0 if closed in ("left", "both") else 1), (6 if closed in ("right", "both") else 5)
    assert sorted(r.value for r in found.collect()) == [float(i) for i in range(low, high + 1)]
    assert all(r.id is None and r.externalId == "pump" for r in found.collect())


def test_open_ends_add_no_limit(spark):
    data = [(1, "a", datetime(y, 5, 1), float(y)) for y in (1850, 1999, 2150)]
    assert sorted(r.value for r in datapoints(points(spark, data), ids=[1]).collect()) == [1850.0, 1999.0, 2150.0]
    counted = aggregate_datapoints(points(spark, data), ["count", "interpolation"], ["1d"]).filter("aggregation = 'count'")
    assert counted.count() == 3


def test_first_rows_is_one_rule(spark, monkeypatch):
    data = [(1, "a", t, v) for t in (None, T0, T0, T0 + timedelta(hours=3)) for v in (2.0, 1.0)] + [(None, "b", T0, 5.0)]
    frame = points(spark, data).repartition(4)
    for n in 1, 3, 5, 200:
        ranked = sorted(map(repr, first_rows(frame, ["id"], n).collect()))
        monkeypatch.setattr(dpm, "GROUP_LIMIT", 0)
        assert sorted(map(repr, first_rows(frame, ["id"], n).collect())) == ranked
        monkeypatch.undo()


def test_bucket_start_decides_and_values_cover_the_bucket(spark):
    hours = [(1, "a", datetime.fromtimestamp(1509490000 + 3600 * i, timezone.utc), float(i)) for i in range(300)]
    found = aggregate_datapoints(
        points(spark, hours), ["max"], ["1d"],
        start=datetime.fromtimestamp(1509490001, timezone.utc), end=datetime.fromtimestamp(1510358400, timezone.utc), closed="both",
    )
    starts = sorted(r.timestamp for r in found.collect())
    assert len(starts) == 11
    assert starts[0].replace(tzinfo=timezone.utc).timestamp() == 1509494400
    # The last bucket starts at the end of the range and still covers its whole day.
    last = max(found.collect(), key=lambda r: r.timestamp)
    assert last.value == max(i for _, _, t, i in hours if t.timestamp() < 1510358400 + 86400)


def test_sixty_day_buckets_are_aligned_to_the_epoch(spark):
    days = [(1, "a", datetime.fromtimestamp(1514592000 + 86400 * i, timezone.utc), 1.0) for i in range(330)]
    found = aggregate_datapoints(
        points(spark, days), ["average"], ["60d"], start=datetime.fromtimestamp(1514592000, timezone.utc),
        end=datetime.fromtimestamp(1514592000 + 330 * 86400, timezone.utc),
    )
    starts = sorted(r.timestamp.replace(tzinfo=timezone.utc).timestamp() for r in found.collect())
    assert starts[0] == 1518912000 and len(starts) == 5


def test_unknown_series_and_empty_buckets(spark):
    dp = points(spark, [(1, "a", T0, 1.0), (1, "a", T0 + timedelta(hours=5), 2.0)])
    assert datapoints(dp, ids=[99]).count() == 0
    assert aggregate_datapoints(dp, ["count"], ["1h"]).count() == 2


def random_points(seed, series=3, n=400, hot=True):
    random = Random(seed)
    data = {}
    for _ in range(n):
        key = 1 if hot and random.random() < 0.5 else random.randint(1, series)
        moment = T0 + timedelta(milliseconds=random.randint(0, 4 * 86400 * 1000) // 1000 * 250)
        data[key, moment] = round(random.uniform(-50, 50), 2)
    return [(k, f"s{k}", t, v) for (k, t), v in data.items()]


def brute(data, size, name, step):
    """Straightforward definitions over sorted lists."""
    epoch = datetime(1970, 1, 1)
    out = {}
    for key in {d[0] for d in data}:
        mine = sorted((int((t - epoch).total_seconds() * 1e6 + 0.5), v) for k, _, t, v in data if k == key)
        for b in sorted({t - t % size for t, _ in mine}):
            inside = [(t, v) for t, v in mine if b <= t < b + size]
            values = [v for _, v in inside]
            pairs = list(zip(inside, inside[1:]))
            left = [p for p in mine if p[0] <= b]
            right = [p for p in mine if p[0] > b]
            mean = sum(values) / len(values)
            if name == "totalVariation":
                out[key, b] = sum(abs(q[1] - p[1]) for p, q in pairs)
            elif name == "discreteVariance":
                out[key, b] = sum((v - mean) ** 2 for v in values) / len(values)
            elif name == "average":
                out[key, b] = mean
            elif name == "count":
                out[key, b] = len(values)
            elif name == "continuousVariance":
                total = sum(q[0] - p[0] for p, q in pairs)
                if not total:
                    out[key, b] = 0.0
                    continue
                if step:
                    e1 = sum((q[0] - p[0]) * p[1] for p, q in pairs) / total
                    e2 = sum((q[0] - p[0]) * p[1] ** 2 for p, q in pairs) / total
                else:
                    e1 = sum((q[0] - p[0]) * (p[1] + q[1]) / 2 for p, q in pairs) / total
                    e2 = sum((q[0] - p[0]) * (p[1] ** 2 + p[1] * q[1] + q[1] ** 2) / 3 for p, q in pairs) / total
                out[key, b] = e2 - e1 * e1
            elif left:
                p = left[-1]
                if name == "stepInterpolation" or step or p[0] == b:
                    out[key, b] = p[1]
                else:
                    q = right[0]
                    out[key, b] = p[1] + (q[1] - p[1]) * (b - p[0]) / (q[0] - p[0])
    return out


NAMES = ["totalVariation", "continuousVariance", "discreteVariance", "average", "count", "interpolation", "stepInterpolation"]


@pytest.mark.parametrize("step", [False, True])
@pytest.mark.parametrize("slice_micros, run", [(3_600_000_000, 100_000), (600_000_000, 2)])
def test_against_brute_force(spark, monkeypatch, step, slice_micros, run):
    """Small slices cut every bucket, and short runs cut the chain of buckets."""
    monkeypatch.setattr(dpm, "BUCKETS_PER_RUN", run)
    data = random_points(7)
    found = aggregate_datapoints(points(spark, data), NAMES, ["6h", "25m"], is_step=step, slice_micros=slice_micros)
    got = {
        (r.granularity, r.aggregation, r.id, int(r.timestamp.replace(tzinfo=timezone.utc).timestamp()) * 10**6): r.value
        for r in found.collect()
    }
    expected = {
        (g, name, *place): value
        for g in ("6h", "25m")
        for name in NAMES
        for place, value in brute(data, to_micros(g), name, step).items()
    }
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value, abs=1e-6), key


def test_interpolation_looks_before_the_range(spark, monkeypatch):
    monkeypatch.setattr(dpm, "BUCKETS_PER_RUN", 2)
    data = random_points(11)
    start = T0 + timedelta(days=1)
    names = ["interpolation", "totalVariation"]
    whole = aggregate_datapoints(points(spark, data), names, ["3h"]).filter(F.col("timestamp") >= F.lit(start))
    part = aggregate_datapoints(points(spark, data), names, ["3h"], start=str(start))
    key = lambda r: (r.id, r.aggregation, r.timestamp)
    assert {key(r): round(r.value, 6) for r in whole.collect()} == {key(r): round(r.value, 6) for r in part.collect()}


@pytest.mark.parametrize("limit", [1000, 3])
def test_first_rows_per_series(spark, monkeypatch, limit):
    monkeypatch.setattr(dpm, "GROUP_LIMIT", limit)
    data = random_points(3)
    expected = sorted(
        d for key in {d[0] for d in data} for d in sorted([d for d in data if d[0] == key], key=lambda d: d[2])[:20]
    )
    assert sorted(tuple(r) for r in first_rows(points(spark, data), ["id"], 20).collect()) == expected


def test_page_starts_one_millisecond_later(spark):
    dp = points(spark, [(1, "a", T0 + timedelta(microseconds=500 * i), float(i)) for i in range(6)])
    assert sorted(r.value for r in page_after(dp, str(T0), 2).collect()) == [2.0, 3.0]


@pytest.mark.parametrize("limits", [{}, {"start": "2022-09-01 05:00", "end": "2022-09-03 07:30"}])
def test_granularities_together_are_those_alone(spark, limits):
    rng = Random(3)
    data = [(i, f"s{i}", T0 + timedelta(seconds=rng.randint(0, 260_000)), rng.uniform(-9, 9)) for i in (1, 2) for _ in range(400)]
    dp = points(spark, list({(i, t): (i, n, t, v) for i, n, t, v in data}.values())).withColumn("step", F.col("id") == 2)
    sizes = ["90s", "2h", "1d", "day", "20h", "7m"]

    def rows(granularities):
        found = aggregate_datapoints(dp, dpm.AGGREGATES, granularities, is_step="step", slice_micros=1_800_000_000, **limits).collect()
        return {(r.id, r.timestamp, r.aggregation, r.granularity): r.value for r in found}

    together, alone = rows(sizes), {}
    for size in sizes:
        alone |= rows([size])
    assert together.keys() == alone.keys() and len(together) > 5000
    assert all(together[k] == pytest.approx(alone[k], abs=1e-9) for k in alone)


def test_points_are_not_multiplied_before_the_shuffle(spark):
    from test_queries import plan

    text = plan(aggregate_datapoints(points(spark, []), ["average", "max"], ["2h", "1d", "1w"]), "simple")
    scan_side = text[text.rindex("Exchange") :]
    assert "Generate" not in scan_side and "explode" not in scan_side and "partial_max" in scan_side
    assert text.count("Scan ExistingRDD") == 1
