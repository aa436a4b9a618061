import io
from contextlib import redirect_stdout
from random import Random

import oracle
import pytest

import __spark_entry__ as entry
from plantframe.operators import intervals, skew

from plantframe.operators.intervals import complement_intervals, intersect_intervals, merge_intervals

SCHEMA = "g string, start long, end long"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def random_spans(seed, n=120, top=300):
    random = Random(seed)
    spans = []
    for _ in range(n):
        start = random.randint(0, top)
        # Half of the rows are in one group, and many start at the same place.
        spans.append(("a" if random.random() < 0.5 else random.choice("bc"), random.choice([start, 7]), start + random.randint(-2, 9)))
    return spans


def covered(spans, group=None):
    return {x for g, s, e in spans if group in (None, g) for x in range(s, e)}


def runs(numbers):
    out = []
    for x in sorted(numbers):
        if out and out[-1][1] == x:
            out[-1][1] = x + 1
        else:
            out.append([x, x + 1])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("slices", [None, 2, 9])
def test_merge(spark, slices):
    spans = random_spans(1)
    found = merge_intervals(table(spark, spans), by=["g"], slices=slices).collect()
    for group in "abc":
        assert sorted((r.start, r.end) for r in found if r.g == group) == runs(covered(spans, group))
    together = merge_intervals(table(spark, spans), slices=slices).collect()
    assert sorted(map(tuple, together)) == runs(covered(spans))


@pytest.mark.parametrize("slices", [None, 2, 9])
def test_intersect(spark, slices):
    left, right = random_spans(2, 40), random_spans(3, 40)
    found = intersect_intervals(table(spark, left), table(spark, right), by=["g"], slices=slices).collect()
    for group in "abc":
        assert sorted((r.start, r.end) for r in found if r.g == group) == runs(covered(left, group) & covered(right, group))


@pytest.mark.parametrize("slices", [None, 2, 9])
def test_complement(spark, slices):
    spans = random_spans(4, 60)
    found = complement_intervals(table(spark, spans), low=5, high=250, slices=slices).collect()
    assert sorted(map(tuple, found)) == runs(set(range(5, 250)) - covered(spans))


def test_complement_twice_is_the_union(spark):
    spans = table(spark, random_spans(5))
    twice = complement_intervals(complement_intervals(spans, by=["g"]), by=["g"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, merge_intervals(spans, by=["g"]).collect()))


def test_unbounded_ends_and_empty_tables(spark):
    half = spark.createDataFrame([(None, 3), (8, None), (4, 4)], "start long, end long")
    assert [tuple(r) for r in complement_intervals(half).collect()] == [(3, 8)]
    none = half.limit(0)
    assert [tuple(r) for r in complement_intervals(none).collect()] == [(None, None)]
    assert merge_intervals(none).count() == 0


LINES = "l_suppkey long, l_partkey long, l_quantity double, l_returnflag string"


def lines_differ(spark, tmp_path, name, lines):
    """How a query over these order lines differs from its SQL."""
    spark.createDataFrame(lines, LINES).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    con = oracle.connect(str(tmp_path))
    con.execute(f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    return oracle.compare(con, entry.oracle_sql()[name], entry.queries()[name](spark, str(tmp_path)))


def test_gaps_beyond_the_last_part_number_are_kept(spark, tmp_path):
    """Larger tables hold part numbers of 100,000 and more, where a supplier's gaps were cut off."""
    lines = [(1, 5, 3.0, "R"), (1, 99_999, 4.0, "A"), (1, 100_010, 2.0, "N"), (2, 250_000, 1.0, "R"), (2, 250_004, 1.0, "R"), (3, 0, 9.0, "A")]
    assert lines_differ(spark, tmp_path, "interval_complement", lines) is None


@pytest.mark.parametrize("slices", [None, 3])
def test_null_is_a_group_like_others(spark, slices):
    spans = table(spark, [(None, 1, 4), (None, 3, 6), ("a", 2, 3), (None, 8, 9)])
    assert sorted(map(tuple, merge_intervals(spans, by=["g"], slices=slices).collect()), key=str) == [("a", 2, 3), (None, 1, 6), (None, 8, 9)]
    both = intersect_intervals(spans, spans, by=["g"], slices=slices).collect()
    assert sorted(map(tuple, both), key=str) == [("a", 2, 3), (None, 1, 6), (None, 8, 9)]


def test_groups_that_are_not_hot_are_dealt_once(spark):
    spans = table(spark, random_spans(6))
    for found in (merge_intervals(spans, by=["g"]), intersect_intervals(spans, spans, by=["g"])):
        out = io.StringIO()
        with redirect_stdout(out):
            found.explain("simple")
        assert out.getvalue().count("Exchange") == 1


def test_hot_groups_are_cut_into_slices(spark, monkeypatch):
    monkeypatch.setattr(intervals, "has_hot_key", lambda *_: (1_000, True))
    spans = random_spans(7)
    for size in (10, 10**6):
        monkeypatch.setattr(skew, "SLICE_ROWS", size)
        found = merge_intervals(table(spark, spans), by=["g"]).collect()
        for group in "abc":
            assert sorted((r.start, r.end) for r in found if r.g == group) == runs(covered(spans, group))


def test_intervals_travel_whole(spark):
    """Steps are made where intervals arrive: one row of an interval is sent, not two."""
    frame = spark.createDataFrame([(1, 0, 5), (1, 3, 9), (2, 4, 6)], "supplier int, start long, end long")
    plan = intersect_intervals(frame, frame, by=["supplier"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RepartitionByExpression")
