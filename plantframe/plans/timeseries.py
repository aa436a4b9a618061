"""Downsampling and paging of data points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.datapoints import aggregate_datapoints, first_latest, first_rows, page_after
from ..sources.star import Star
from .oracle import with_views
from .registry import query


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumn("value", F.round("value", digits))


def _bucket(us: int, column: str = "us") -> str:
    return f"({column} - {column} % {us}::BIGINT)"


H6, H12 = 21_600_000_000, 43_200_000_000
DAY = 86_400_000_000


def plain_sql(aggregations: dict[str, str], granularity: str, us: int, where: str = "true", digits: int = 6) -> str:
    """Plain aggregates in long form."""
    columns = ", ".join(f"({e})::DOUBLE AS {n}" for n, e in aggregations.items())
    parts = " UNION ALL ".join(
        f"SELECT id, timestamp, round({n}, {digits}) AS value, '{n}' AS aggregation, '{granularity}' AS granularity FROM g"
        for n in aggregations
    )
    return f"""
    SELECT * FROM (
        WITH g AS (SELECT id, make_timestamp({_bucket(us)}) AS timestamp, {columns} FROM dp GROUP BY ALL) {parts})
    WHERE {where}"""


def _single(df: DataFrame) -> DataFrame:
    """Values in single precision, which two ways of summing the same numbers agree on."""
    return df.withColumn("value", F.round("value", 9).cast("float").cast("double"))


PLAIN_SQL = {
    "count": "count(*)",
    "sum": "sum(value)",
    "min": "min(value)",
    "max": "max(value)",
    "average": "avg(value)",
    "discreteVariance": "var_pop(value)",
}
FIVE = ["count", "sum", "min", "max", "average"]


@query(
    "multi_agg",
    with_views("dp")
    + plain_sql(
        {a: PLAIN_SQL[a] for a in FIVE}, "6h", H6,
        "timestamp >= TIMESTAMP '2024-01-02 03:00:00' AND timestamp <= TIMESTAMP '2024-01-28 12:00:00'",
    ),
)
def multi_agg(s: Star) -> DataFrame:
    points = s.catalog.scan("datapoints")
    return rounded(
        aggregate_datapoints(points, FIVE, ["6h"], start="2024-01-02 03:00:00", end="2024-01-28 12:00:00", closed="both")
    )


@query(
    "agg_count_sum_min_max",
    with_views("dp") + plain_sql({a: PLAIN_SQL[a] for a in ("count", "sum", "min", "max")}, "1d", DAY),
)
def agg_count_sum_min_max(s: Star) -> DataFrame:
    return rounded(aggregate_datapoints(s.catalog.scan("datapoints"), ["count", "sum", "min", "max"], ["1d"]))


@query("agg_average", with_views("dp") + plain_sql({"average": PLAIN_SQL["average"]}, "60d", 60 * DAY))
def agg_average(s: Star) -> DataFrame:
    return rounded(aggregate_datapoints(s.catalog.scan("datapoints"), ["average"], ["60d"]))


@query(
    "agg_discrete_variance",
    with_views("dp")
    + "SELECT * REPLACE (value::FLOAT::DOUBLE AS value) FROM ("
    + plain_sql({"discreteVariance": PLAIN_SQL["discreteVariance"]}, "12h", H12, digits=9)
    + ")",
)
def agg_discrete_variance(s: Star) -> DataFrame:
    return _single(aggregate_datapoints(s.catalog.scan("datapoints"), ["discreteVariance"], ["12h"]))


FORMS = {
    "1d": 86400, "day": 86400, "h": 3600, "hour": 3600, "m": 60, "minute": 60, "1hour": 3600, "2h": 7200,
    "20d": 1728000, "13day": 1123200, "7m": 420, "7minute": 420, "w": 604800, "2week": 1209600, "90s": 90,
    "second": 1,
}


@query(
    "granularity_forms",
    with_views("dp")
    + ",\nforms(granularity, us) AS (VALUES "
    + ", ".join(f"('{k}', {v}000000::BIGINT)" for k, v in FORMS.items())
    + """)
    SELECT granularity, count(*) AS buckets, min(b) AS first, round(sum(n), 4) AS points
    FROM (SELECT granularity, id, make_timestamp(us - us % f) AS b, count(*)::DOUBLE AS n
          FROM (SELECT dp.id, dp.us, granularity, forms.us AS f FROM dp, forms) GROUP BY ALL)
    GROUP BY granularity""",
)
def granularity_forms(s: Star) -> DataFrame:
    long = aggregate_datapoints(s.catalog.scan("datapoints"), ["count"], list(FORMS))
    return long.groupBy("granularity").agg(
        F.count(F.lit(1)).alias("buckets"), F.min("timestamp").alias("first"), F.round(F.sum("value"), 4).alias("points")
    )


@query(
    "multi_granularity",
    with_views("dp")
    + "SELECT * FROM ("
    + plain_sql({a: PLAIN_SQL[a] for a in ("average", "max")}, "1d", DAY)
    + ") UNION ALL SELECT * FROM ("
    + plain_sql({a: PLAIN_SQL[a] for a in ("average", "max")}, "2h", 7_200_000_000)
    + ")",
)
def multi_granularity(s: Star) -> DataFrame:
    return rounded(aggregate_datapoints(s.catalog.scan("datapoints"), ["average", "max"], ["1d|2h"]))


def _ordered_sql(expression: str, name: str, granularity: str, us: int, digits: int) -> str:
    """An aggregate over neighbouring points of one bucket."""
    return f""",
    n AS (SELECT id, isStep, us, value, {_bucket(us)} AS b,
                 lag(us) OVER w AS us0, lag(value) OVER w AS v0
          FROM dp WINDOW w AS (PARTITION BY id, {_bucket(us)} ORDER BY us)),
    seg AS (SELECT *, (us - us0) / 1e6 AS dt,
                   CASE WHEN isStep THEN (us - us0) / 1e6 * v0 ELSE (us - us0) / 1e6 * (v0 + value) / 2 END AS i1,
                   CASE WHEN isStep THEN (us - us0) / 1e6 * v0 * v0
                        ELSE (us - us0) / 1e6 * (v0 * v0 + v0 * value + value * value) / 3 END AS i2
            FROM n)
    SELECT id, make_timestamp(b) AS timestamp, round({expression}, {digits}) AS value, '{name}' AS aggregation,
           '{granularity}' AS granularity
    FROM seg GROUP BY id, b"""


@query(
    "agg_total_variation",
    with_views("dp") + _ordered_sql("coalesce(sum(abs(value - v0)), 0)", "totalVariation", "6h", H6, 6),
)
def agg_total_variation(s: Star) -> DataFrame:
    return rounded(aggregate_datapoints(s.catalog.scan("datapoints"), ["totalVariation"], ["6h"]))


@query(
    "agg_continuous_variance",
    with_views("dp")
    + _ordered_sql(
        "CASE WHEN sum(dt) > 0 THEN sum(i2) / sum(dt) - (sum(i1) / sum(dt)) * (sum(i1) / sum(dt)) ELSE 0 END",
        "continuousVariance", "12h", H12, 4,
    ),
)
def agg_continuous_variance(s: Star) -> DataFrame:
    points = s.catalog.scan("datapoints").withColumn("isStep", F.col("id") % 2 == 0)
    return rounded(aggregate_datapoints(points, ["continuousVariance"], ["12h"], is_step="isStep"), 4)


def _interpolated_sql(us: int, granularity: str, step: bool, name: str, where: str = "true") -> str:
    """Value at the start of every bucket with points, from the neighbours on both sides."""
    straight = "l.v + (r.v - l.v) * ((b - l.us) / (r.us - l.us))"
    value = "l.v" if step else f"CASE WHEN isStep OR l.us = b THEN l.v ELSE {straight} END"
    return f""",
    buckets AS (SELECT DISTINCT id, isStep, {_bucket(us)} AS b FROM dp),
    sides AS (
        SELECT k.id, k.isStep, k.b,
               (SELECT max({{'us': us, 'v': value}}) FROM dp WHERE dp.id = k.id AND dp.us <= k.b) AS l,
               (SELECT min({{'us': us, 'v': value}}) FROM dp WHERE dp.id = k.id AND dp.us > k.b) AS r
        FROM buckets k)
    SELECT id, make_timestamp(b) AS timestamp, round({value}, 6) AS value, '{name}' AS aggregation,
           '{granularity}' AS granularity
    FROM sides WHERE l IS NOT NULL AND {where}"""


@query(
    "agg_step_interpolation",
    with_views("dp") + _interpolated_sql(H12, "12h", True, "stepInterpolation"),
)
def agg_step_interpolation(s: Star) -> DataFrame:
    return rounded(aggregate_datapoints(s.catalog.scan("datapoints"), ["stepInterpolation"], ["12h"]))


@query(
    "agg_interpolation",
    with_views("dp") + _interpolated_sql(H12, "12h", False, "interpolation"),
)
def agg_interpolation(s: Star) -> DataFrame:
    points = s.catalog.scan("datapoints").withColumn("isStep", F.col("id") % 2 == 0)
    return rounded(aggregate_datapoints(points, ["interpolation"], ["12h"], is_step="isStep"))


@query(
    "agg_interpolation_range",
    with_views("dp")
    + _interpolated_sql(
        DAY, "1d", False, "interpolation", "make_timestamp(b) >= TIMESTAMP '2024-01-10' AND make_timestamp(b) < TIMESTAMP '2024-01-25'"
    ),
)
def agg_interpolation_range(s: Star) -> DataFrame:
    """The left neighbour of the first bucket lies before the range."""
    points = s.catalog.scan("datapoints").withColumn("isStep", F.col("id") % 2 == 0)
    return rounded(
        aggregate_datapoints(points, ["interpolation"], ["1d"], start="2024-01-10", end="2024-01-25", is_step="isStep")
    )


_TWO = (("6h", H6), ("1d", DAY))


@query(
    "agg_rollup",
    "SELECT * REPLACE (value::FLOAT::DOUBLE AS value) FROM ("
    + " UNION ALL ".join(
        f"SELECT * FROM ({with_views('dp')} {part})"
        for g, us in _TWO
        for part in (
            _ordered_sql("coalesce(sum(abs(value - v0)), 0)", "totalVariation", g, us, 9),
            plain_sql({"discreteVariance": PLAIN_SQL["discreteVariance"]}, g, us, digits=9),
            _interpolated_sql(us, g, True, "stepInterpolation"),
        )
    )
    + ")",
)
def agg_rollup(s: Star) -> DataFrame:
    """Aggregates of every kind at two granularities from the same states."""
    wanted = ["totalVariation", "discreteVariance", "stepInterpolation"]
    return _single(aggregate_datapoints(s.catalog.scan("datapoints"), wanted, ["6h|1d"]))


@query(
    "first_latest",
    with_views("dp")
    + """
    SELECT id, min(timestamp) AS firstTimestamp, arg_min(value, timestamp) AS firstValue,
           max(timestamp) AS latestTimestamp, arg_max(value, timestamp) AS latestValue
    FROM dp WHERE timestamp >= TIMESTAMP '2024-01-03' GROUP BY id""",
)
def first_latest_query(s: Star) -> DataFrame:
    return first_latest(s.catalog.scan("datapoints"), start="2024-01-03")


@query(
    "count_consistency",
    with_views("dp") + "SELECT id, count(*) AS raw, count(*)::DOUBLE AS bucketed FROM dp GROUP BY id",
)
def count_consistency(s: Star) -> DataFrame:
    points = s.catalog.scan("datapoints")
    raw = points.groupBy("id").agg(F.count(F.lit(1)).alias("raw"))
    weekly = aggregate_datapoints(points, ["count"], ["7d"]).groupBy("id").agg(F.sum("value").alias("bucketed"))
    return raw.join(weekly, "id")


@query(
    "datapoints_value_filter",
    with_views("dp") + "SELECT externalId, timestamp, value FROM dp WHERE value > 100",
)
def datapoints_value_filter(s: Star) -> DataFrame:
    return s.catalog.scan("datapoints", where="value > 100", columns=["externalId", "timestamp", "value"])


@query(
    "limit_per_series",
    with_views("dp")
    + """
    SELECT id, timestamp, value FROM dp QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp) <= 5""",
)
def limit_per_series(s: Star) -> DataFrame:
    return first_rows(s.catalog.scan("datapoints"), ["id"], 5).select("id", "timestamp", "value")


@query(
    "limit_per_series_large",
    """
    SELECT event_type, event_id, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts) <= 1500""",
)
def limit_per_series_large(s: Star) -> DataFrame:
    """A large limit per group, found from counts per hour instead of sorting whole groups."""
    return first_rows(s.base("events").select("event_type", "event_id", "ts"), ["event_type"], 1500, "ts")


@query(
    "datapoints_page",
    with_views("dp")
    + """
    SELECT id, timestamp, value FROM dp WHERE timestamp >= TIMESTAMP '2024-01-10 00:00:00.001'
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp) <= 4""",
)
def datapoints_page(s: Star) -> DataFrame:
    return page_after(s.catalog.scan("datapoints"), "2024-01-10", 4).select("id", "timestamp", "value")
