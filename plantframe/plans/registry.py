"""The registered queries: a name, a function of the benchmark tables, and SQL giving the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.star import Star


@dataclass(frozen=True)
class Query:
    run: Callable[[Star], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of ``Star`` under ``name``."""

    def register(run: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def execute(name: str, spark: SparkSession, root: str) -> DataFrame:
    """Run a query in UTC; times come out without zone, as they are in the files."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = REGISTRY[name].run(Star(spark, root))
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
