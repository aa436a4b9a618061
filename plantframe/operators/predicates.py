"""Row selection that the resource tables offer beyond a plain filter."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this many keys a list travels as a table instead of literals in the plan.
MAX_LITERALS = 10_000


def parse_ids(text: str | None) -> tuple[list[int], list[str]]:
    """Id list option: a JSON integer is an id, a JSON string an external id, a list mixes both,
    and any other text is one external id as it stands."""
    if text is None:
        return [], []
    try:
        value = json.loads(text)
    except ValueError:
        return [], [text]
    items = value if isinstance(value, list) else [value]
    is_id = [isinstance(i, int) and not isinstance(i, bool) for i in items]
    if not all(number or isinstance(i, str) for number, i in zip(is_id, items)):
        return [], [text]
    ids = [i for number, i in zip(is_id, items) if number]
    names = [i for number, i in zip(is_id, items) if not number]
    return ids, names


def lookup_rows(
    df: DataFrame,
    ids: Sequence[int] = (),
    external_ids: Sequence[str] = (),
    or_where: Column | str | None = None,
) -> DataFrame:
    """Rows with one of the ids, or one of the external ids, or matching a condition, each once."""
    if len(ids) + len(external_ids) > MAX_LITERALS:
        return _lookup_by_join(df, ids, external_ids, or_where)
    keep = F.lit(False)
    if ids:
        keep = keep | F.col("id").isin(list(ids))
    if external_ids:
        keep = keep | F.col("externalId").isin(list(external_ids))
    if or_where is not None:
        keep = keep | (F.expr(or_where) if isinstance(or_where, str) else or_where)
    return df.filter(keep)


def _lookup_by_join(
    df: DataFrame, ids: Sequence[int], external_ids: Sequence[str], or_where: Column | str | None
) -> DataFrame:
    spark = df.sparkSession
    wanted_id = spark.createDataFrame([(i,) for i in set(ids)], "id long").withColumn("_by_id", F.lit(True))
    wanted_name = spark.createDataFrame([(e,) for e in set(external_ids)], "externalId string").withColumn(
        "_by_name", F.lit(True)
    )
    condition = F.lit(False) if or_where is None else F.expr(or_where) if isinstance(or_where, str) else or_where
    return (
        df.join(wanted_id, "id", "left")
        .join(wanted_name, "externalId", "left")
        .filter(F.col("_by_id") | F.col("_by_name") | condition)
        .select(*df.columns)
    )


def contains_any(column: str, values: Sequence) -> Column:
    """True when an array column shares an element with ``values``."""
    return F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in values]))


def equals_array(column: str, values: Sequence) -> Column:
    """True when an array column is exactly ``values``."""
    return F.col(column) == F.array(*[F.lit(v) for v in values])


def reference(space: str, external_id: str) -> Column:
    """Literal instance reference, comparable with ``=`` to reference columns."""
    return F.struct(F.lit(space).alias("space"), F.lit(external_id).alias("externalId"))
