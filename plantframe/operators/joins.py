"""Joins between resources that the documented queries are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consecutive_pairs(
    df: DataFrame, keys: Sequence[str], sequence: str, columns: Sequence[str]
) -> DataFrame:
    """Each row with the row of the next sequence number: ``columns`` appear as from_* and to_*.

    The sequence number is part of the join key, so a long run is spread over all tasks.
    """
    left = df.select(*keys, F.col(sequence), *[F.col(c).alias(f"from_{c}") for c in columns])
    right = df.select(*keys, (F.col(sequence) - 1).alias(sequence), *[F.col(c).alias(f"to_{c}") for c in columns])
    return left.join(right, [*keys, sequence])


def link_assets(items: DataFrame, assets: DataFrame, column: str = "assetIds") -> DataFrame:
    """Items joined to every asset they name; asset columns get the prefix ``asset_``."""
    named = assets.select(
        F.col("id").alias("asset_id"), *[F.col(c).alias(f"asset_{c}") for c in assets.columns if c != "id"]
    )
    return items.withColumn("asset_id", F.explode(column)).join(named, "asset_id")


def edge_endpoints(edges: DataFrame, nodes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Edges with columns of their start node and end node, as start_* and end_*."""
    joined = edges
    for side, prefix in (("startNode", "start"), ("endNode", "end")):
        ends = nodes.select(
            F.struct("space", "externalId").alias(side), *[F.col(c).alias(f"{prefix}_{c}") for c in columns]
        )
        joined = joined.join(ends, side)
    return joined


def split_existing(source: DataFrame, target: DataFrame, key: str = "externalId") -> tuple[DataFrame, DataFrame]:
    """Source rows whose key exists in the target, and those whose key does not."""
    known = target.filter(F.col(key).isNotNull()).select(key)
    return source.join(known, key, "left_semi"), source.join(known, key, "left_anti")
