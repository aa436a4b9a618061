"""Helpers the operators share: text normalisation, staged tables, groups joined back without a hot task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of words and lines, as characters.
BLANKS = " \t\n\x0b\x0c\r"

staged = cut_lineage


def text_of(column: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(column, UPPER, LOWER)


def packed(df: DataFrame, name: str = "_row") -> Column:
    """All columns of ``df`` as one struct, so that no name of theirs can clash with a column added on the way."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def with_group(rows: DataFrame, keys: list[str], firsts: dict[str, Column], merges: dict[str, Column], salts: int = 64) -> DataFrame:
    """``rows`` with aggregates of their key's group.

    Rows are counted per key and salt before any of them meet, and joined back on both, so that a key with a third of
    all rows is spread over ``salts`` tasks. ``firsts`` aggregates rows, ``merges`` aggregates what ``firsts`` made.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    parts = salted.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in firsts.items()])
    whole = parts.groupBy(*keys).agg(*[c.alias(n) for n, c in merges.items()], F.collect_set("_salt").alias("_salts"))
    return salted.join(whole.withColumn("_salt", F.explode("_salts")).drop("_salts"), [*keys, "_salt"]).drop("_salt")


def beside_group(rows: DataFrame, keys: list[str], **found: Column) -> DataFrame:
    """``rows``, which are best staged, with aggregates of their key's group.

    Spark aggregates rows where they lie before any of them meet. The join has a shuffle and nothing else on either
    side, so that Spark can split the partition of a key with a third of all rows.
    """
    return rows.join(staged(rows.groupBy(*keys).agg(*[c.alias(n) for n, c in found.items()])), keys)


def bound_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let no batch of texts that goes to Python hold much more than ``size``, however long its documents are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def spans(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(from, to) of texts that have about ``size`` bytes together, one text at least."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < len(texts):
        full = size + (ends[at - 1] if at else 0)
        to = max(at + 1, min(len(texts), int(np.searchsorted(ends, full)) + 1))
        yield at, to
        at = to


def text_chunks(texts: pa.Array, size: int) -> Iterator[tuple[int, int, list[str]]]:
    """(from, to, texts) of about ``size`` bytes, one text at least; no others are Python strings at that time."""
    for at, to in spans(texts, size):
        yield at, to, texts.slice(at, to - at).to_pylist()


def fixed_width(column: pa.Array, width: int) -> np.ndarray:
    """A binary column whose values all have ``width`` bytes, as unsigned 64-bit words per row."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(-1, width // 8)


def lists(values: np.ndarray, ends: Iterable[int], kind: pa.DataType) -> pa.Array:
    """A list column from all values in a row and the end of each list."""
    return pa.ListArray.from_arrays(pa.array(chain((0,), ends), pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def summed(blocks: DataFrame, kind: str, ways: int = 64) -> DataFrame:
    """(block, data): sums by block of equally long arrays, from (block, part, data); in two steps, so that no task gets all parts."""

    def add(pdf):
        total = np.sum([np.frombuffer(x, kind) for x in pdf["data"]], axis=0, dtype=kind)
        return pdf.head(1).assign(data=[total.tobytes()])

    schema = "block int, part long, data binary"
    some = blocks.select("block", F.pmod("part", F.lit(ways)).alias("part"), "data").groupBy("block", "part").applyInPandas(add, schema)
    return some.groupBy("block").applyInPandas(add, schema).select("block", "data")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b): the smallest node that links reach.

    Alternating stars: neighbours move to the smallest neighbour until every node has one, which has none itself. A
    node with very many links is aggregated where they lie and split by the join; every step is written to shared
    storage, so that no plan holds more than one of them.
    """

    def large(pairs: DataFrame) -> DataFrame:
        turned = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = staged(pairs.unionAll(turned).groupBy("u").agg(F.least(F.min("v"), "u").alias("m")))
        return turned.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small(pairs: DataFrame) -> DataFrame:
        least = staged(pairs.groupBy("u").agg(F.min("v").alias("m")))
        moved = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()

    def tangled(pairs: DataFrame) -> bool:
        """Whether a node has several smaller neighbours, or one while others have it."""
        ends = pairs.select(F.explode(F.expr("array(struct(u as node, 1 as up, 0 as down), struct(v as node, 0 as up, 1 as down))")).alias("e"))
        roles = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
        return roles.agg(F.max(F.expr("up + down > 1 and up > 0"))).first()[0] or False

    now = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while tangled(now):
        now = staged(small(staged(large(now))))
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
