"""Exact de-duplication with two-pass Bloom filtering.

Pass one sets bits of a saturating Bloom filter with two bits a place: seen, and seen again. Pass two probes the
"seen again" bits: rows that miss are unique for certain and go straight through, the others shuffle and are grouped
exactly. A filter has a fixed size; more digests than it can hold are handled slice by slice, each with its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fixed_width, lower_ascii, packed, staged, text_of, with_group

#: Bits of one filter (32 MB), the most that is broadcast; bits for each digest; places each digest sets.
FILTER_BITS, BITS_PER_DIGEST, PLACES = 1 << 28, 16, 6
_BLOCK = 1 << 16


def digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, as 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(text), 256))


def _places(digests: np.ndarray, bits: int) -> np.ndarray:
    steps = np.arange(PLACES, dtype=np.uint64)[None, :]
    return (digests[:, :1] + steps * (digests[:, 1:2] | np.uint64(1))) & np.uint64(bits - 1)


def _set(filter_: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(filter_, (places >> np.uint64(3)).ravel().astype(np.int64), (np.uint8(1) << (places & np.uint64(7)).astype(np.uint8)).ravel())


def repeat_filter(digests: DataFrame, bits: int, every: bool = False) -> Broadcast:
    """A filter of ``bits`` bits (a power of two) that holds every digest which occurs twice or more; with ``every``, all.

    Each task sets its own bits and passes on the blocks it touched; blocks are merged by number.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            if batch.num_rows:
                own, counts = np.unique(fixed_width(batch.column(0), 32)[:, :2], axis=0, return_counts=True)
                places = _places(own, bits)
                known = ((once[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
                _set(twice, places[known | (counts > 1) | every])
                _set(once, places)
        for start in range(0, bits // 8, _BLOCK):
            a, b = once[start : start + _BLOCK], twice[start : start + _BLOCK]
            if a.any():
                yield pa.RecordBatch.from_arrays([pa.array([start // _BLOCK], pa.int32()), pa.array([a.tobytes()]), pa.array([b.tobytes()])], names=["block", "once", "twice"])

    def merge(pdf):
        once = twice = np.zeros(min(_BLOCK, bits // 8), np.uint8)
        for a, b in zip(pdf["once"], pdf["twice"]):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            once, twice = once | a, twice | b | (once & a)
        return pdf.head(1).assign(once=[b""], twice=[twice.tobytes()])

    schema = "block int, once binary, twice binary"
    blocks = digests.select("_sha").mapInArrow(fill, schema).groupBy("block").applyInPandas(merge, schema)
    whole = np.zeros(bits // 8, np.uint8)
    for row in blocks.select("block", "twice").toLocalIterator():
        whole[row[0] * _BLOCK : row[0] * _BLOCK + len(row[1])] = np.frombuffer(row[1], np.uint8)
    return digests.sparkSession.sparkContext.broadcast(whole)


def may_hold(filter_: Broadcast, bits: int):
    """A column function: False where the digest is certainly not in the filter."""

    @F.pandas_udf("boolean")
    def probe(sha):
        import pandas as pd

        if not len(sha):
            return pd.Series([], dtype=bool)
        places, words = _places(fixed_width(pa.array(sha, pa.binary()), 32)[:, :2], bits), filter_.value
        found = (words[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1
        return pd.Series(found.all(axis=1))

    return probe


def _bits(n: int, most: int) -> int:
    return min(most, 1 << max(16, math.ceil(math.log2(max(1, n) * BITS_PER_DIGEST))))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after lower-casing A-Z; null is the empty text. Of equal texts the row with the
    largest id is kept, null being the smallest id; of rows that share that id too, the last one read. Texts of any
    length count whole. An empty table gives no rows. Other columns are not read.
    """
    n = docs.count()
    slices = max(1, math.ceil(n * BITS_PER_DIGEST / filter_bits))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), digest(text_of(text_col)).alias("_sha"))
    rows = rows.select("*", F.monotonically_increasing_id().alias("_pos"), F.pmod(F.xxhash64("_sha"), F.lit(slices)).cast("int").alias("_slice"))
    rows = staged(rows.sortWithinPartitions("_slice") if slices > 1 else rows)
    bits, marked = _bits(-(-n // slices), filter_bits), None
    for s in range(slices):
        part = rows.filter(F.col("_slice") == s) if slices > 1 else rows
        part = part.withColumn("_maybe", may_hold(repeat_filter(part, bits), bits)("_sha"))
        marked = part if marked is None else marked.unionAll(part)
    straight = marked.filter(~F.col("_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "_sha")
    last = F.max(F.struct("doc_id", "_pos"))
    groups = with_group(
        marked.filter("_maybe").select("doc_id", "_pos", "_sha"),
        ["_sha"],
        {"_last": last, "_n": F.count(F.lit(1))},
        {"_last": F.max("_last"), "group_size": F.sum("_n")},
    )
    shuffled = groups.select("doc_id", F.col("_last.doc_id").alias("keep_id"), "group_size", (F.col("_pos") == F.col("_last._pos")).alias("kept"), "_sha")
    return straight.unionAll(shuffled).withColumn("text_sha256", F.lower(F.hex("_sha"))).drop("_sha")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, as ``exact_groups`` keeps it; all columns stay as they are.

    Rows without a copy do not shuffle: a filter of the repeated digests lets them pass. Of rows that share the largest
    id and the text, any one stays.
    """
    groups = exact_groups(docs, id_col, text_col, filter_bits).filter("group_size > 1 and kept")
    winners = staged(groups.select(F.col("keep_id").alias("_keep"), F.unhex("text_sha256").alias("_sha")))
    bits = _bits(winners.count(), filter_bits)
    rows = docs.select(packed(docs), F.col(f"`{id_col}`").alias("_keep"), digest(text_of(text_col)).alias("_sha"))
    rows = rows.withColumn("_maybe", may_hold(repeat_filter(winners, bits, every=True), bits)("_sha"))
    maybe = rows.filter("_maybe").drop("_maybe").alias("r")
    hits = winners.alias("w")
    same = F.col("r._sha") == F.col("w._sha")
    # Rows whose digest has no winner were let in by chance and stay.
    stay = maybe.join(hits, same, "left_anti").select("_row")
    won = maybe.join(hits, same & F.col("r._keep").eqNullSafe(F.col("w._keep")), "left_semi").dropDuplicates(["_sha"]).select("_row")
    return rows.filter(~F.col("_maybe")).select("_row").unionAll(stay).unionAll(won).select("_row.*")
