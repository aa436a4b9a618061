"""Line de-duplication: repeated lines live in a sharded minimal perfect hash, and documents probe its arrays.

A shard holds a perfect hash of its line hashes (levels of bit arrays, ranked) and, by slot, a fingerprint, the number
of rows with the line and the smallest document. Line hashes visit their shard sorted behind it, one shard in memory
at a time; each shard has several copies so that a line found everywhere is spread over several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fixed_width, mix, packed, staged, text_of

#: Code points a line needs to be compared; lines in one shard; copies of each shard.
MIN_CHARS, SHARD_LINES, COPIES = 10, 250_000, 16


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128 bits of the line's key: white space stripped at both ends, A-Z lower-cased. None for short lines."""
    key = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def _keys(min_chars: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {k for line in text.split("\n") if (k := line_key(line, min_chars))}
                keys.extend(own)
                docs.extend([doc] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(keys, pa.binary())], names=["doc", "key"])

    return of


def _level(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys[:, 0] + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1) ^ keys[:, 1]) % np.uint64(size)).astype(np.int64)


def perfect_hash(keys: np.ndarray, room: float = 2.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits in a row, and the slot of each key: distinct numbers from 0 to len(keys) - 1.

    A level has ``room`` places for each key left; keys alone at their place stay there, the others go on.
    """
    sizes, bits, slots, left, base = [], [], np.zeros(len(keys), np.int64), np.arange(len(keys)), 0
    while len(left):
        size = max(8, int(room * len(left)))
        at = _level(keys[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        slots[left[settled]] = base + (np.cumsum(alone) - 1)[at[settled]]
        base += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~settled]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slots


def find_slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The slot of each key, some slot or -1 for keys that were not hashed."""
    slots, left, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = start + _level(keys[left], level, size)
        here = bits[at]
        slots[left[here]] = ranks[at[here]]
        left, start = left[~here], start + size
    return slots


_SHARD = "shard int, sizes array<int>, bits binary, prints binary, counts binary, firsts binary"


def _build(pdf):
    keys = np.frombuffer(b"".join(pdf["key"]), "<u8").reshape(-1, 2)
    sizes, bits, slots = perfect_hash(keys)
    prints, counts, firsts = np.zeros(len(keys), "<u8"), np.zeros(len(keys), "<i8"), np.zeros(len(keys), "<i8")
    prints[slots], counts[slots], firsts[slots] = keys[:, 1], pdf["n"], pdf["first"]
    return pdf.head(1)[["shard"]].assign(sizes=[sizes], bits=[np.packbits(bits).tobytes()], prints=[prints.tobytes()], counts=[counts.tobytes()], firsts=[firsts.tobytes()])


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, shard = None, None
    for batch in batches:
        places = list(zip(batch.column("shard").to_pylist(), batch.column("copy").to_pylist()))
        cuts = [i for i in range(len(places)) if i == 0 or places[i] != places[i - 1]] + [len(places)]
        for start, end in zip(cuts, cuts[1:]):
            if places[start] != at:
                at, shard = places[start], None
            run = batch.slice(start, end - start)
            if not run.column("probe")[0].as_py():
                head = {n: run.column(n)[0].as_py() for n in ("sizes", "bits", "prints", "counts", "firsts")}
                bits = np.unpackbits(np.frombuffer(head["bits"], np.uint8), count=sum(head["sizes"])).astype(bool)
                shard = (head["sizes"], bits, np.cumsum(bits) - 1, *[np.frombuffer(head[n], k) for n, k in (("prints", "<u8"), ("counts", "<i8"), ("firsts", "<i8"))])
                run = run.slice(1)
            if shard is None or not run.num_rows:
                continue
            sizes, bits, ranks, prints, counts, firsts = shard
            keys, docs = fixed_width(run.column("key"), 16), run.column("doc").to_numpy(zero_copy_only=False)
            slots = find_slots(keys, sizes, bits, ranks)
            out = np.flatnonzero((slots >= 0) & (prints[slots] == keys[:, 1]) & (firsts[slots] < docs))
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(docs[out], pa.int64()), run.column("key").take(pa.array(out)), pa.array(counts[slots[out]], pa.int64())], names=["doc", "key", "n"])


def repeated_lines(lines: DataFrame, shard_lines: int = SHARD_LINES, copies: int = COPIES) -> DataFrame:
    """The (doc, key, n) of lines to drop, from all (doc, key): those whose line has a smaller document too."""
    index = lines.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
    index = staged(index.filter("first < last").select("key", "first", "n"))
    shards = max(16, math.ceil(index.count() / shard_lines))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")
    built = index.select(shard, "key", "first", "n").groupBy("shard").applyInPandas(_build, _SHARD)
    arrays = built.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(False).alias("probe"), F.lit(None).cast("long").alias("doc"), F.lit(None).cast("binary").alias("key"),
        "sizes", "bits", "prints", "counts", "firsts",
    )
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in arrays.schema.fields[5:]]
    probes = lines.select(shard, F.pmod(F.xxhash64("doc"), F.lit(copies)).cast("int").alias("copy"), F.lit(True).alias("probe"), "doc", "key", *empty)
    visits = arrays.unionAll(probes).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "probe")
    return visits.mapInArrow(_probe, "doc long, key binary, n long")


def _strip(min_chars: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, drops in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = text.split("\n")
                stay = lines
                if drops:
                    drops = set(drops)
                    stay = [x for x in lines if line_key(x, min_chars) not in drops]
                rows.append(("\n".join(stay), len(lines), len(lines) - len(stay)))
            kept, before, dropped = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64()), batch.column(3)], names=["_row", "_kept", "_lines", "_dropped", "_most"]
            )

    return of


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, shard_lines: int = SHARD_LINES) -> DataFrame:
    """Per row of ``docs``: doc_id, kept_text, n_lines (before), n_dropped, most_rows (of the commonest dropped line).

    Lines of at least ``min_chars`` code points after stripping that occur in two documents or more are dropped
    everywhere but in the smallest id, where all of them stay. Null or empty text is one empty line. Rows that share an
    id are one document when lines are compared, each with its own result; rows without an id keep all lines and count
    for nothing. A document that loses all lines has the empty text.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), text_of(text_col).alias("text"))
    lines = staged(rows.filter("doc is not null").mapInArrow(_keys(min_chars), "doc long, key binary"))
    drops = repeated_lines(lines, shard_lines).groupBy("doc").agg(F.collect_set("key").alias("drops"), F.max("n").alias("most"))
    own = rows.select(packed(rows.select("doc")), "doc", "text").join(drops, "doc", "left")
    done = own.select("_row", "text", "drops", "most").mapInArrow(_strip(min_chars), "_row struct<doc:long>, _kept string, _lines long, _dropped long, _most long")
    return done.select(F.col("_row.doc").alias("doc_id"), F.col("_kept").alias("kept_text"), F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.col("_most").alias("most_rows"))
