"""Words and their hashes straight from the bytes of a text column, many texts at a time; blocks of texts that rows travel in."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, text_of

_U = np.uint64
#: Bytes hashed at once.
_STEP = 1 << 20
#: The white space of words, as bytes.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in a row, and where each text begins; one more for the end."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return flat, ends - ends[0] if len(texts) else np.zeros(1, np.int64)


def split(flat: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, a run of bytes that are not ``blank`` inside one text; and how many each text has."""
    empty = np.concatenate([[True], blank[flat], [True]])
    starts = ~empty[1:-1] & empty[:-2]
    ends = ~empty[1:-1] & empty[2:]
    cuts = offsets[(offsets > 0) & (offsets < len(flat))]
    starts[cuts] = ~empty[cuts + 1]
    ends[cuts - 1] = ~empty[cuts]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


class Hashes:
    """A 64-bit hash of byte runs: a polynomial over random values of the bytes, read off running sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.factor = int(rng.integers(0, 1 << 63)) * 2 + 1
        self.power = self.inverse = np.ones(1, _U)

    def _grow(self, size: int) -> None:
        if len(self.power) < size:
            size = max(size, _STEP)
            for name, base in (("power", self.factor), ("inverse", pow(self.factor, -1, 1 << 64))):
                steps = np.full(size, base, _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def of(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        found, i = np.empty(len(starts), _U), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + _STEP)))
            low, high = int(starts[i]), int(ends[j - 1])
            self._grow(high - low + 1)
            run = np.zeros(high - low + 1, _U)
            np.cumsum(self.values[flat[low:high]] * self.power[: high - low], out=run[1:])
            at = starts[i:j] - low
            found[i:j] = (run[ends[i:j] - low] - run[at]) * self.inverse[at]
            i = j
        return mix(found + (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15))


#: Two hashes that know nothing of each other; together 128 bits.
FIRST, SECOND = Hashes(1), Hashes(2)


def rolled(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the runs of ``length`` words that begin ``at`` these places."""
    total = np.zeros(len(at), _U)
    for j in range(length):
        total = total * _U(0x9E3779B97F4A7C15) + hashes[at + j]
    return mix(total + _U(length))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


def short_keys(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard and 40 bits in one number: with some million keys a shard, two in a million keys meet another by chance."""
    return shard_of(hashes, shards).astype(_U) << _U(40) | hashes & _U((1 << 40) - 1)


def to_five(keys: np.ndarray) -> bytes:
    """The lower 40 bits of each number."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def from_five(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin; one more for the end."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]]) if len(values) else np.zeros(1, np.int64)


def ordered(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys in two parts, and where runs of equal ones begin."""
    order = np.argsort(first, kind="stable")
    one, two = first[order], second[order]
    if ((one[1:] == one[:-1]) & (two[1:] != two[:-1])).any():
        order = np.lexsort((second, first))
        one, two = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return order, np.flatnonzero(new)


def gathered(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of byte runs, and their bytes one after the other; a run may end one byte behind all bytes."""
    sizes = ends - starts
    stop = np.cumsum(sizes)
    source = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - sizes - starts, sizes)
    return sizes, flat[np.minimum(source, len(flat) - 1)]


def text_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """(block, docs): about ``block_bytes`` of texts with their ids in one row each; and the bytes of all texts.

    The block of a row follows from its id and text, so that a task run again makes the same blocks.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), text_of(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + F.count(F.lit(1))).first()[0]
    block = F.pmod(F.xxhash64("doc", "text"), F.lit(max(1, math.ceil(size / block_bytes))))
    dealt = rows.select(block.alias("block"), F.struct("doc", "text").alias("doc")).repartition("block")
    return dealt.groupBy("block").agg(F.collect_list("doc").alias("docs")), size


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, pa.Array, pa.RecordBatch]]:
    """Block, ids, texts and the row, one block at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            docs = row.column("docs").flatten()
            yield row.column("block")[0].as_py(), docs.field("doc"), docs.field("text"), row
