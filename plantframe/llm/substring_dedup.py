"""Substring de-duplication with difference-cover anchors.

A window is a run of words. Anchors are shorter runs that begin only at places of a difference cover modulo a period:
whatever the places of two equal windows, some word of both lies on the cover at the same distance from their starts,
and the anchor that begins there lies inside both windows. So blocks of texts send their anchors to shards and learn
which of them other blocks have too. Only around those, anchors are extended to whole windows, which are compared by
96 bits; blocks learn which of their windows begin in a smaller document elsewhere. What texts of one block share is
found inside the block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .words import FIRST, SECOND, as_bytes, block_rows, from_five, gathered, ordered, rolled, runs, shard_of, short_keys, split, text_blocks, to_five

#: Words of a window; bytes of texts in a block, and for each shard.
WINDOW, BLOCK_BYTES, SHARD_BYTES = 13, 4_000_000, 16_000_000
#: Perfect difference sets by their period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def cover(window: int) -> tuple[int, np.ndarray]:
    """The longest period that leaves anchors of half a window at least, and which places modulo it are on the cover."""
    period = max(p for p in COVERS if 2 * p <= window + 1)
    on = np.zeros(period, bool)
    on[list(COVERS[period])] = True
    return period, on


class _Block:
    """Words of a block's texts: where they lie, their document's number and their place in it."""

    def __init__(self, ids: pa.Array, texts: pa.Array, window: int):
        self.flat, self.offsets = as_bytes(texts)
        self.starts, self.ends, self.counts = split(self.flat, self.offsets)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place = np.arange(len(self.row)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        self.left = np.repeat(self.counts, self.counts) - self.place
        self.has_id = np.asarray(ids.is_valid())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.window, self.hashes = window, FIRST.of(self.flat, self.starts, self.ends)

    def anchors(self, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all anchors and their keys."""
        period, on = cover(self.window)
        long = self.window - period + 1
        able = (self.counts >= self.window) & self.has_id
        at = np.flatnonzero(on[self.place % period] & (self.left >= long) & able[self.row])
        return at, short_keys(rolled(self.hashes, at, long), shards)

    def around(self, anchors: np.ndarray) -> np.ndarray:
        """Windows that hold one of these anchors at a place where a cover of both windows can meet."""
        period, _ = cover(self.window)
        low = anchors - np.minimum(self.place[anchors], period - 1)
        high = anchors - np.maximum(self.window - self.left[anchors], 0)
        steps = np.zeros(len(self.row) + 1, np.int64)
        np.add.at(steps, low[low <= high], 1)
        np.add.at(steps, high[low <= high] + 1, -1)
        return np.flatnonzero(np.cumsum(steps[:-1]) > 0)

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        second = SECOND.of(self.flat, self.starts, self.ends)
        return rolled(self.hashes, at, self.window), rolled(second, at, self.window)


def _send_anchors(window: int, shards: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts, _ in block_rows(batches):
            keys = np.unique(_Block(ids, texts, window).anchors(shards)[1])
            shard = (keys >> np.uint64(40)).astype(np.int32)
            cuts = runs(shard)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[cuts[:-1]], pa.int32()), pa.array(np.full(len(cuts) - 1, block)), pa.array([to_five(keys[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())],
                names=["shard", "block", "keys"],
            )

    return of


def _shared_anchors(packets: pa.Table) -> pa.Table:
    """Of each packet, the anchors that another block has too."""
    blobs = packets["keys"].to_pylist()
    keys, ends = from_five(b"".join(blobs)), np.cumsum([len(b) // 5 for b in blobs])
    order = np.argsort(keys, kind="stable")
    again = keys[order][1:] == keys[order][:-1]
    shared = np.zeros(len(keys), bool)
    shared[order[1:][again]] = shared[order[:-1][again]] = True
    parts = [to_five(keys[a:b][shared[a:b]]) for a, b in zip([0, *ends[:-1]], ends)]
    told = packets.select(["block", "shard"]).append_column("keys", pa.array(parts, pa.binary()))
    return told.filter(pa.array([bool(p) for p in parts]))


def _send_windows(window: int, shards: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, texts, row in block_rows(batches):
            told = row.column("told").flatten()
            if not len(told):
                continue
            shared = [from_five(k) | np.uint64(s << 40) for s, k in zip(told.field("shard").to_pylist(), told.field("keys").to_pylist())]
            block = _Block(ids, texts, window)
            at, keys = block.anchors(shards)
            at = block.around(at[np.isin(keys, np.concatenate(shared))])
            first, second = block.windows(at)
            order, new = ordered(first, second)
            least = np.minimum.reduceat(block.ids[block.row[at[order]]], new) if len(new) else np.zeros(0, np.int64)
            first, second = first[order[new]], second[order[new]]
            shard = shard_of(first, shards)
            cuts = runs(shard)
            own, least = _twelve(first, second), _planes(least, cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[cuts[:-1]], pa.int32()),
                    pa.array(np.full(len(cuts) - 1, number)),
                    pa.array([own[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array(least, pa.binary()),
                ],
                names=["shard", "block", "keys", "least"],
            )

    return of


def _twelve(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """96 bits of each window."""
    return np.concatenate([first.astype("<u8").view(np.uint8).reshape(-1, 8), second.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :4]], axis=1)


def _from_twelve(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(blob, np.uint8).reshape(-1, 12)
    return np.ascontiguousarray(both[:, :8]).view("<u8").ravel(), np.ascontiguousarray(both[:, 8:]).view("<u4").ravel().astype(np.uint64)


def _planes(values: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """Parts of numbers, lowest bytes of all first: the upper ones are mostly equal and take no room when compressed."""
    return [values[a:b].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for a, b in zip(cuts, cuts[1:])]


def _later_windows(packets: pa.Table) -> pa.Table:
    """Of each packet, the windows that begin in a smaller document of another block."""
    blobs = packets["keys"].to_pylist()
    keys = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 12)
    least = np.concatenate([np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view("<i8").ravel() for x in packets["least"].to_pylist()])
    order, new = ordered(*_from_twelve(b"".join(blobs)))
    smallest = np.repeat(np.minimum.reduceat(least[order], new), np.diff([*new, len(order)])) if len(new) else least
    later = np.zeros(len(keys), bool)
    later[order] = least[order] > smallest
    ends = np.cumsum([len(b) // 12 for b in blobs])
    parts = [keys[a:b][later[a:b]].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
    told = packets.select(["block"]).append_column("keys", pa.array(parts, pa.binary()))
    return told.filter(pa.array([bool(p) for p in parts]))


def _kept(block: _Block, stays: np.ndarray) -> pa.Array:
    """The texts of a block made of the words that stay, joined by one space."""
    row = block.row[stays]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    sizes, out = gathered(block.flat, block.starts[stays], block.ends[stays] + ~last)
    out[np.cumsum(sizes)[~last] - 1] = 0x20
    text = np.bincount(row, weights=sizes, minlength=len(block.counts)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(np.concatenate([[0], np.cumsum(text)])), pa.py_buffer(out))


def _remove(window: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, texts, row in block_rows(batches):
            block = _Block(ids, texts, window)
            at = np.flatnonzero((block.left >= window) & block.has_id[block.row])
            first, second = block.windows(at)
            order, new = ordered(first, second)
            gone = np.zeros(len(at), bool)
            if len(new):
                own = block.ids[block.row[at[order]]]
                gone[order] = own > np.repeat(np.minimum.reduceat(own, new), np.diff([*new, len(order)]))
            told = [x for x in row.column("told").flatten().to_pylist()]
            if told and len(at):
                one, two = _from_twelve(b"".join(told))
                by_first = np.argsort(one)
                one, two = one[by_first], two[by_first]
                found = np.minimum(np.searchsorted(one, first), len(one) - 1)
                gone |= (one[found] == first) & (two[found] == (second & np.uint64(0xFFFFFFFF)))
            steps = np.zeros(len(block.row) + 1, np.int64)
            steps[at[gone]] += 1
            steps[at[gone] + window] -= 1
            stays = np.cumsum(steps[:-1]) == 0
            removed = np.bincount(block.row[~stays], minlength=len(block.counts))
            yield pa.RecordBatch.from_arrays(
                [ids, _kept(block, stays).cast(pa.string()), pa.array(block.counts, pa.int64()), pa.array(removed, pa.int64())], names=["doc_id", "kept_text", "n_words", "n_removed"]
            )

    return of


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Per row of ``docs``: doc_id, kept_text, n_words (before) and n_removed.

    Words are runs of characters that are not ASCII white space, unchanged. Every word that lies in a window of
    ``window`` words whose word sequence also begins in a document with a smaller id is removed; windows are those of
    the input. What stays is joined by one space. Null text has no words. Rows that share an id are one document when
    windows are compared, each with its own result; rows without an id keep all words and count for nothing. Texts of
    any length count whole; fewer words than a window always stay. An empty table gives no rows, other columns are
    not read. Rows equal in id and text travel in one block.
    """
    bound_batches(docs.sparkSession)
    blocks, size = text_blocks(docs, id_col, text_col, block_bytes)
    shards = max(1, math.ceil(size / shard_bytes))
    anchors = blocks.mapInArrow(_send_anchors(window, shards), "shard int, block long, keys binary")
    told = anchors.groupBy("shard").applyInArrow(_shared_anchors, "block long, shard int, keys binary")
    told = told.groupBy("block").agg(F.collect_list(F.struct("shard", "keys")).alias("told"))
    # Left joins: an inner one would filter the blocks first, and their exchange could not be used three times.
    windows = blocks.join(told, "block", "left").mapInArrow(_send_windows(window, shards), "shard int, block long, keys binary, least binary")
    later = windows.groupBy("shard").applyInArrow(_later_windows, "block long, keys binary")
    later = later.groupBy("block").agg(F.collect_list("keys").alias("told"))
    return blocks.join(later, "block", "left").mapInArrow(_remove(window), "doc_id long, kept_text string, n_words long, n_removed long")
