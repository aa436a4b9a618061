"""Best-fit packing with linear grouping.

Documents become token pieces of at most one sequence. All that follows works on counts: large lengths are sorted into
groups of equal cardinality and rounded up to the largest of their group, the few sizes left are packed by configurations
(column generation, then rounding), actual documents take the slots of their group, and small pieces fill what is left,
best fit first. Plans are made from histograms, whose size the sequence length bounds; rows are numbered within groups
and looked up in the plan.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_chunks, text_of

#: Tokens in a sequence; groups of large lengths; pieces of at most this share of a sequence are small.
SEQUENCE, GROUPS, SMALL = 2048, 48, 1 / 16
#: Words a worker remembers with their ids; bytes of text it cuts into words at once.
REMEMBERED, CHUNK = 300_000, 1_000_000
#: White space stays with what follows it; no token of the vocabularies reaches over such a cut.
_CUT = re.compile(r"\s*\S+|\s+")
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\u00a1-\u024f]*")
_tokenizers: dict[str, tuple] = {}


def _tokenizer(path: str) -> tuple:
    """The tokenizer; its vocabulary as ranks, if a file of that name lies beside it; the words met so far."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        ranks, fast = path.removesuffix(".json") + ".tiktoken", None
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        _tokenizers[path] = Tokenizer.from_file(path), fast, {}
    return _tokenizers[path]


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit numbers, the same as of ``encode`` of the whole text.

    A text is cut before white space, and words met before are looked up. Plain new words go through the same merges
    as ranks, which is faster word by word; others, and special tokens, through the tokenizer itself.
    """
    tokenizer, fast, known = _tokenizer(path)
    words = [_CUT.findall(t) for t in texts]
    new = set().union(*words).difference(known)
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = set().union(*words)
    odd = [w for w in new if fast is None or "<|" in w or not _PLAIN.fullmatch(w)]
    for word, found in zip(odd, tokenizer.encode_batch(odd, add_special_tokens=False)):
        known[word] = array("I", found.ids).tobytes()
    for word in new.difference(odd):
        known[word] = array("I", fast.encode_ordinary(word)).tobytes()
    return [b"".join(map(known.__getitem__, w)) for w in words]


def _pieces(path: str, end: int, most: int, with_ids: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0)
            for at, _, texts in text_chunks(batch.column(1), CHUNK):
                cells = []
                for row, tokens in enumerate(token_bytes(texts, path), at):
                    tokens += last
                    n = len(tokens) // 4
                    first = n % most or most
                    for piece, start in enumerate([0, *range(first, n, most)]):
                        length = first if piece == 0 else most
                        own = tokens[4 * start : 4 * (start + length)]
                        cells.append((row, piece, start, length, zlib.crc32(own), own))
                row, piece, start, length, crc, own = zip(*cells)
                out = [ids.take(pa.array(row)).cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    flat = np.frombuffer(b"".join(own), "<u4").astype(np.int32)
                    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in own])]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    return of


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, end: int = 0, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and on request the ids. Only the first piece may be shorter."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(f"`{id_col}`").cast("long"), text_of(text_col)).mapInArrow(_pieces(tokenizer, end, sequence, with_ids), kind)


def best_configurations(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Configurations (items of each size in a bin) with how often each is used; together they hold all ``counts``.

    The linear programme over all configurations is solved by column generation, where the best new column is an
    integer knapsack over the room; its solution is rounded down and what is left is packed by first fit.
    """
    k = len(sizes)
    basis = np.diag(room // sizes).astype(float)
    for _ in range(40 * k):
        inverse = np.linalg.inv(basis)
        value, level = inverse.sum(axis=0), inverse @ counts
        best, last = np.zeros(room + 1), np.full(room + 1, -1)
        for r in range(1, room + 1):
            fit = np.flatnonzero(sizes <= r)
            best[r], last[r] = best[r - 1], -1
            if len(fit):
                worth = best[r - sizes[fit]] + value[fit]
                top = int(worth.argmax())
                if worth[top] > best[r] + 1e-12:
                    best[r], last[r] = worth[top], fit[top]
        if best[room] <= 1 + 1e-7:
            break
        column, r = np.zeros(k), room
        while r > 0:
            if last[r] < 0:
                r -= 1
            else:
                column[last[r]] += 1
                r -= sizes[last[r]]
        step = inverse @ column
        ratio = np.where(step > 1e-9, np.maximum(level, 0) / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    used = np.floor(np.maximum(np.linalg.inv(basis) @ counts, 0) + 1e-6).astype(int)
    left, plan = counts.astype(int).copy(), []
    for column, times in zip(basis.T.astype(int), used):
        times = min([times, *(left[column > 0] // column[column > 0])])
        if times > 0:
            plan.append((column, int(times)))
            left -= column * times
    # The remainder, less than one bin for each configuration: fill bins with the largest that fit, as often as possible.
    while left.any():
        column, space = np.zeros(k, int), room
        for i in np.argsort(-sizes, kind="stable"):
            column[i] = min(left[i], space // sizes[i])
            space -= column[i] * sizes[i]
        times = int((left[column > 0] // column[column > 0]).min())
        plan.append((column, times))
        left -= column * times
    return plan


def group_lengths(histogram: dict[int, int], groups: int) -> list[tuple[int, int, int]]:
    """(smallest, largest, count) of at most ``groups`` groups of lengths, of about equal cardinality, largest first.

    Equal lengths stay together, so a length with more items than a group's share is a group by itself.
    """
    total, found, low, high, n = sum(histogram.values()), [], None, None, 0
    for length in sorted(histogram, reverse=True):
        if n and n + histogram[length] / 2 > total / groups:
            found.append((low, high, n))
            high, n = None, 0
        low, high, n = length, high or length, n + histogram[length]
    return [*found, (low, high, n)] if n else found


def best_fit(spaces: dict[int, int], lengths: dict[int, int], room: int) -> tuple[list[tuple[int, list[int], int]], list[tuple[list[int], int]]]:
    """Place items by length into bins by space, longest first, each into the least space that holds it.

    Returns (space, lengths placed, how many such bins) and, for what found no space, (lengths, bins) of new bins.
    Bins of equal space and content are one entry.
    """
    open_: dict[int, list[list]] = defaultdict(list)  # by space now: [space at first or None, content, bins]
    order: list[int] = []

    def put(space: int, entry: list) -> None:
        if not open_[space] and (i := bisect_left(order, space)) == len(order) or not open_[space] and order[i] != space:
            insort(order, space)
        open_[space].append(entry)

    for space, bins in sorted(spaces.items()):
        if bins and space:
            put(space, [space, (), bins])
    for length in sorted(lengths, reverse=True):
        todo = lengths[length]
        while todo:
            i = bisect_left(order, length)
            if i == len(order):
                each = room // length
                if todo >= each:
                    put(room - each * length, [None, (length,) * each, todo // each])
                    todo %= each
                if todo:
                    put(room - todo * length, [None, (length,) * todo, 1])
                    todo = 0
                continue
            space = order[i]
            if not open_[space]:
                order.pop(i)
                continue
            entry = open_[space].pop()
            if not open_[space]:
                order.pop(i)
            each = min(space // length, todo)
            bins = min(entry[2], todo // each)
            todo -= bins * each
            if bins < entry[2]:
                put(space, [entry[0], entry[1], entry[2] - bins])
            put(space - each * length, [entry[0], entry[1] + (length,) * each, bins])
    entries = [e for group in open_.values() for e in group if e[1]]
    return [(s, list(c), n) for s, c, n in entries if s is not None], [(list(c), n) for s, c, n in entries if s is None]


def numbered(rows: DataFrame, group: str, order: list[str], ways: int = 256) -> DataFrame:
    """``rows`` with ``_rank``, from 0, within ``group``; a group is spread over ``ways`` parts whose counts are summed."""
    parted = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(ways)).cast("int"))
    counts = parted.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.withColumn("_start", F.sum("_n").over(Window.partitionBy(group).orderBy("_part")) - F.col("_n")).drop("_n")
    own = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order)) - 1
    return parted.withColumn("_own", own).join(starts, [group, "_part"]).withColumn("_rank", F.col("_start") + F.col("_own")).drop("_part", "_own", "_start")


def _slots(spark, uses: list[tuple], key: str) -> DataFrame:
    """(key, lo, hi, bin, each): ranks lo to hi - 1 of a key go to bins from ``bin`` on, ``each`` to a bin."""
    return spark.createDataFrame(uses, f"{key} long, lo long, hi long, bin long, each long")


def _assigned(rows: DataFrame, slots: DataFrame, key: str) -> DataFrame:
    """Rows with the bin that the slots give their rank: a plan's rows are few, one list for each key."""
    listed = slots.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "bin", "each"))).alias("_plan"))
    # A rank's slot is found by its place in the sorted list of starts.
    mine = F.expr("get(filter(_plan, s -> s.lo <= _rank and _rank < s.hi), 0)")
    return rows.join(F.broadcast(listed), key).withColumn("_slot", mine).withColumn("bin", F.expr("_slot.bin + (_rank - _slot.lo) div _slot.each")).drop("_slot", "_plan", "_rank")


def pack(pieces: DataFrame, sequence: int = SEQUENCE, groups: int = GROUPS, small: float = SMALL) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset; no sequence holds more than ``sequence`` tokens.

    Pieces of a sequence lie one after the other from offset 0 on. Pieces that share doc_id and piece are pieces of
    their own. No pieces, no sequences. ``sequence`` bounds the plan: it has at most a row for each group and
    configuration and for each pair of a length and a space.
    """
    spark = pieces.sparkSession
    rows = staged(pieces.withColumn("_row", F.monotonically_increasing_id()))
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}
    limit = max(1, int(sequence * small))
    large = {n: c for n, c in histogram.items() if n > limit}
    little = {n: c for n, c in histogram.items() if n <= limit}
    found = group_lengths(large, groups)
    uses, next_bin = [], 0
    if found:
        sizes, counts = (np.array([g[i] for g in found]) for i in (1, 2))
        filled = [0] * len(found)
        for column, times in best_configurations(sizes, counts, sequence):
            for g in np.flatnonzero(column):
                each = int(column[g])
                uses.append((int(g), filled[g], filled[g] + each * times, next_bin, each))
                filled[g] += each * times
            next_bin += times
    group = F.lit(None).cast("long")
    for g, (low, high, _) in enumerate(found):
        group = F.when(F.col("length").between(low, high), F.lit(g).cast("long")).otherwise(group)
    narrow = rows.select("_row", "length", group.alias("group"))
    big = _assigned(numbered(narrow.filter("group is not null"), "group", ["_row"]), _slots(spark, uses, "group"), "group") if uses else None
    placed = staged(big.select("_row", "length", "bin")) if big is not None else None
    if little:
        fills, fresh = [], []
        if placed is not None:
            spaces = placed.groupBy("bin").agg((F.lit(sequence) - F.sum("length")).alias("space")).filter("space > 0")
            spaces = staged(spaces)
            fills, fresh = best_fit({r[0]: r[1] for r in spaces.groupBy("space").count().collect()}, little, sequence)
        else:
            _, fresh = best_fit({}, little, sequence)
        # Bins of a space are numbered; each fill takes a range of them, and each length a range of its ranks.
        taken, given, ranges, uses = defaultdict(int), defaultdict(int), [], []
        virtual = 0
        for space, content, bins in [*fills, *((0, c, n) for c, n in fresh)]:
            ranges.append((space, taken[space], taken[space] + bins, virtual, 1))
            taken[space] += bins
            for length in sorted(set(content)):
                each = content.count(length)
                uses.append((length, given[length], given[length] + each * bins, virtual, each))
                given[length] += each * bins
            virtual += bins
        filled = _assigned(numbered(narrow.filter("group is null"), "length", ["_row"]), _slots(spark, uses, "length"), "length").select("_row", "length", F.col("bin").alias("virtual"))
        new = [r for r in ranges if r[0] == 0]
        first_new = min([r[3] for r in new], default=virtual)
        if fills:
            real = _assigned(numbered(spaces, "space", ["bin"]).withColumnRenamed("bin", "old"), _slots(spark, [r for r in ranges if r[0]], "space"), "space")
            real = real.filter("bin is not null").select(F.col("bin").alias("virtual"), "old")
            filled = filled.join(real, "virtual", "left")
        else:
            filled = filled.withColumn("old", F.lit(None).cast("long"))
        filled = filled.select("_row", "length", F.coalesce("old", F.col("virtual") - first_new + next_bin).alias("bin"))
        placed = filled if placed is None else placed.unionByName(filled)
    if placed is None:
        return rows.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).drop("_row")
    along = Window.partitionBy("bin").orderBy(F.desc("length"), "_row")
    offset = F.sum("length").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    laid = placed.withColumn("offset", offset).select("_row", F.col("bin").alias("sequence_id"), "offset")
    return rows.join(laid, "_row").drop("_row")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """All documents as packed pieces: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    Null and empty texts are the end token alone. Rows that share an id are documents of their own; a null id stays
    null. Texts of any length are cut, none is shortened.
    """
    return pack(token_pieces(docs, tokenizer, id_col, text_col, sequence, with_ids=with_ids), sequence)
