"""Collocations by prefix-free parsing.

Texts are cut where a window of words hashes to a trigger, so the same passage is cut alike wherever it stands, and
chunks overlap by the window, one word less than the longest phrase. A phrase belongs to the chunk in which it begins
before the overlap, so none is counted twice. Equal chunks become one dictionary entry with its frequency, and phrases
are counted inside distinct chunks, weighted. Blocks of the dictionary first learn which of their words and word pairs
can be frequent anywhere; phrases made of others are not sent.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, mix, staged, text_of
from .words import FIRST, SECOND, as_bytes, from_five, gathered, ordered, rolled, runs, shard_of, short_keys, split, to_five

#: Words of the longest phrase; a window in so many triggers a cut; occurrences a candidate has.
LONGEST, TRIGGER, MIN_COUNT = 5, 32, 100
#: A candidate goes when a longer one around it has this share of its occurrences, in hundredths; phrases returned a language.
COVER, TOP = 100, 2000
#: Bytes of chunks in a block, and of texts for each shard; parts a language is ranked in.
BLOCK_BYTES, SHARD_BYTES, RANK_PARTS = 6_000_000, 16_000_000, 64
_U = np.uint64
_BLANK, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _parse(longest: int, trigger: int):
    """Chunks of texts, equal ones of a batch together. A blank joins words of a piece, a line end stands where a piece
    ends; a chunk that ends with a line end is the last of its text."""
    overlap = longest - 1

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = as_bytes(batch.column(1))
            flat = _LOWER[flat]
            starts, ends, counts = split(flat, offsets, _BLANK | _BREAK)
            if not len(starts):
                continue
            row = np.repeat(np.arange(len(counts)), counts)
            stop = np.cumsum(counts)
            breaks = np.concatenate([[0], np.cumsum(_BREAK[flat])])
            cut = np.ones(len(starts), bool)  # a piece begins with this word
            cut[1:] = (breaks[starts[1:]] > breaks[ends[:-1]]) | (row[1:] != row[:-1])
            sizes, text = gathered(flat, starts, ends + 1)
            after = np.cumsum(sizes)
            text[after - 1] = np.where(np.append(cut[1:], True), 0x0A, 0x20)
            seen = mix(FIRST.of(flat, starts, ends) + cut.astype(_U))
            at = np.flatnonzero(np.arange(len(starts)) + overlap <= stop[row])
            begins = np.zeros(len(starts), bool)
            begins[at] = rolled(seen, at, overlap) % _U(trigger) == 0
            begins[stop[counts > 0] - counts[counts > 0]] = True
            begins = np.flatnonzero(begins)
            following = np.append(begins[1:], len(starts))
            final = following == stop[row[begins]]
            low = after[begins] - sizes[begins]
            high = np.where(final, after[following - 1], after[np.minimum(following + overlap, len(starts)) - 1] - 1)
            whole, langs = text.tobytes(), batch.column(0).to_pylist()
            found = Counter((langs[r], whole[a:b]) for r, a, b in zip(row[begins].tolist(), low.tolist(), high.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.binary()), pa.array(found.values(), pa.int64())], names=["lang", "chunk", "n"]
            )

    return of


class _Block:
    """Words of a block of the dictionary, and how many words of their piece follow from each that counts."""

    def __init__(self, entries: pa.Array, longest: int):
        self.langs, weight = entries.field("lang"), entries.field("n").to_numpy()
        self.flat, offsets = as_bytes(entries.field("chunk").cast(pa.large_binary()))
        self.starts, self.ends, counts = split(self.flat, offsets, _BLANK | _BREAK)
        self.chunk = np.repeat(np.arange(len(counts)), counts)
        self.weight = weight[self.chunk]
        stop = np.cumsum(counts)
        place = np.arange(len(self.starts)) - (stop - counts)[self.chunk]
        last = self.flat[offsets[1:] - 1] == 0x0A
        own = place < np.where(last, counts, counts - longest + 1)[self.chunk]
        closes = np.append(self.flat, 0x0A)[self.ends] == 0x0A
        closes[stop - 1] = True
        nexts = np.flatnonzero(closes)
        self.room = np.where(own, nexts[np.searchsorted(nexts, np.arange(len(closes)))] - np.arange(len(closes)) + 1, 0)
        names = self.langs.dictionary_encode()
        codes = np.array([xxhash.xxh3_64_intdigest(x) for x in names.dictionary.to_pylist()], _U)
        self.code = codes[names.indices.to_numpy()][self.chunk]
        self.first = FIRST.of(self.flat, self.starts, self.ends)

    def keys(self, at: np.ndarray, words: int, shards: int) -> np.ndarray:
        return short_keys(mix(rolled(self.first, at, words) ^ self.code[at]), shards)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, pa.RecordBatch]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            yield row.column("block")[0].as_py(), row.column("entries").flatten(), row


def _send_pairs(longest: int, min_count: int, shards: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, entries, _ in _entries(batches):
            block = _Block(entries, longest)
            at = [np.flatnonzero(block.room >= k) for k in (1, 2)]
            keys = np.concatenate([block.keys(x, k, shards) for k, x in enumerate(at, 1)])
            weight = np.concatenate([block.weight[x] for x in at])
            order = np.argsort(keys, kind="stable")
            cuts = runs(keys[order])
            keys, counts = keys[order][cuts[:-1]], np.minimum(np.add.reduceat(weight[order], cuts[:-1]), min_count).astype("<u4")
            shard = (keys >> _U(40)).astype(np.int32)
            cuts = runs(shard)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[cuts[:-1]], pa.int32()),
                    pa.array(np.full(len(cuts) - 1, number)),
                    pa.array([to_five(keys[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                names=["shard", "block", "keys", "counts"],
            )

    return of


def _frequent_pairs(min_count: int):
    def of(packets: pa.Table) -> pa.Table:
        """Of each packet, the keys that reach ``min_count`` over all blocks."""
        blobs = packets["keys"].to_pylist()
        keys, counts = from_five(b"".join(blobs)), np.frombuffer(b"".join(packets["counts"].to_pylist()), "<u4").astype(np.int64)
        order = np.argsort(keys, kind="stable")
        cuts = runs(keys[order])
        often = np.zeros(len(keys), bool)
        often[order] = np.repeat(np.add.reduceat(counts[order], cuts[:-1]) >= min_count, np.diff(cuts))
        ends = np.cumsum([len(b) // 5 for b in blobs])
        parts = [to_five(keys[a:b][often[a:b]]) for a, b in zip([0, *ends[:-1]], ends)]
        told = packets.select(["block", "shard"]).append_column("keys", pa.array(parts, pa.binary()))
        return told.filter(pa.array([bool(p) for p in parts]))

    return of


def _send_phrases(longest: int, shards: int, phrase_shards: int):
    """Counts of the phrases whose words and word pairs may be frequent, and of all words (the empty phrase), by shard
    and language; every phrase ends with a line end."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, entries, row in _entries(batches):
            block = _Block(entries, longest)
            told = row.column("told").flatten()
            often = [from_five(k) | _U(s << 40) for s, k in zip(told.field("shard").to_pylist(), told.field("keys").to_pylist())]
            often = np.sort(np.concatenate(often)) if often else np.zeros(0, _U)
            langs = block.langs.dictionary_encode()
            lang = langs.indices.to_numpy()[block.chunk]
            totals = np.zeros(len(langs.dictionary), np.int64)
            np.add.at(totals, lang[block.room > 0], block.weight[block.room > 0])
            yield from _packets(langs.dictionary, np.arange(len(totals)), np.zeros(len(totals), np.int64), np.ones(len(totals), np.int64), np.full(len(totals), 0x0A, np.uint8), totals)
            if not len(often):
                continue
            second = SECOND.of(block.flat, block.starts, block.ends)
            frequent = []  # words, then pairs, that may be frequent and begin here
            for k in (1, 2):
                at = np.flatnonzero(block.room >= k)
                keys = block.keys(at, k, shards)
                hit = np.zeros(len(block.room), bool)
                hit[at] = often[np.minimum(np.searchsorted(often, keys), len(often) - 1)] == keys
                frequent.append(hit)
            for k in range(1, longest + 1):
                if k <= 2:
                    at = np.flatnonzero(frequent[k - 1])
                else:
                    # The last pair may begin in the overlap, where the next chunk counts it: it is not looked at there.
                    at = at[block.room[at] >= k]
                    at = at[frequent[1][at + k - 2] | (block.room[at + k - 2] < 2)]
                if not len(at):
                    break
                first = rolled(block.first, at, k)
                order, new = ordered(first ^ block.code[at], rolled(second, at, k))
                some, n = at[order[new]], np.add.reduceat(block.weight[at[order]], new)
                shard = shard_of(first[order[new]], phrase_shards)
                by = np.lexsort((shard, lang[some]))
                some = some[by]
                sizes, text = gathered(block.flat, block.starts[some], block.ends[some + k - 1] + 1)
                text[np.cumsum(sizes) - 1] = 0x0A
                yield from _packets(langs.dictionary, lang[some], shard[by], sizes, text, n[by])

    return of


def _packets(names: pa.Array, lang: np.ndarray, shard: np.ndarray, sizes: np.ndarray, text: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases in order of language and shard, one row for each of both."""
    cuts = runs(lang.astype(np.int64) << 32 | shard)
    at, ends, whole = cuts[:-1], np.concatenate([[0], np.cumsum(sizes)]), text.tobytes()
    phrases = [whole[ends[a] : ends[b]] for a, b in zip(cuts, cuts[1:])]
    counts = [n[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    yield pa.RecordBatch.from_arrays([names.take(pa.array(lang[at])), pa.array(shard[at], pa.int32()), pa.array(phrases, pa.binary()), pa.array(counts, pa.binary())], names=["lang", "shard", "phrases", "counts"])


def _sum_phrases(min_count: int):
    def of(packets: pa.Table) -> pa.Table:
        flat = np.frombuffer(b"".join(packets["phrases"].to_pylist()), np.uint8)
        offsets = np.concatenate([[0], np.flatnonzero(flat == 0x0A) + 1])
        phrases = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(flat))
        found = pa.table({"phrase": phrases, "n": np.frombuffer(b"".join(packets["counts"].to_pylist()), np.int64)}).group_by("phrase").aggregate([("n", "sum")])
        phrase, n = pc.utf8_rtrim(found["phrase"], "\n"), found["n_sum"]
        words = pc.if_else(pc.equal(phrase, ""), 0, pc.add(pc.count_substring(phrase, " "), 1)).cast(pa.int32())
        table = pa.table({"lang": pa.repeat(packets["lang"][0], len(found)), "words": words, "phrase": phrase.cast(pa.string()), "n": n})
        return table.filter(pc.or_(pc.equal(words, 0), pc.greater_equal(n, min_count)))

    return of


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, trigger: int = TRIGGER, min_count: int = MIN_COUNT, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(lang, words, phrase, n) of every phrase of up to ``longest`` words that occurs ``min_count`` times or more in
    its language; n of the empty phrase, of 0 words, is the number of all words."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards, blocks = max(1, math.ceil(size / shard_bytes)), max(1, math.ceil(size / block_bytes))
    chunks = rows.mapInArrow(_parse(longest, trigger), "lang string, chunk binary, n long")
    dealt = chunks.withColumn("block", F.pmod(F.xxhash64("lang", "chunk"), F.lit(blocks))).repartition("block")
    entries = dealt.groupBy("block", "lang", "chunk").agg(F.sum("n").alias("n"))
    entries = entries.groupBy("block").agg(F.collect_list(F.struct("lang", "chunk", "n")).alias("entries"))
    packets = entries.mapInArrow(_send_pairs(longest, min_count, shards), "shard int, block long, keys binary, counts binary")
    told = packets.groupBy("shard").applyInArrow(_frequent_pairs(min_count), "block long, shard int, keys binary")
    told = told.groupBy("block").agg(F.collect_list(F.struct("shard", "keys")).alias("told"))
    found = entries.join(told, "block", "left").mapInArrow(_send_phrases(longest, shards, 4 * shards), "lang string, shard int, phrases binary, counts binary")
    return found.groupBy("lang", "shard").applyInArrow(_sum_phrases(min_count), "lang string, words int, phrase string, n long")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    trigger: int = TRIGGER,
    min_count: int = MIN_COUNT,
    cover: int = COVER,
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, A-Z lower-cased, are split at ``.,;:!?`` and line ends into pieces and those at blanks and tabs into words; a
    phrase lies inside one piece. Candidates are phrases of 2 to ``longest`` words with a >= ``min_count`` occurrences,
    overlapping ones included. The score is the least of floor(1000 a n / (l r)) over the cuts into a first part and
    the rest, which occur l and r times, the earliest cut on ties; n counts the language's words. Candidates inside a
    longer one with ``cover`` hundredths of their occurrences go. Order: score, a, then the phrase by its bytes.

    A null text is empty, a null language ``und``; rows repeat as often as they stand in the table. Texts of any length
    count whole. An empty table gives no rows, other columns are not read.
    """
    counts = staged(phrase_counts(docs, text_col, lang_col, longest, trigger, min_count, block_bytes, shard_bytes))
    known = counts.filter("words > 0").select("lang", "phrase", "n")
    total = counts.filter("words = 0").select("lang", F.col("n").alias("n"))
    candidates = counts.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("_w"))
    part = lambda start, length: F.array_join(F.slice("_w", start, length), " ")
    cuts = candidates.select("lang", "words", "phrase", "a", "_w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("_first"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("_rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("_first"), F.col("n").alias("l")), ["lang", "_first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("_rest"), F.col("n").alias("r")), ["lang", "_rest"]).join(total, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    cuts = cuts.withColumns({"_up": F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"], "_down": wide["l"] * wide["r"]})
    scored = cuts.withColumn("score", F.expr("_up div _down")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("_s")).select("lang", "phrase", "_s.*")
    inside = candidates.filter("words > 2").select("lang", "words", "a", "_w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("k"))
    inside = inside.select("lang", "a", "_w", "k", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("k") + 1)).alias("_at"))
    inside = inside.select("lang", part(F.col("_at"), F.col("k")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_around"))
    left = scored.join(inside, ["lang", "phrase"], "left").filter(f"_around is null or 100 * _around < {int(cover)} * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    left = left.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    for keys in (["lang", "_part"], ["lang"]):
        left = left.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return left.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
