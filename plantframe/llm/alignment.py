"""Alignment of two tokenizers by sparse products over bytes.

Tokens and the bytes they hold form incidence matrices in compressed rows. Row by row, the product of one with the
other's transpose gives the tokens that overlap, with the bytes they share; tokens and groups, which end where tokens of
both end, are multiplied alike. Neither vocabulary has a token that reaches from a word over the white space before the
next one, so words are aligned once and looked up; texts keep which words they have. How often two ids are linked in
the corpus is a sum over words, handed back in slices of fixed size, and each text adds up its words.
"""

from __future__ import annotations

import base64
import hashlib
import math
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, lists, staged, text_chunks, text_of
from .words import runs

#: Bytes of text handled at once; words a worker remembers; pairs of ids in a slice; entries a product expands at once.
CHUNK, REMEMBERED, SLICE_PAIRS, EXPANDED = 500_000, 120_000, 2_000_000, 1_000_000
#: Bytes of staged chunks that a task reads at once; a chunk has some 600,000.
GROUP_BYTES = 4 << 20
#: White space stays with the word behind it. Texts of other characters are aligned whole.
_CUT = re.compile(r"[ \n\t]*[^ \n\t]+|[ \n\t]+")
_PLAIN = re.compile(r"[\t\n\x20-\x7e¡-ɏ]*")


class Rows(NamedTuple):
    """A sparse matrix by rows: where each row's entries begin, and one more for the end; their columns; their values."""

    ptr: np.ndarray
    columns: np.ndarray
    values: np.ndarray


def ones(ptr: np.ndarray, columns: np.ndarray) -> Rows:
    return Rows(ptr, columns, np.ones(len(columns), np.int64))


def product_blocks(a: Rows, b: Rows, width: int, expanded: int = EXPANDED) -> Iterator[tuple[int, int, Rows]]:
    """``a`` times ``b``, which has ``width`` columns, as blocks of rows (from, to, rows): each row of ``a`` adds up the
    rows of ``b`` that its entries name. A block has about ``expanded`` sums, one row at least."""
    sizes = b.ptr[a.columns + 1] - b.ptr[a.columns]
    work = np.concatenate([[0], np.cumsum(sizes)])[a.ptr]
    low, rows = 0, len(a.ptr) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(work, work[low] + expanded, "right")) - 1)
        inner = slice(a.ptr[low], a.ptr[high])
        own, n = sizes[inner], int(work[high] - work[low])
        at = np.arange(n) - np.repeat(np.cumsum(own) - own - b.ptr[a.columns[inner]], own)
        row = np.repeat(np.repeat(np.arange(high - low), np.diff(a.ptr[low : high + 1])), own)
        key, value = row * width + b.columns[at], np.repeat(a.values[inner], own) * b.values[at]
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        new = runs(key)[:-1]
        ptr = np.concatenate([[0], np.cumsum(np.bincount(key[new] // width, minlength=high - low))])
        yield low, high, Rows(ptr, key[new] % width, np.add.reduceat(value, new) if n else value)
        low = high


def product(a: Rows, b: Rows, width: int, expanded: int = EXPANDED) -> Rows:
    ptr, columns, values = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for _, _, block in product_blocks(a, b, width, expanded):
        ptr.append(block.ptr[1:] + ptr[-1][-1])
        columns.append(block.columns)
        values.append(block.values)
    return Rows(*map(np.concatenate, (ptr, columns, values)))


def byte_incidence(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[Rows, Rows]:
    """Tokens of A by bytes, and bytes by tokens of B; both cut the same bytes, into tokens of these sizes."""
    ptr = np.concatenate([[0], np.cumsum(a_sizes)])
    n = int(ptr[-1])
    return ones(ptr, np.arange(n)), ones(np.arange(n + 1), np.repeat(np.arange(len(b_sizes)), b_sizes))


def groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B: groups end where tokens of both end."""
    a, b = np.cumsum(a_sizes), np.cumsum(b_sizes)
    both = np.intersect1d(a, b, assume_unique=True)
    return np.searchsorted(both, a), np.searchsorted(both, b)


def group_incidence(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[Rows, Rows]:
    """Tokens of A by groups, and groups by tokens of B."""
    a, b = groups(a_sizes, b_sizes)
    n = int(a[-1]) + 1 if len(a) else 0
    return ones(np.arange(len(a) + 1), a), ones(np.searchsorted(b, np.arange(n + 1)), np.arange(len(b)))


def _byte_values() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from 256 on."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and the words aligned so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.a_path, self.a = a_path, None
        ranks, self.fast = a_path.removesuffix(".json") + ".tiktoken", None
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        else:
            values = _byte_values()
            known = {bytes(values[c] for c in entry) if all(c in values for c in entry) else entry.encode(): i for entry, i in self._whole().get_vocab().items()}
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for entry, i in known.items():
            self.a_bytes[i] = entry
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
        self.space = self.b.piece_to_id("▁")
        self.splits = all("▁" not in p.lstrip("▁") and not ({*" \n\t"} & {*p} and len(p) > 1) for p, _ in pieces)
        self.sizes = [np.array([len(x) for x in own], np.int64) for own in (self.a_bytes, self.b_bytes)]
        ids = max(len(self.a_bytes), len(self.b_bytes))
        self.names = {end: np.array([b"%d%s" % (i, end) for i in range(ids)], object) for end in (b",", b"|", b";")}
        #: Per word: its number; by number: tokens of A, of B, groups, links (all 0 if the bytes differ), group text, linked ids.
        self.known, self.counts, self.texts, self.links = {}, np.zeros((4, 0), np.int64), [], []

    def _whole(self):
        """The tokenizer of A itself, loaded for the first text that needs it."""
        if self.a is None:
            from tokenizers import Tokenizer

            self.a = Tokenizer.from_file(self.a_path)
            self.a.encode_special_tokens = True
        return self.a

    def keep(self, words: set[str], more: int) -> None:
        """Forget all words but these, and make room for ``more``."""
        old = [self.known[w] for w in words]
        counts = np.zeros((4, max(REMEMBERED, len(old) + more)), np.int64)
        counts[:, : len(old)] = self.counts[:, old]
        self.known, self.counts = {w: i for i, w in enumerate(words)}, counts
        self.texts, self.links = [self.texts[i] for i in old], [self.links[i] for i in old]

    def words(self, text: str) -> list[str]:
        """The text with a space before it, cut where no token of either vocabulary reaches over."""
        full = " " + text
        return _CUT.findall(full) if self.splits and self.fast and _PLAIN.fullmatch(text) else [full]

    def _encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [self.fast.encode_ordinary(w) if self.fast and _PLAIN.fullmatch(w) else self._whole().encode(w, add_special_tokens=False).ids for w in words]
        b = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        for i, w in enumerate(words):
            if w == " ":  # the tokenizer puts nothing before an empty text
                b[i] = [self.space]
            elif w[0] != " ":
                b[i] = b[i][1:]
        return a, b

    def learn(self, words: list[str]) -> None:
        """Align new words, all in one product: equal bytes one after the other, groups of different words stay apart."""
        a, b = self._encode(words)
        equal = [b"".join(map(self.a_bytes.__getitem__, x)) == b"".join(map(self.b_bytes.__getitem__, y)) == w.encode() for w, x, y in zip(words, a, b)]
        a, b = ([x if e else [] for e, x in zip(equal, own)] for own in (a, b))
        n_a, n_b = (np.array([len(x) for x in own], np.int64) for own in (a, b))
        flat_a, flat_b = (np.array([i for x in own for i in x], np.int64) for own in (a, b))
        sizes_a, sizes_b = self.sizes[0][flat_a], self.sizes[1][flat_b]
        linked = product(*byte_incidence(sizes_a, sizes_b), max(1, len(sizes_b)))
        group_a, group_b = groups(sizes_a, sizes_b)
        keys = np.repeat(flat_a, np.diff(linked.ptr)) * len(self.b_bytes) + flat_b[linked.columns]
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        link_stop = linked.ptr[stop_a]
        number = np.concatenate([[0], group_a + 1])[stop_a]
        start, rows = len(self.texts), slice(len(self.texts), len(self.texts) + len(words))
        self.counts[:, rows] = n_a, n_b, np.diff(number, prepend=0), np.diff(link_stop, prepend=0)
        # In the group text, a token of A has the tokens of B of all groups before it, one of B also the tokens of A of its own.
        parts = np.empty(len(flat_a) + len(flat_b), object)
        parts[np.arange(len(flat_a)) + np.searchsorted(group_b, group_a)] = np.where(np.append(np.diff(group_a), 1) > 0, self.names[b"|"][flat_a], self.names[b","][flat_a])
        parts[np.arange(len(flat_b)) + np.searchsorted(group_a, group_b, "right")] = np.where(np.append(np.diff(group_b), 1) > 0, self.names[b";"][flat_b], self.names[b","][flat_b])
        parts, keys = parts.tolist(), keys.astype("<u8").tobytes()
        ends, link_ends = [0, *(stop_a + stop_b).tolist()], [0, *(8 * link_stop).tolist()]
        self.texts += [b"".join(parts[i:j]) for i, j in zip(ends, ends[1:])]
        self.links += [keys[i:j] for i, j in zip(link_ends, link_ends[1:])]
        self.known |= {w: start + i for i, w in enumerate(words)}

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of all texts by number, and how many each text has; none where the bytes of a text differ."""
        words = [self.words(t) if t else [] for t in texts]
        own = set().union(*words)
        new = own.difference(self.known)
        if len(self.known) + len(new) > self.counts.shape[1]:
            self.keep(own - new, len(new))
        if new:
            self.learn(list(new))
        sizes = np.array([len(w) for w in words], np.int64)
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        row = np.repeat(np.arange(len(texts)), sizes)
        differs = np.bincount(row, weights=self.counts[0, numbers] == 0, minlength=len(texts)) > 0
        return numbers[~differs[row]], np.where(differs, 0, sizes)


_loaded: dict[tuple[str, str], Tokenizers] = {}
_DOCS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_STAGED = (
    "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, groups array<string>, "
    "n_words binary, words binary, n_word_links binary, word_links binary, pairs binary, counts binary"
)


def _align(a_path: str, b_path: str, with_groups: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _loaded.get((a_path, b_path)) or _loaded.setdefault((a_path, b_path), Tokenizers(a_path, b_path))
        made = 0
        for batch in batches:
            for at, to, texts in text_chunks(batch.column(1), CHUNK):
                number, sizes = both.number(texts)
                stop = np.cumsum(sizes)
                sums = np.zeros((4, len(number) + 1), np.int64)
                np.cumsum(both.counts[:, number], axis=1, out=sums[:, 1:])
                sums = sums[:, stop] - sums[:, stop - sizes]
                named = list(map(both.texts.__getitem__, number.tolist()))
                joined = [b"".join(named[e - n : e])[:-1] for e, n in zip(stop.tolist(), sizes.tolist())]
                words, own, often = np.unique(number, return_inverse=True, return_counts=True)
                links = [both.links[w] for w in words.tolist()]
                n_links = np.array([len(x) // 8 for x in links], np.int64)
                pairs, linked = np.unique(np.frombuffer(b"".join(links), "<u8"), return_inverse=True)
                counts = np.zeros(len(pairs), np.int64)
                np.add.at(counts, linked, np.repeat(often, n_links))
                made += 1
                one = lambda kind, *values: [pa.array([v], kind) for v in values]
                blobs = (sizes.astype("<u4"), own.astype("<u4"), n_links.astype("<u4"), linked.astype("<u4"), pairs, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([TaskContext.get().taskAttemptId() << 24 | made]),
                        pa.ListArray.from_arrays([0, to - at], batch.column(0).slice(at, to - at).cast(pa.int64())),
                        *[lists(values, [to - at], pa.int64()) for values in sums],
                        *one(pa.list_(pa.string()), [hashlib.sha256(x).hexdigest() if x else "" for x in joined], [x.decode() for x in joined] if with_groups else None),
                        *one(pa.binary(), *[x.tobytes() for x in blobs]),
                    ],
                    names=[f.split()[0] for f in _STAGED.split(", ")],
                )

    return of


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(pairs, np.int64)), pa.array(np.frombuffer(counts, np.int64))], names=["pair", "n"])


def _add_up(table, last: bool):
    """Sums over each text's links of their counts, and of those that are the highest of their B id, within one slice.

    Words times pairs, then texts times words: products of compressed rows with vectors.
    """

    def times(sizes: np.ndarray, columns: np.ndarray, values: np.ndarray) -> np.ndarray:
        run = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(values[:, columns], axis=1)], axis=1)
        stop = np.cumsum(sizes.astype(np.int64))
        return run[:, stop] - run[:, stop - sizes]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                blob = lambda name, kind="<u4": np.frombuffer(row.column(name)[0].as_py(), kind)  # noqa: E731, B023
                own = blob("pairs", np.int64)
                found = np.minimum(np.searchsorted(pairs, own), max(0, len(pairs) - 1))
                hit = pairs[found] == own if len(pairs) else np.zeros(len(own), bool)
                values = np.where(hit, np.stack([best[found], counts[found]]), 0) if len(pairs) else np.zeros((2, len(own)), np.int64)
                values = times(blob("n_word_links"), blob("word_links"), values)
                values = times(blob("n_words"), blob("words"), values)
                n = values.shape[1]
                head = [row.column("chunk").take(pa.array(np.zeros(n, np.int64))), pa.array(np.arange(n))]
                rest = [row.column(c).flatten() if last and len(row.column(c).flatten()) else pa.nulls(n, row.column(c).type.value_type) for c in [*_DOCS, "groups"]]
                yield pa.RecordBatch.from_arrays([*head, *rest, pa.array(values[0]), pa.array(values[1])], names=["chunk", "place", *_DOCS, "groups", "n_best", "count_sum"])

    return of

_RESULT = "chunk long, place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, n_best long, count_sum long"


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and on request groups.

    A is a byte-level vocabulary that reads a space and the text, B one of pieces with byte fallback that puts the space
    there itself. Byte offsets where tokens of both end close a group; tokens that share bytes are linked. The count of
    an id pair is the number of its links in all rows; ``count_sum`` adds it up over a text's links and ``n_best``
    counts the links whose pair has the highest count of its B id, ties included. ``groups`` reads
    ``a1,a2|b1;a3|b2,b3``, and its hash is empty where there are no tokens: for null and empty texts and those whose
    bytes one tokenizer changes. Strings of special tokens are plain text. Rows repeat as often as they stand in the
    table, also those that share an id or have none; texts of any length count whole. An empty table gives no rows,
    other columns are not read.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    chunks = staged(rows.mapInArrow(_align(a_path, b_path, with_groups), _STAGED), GROUP_BYTES)
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    counts = chunks.select("pairs", "counts").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = staged(counts.withColumn("b", F.pmod("pair", F.lit(width))))
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))
    table = counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    # The vocabularies bound the number of slices, whatever the number of texts.
    slices, found = max(1, math.ceil(counts.count() / slice_pairs)), None
    for s in range(slices):
        part = table.filter(F.pmod(F.xxhash64("pair"), F.lit(slices)) == s) if slices > 1 else table
        part = part.toArrow().sort_by("pair")
        values = [part[c].to_numpy() for c in ("pair", "n")] + [part["best"].to_numpy().astype(np.int64)]
        sent = docs.sparkSession.sparkContext.broadcast(values)
        one = chunks.mapInArrow(_add_up(sent, s == 0), _RESULT)
        if slices > 1:  # one slice is held at a time
            one = staged(one)
            sent.destroy()
        found = one if found is None else found.unionAll(one)
    out = [*_DOCS[:-1], "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups]
    if slices > 1:
        firsts = [F.max(c).alias(c) for c in [*_DOCS, "groups"]]
        found = found.groupBy("chunk", "place").agg(*firsts, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.select(*out)




def _links(a_path: str, b_path: str, incidence):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _loaded.get((a_path, b_path)) or _loaded.setdefault((a_path, b_path), Tokenizers(a_path, b_path))
        for batch in batches:
            for at, _, texts in text_chunks(batch.column(1), CHUNK):
                for row, text in enumerate(texts, at):
                    a, b = (np.array([i for w in own for i in w], np.int64) for own in both._encode(both.words(text) if text else []))
                    if b"".join(both.a_bytes[i] for i in a) != (" " + text).encode() or b"".join(both.b_bytes[i] for i in b) != (" " + text).encode():
                        continue
                    for low, high, found in product_blocks(*incidence(both.sizes[0][a], both.sizes[1][b]), len(b)):
                        a_at = np.repeat(np.arange(low, high), np.diff(found.ptr))
                        ids = batch.column(0).take(pa.array(np.full(len(a_at), row))).cast(pa.int64())
                        yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (a_at, found.columns, a[a_at], b[found.columns], found.values))], names=["doc_id", "a_at", "b_at", "a", "b", "shared"])

    return of


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", by: str = "bytes") -> DataFrame:
    """The links themselves: doc_id, a_at, b_at (places of the tokens), a, b (their ids) and shared.

    By ``bytes``, tokens that overlap, with the number of bytes they share; by ``groups``, tokens of one group, which are
    as many as the product of its sizes. Texts without tokens, as in ``align``, have no links.
    """
    incidence = {"bytes": byte_incidence, "groups": group_incidence}[by]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_links(a_path, b_path, incidence), "doc_id long, a_at long, b_at long, a long, b long, shared long")
