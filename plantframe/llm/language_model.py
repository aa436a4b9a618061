"""Scoring by masked pseudo-likelihood with a small bidirectional window network.

The network predicts a word from the words on both sides of it: embeddings weighted by position, one hidden layer, and a
softmax in two steps (class, word in class). The predicted word is never in its own window, so every position of every
document is a training target, once: each round takes its own share of the positions. Words with ids of their own grow
with the cube root of all words; the others share ids by hash, and what the network gives such an id is divided among
them by their counts in all texts.

Texts are split and numbered once, in chunks; both training rounds and the scoring read the numbers. The network is
trained in numpy inside tasks; after each round the tasks' parameters are averaged, weighted by what they have seen.
Chunks send the hashes of their distinct rare words to the shard that holds the counts, in packets, and get the
words' shares back in the same order. A document's score is the sum of the conditional log-probabilities of all its words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lists, spans, staged, summed, text_of

#: Least number of classes, and of words in a class; width of embeddings; words seen on each side.
LEAST, WIDTH, SIDE = 32, 24, 2
#: Words with ids, shared ones included, per cube root of all words; the part of the ids that rare words share.
GROWTH, SHARED = 10, 4
#: Rounds of training, which share the positions between them; rate.
ROUNDS, RATE = 2, 0.1
#: Bytes of text in a chunk; distinct words held while counting; hashes in a shard; parameters in a block that tasks add up;
#: places scored at once.
_CHUNK, _COUNTED, _SHARD, _BLOCK, _SCORED = 2_000_000, 200_000, 2_000_000, 32_768, 4096
_PAD, RARE = LEAST * LEAST, LEAST * LEAST // SHARED
#: Logarithms are added as whole numbers of this size, so that no order of rows changes a sum.
_GRID = 2.0**-24


class Words:
    """Ids of words: frequent ones have their own, others share one of ``rare`` by hash."""

    def __init__(self, frequent: list[bytes], classes: int = LEAST):
        self.frequent, self.pad, self.rare = pa.array(frequent, pa.binary()), classes * classes, classes * classes // SHARED

    def ids(self, distinct: pa.Array) -> np.ndarray:
        own = pc.fill_null(pc.index_in(distinct, value_set=self.frequent.cast(distinct.type)), -1).to_numpy()
        hashes = np.fromiter(map(zlib.crc32, _bytes(distinct)), np.int64, len(distinct))
        return np.where(own < 0, self.pad - self.rare + hashes % self.rare, own).astype(kind(self.pad))


def _bytes(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def split_all(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and the words of all texts in a row, A-Z lower-cased."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    words = pc.ascii_split_whitespace(trimmed)
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    # Arrow finds one empty word in a text without words.
    empty = pc.fill_null(pc.equal(pc.binary_length(trimmed), 0), False).to_numpy(zero_copy_only=False)
    flat = words.flatten()
    if empty.any():
        sizes[empty], flat = 0, flat.filter(pc.greater(pc.binary_length(flat), 0))
    return sizes, flat.cast(pa.large_binary() if pa.types.is_large_string(flat.type) else pa.binary())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def out() -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in batches:
        for a, b in spans(batch.column(0), _CHUNK):
            words, counts = split_all(batch.column(0).slice(a, b - a))[1].value_counts().flatten()
            held.append(pa.table({"word": words.cast(pa.binary()), "n": counts}))
            n += len(words)
            if n > 2 * _COUNTED:
                held = [out()]
                n = held[0].num_rows
                if n > _COUNTED:
                    yield from held[0].to_batches()
                    held, n = [], 0
    if held:
        yield from out().to_batches()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all words of all texts, written once."""
    return staged(texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))


def classes_of(counts: DataFrame) -> int:
    """How many classes, and words in each, a corpus of so many words gets."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return max(LEAST, math.ceil(math.sqrt(GROWTH * total ** (1 / 3))))


def vocabulary(counts: DataFrame, classes: int = LEAST) -> list[bytes]:
    """The commonest words, as many as have ids of their own; ties go to the smaller word."""
    own = classes * classes - classes * classes // SHARED
    return [bytes(r[0]) for r in counts.orderBy(F.desc("n"), "word").limit(own).collect()]


def shares(counts: DataFrame, frequent: list[bytes], rare: int = RARE) -> tuple[DataFrame, int]:
    """(word, share) of the words that share an id: the logarithm of a word's part of all words with that id, in steps
    of the grid. And the least that a word may have, for one that was not counted."""
    own = counts.sparkSession.createDataFrame([(bytearray(w),) for w in frequent], "word binary")
    # Both broadcasts hold no more than the ids of the vocabulary, whose number classes_of() bounds.
    left = counts.join(F.broadcast(own), "word", "left_anti").withColumn("id", (F.crc32("word") % rare).cast("int"))
    found = {r["id"]: r["total"] for r in left.groupBy("id").agg(F.sum("n").alias("total")).collect()}
    totals = counts.sparkSession.createDataFrame([(i, math.log(n)) for i, n in found.items()], "id int, total double")
    share = F.round((F.log("n") - F.col("total")) / _GRID).cast("int")
    return left.join(F.broadcast(totals), "id").select("word", share.alias("share")), round(-math.log(sum(found.values()) + 1) / _GRID)


def kind(pad: int) -> type:
    """The type of stored ids."""
    return np.uint16 if pad < 1 << 16 else np.int32


def numbers(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts in a row with padding between them, the places of the words, and the text of each place."""
    sizes, flat = split_all(pa.array(texts, pa.string()))
    return _placed(sizes, _ids(flat, words)[0], words)


def _ids(flat: pa.Array, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Ids of words in a row; each one's number among the distinct words, and these with their ids."""
    found = flat.dictionary_encode()
    own, index = words.ids(found.dictionary), found.indices.to_numpy()
    return own[index], index, own, found.dictionary


def _placed(sizes: np.ndarray, ids: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(doc)) + SIDE * (doc + 1)
    row = np.full(len(doc) + SIDE * (len(sizes) + 1), words.pad, kind(words.pad))
    row[places] = ids
    return row, places, doc


_CHUNKS = "chunk long, doc_id array<long>, sizes binary, ids binary, seen binary, hashes binary"


def _number(known, classes: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, at = Words(known.value, classes), TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in spans(batch.column(1), _CHUNK):
                sizes, flat = split_all(batch.column(1).slice(a, b - a))
                ids, index, own, distinct = _ids(flat, words)
                rare = own >= words.pad - words.rare
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, _bytes(distinct.filter(pa.array(rare)))), np.uint64, np.count_nonzero(rare))
                order = np.argsort(hashes)
                rank = np.empty(len(own), np.int32)
                rank[np.flatnonzero(rare)[order]] = np.arange(len(order))
                data = [sizes, _placed(sizes, ids, words)[0], rank[index[rare[index]]], hashes[order]]
                ids = lists(batch.column(0).slice(a, b - a), [b - a], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([at]), ids, *[pa.array([d.tobytes()], pa.binary()) for d in data]], names=["chunk", "doc_id", "sizes", "ids", "seen", "hashes"])
                at += 1

    return of


_OFFSETS = [i for i in range(-SIDE, SIDE + 1) if i]


def shapes(classes: int) -> dict[str, tuple[int, ...]]:
    return {"embed": (classes * classes + 1, WIDTH), "place": (2 * SIDE, WIDTH), "bias": (WIDTH,), "classes": (classes, WIDTH), "class_bias": (classes,), "members": (classes, classes, WIDTH), "member_bias": (classes, classes)}


_SHAPES = shapes(LEAST)


def fresh(seed: int, classes: int = LEAST) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {n: (0.1 * rng.standard_normal(s)).astype(np.float32) for n, s in shapes(classes).items()}
    model["place"] += 1
    return model


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[n].ravel() for n in _SHAPES])


def shaped(values: np.ndarray, classes: int = LEAST) -> dict[str, np.ndarray]:
    every = shapes(classes)
    parts = np.split(values.astype(np.float32), np.cumsum([math.prod(s) for s in every.values()])[:-1])
    return {n: p.reshape(s) for (n, s), p in zip(every.items(), parts)}


def _with_ones(hidden: np.ndarray, of: type = np.float32) -> np.ndarray:
    """Rows of the hidden layer and a one, so that a product with ``_with_bias`` has the bias in it."""
    found = np.ones((len(hidden), WIDTH + 1), of)
    found[:, :WIDTH] = hidden
    return found


def _with_bias(model: dict[str, np.ndarray], of: type = np.float32) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of the classes, and of the members of each class."""
    upper = np.concatenate([model["classes"], model["class_bias"][:, None]], axis=1, dtype=of)
    return upper, np.concatenate([model["members"], model["member_bias"][..., None]], axis=2, dtype=of)


def _member_scores(lower: np.ndarray, hidden: np.ndarray, starts: list[int]) -> np.ndarray:
    """A column per place, which stand by class: scores of the members of its class."""
    scores = np.empty((lower.shape[1], len(hidden)), hidden.dtype)
    for c, weights in enumerate(lower):
        a, b = starts[c], starts[c + 1]
        if a < b:
            np.matmul(weights, hidden[a:b].T, out=scores[:, a:b])
    return scores


def _taken(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per column the logarithm of the softmax in row ``at``."""
    scores -= scores.max(axis=0)
    own = scores[at, np.arange(len(at))]
    return own - np.log(np.exp(scores, out=scores).sum(axis=0))


def _slopes(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per column the slope of that logarithm by each score."""
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores *= -1 / scores.sum(axis=0)
    scores[at, np.arange(len(at))] += 1
    return scores


def _hidden(model: dict, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings of a span of the row, and the hidden layer at all its places but ``SIDE`` at both ends."""
    embedded, n = model["embed"][span], len(span) - 2 * SIDE
    total = np.broadcast_to(model["bias"], (n, WIDTH)).copy()
    for j, offset in enumerate(_OFFSETS):
        total += embedded[SIDE + offset : SIDE + offset + n] * model["place"][j]
    return embedded, np.tanh(total)


def _by_class(target: np.ndarray, classes: int) -> tuple[np.ndarray, list[int]]:
    """The order that puts targets of one class together, and where each class begins and the last ends."""
    group = (target % classes).astype(np.uint16)
    return np.argsort(group, kind="stable"), [0, *np.cumsum(np.bincount(group, minlength=classes)).tolist()]


def log_probabilities(model: dict, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of the word at each place (ascending), given the words around it."""
    return _scored(model, _with_bias(model, np.float64), row, at)


def _scored(model: dict, weights: tuple[np.ndarray, np.ndarray], row: np.ndarray, at: np.ndarray) -> np.ndarray:
    # Products are rounded from higher precision, so that values do not hang on where a place stands among the others.
    (upper, lower), classes = weights, len(model["classes"])
    target, (_, hidden) = row[at], _hidden(model, row[at[0] - SIDE : at[-1] + SIDE + 1])
    order, starts = _by_class(target, classes)
    hidden, target = _with_ones(hidden[(at - at[0])[order]], np.float64), target[order]
    sums = _taken((upper @ hidden.T).astype(np.float32), target % classes)
    sums += _taken(_member_scores(lower, hidden, starts).astype(np.float32), target // classes)
    found = np.empty_like(sums)
    found[order] = sums
    return found


def train_step(model: dict, squares: dict, row: np.ndarray, at: np.ndarray, rate: float) -> None:
    """One step of gradient ascent on the log-probabilities of the words at ascending places, which lie close together;
    each parameter's rate is scaled by its past gradients."""
    classes, (above, below) = len(model["classes"]), _with_bias(model)
    span = row[at[0] - SIDE : at[-1] + SIDE + 1]
    embedded, layer = _hidden(model, span)
    order, starts = _by_class(row[at], classes)
    inside, target = (at - at[0])[order], row[at][order]
    hidden = _with_ones(layer[inside])
    upper = _slopes(above @ hidden.T, target % classes)
    lower = _slopes(_member_scores(below, hidden, starts), target // classes)
    back, found, inner_ = upper.T @ model["classes"], upper @ hidden, np.zeros_like(below)
    for c in range(classes):
        a, b = starts[c], starts[c + 1]
        if a < b:
            back[a:b] += lower[:, a:b].T @ model["members"][c]
            np.matmul(lower[:, a:b], hidden[a:b], out=inner_[c])
    change = {"classes": found[:, :WIDTH], "class_bias": found[:, WIDTH], "members": inner_[..., :WIDTH], "member_bias": inner_[..., WIDTH]}
    hidden = hidden[:, :WIDTH]
    back *= 1 - hidden**2
    change["bias"] = back.sum(axis=0)
    full, inner, change["place"] = np.zeros_like(layer), np.zeros_like(embedded), np.empty_like(model["place"])
    full[inside] = back
    for j, offset in enumerate(_OFFSETS):
        to = slice(SIDE + offset, SIDE + offset + len(full))
        change["place"][j] = np.einsum("nd,nd->d", full, embedded[to])
        inner[to] += full * model["place"][j]
    by_word = np.argsort(span, kind="stable")
    words, first = np.unique(span[by_word], return_index=True)
    step = np.add.reduceat(inner[by_word], first, axis=0) / len(at)
    squares["embed"][words] += step**2
    model["embed"][words] += rate * step / np.sqrt(squares["embed"][words] + 1e-8)
    for name, step in change.items():
        step /= len(at)
        squares[name] += step**2
        model[name] += rate * step / np.sqrt(squares[name] + 1e-8)


def _train(state, classes: int, round_: int, rounds: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, step, pad, seen = TaskContext.get().partitionId(), classes * classes, classes * classes, 0
        model, squares = (shaped(half, classes) for half in np.split(state.value, 2))
        for batch in batches:
            for data in batch.column(0):
                row = np.frombuffer(data.as_buffer(), kind(pad))
                places = np.flatnonzero(row != pad)
                for i in range(0, len(places), rounds * step):
                    window = places[i : i + rounds * step]
                    part_of = math.ceil(len(window) / rounds)
                    at = window[round_ * part_of : (round_ + 1) * part_of]
                    if len(at):
                        train_step(model, squares, row, at, RATE)
                        seen += len(at)
        if seen:
            values = (np.concatenate([flat(model), flat(squares), [1]]) * (seen / 1e6)).astype(np.float32)
            blocks = [values[i : i + _BLOCK].tobytes() for i in range(0, len(values), _BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int64()), pa.array(blocks)], names=["block", "part", "data"])

    return of


def fit(chunks: DataFrame, classes: int, rounds: int = ROUNDS, seed: int = 0) -> dict[str, np.ndarray]:
    """The network, from the numbers of all chunks. A step has as many places as there are ids.

    What passes through the driver is the network and its squared gradients, which grow with the cube root of the corpus.
    """
    network = flat(fresh(seed, classes))
    values, ways = np.concatenate([network, np.zeros_like(network)]), max(8, math.isqrt(chunks.rdd.getNumPartitions()))
    for round_ in range(rounds):
        state = chunks.sparkSession.sparkContext.broadcast(values)
        parts = chunks.select("ids").mapInArrow(_train(state, classes, round_, rounds), "block int, part long, data binary")
        total = dict(tuple(r) for r in summed(parts, "<f4", ways).collect())
        if total:
            sums = np.concatenate([np.frombuffer(total[i], "<f4") for i in range(len(total))])
            values = (sums[:-1] / sums[-1]).astype(np.float32)
        state.unpersist()
    return shaped(values[: len(network)], classes)


def _asked(bits: int):
    """Hashes of chunks, in packets by shard; their order within a chunk is that of the shards."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = np.frombuffer(data.as_buffer(), np.uint64)
                shards, first = np.unique(hashes >> np.uint64(64 - bits), return_index=True)
                packets = [x.tobytes() for x in np.split(hashes, first[1:])] if len(shards) else []
                yield pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int64)), pa.array([chunk] * len(packets), pa.int64()), pa.array(packets, pa.binary()), pa.nulls(len(packets), pa.binary())], names=["shard", "chunk", "hashes", "shares"])

    return of


def _known(bits: int):
    """Hashes and shares of words, in packets by shard, without a chunk."""

    def out(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, values = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(hashes)
        hashes, values = hashes[order], values[order]
        shards, first = np.unique(hashes >> np.uint64(64 - bits), return_index=True)
        packed = [pa.array([x.tobytes() for x in np.split(all_, first[1:])], pa.binary()) for all_ in (hashes, values)]
        return pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int64)), pa.nulls(len(shards), pa.int64()), *packed], names=["shard", "chunk", "hashes", "shares"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append((np.fromiter(map(xxhash.xxh3_64_intdigest, _bytes(batch.column(0))), np.uint64, batch.num_rows), batch.column(1).to_numpy()))
                n += batch.num_rows
            if n > _COUNTED:
                yield out(held)
                held, n = [], 0
        if held:
            yield out(held)

    return of


def rare_shares(chunks: DataFrame, words: int, share: DataFrame, least: int) -> DataFrame:
    """(chunk, shard, shares): shares of the distinct rare words of chunks, in the order of their hashes."""
    many = (chunks.agg(F.sum(F.length("hashes"))).first()[0] or 0) // 8 + words
    bits = max(3, math.ceil(math.log2(many / _SHARD + 1)))

    def find(packets: pa.Table) -> pa.Table:
        counted = packets.filter(packets["chunk"].is_null())
        asked = packets.filter(packets["chunk"].is_valid())
        hashes = np.frombuffer(b"".join(counted["hashes"].to_pylist()), np.uint64)
        values = np.frombuffer(b"".join(counted["shares"].to_pylist()), np.int32)
        order = np.argsort(hashes)
        hashes, values, answers = hashes[order], values[order], []
        for data in asked["hashes"]:
            wanted = np.frombuffer(data.as_buffer(), np.uint64)
            if not len(hashes):
                answers.append(np.full(len(wanted), least, np.int32).tobytes())
                continue
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            answers.append(np.where(hashes[at] == wanted, values[at], np.int32(least)).tobytes())
        return pa.table({"chunk": asked["chunk"], "shard": asked["shard"], "shares": pa.array(answers, pa.binary())})

    schema = "shard long, chunk long, hashes binary, shares binary"
    packets = chunks.select("chunk", "hashes").mapInArrow(_asked(bits), schema).unionAll(share.mapInArrow(_known(bits), schema))
    return packets.groupBy("shard").applyInArrow(find, "chunk long, shard long, shares binary")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, seed: int = 0) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, log_likelihood (summed over its words), mean_log_likelihood.

    Words are split at ASCII white space, A-Z lower-cased. Texts without words, null among them, have a sum of 0 and no
    mean; a null id stays null. Very long texts are scored whole. Rows that repeat count each time and have equal
    scores; an empty table gives no rows. Other columns, whatever their names, are not read. Every word counts with its
    own probability: that of its id, times its share of the id where others have the same.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    counts, context = word_counts(rows.select("text")), docs.sparkSession.sparkContext
    classes = classes_of(counts)
    words = vocabulary(counts, classes)
    # Written once: no text is split again, and chunks keep their numbers.
    chunks = staged(rows.mapInArrow(_number(context.broadcast(words), classes), _CHUNKS))
    values = context.broadcast(flat(fit(chunks, classes, rounds, seed)))
    found = rare_shares(chunks, counts.count(), *shares(counts, words, classes * classes // SHARED))

    def network(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, pad = shaped(values.value, classes), classes * classes
        weights = _with_bias(model, np.float64)
        for batch in batches:
            for i in range(batch.num_rows):
                row, sizes = (np.frombuffer(batch[c][i].as_buffer(), k) for c, k in (("ids", kind(pad)), ("sizes", np.int64)))
                places, doc, sums = np.flatnonzero(row != pad), np.repeat(np.arange(len(sizes)), sizes), np.zeros(len(sizes))
                for k in range(0, len(places), _SCORED):
                    steps = np.rint(_scored(model, weights, row, places[k : k + _SCORED]) / _GRID)
                    sums += np.bincount(doc[k : k + _SCORED], steps, minlength=len(sizes))
                rare = np.bincount(doc[row[places] >= pad - pad // SHARED], minlength=len(sizes))
                more = [pa.array([x.tobytes()], pa.binary()) for x in (sums, rare)]
                yield pa.RecordBatch.from_arrays([*[batch[c].slice(i, 1) for c in ("chunk", "doc_id", "sizes", "seen")], *more], names=["chunk", "doc_id", "sizes", "seen", "sums", "rare"])

    def of(parts: pa.Table) -> pa.Table:
        packets = parts.filter(parts["shard"].is_valid()).sort_by("shard")
        chunk = parts.filter(parts["shard"].is_null()).slice(0, 1)
        kinds = (("sizes", np.int64), ("seen", np.int32), ("sums", np.float64), ("rare", np.int64))
        sizes, seen, sums, rare = (np.frombuffer(chunk[c][0].as_buffer(), k) for c, k in kinds)
        share = np.frombuffer(b"".join(packets["shares"].to_pylist()), np.int32)
        sums = (sums + np.bincount(np.repeat(np.arange(len(sizes)), rare), share[seen], minlength=len(sizes))) * _GRID
        mean = pa.array(sums / np.maximum(sizes, 1), mask=sizes == 0)
        return pa.table({"doc_id": chunk["doc_id"].combine_chunks().flatten(), "n_words": pa.array(sizes), "log_likelihood": pa.array(sums), "mean_log_likelihood": mean})

    scored = "chunk long, doc_id array<long>, sizes binary, seen binary, sums binary, rare binary"
    own = chunks.select("chunk", "doc_id", "sizes", "ids", "seen").mapInArrow(network, scored)
    return own.unionByName(found, allowMissingColumns=True).groupBy("chunk").applyInArrow(of, "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double")
