"""Exact Jaccard self-join of word shingles by universe partition and pigeonhole.

Shingle hashes are cut into segments by value, more segments for larger size bands. Two sets that are similar enough
differ in at most d shingles, so they agree on some segment if d + 1 segments are compared, or differ by one shingle in
a segment that counts twice. The larger set of a pair probes: it takes the segments that cost least, by a sketch of
shingle frequencies, as whole subsets, or with its one-deletion neighbourhood where that is cheaper; smaller sets are
indexed with every whole subset and, in some segments of a band, with all one-deletions.

Documents with equal sets are one node. Signatures travel in packed arrays to their shard, and only those that two
nodes share become rows. Buckets are not expanded into pairs: each node is verified against one central node, which
puts most of a group of near copies into one component, and where a bucket still holds several components, its members
are verified in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside_group, components, mix, staged, summed, text_of

#: Words in a shingle; similarity as a fraction; counters of the frequency sketch; signatures in one shard.
WORDS, SIMILARITY, SKETCH, SHARD_SIGNATURES = 5, (80, 100), 1 << 18, 2_000_000
#: Bytes of text handled at once; rows a shard holds before it lets go of shared ones.
CHUNK, HELD = 2_000_000, 3_000_000
#: Bytes of shingle hashes in a block of sets that are compared with each other.
BLOCK = 2_000_000
_U = np.uint64
_INDEX, _PROBE, _GONE = 1, 2, 4


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts, sorted by text and hash, and how many each text has.

    Words are split at ASCII white space, A-Z lower-cased. A text of fewer words is one shingle; without words, none.
    """
    split = [t.encode().lower().split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter((h for s in split for h in map(xxhash.xxh3_64_intdigest, s)), _U, int(sizes.sum()))
    ends = np.cumsum(sizes)
    starts, doc = ends - sizes, np.repeat(np.arange(len(split)), sizes)
    factor, rolled = _U(0x9E3779B97F4A7C15), np.zeros(max(0, len(flat) - words + 1), _U)
    for j in range(words):
        rolled = rolled * factor + flat[j : j + len(rolled)]
    whole = np.arange(len(rolled)) + words <= ends[doc[: len(rolled)]]
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    alone = [sum(int(flat[starts[i] + j]) * pow(int(factor), int(sizes[i]) - 1 - j, 1 << 64) for j in range(sizes[i])) + int(sizes[i]) & (1 << 64) - 1 for i in short]
    hashes = mix(np.concatenate([rolled[whole], np.array(alone, _U)]))
    doc = np.concatenate([doc[: len(rolled)][whole], short])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    first = np.ones(len(doc), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[first], np.bincount(doc[first], minlength=len(split))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return run[ends] - run[np.concatenate([[0], ends[:-1]]).astype(np.int64)] if len(ends) else values[:0]


def set_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """64 bits of each set: equal for equal sets."""
    return mix(_sums(mix(hashes ^ _U(0x5851F42D4C957F2D)), np.cumsum(counts)) + counts.astype(_U)).view(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts in groups of about ``size`` characters."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


class Bands:
    """Size bands and what a pair may differ in, for a similarity of ``num / den``."""

    def __init__(self, similarity: tuple[int, int] = SIMILARITY, ratio: float = 1.5):
        self.num, self.den = similarity
        tops = [1]
        while tops[-1] < 1 << 40:
            tops.append(max(tops[-1] + 1, int(tops[-1] * ratio)))
        self.tops = np.array(tops, np.int64)
        largest = self.tops * self.den // self.num
        self.segments = np.ceil(1.1 * self.units(largest, self.tops)).astype(np.int64) + 1
        self.loose = np.where(self.segments <= 8, self.segments, -(-self.segments // 16))

    def units(self, size: np.ndarray, top: np.ndarray) -> np.ndarray:
        """One more than the shingles by which a set may differ from a smaller one of at most ``top``."""
        return (np.minimum(size, top) + size) * (self.den - self.num) // (self.den + self.num) + 1

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, size)

    def reaches_lower(self, size: np.ndarray, band: np.ndarray) -> np.ndarray:
        return (band > 0) & (self.num * size <= self.den * self.tops[band - 1])


def signatures(hashes: np.ndarray, counts: np.ndarray, band: np.ndarray, own: bool, bands: Bands, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of sets in ``band`` (their own, or the one below, where they only probe): hash, set number, role."""
    n = len(counts)
    m, loose, units = bands.segments[band], bands.loose[band], bands.units(counts, bands.tops[band])
    base = np.cumsum(m) - m
    doc = np.repeat(np.arange(n), counts)
    # Segments follow the hash's order, so sorted hashes lie in sorted segments.
    inside = ((hashes >> _U(32)) * m[doc].astype(_U) >> _U(32)).astype(np.int64)
    at, total = base[doc] + inside, int(m.sum())
    filled = np.bincount(at, minlength=total)
    weight = mix(hashes + _U(0x2545F4914F6CDD1D))
    subset = _sums(weight, np.cumsum(filled))
    owner = np.repeat(np.arange(n), m)
    number = np.arange(total) - base[owner]
    name = mix((band[owner].astype(_U) << _U(48)) + number.astype(_U) * _U(2))
    name_less = mix((band[owner].astype(_U) << _U(48)) + number.astype(_U) * _U(2) + _U(1))
    # What a segment costs: how often its rarest shingle occurs, or without any, more than anything else.
    often = sketch[(hashes & _U(len(sketch) - 1)).astype(np.int64)].astype(np.int64)
    nothing = np.int64(1) << 40
    cost = np.full(total, nothing)
    if len(often):
        cost[filled > 0] = np.minimum.reduceat(often, (np.cumsum(filled) - filled)[filled > 0])
    may = np.flatnonzero(number < loose[owner])
    in_loose = np.flatnonzero(inside < loose[doc])
    second = np.full(total, nothing)
    if len(in_loose):
        by = in_loose[np.lexsort((often[in_loose], at[in_loose]))]
        new = np.ones(len(by), bool)
        new[1:] = at[by[1:]] != at[by[:-1]]
        runner = np.flatnonzero(~new & np.concatenate([[False], new[:-1]]))
        second[at[by[runner]]] = often[by[runner]]
    upgrade = np.maximum(cost[may], np.minimum(second[may] + filled[may] * cost[may], 2 * nothing))
    # The cheapest ``units`` of all: each whole subset is one, its one-deletions are one more.
    choice_owner, choice_cost = np.concatenate([owner, owner[may]]), np.concatenate([cost, upgrade])
    order = np.lexsort((choice_cost, choice_owner))
    sizes = m + np.bincount(owner[may], minlength=n)
    rank = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    taken = np.zeros(len(order), bool)
    taken[order] = rank < units[choice_owner[order]]
    whole, less = taken[:total], np.zeros(total, bool)
    less[may] = taken[total:]
    exact = mix(subset ^ name)
    minus = subset[at] - weight
    out = []
    if own:
        out.append((exact, owner, np.where(whole, _INDEX | _PROBE, _INDEX)))
        out.append((mix(minus[in_loose] ^ name_less[at[in_loose]]), doc[in_loose], np.full(len(in_loose), _INDEX)))
    else:
        out.append((exact[whole], owner[whole], np.full(int(whole.sum()), _PROBE)))
    near = np.flatnonzero(less[at])
    out.append((mix(minus[near] ^ name[at[near]]), doc[near], np.full(len(near), _PROBE)))
    out.append((mix(subset[less] ^ name_less[less]), owner[less], np.full(int(less.sum()), _PROBE)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _sets(words: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, sketch = TaskContext.get().partitionId(), np.zeros(SKETCH, np.int64)
        names = ["doc_id", "n", "key", "block", "part", "data"]
        for ids, texts in chunks(batches):
            hashes, counts = shingles(texts, words)
            sketch += np.bincount((hashes & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            none = [pa.nulls(len(ids), k) for k in (pa.int32(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(set_keys(hashes, counts), pa.int64()), *none], names=names)
        blocks = [x.astype("<u4").tobytes() for x in np.split(np.minimum(sketch, 2**32 - 1), 64)]
        none = [pa.nulls(64, pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([*none, pa.array(range(64), pa.int32()), pa.array([part] * 64, pa.int64()), pa.array(blocks, pa.binary())], names=names)

    return of


def _packets(words: int, similarity: tuple[int, int], shards: int, sketch):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bands, packet = Bands(similarity), TaskContext.get().partitionId() << 32
        for _, texts in chunks(batches):
            hashes, counts = shingles(texts, words)
            keys = set_keys(hashes, counts)
            # Copies within a chunk speak once.
            once = np.zeros(len(keys), bool)
            once[np.unique(keys, return_index=True)[1]] = True
            once &= counts > 0
            hashes, keys, counts = hashes[np.repeat(once, counts)], keys[once], counts[once]
            own = bands.of(counts)
            lower = bands.reaches_lower(counts, own)
            found = [signatures(hashes, counts, own, True, bands, sketch.value)]
            low = signatures(hashes[np.repeat(lower, counts)], counts[lower], own[lower] - 1, False, bands, sketch.value)
            found.append((low[0], np.flatnonzero(lower)[low[1]], low[2]))
            sig, node, role = (np.concatenate(x) for x in zip(*found))
            place = (sig % _U(shards)).astype(np.int64) * 2 + (role == _INDEX)
            order = np.argsort(place, kind="stable")
            sig, node, role, place = sig[order], keys[node[order]], role[order].astype(np.uint8), place[order]
            cuts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, int)
            ends = [*cuts[1:], len(place)]
            data = [[x[a:b].tobytes() for a, b in zip(cuts, ends)] for x in (sig, node, role)]
            packet += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[cuts] // 2, pa.int32()), pa.array(place[cuts] % 2, pa.int32()), pa.array([packet] * len(cuts), pa.int64()), *[pa.array(x, pa.binary()) for x in data]],
                names=["shard", "kind", "packet", "sig", "node", "role"],
            )

    return of


class _Shard:
    """What has come to one shard: probing rows are held, index rows are matched with them as they pass."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n, self.least, self.sorted, self.met = 0, 0, None, None

    def add(self, rows: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
        self.held.append(rows)
        self.n += len(rows[0])
        if self.n > max(HELD, 3 * self.least // 2):  # what stays is not sorted anew for every packet
            yield self.shared(False)
            self.least = self.n

    def _grouped(self) -> tuple:
        # One copy of one column at a time: what is held is the most that a worker has.
        columns = [[h[i] for h in self.held] for i in range(3)]
        self.held = []
        for i in range(3):
            columns[i] = np.concatenate(columns[i])
        order = np.lexsort((columns[1], columns[0]))
        for i in range(3):
            columns[i] = columns[i][order]
        sig, node, role = columns
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        return sig, node, role, starts

    def shared(self, last: bool) -> tuple[np.ndarray, ...]:
        """The rows whose signature several have; one row of each signature stays, unless this is the last call."""
        sig, node, role, starts = self._grouped() if self.sorted is None else self.sorted
        sizes = np.diff([*starts, len(sig)])
        roles = np.bitwise_or.reduceat(role, starts)
        go = (sizes > 1) & ((roles & _INDEX > 0) & (roles & _PROBE > 0) | (not last) | (roles & _GONE > 0))
        if self.met is not None:
            go |= self.met
        rows = np.repeat(go, sizes) & (role & _GONE == 0)
        stay = role[starts] | roles | np.where(go, _GONE, 0).astype(np.uint8)
        self.held, self.n = [(sig[starts], node[starts], stay)], len(starts)
        return sig[rows], node[rows], role[rows]

    def match(self, rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        if not self.n:
            return tuple(x[:0] for x in rows)
        if self.sorted is None:
            self.sorted = self._grouped()
            self.met = np.zeros(len(self.sorted[3]), bool)
        known = self.sorted[0][self.sorted[3]]
        at = np.minimum(np.searchsorted(known, rows[0]), len(known) - 1)
        hit = known[at] == rows[0]
        self.met[at[hit]] = True
        return tuple(x[hit] for x in rows)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, shard = None, _Shard()

    def rows(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64), pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2].astype(np.int32), pa.int32())], names=["sig", "node", "role"])

    for batch in batches:
        for place, kind, sig, node, role in zip(*(batch.column(n).to_pylist() for n in ("shard", "kind", "sig", "node", "role"))):
            if place != at:
                if shard.n:
                    yield rows(shard.shared(True))
                at, shard = place, _Shard()
            got = np.frombuffer(sig, "<u8"), np.frombuffer(node, "<i8"), np.frombuffer(role, np.uint8)
            for found in [shard.match(got)] if kind else shard.add(got):
                if len(found[0]):
                    yield rows(found)
    if shard.n:
        yield rows(shard.shared(True))


def _tokens(words: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            hashes, counts = shingles(texts, words)
            parts = np.split(hashes, np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(set_keys(hashes, counts), pa.int64()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["node", "tokens"])

    return of


def _compare(num: int, den: int, heads_only: bool):
    """Links between the sets of two blocks whose components differ; of those that say the same, one."""

    def unpack(block: list[dict]) -> tuple[list[int], list[int], list[np.ndarray]]:
        return [x["node"] for x in block], [x["comp"] for x in block], [np.frombuffer(x["tokens"], "<u8") for x in block]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                names, comps, tokens = unpack(batch.column("x")[i].as_py())
                others, their, theirs = (names, comps, tokens) if batch.column("same")[i].as_py() else unpack(batch.column("y")[i].as_py())
                if heads_only:
                    home = batch.column("home")[i].as_py()
                    names, comps, tokens = ([x[j] for j in range(len(names)) if names[j] == home][:1] for x in (names, comps, tokens))
                sizes, root = np.array([len(t) for t in theirs]), {}

                def find(c):
                    while root.get(c, c) != c:
                        c = root[c]
                    return c

                known, ids = np.unique(np.concatenate(theirs), return_inverse=True)
                at, links = np.repeat(np.arange(len(theirs)), sizes), []
                their_now = np.array(their, np.int64)
                for node, comp, own in zip(names, comps, tokens):
                    there = np.searchsorted(known, own)
                    there = there[(there < len(known)) & (known[np.minimum(there, len(known) - 1)] == own)]
                    mark = np.zeros(len(known), bool)
                    mark[there] = True
                    both = np.bincount(at[mark[ids]], minlength=len(sizes))
                    for j in np.flatnonzero((den * both >= num * (len(own) + sizes - both)) & (their_now != comp)):
                        x, y = find(comp), find(their[j])
                        if x != y:
                            root[y] = x
                            links.append((node, others[j]))
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return of


def _shared_buckets(rows: DataFrame) -> DataFrame:
    """(sig, node) of the buckets in which a probing and an indexed set meet; of buckets with equal members, one."""
    members = rows.groupBy("sig").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("node")).alias("h"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("g"), F.bit_or("role").alias("all")
    )
    one = members.filter("c > 1 and all & 3 = 3").groupBy("c", "h", "g").agg(F.min("sig").alias("sig")).select("sig")
    return rows.select("sig", "node").join(staged(one), "sig", "left_semi")


def _links(spark, buckets: DataFrame, tokens: DataFrame, num: int, den: int) -> DataFrame:
    """Enough verified links (a, b) between nodes that share a bucket to connect all that are connected.

    First every node is compared with one other: of the most central nodes of its buckets, the one that it meets most
    often. Buckets whose members this puts into one component are done. The members of the others are compared in
    blocks of bounded size, for all pairs of blocks that meet in a bucket, and no pair becomes a row.
    """
    central = buckets.groupBy("node").agg(F.count(F.lit(1)).alias("deg"))
    named = staged(buckets.join(staged(central), "node"))
    top = beside_group(named, ["sig"], m=F.max(F.struct("deg", "node"))).filter("m.node <> node")
    met = top.groupBy("node", F.col("m.node").alias("head")).agg(F.count(F.lit(1)).alias("c"))
    homes = met.groupBy("node").agg(F.max(F.struct("c", "head")).alias("m")).select("node", F.col("m.head").alias("home"))
    sized = tokens.select("node", F.octet_length("tokens").alias("size")).join(homes, "node", "left").withColumn("home", F.coalesce("home", "node"))
    sized = beside_group(staged(sized), ["home"], all=F.sum("size"))
    parts = F.ceil(F.col("all") / BLOCK).cast("int")
    placed = staged(sized.select("node", "home", F.xxhash64("home", F.pmod(F.xxhash64("node"), parts)).alias("block")))
    heads = placed.filter("node <> home").select("home", "block").distinct().select(F.col("home").alias("node"), "home", "block")

    def blocks(members: DataFrame) -> DataFrame:
        return members.join(tokens, "node").groupBy("block").agg(F.max("home").alias("home"), F.collect_list(F.struct("node", "comp", "tokens")).alias("x"))

    def compared(pairs: DataFrame, heads_only: bool) -> DataFrame:
        # Few rows in a batch, as each may hold two whole blocks.
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = spark.conf.get(key)
        spark.conf.set(key, "8")
        try:
            return staged(pairs.mapInArrow(_compare(num, den, heads_only), "a long, b long"))
        finally:
            spark.conf.set(key, before)

    families = blocks(placed.join(heads.select("block").distinct(), "block", "left_semi").unionByName(heads).distinct().withColumn("comp", F.col("node")))
    links = compared(families.select("home", "x", F.lit(True).alias("same")), True)
    roots = staged(components(links)).select("node", F.col("root").alias("comp"))
    now = staged(placed.join(roots, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    rows = staged(buckets.join(now, "node"))
    several = rows.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("sig")
    left = staged(rows.join(staged(several), "sig", "left_semi"))
    both = left.select("sig", "block").distinct().groupBy("sig").agg(F.sort_array(F.collect_list("block")).alias("at")).select("at").distinct()
    pairs = both.select(F.explode(F.expr("flatten(transform(at, (p, i) -> transform(slice(at, i + 1, size(at)), q -> struct(p as p, q as q))))")).alias("w")).select("w.p", "w.q").distinct()
    packed_ = staged(blocks(left.select("node", "home", "block", "comp").distinct()))
    first = packed_.select(F.col("block").alias("p"), "x")
    second = packed_.select(F.col("block").alias("q"), F.col("x").alias("y"))
    apart = staged(pairs).join(first, "p")
    alone = apart.filter("p = q").select("x", F.lit(True).alias("same"), F.expr("filter(x, e -> false)").alias("y"))
    across = apart.filter("p <> q").join(second, "q").select("x", F.lit(False).alias("same"), "y")
    return roots.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionAll(compared(alone.unionAll(across), False))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest id that links reach), set_key.

    Two rows link when their sets of ``words``-word shingles have a Jaccard similarity of num / den or more. Texts
    without words (null, empty, blank) have the empty set and link with nothing. Rows that share an id are rows of
    their own, told apart by their sets; a null id is passed over when the smallest is sought, so a component without
    any id has none. Sets are told apart by 64 bits of hash. An empty table gives no rows.
    """
    spark, (num, den) = docs.sparkSession, similarity
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    first = staged(rows.mapInArrow(_sets(words), "doc_id long, n long, key long, block int, part long, data binary"))
    sets = first.filter("block is null").select("doc_id", "n", "key")
    total = sets.agg(F.sum("n")).first()[0] or 0
    sketch = np.zeros(SKETCH, "<u4")
    for block, data in summed(first.filter("block is not null").select("block", "part", "data"), "<u4").collect():
        sketch[block * len(data) // 4 : (block + 1) * len(data) // 4] = np.frombuffer(data, "<u4")
    shards = max(24, math.ceil(0.6 * total / SHARD_SIGNATURES))
    packets = rows.select("doc_id", "text").mapInArrow(_packets(words, similarity, shards, spark.sparkContext.broadcast(sketch)), "shard int, kind int, packet long, sig binary, node binary, role binary")
    met = packets.repartition("shard").sortWithinPartitions("shard", "kind", "packet").mapInArrow(_meet, "sig long, node long, role int")
    buckets = staged(_shared_buckets(staged(met.groupBy("sig", "node").agg(F.bit_or("role").alias("role")))))
    nodes = staged(buckets.select("node").distinct())
    keyed = sets.filter("n > 0")
    # One row of each candidate set is read again, and rows without an id, as a set may have no others.
    chosen = staged(keyed.join(nodes, keyed["key"] == nodes["node"], "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct())
    texts = rows.join(chosen, "doc_id", "left_semi").unionAll(rows.filter("doc_id is null"))
    tokens = texts.select("doc_id", "text").mapInArrow(_tokens(words), "node long, tokens binary")
    tokens = staged(tokens.join(nodes, "node", "left_semi").dropDuplicates(["node"]))
    links = _links(spark, buckets, tokens, num, den)
    roots = staged(components(links))
    ids = staged(keyed.groupBy("key").agg(F.min("doc_id").alias("id")))
    linked = staged(ids.join(roots, ids["key"] == roots["node"]).select("key", "id", "root"))
    linked = staged(beside_group(linked, ["root"], low=F.min("id")).select("key", "low"))
    # One row for each set, so that the rows of a set with very many copies meet one join.
    named = staged(ids.join(linked, "key", "left").select("key", F.coalesce("low", "id").alias("component_id")))
    own = keyed.join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("key").alias("set_key"))
    none = sets.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("set_key"))
    return own.unionAll(none)


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; all columns stay as they are.

    Documents without words are components of their own. Of rows that repeat the smallest id, and of rows without an
    id whose component has no other, all stay. Where an id is repeated, only its rows that are similar to others go.
    """
    found = staged(similar_components(docs, id_col, text_col, words, similarity))
    away = staged(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone"), F.col("set_key").alias("_key")).distinct())
    whole = away.select("_gone").distinct()
    kept = found.filter("component_id = doc_id").select(F.col("doc_id").alias("_gone"))
    shared = staged(whole.join(kept, "_gone", "left_semi"))
    if shared.isEmpty():
        return docs.join(whole, docs[id_col] == whole["_gone"], "left_anti")
    # Ids with rows that stay and rows that go: there the texts say which is which.
    alone = whole.join(shared, "_gone", "left_anti")
    left = docs.join(alone, docs[id_col] == alone["_gone"], "left_anti")
    print_ = F.xxhash64(text_of(text_col))
    texts = docs.join(shared, docs[id_col] == shared["_gone"], "left_semi").select(print_.alias("doc_id"), text_of(text_col).alias("text"))
    keys = texts.mapInArrow(_sets(words), "doc_id long, n long, key long, block int, part long, data binary").filter("block is null")
    keys = staged(keys.select(F.col("doc_id").alias("_print"), F.col("key").alias("_key")).distinct())
    pairs = away.join(shared, "_gone", "left_semi").join(keys, "_key").select("_gone", "_print").distinct()
    return left.join(pairs, (left[id_col] == pairs["_gone"]) & (print_ == pairs["_print"]), "left_anti")
