"""Nearest neighbours with randomly rotated one-bit codes.

A vector is stored as the signs of its rotated offset from the centroid, with the offset's length and the inner product
of the code with the offset's direction. From these an inner product with a query is estimated without bias and with a
bound on its error; vectors whose bound allows them among the nearest are measured exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Width of the error bound, in standard deviations; queries that are broadcast at once; rows estimated at once.
BOUND, QUERIES_AT_ONCE, ROWS_AT_ONCE = 3.0, 2048, 1024


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, length of the offset, and the code's inner product with the offset's direction (1 for none)."""
    turned = (vectors - centre) @ turn
    length = np.linalg.norm(turned, axis=1)
    own = np.abs(turned).sum(axis=1) / (math.sqrt(turned.shape[1]) * np.where(length > 0, length, 1))
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, own, 1)


def estimate(bits: np.ndarray, length: np.ndarray, own: np.ndarray, queries: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances, rows by queries (already turned)."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    far = np.linalg.norm(queries, axis=1)
    inner = (signs @ queries.T.astype(np.float32)) / math.sqrt(dim) / own[:, None]
    spread = bound * np.sqrt(np.maximum(1 - own**2, 0)) / own / math.sqrt(max(dim - 1, 1))
    middle = length[:, None] ** 2 + far**2 - 2 * length[:, None] * inner
    wide = 2 * (length * spread)[:, None] * far + 1e-4 * (length[:, None] ** 2 + far**2)
    return middle - wide, middle + wide


def usable(vector: str) -> Column:
    """Not null, not zero, every component present and finite."""
    return F.coalesce(F.expr(f"forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists({vector}, x -> x <> 0)"), F.lit(False))


def index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 0) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Codes of all usable vectors (id, vector, bits, length, own), with the centroid and the rotation.

    Vectors that are null, zero or have a null or non-finite component take no part, nor do rows without an id and
    vectors whose dimension is not the commonest (the smaller on a tie).
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & usable("vector"))
    common = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = common[0] if common else 1
    rows = rows.filter(F.size("vector") == dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim), 0
        for batch in batches:
            total, n = total + matrix(batch.column(0), dim).sum(axis=0), n + batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total), pa.array([n] * dim, pa.int64())], names=["i", "total", "n"])

    sums = rows.select("vector").mapInArrow(add, "i int, total double, n long").groupBy("i").agg((F.sum("total") / F.greatest(F.sum("n"), F.lit(1))).alias("m"))
    centre = np.zeros(dim)
    for i, m in sums.collect():
        centre[i] = m
    turn = rotation(dim, seed)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, length, own = encode(matrix(batch.column(1), dim), centre, turn)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(own)], names=["id", "vector", "bits", "length", "own"])

    return staged(rows.mapInArrow(codes, "id long, vector array<double>, bits binary, length double, own double")), centre, turn


class _Best:
    """For each query the ``k`` nearest rows so far, by distance and id; an id counts once."""

    def __init__(self, k: int, queries: int):
        self.k, self.limit = k, np.full(queries, np.inf)
        self.query, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids, score = np.concatenate([self.query, query]), np.concatenate([self.id, ids]), np.concatenate([self.score, score])
        order = np.lexsort((score, ids, query))
        query, ids, score = query[order], ids[order], score[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
        query, ids, score = query[new], ids[new], score[new]
        order = np.lexsort((ids, score, query))
        query, ids, score = query[order], ids[order], score[order]
        starts = np.searchsorted(query, query)
        rank = np.arange(len(query)) - starts
        near = rank < self.k
        last = rank == self.k - 1
        self.limit[query[last]] = score[last]
        self.query, self.id, self.score = query[near], ids[near], score[near]


def _search(found, centre, turn, k: int, bound: float):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = found.value
        turned, best = (queries - centre) @ turn, _Best(k, len(names))
        for batch in batches:
            ids = batch.column("id").to_numpy()
            vectors = matrix(batch.column("vector"), len(centre))
            bits = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(len(ids), -1)
            length, own = batch.column("length").to_numpy(), batch.column("own").to_numpy()
            for at in range(0, len(ids), ROWS_AT_ONCE):
                s = slice(at, at + ROWS_AT_ONCE)
                low, high = estimate(bits[s], length[s], own[s], turned, bound)
                high[ids[s][:, None] == names] = np.inf
                limit = best.limit**2
                if len(high) >= k:
                    limit = np.minimum(limit, np.partition(high, k - 1, axis=0)[k - 1])
                row, query = np.nonzero((low <= limit * (1 + 1e-9)) & (ids[s][:, None] != names))
                score = np.concatenate([np.zeros(0), *(np.sqrt(((vectors[s][row[i : i + 65536]] - queries[query[i : i + 65536]]) ** 2).sum(axis=1)) for i in range(0, len(row), 65536))])
                best.add(query, ids[s][row], score)
        yield pa.RecordBatch.from_arrays([pa.array(names[best.query]), pa.array(best.id), pa.array(best.score)], names=["query_id", "vec_id", "score"])

    return of


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", bound: float = BOUND, seed: int = 0) -> DataFrame:
    """The ``k`` nearest found of each usable row that ``queries`` chooses: query_id, rank (from 1), vec_id, score.

    ``queries`` is a condition on the column ``id``. Scores are Euclidean distances in double precision; ties go to the
    smaller id. Rows that repeat an id are one candidate, the nearest of them, and none for the query of that id; a
    query id that repeats is searched with one of its vectors. Fewer candidates than ``k`` are all returned. Queries
    are broadcast in parts of bounded size, each part against all codes.
    """
    spark = vectors.sparkSession
    codes, centre, turn = index(vectors, id_col, vector_col, seed)
    asked = staged(codes.filter(queries).groupBy("id").agg(F.min("vector").alias("vector")))
    parts, result = max(1, math.ceil(asked.count() / QUERIES_AT_ONCE)), None
    for part in range(parts):
        own = asked.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).orderBy("id").collect()
        if not own:
            continue
        found = spark.sparkContext.broadcast((np.array([r[0] for r in own], np.int64), np.array([r[1] for r in own], np.float64)))
        near = codes.mapInArrow(_search(found, centre, turn, k, bound), "query_id long, vec_id long, score double")
        result = near if result is None else result.unionAll(near)
    if result is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    once = result.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
