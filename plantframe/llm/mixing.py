"""Mixing sources to target weights by temperature, in DataFrame functions only.

Each source's share of tokens is raised to an exponent between 0 (all sources alike) and 1 (as they are), found by
bisection: the exponent at which the weights' entropy is a target, or at which no document is repeated more than a
limit allows. Every source then gets a budget of tokens, spent in passes over its documents, each a permutation of
blocks; the last pass ends with a part of a block when the budget does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, staged, text_of

#: How often a document may occur; tokens in a block; points of a pass of the search, and passes.
MAX_REPEATS, BLOCK_TOKENS, POINTS, PASSES = 2.0, 1_000_000, 32, 5


def tokens_of(text_col: str) -> Column:
    """Words at ASCII white space, and one for the end of the document."""
    return (F.regexp_count(text_of(text_col), F.lit("[^\\x20\\x09-\\x0D]+")) + 1).cast("long")


def exponent(totals: DataFrame, entropy: float | None = None, max_repeats: float | None = MAX_REPEATS) -> float:
    """The exponent for sources with ``tokens``, by bisection, five bits at a time.

    With ``entropy`` (nats) the largest exponent whose weights have at least that much, 0 if none has. Otherwise the
    smallest at which the smallest source is repeated at most ``max_repeats`` times as often as the largest.
    """
    total = totals.agg(F.sum("tokens")).first()[0] or 1
    shares = totals.filter("tokens > 0").select((F.col("tokens") / F.lit(float(total))).alias("p"))
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        points = [low + (high - low) * i / POINTS for i in range(POINTS + 1)]
        columns = []
        for i, a in enumerate(points):
            columns += [F.sum(F.pow("p", F.lit(a))).alias(f"s{i}"), F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"l{i}")]
        row = shares.agg(F.min("p").alias("least"), F.max("p").alias("most"), *columns).first()
        if row["least"] is None:
            return 1.0
        if entropy is not None:
            fits = [math.log(row[f"s{i}"]) - a * row[f"l{i}"] / row[f"s{i}"] >= entropy for i, a in enumerate(points)]
            if not fits[0] or all(fits):
                return points[0] if not fits[0] else points[-1]
            at = max(i for i, x in enumerate(fits) if x)
            low, high = points[at], points[at + 1]
        else:
            fits = [(row["most"] / row["least"]) ** (1 - a) <= max_repeats for a in points]
            if fits[0]:
                return points[0]
            at = min(i for i, x in enumerate(fits) if x)
            low, high = points[at - 1], points[at]
    return low if entropy is not None else high


def weights(totals: DataFrame, entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget: int | None = None) -> DataFrame:
    """``totals`` (source, tokens) with weight, target (tokens) and repeats (target by tokens).

    Weights sum to 1. Without ``budget`` it is the smallest one at which no source falls short of one whole pass.
    """
    alpha = exponent(totals, entropy, max_repeats)
    powered = totals.withColumn("_w", F.pow(F.col("tokens").cast("double"), F.lit(alpha)))
    sums = powered.agg(F.sum("_w").alias("w"), F.max(F.col("tokens") / F.col("_w")).alias("r")).first()
    total = float(budget) if budget is not None else (sums["r"] or 0.0) * (sums["w"] or 0.0)
    done = powered.withColumn("weight", F.col("_w") / F.lit(sums["w"] or 1.0)).drop("_w")
    done = done.withColumn("target", F.col("weight") * total)
    # A budget that is a whole number of passes but for rounding is that number.
    repeats = F.col("target") / F.col("tokens")
    return done.withColumn("repeats", F.when(F.abs(repeats - F.round(repeats)) < 1e-9, F.round(repeats)).otherwise(repeats))


def _place(seed: int, epoch: Column, blocks: Column) -> tuple[Column, Column]:
    """A document's block in a pass, and its place within the block, from a hash of id, text and pass."""
    h = F.xxhash64(F.lit(seed), epoch, "_id", "_text_hash")
    return F.pmod(h, blocks), F.xxhash64(h)


def _realised(rows: DataFrame, plan: DataFrame, seed: int, block_tokens: int) -> DataFrame:
    """``rows`` (_source, _id, _text_hash, _tokens, ...) as often as the plan says, with epoch, block and place."""
    shown = plan.select("_source", F.floor("repeats").cast("long").alias("_full"), (F.col("target") - F.floor("repeats") * F.col("tokens")).alias("_rest"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("tokens") / block_tokens)).alias("_blocks"))
    known = rows.join(shown, "_source")
    whole = known.filter("_full > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_full") - 1)))
    block, place = _place(seed, F.col("epoch"), F.col("_blocks"))
    whole = whole.withColumn("block", block).withColumn("place", place)
    part = known.withColumn("epoch", F.col("_full"))
    block, place = _place(seed, F.col("epoch"), F.col("_blocks"))
    part = part.withColumn("block", block).withColumn("place", place)
    sums = part.select("_source", "block", "_rest", "_tokens").groupBy("_source", "block", "_rest").agg(F.sum("_tokens").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("_source").orderBy("block")) - F.col("_sum")
    cut = staged(sums.withColumn("_before", before).filter("_before < _rest").select("_source", "block", "_before", "_sum"))
    part = part.join(cut, ["_source", "block"])
    taken = part.filter("_before + _sum <= _rest")
    # At most one block of a source is cut; within it documents are taken in their places while the budget lasts.
    run = F.sum("_tokens").over(Window.partitionBy("_source").orderBy("place", "_id").rowsBetween(Window.unboundedPreceding, 0))
    cut_rows = part.filter("_before + _sum > _rest").withColumn("_run", run).filter("_before + _run <= _rest").drop("_run")
    columns = [c for c in rows.columns] + ["epoch", "block", "place"]
    return whole.select(columns).unionAll(taken.select(columns)).unionAll(cut_rows.select(columns))


def _keyed(docs: DataFrame, source_col: str, id_col: str, text_col: str, *more: Column) -> DataFrame:
    source = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit("-"))
    return docs.select(source.alias("_source"), F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text_of(text_col)).alias("_text_hash"), tokens_of(text_col).alias("_tokens"), *more)


def plan_of(rows: DataFrame, entropy: float | None, max_repeats: float | None, budget: int | None) -> DataFrame:
    totals = staged(rows.groupBy("_source").agg(F.sum("_tokens").alias("tokens")))
    return staged(weights(totals, entropy, max_repeats, budget))


def mix_plan(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget: int | None = None, seed: int = 0, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A row for each time that a document occurs in the mixture: doc_id, source, epoch, block, place, n_tokens, weight, repeats.

    Passes follow one another; within a pass, blocks by number and documents by place are a permutation of the source.
    Rows without a source are one source of their own. Texts without words, null among them, count their end alone.
    Rows that share id and text share their place and count each time. A budget that no document fits into gives none.
    """
    rows = staged(_keyed(docs, source_col, id_col, text_col))
    plan = plan_of(rows, entropy, max_repeats, budget)
    found = _realised(rows, plan, seed, block_tokens).join(plan.select("_source", "weight", "repeats"), "_source")
    source = F.when(F.col("_source") != "-", F.expr("substring(_source, 2)"))
    return found.select(F.col("_id").alias("doc_id"), source.alias("source"), "epoch", "block", "place", F.col("_tokens").alias("n_tokens"), "weight", "repeats")


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget: int | None = None, seed: int = 0, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mixture itself: rows of ``docs``, all columns, as often as ``mix_plan`` says."""
    plan = plan_of(_keyed(docs, source_col, id_col, text_col), entropy, max_repeats, budget)
    return _realised(_keyed(docs, source_col, id_col, text_col, packed(docs)), plan, seed, block_tokens).select("_row.*")
