"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

A document's log weight is the sum over its word n-grams of the log ratio of two bag-of-hashed-n-grams models. Sampling
without replacement with these weights is taking the k largest of log weight plus Gumbel noise; the noise comes from the
id, so a rerun repeats itself, and the k-th largest key is found by counting, not by sorting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, packed, staged, text_chunks, text_of

#: Hash buckets; longest n-gram; labelled target documents the target model is fitted on, at most; pseudo-count.
BUCKETS, LONGEST, TARGET_DOCS, SMOOTHING = 10_000, 2, 20_000, 100.0
_CHUNK = 1_000_000
#: Words, and runs of marks: junk often shows in its marks.
_WORD = re.compile(r"\w+|[^\w\s]+")


def ngram_buckets(texts: list[str], buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and the text of each; of words and runs of marks, case counts."""
    words = [_WORD.findall(t) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(words)), sizes)
    found, owner, rolled = [], [], flat
    for n in range(1, longest + 1):
        if n > 1:
            rolled = rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + flat[n - 1 :] if len(rolled) else rolled
        inside = doc[: len(rolled)] == doc[n - 1 :][: len(rolled)]
        found.append((mix(rolled[inside] + np.uint64(n)) % np.uint64(buckets)).astype(np.int64))
        owner.append(doc[: len(rolled)][inside])
    return np.concatenate(found), np.concatenate(owner)


def _count(buckets: int, longest: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for at, to, texts in text_chunks(batch.column(1), _CHUNK):
                found, owner = ngram_buckets(texts, buckets, longest)
                raw += np.bincount(found, minlength=buckets)
                target += np.bincount(found[good[at:to][owner]], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(raw[some], pa.int64()), pa.array(target[some], pa.int64())], names=["bucket", "raw", "target"])

    return of


def log_ratios(docs: DataFrame, targets: DataFrame, id_col: str, text_col: str, buckets: int, longest: int, smoothing: float) -> np.ndarray:
    """Log of target over raw probability of each bucket. Raw counts are of all documents, target counts of ``targets``,
    both with ``smoothing`` added in proportion to the raw model."""
    chosen = targets.select(F.col(targets.columns[0]).alias("_id")).distinct().withColumn("_good", F.lit(True))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_of(text_col).alias("_text")).join(F.broadcast(chosen), "_id", "left")
    counted = rows.select(F.coalesce("_good", F.lit(False)), "_text").mapInArrow(_count(buckets, longest), "bucket long, raw long, target long")
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for bucket, r, t in counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[bucket], target[bucket] = r, t
    # Counts too small to tell the models apart give no weight.
    expected = raw * (target.sum() / max(raw.sum(), 1))
    return np.log((target + smoothing) / (expected + smoothing)) if target.any() else np.zeros(buckets)


def _sortable(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the same order as the doubles."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def _keys(ratios, buckets: int, longest: int):
    """A column function of text and noise: log weight, key, and a whole number in the order of the keys."""

    @F.pandas_udf("weight double, key double, place long")
    def keys(texts, noise):
        import pandas as pd

        weights = [np.zeros(0)]
        for _, _, some in text_chunks(pa.array(texts, pa.string()), _CHUNK):
            found, owner = ngram_buckets(some, buckets, longest)
            weights.append(np.bincount(owner, ratios.value[found], minlength=len(some)))
        weight = np.concatenate(weights)
        key = weight + noise.to_numpy(float)
        return pd.DataFrame({"weight": weight, "key": key, "place": _sortable(key)})

    return keys


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest of a long column, by counting its bits sixteen at a time; None if there are no more than k."""
    low, shift, left = rows, 48, k
    found = 0
    while shift >= 0:
        digit = F.shiftright(column, shift) if shift == 48 else F.shiftright(column, shift).bitwiseAND(0xFFFF)
        counts = sorted(low.groupBy(digit.alias("d")).count().collect(), reverse=True)
        for d, n in counts:
            if left <= n:
                break
            left -= n
        else:
            return None
        found, low, shift = found + (d << shift), low.filter(digit == d), shift - 16
    return found


class Resampler:
    """Importance weights of documents towards a target, fitted on all documents and ``targets`` (ids, few enough to broadcast)."""

    def __init__(self, docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, buckets: int = BUCKETS, longest: int = LONGEST, smoothing: float = SMOOTHING):
        ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, targets, id_col, text_col, buckets, longest, smoothing))
        self.docs, self.id, self.text, self.seed, self.keys = docs, F.col(f"`{id_col}`").cast("long"), text_of(text_col), seed, _keys(ratios, buckets, longest)

    def keyed(self, *columns) -> DataFrame:
        """The columns with _weight, _key and _order, a whole number in the order of the keys."""
        noise = -F.log(-F.log((F.pmod(F.xxhash64(F.col("_id"), F.lit(self.seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)))
        rows = self.docs.select(*columns, self.id.alias("_id"), self.text.alias("_text")).withColumn("_keys", self.keys("_text", noise))
        return rows.drop("_text").select("*", F.col("_keys.weight").alias("_weight"), F.col("_keys.key").alias("_key"), F.col("_keys.place").alias("_order")).drop("_keys")

    def kept(self, keyed: DataFrame, k: int | None, share: float = 0.0) -> Column:
        """Whether a row has one of the ``k`` largest keys of ``keyed``."""
        if k is None:
            accepted, n = keyed.agg(F.sum(F.exp(F.least("_weight", F.lit(0.0)))), F.count(F.lit(1))).first()
            k = round(max(accepted or 0, share * n))
        last = kth_largest(keyed, "_order", k) if k > 0 else None
        return F.lit(k > 0) if last is None else F.col("_order") >= F.lit(last)


def resample(docs: DataFrame, targets: DataFrame, k: int | None = None, share: float = 0.0, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, log_weight, key (with the noise) and kept.

    ``targets`` has ids of documents of the target distribution. The ``k`` largest keys are kept. Without ``k`` it is the
    number that rejection sampling would accept, the sum over all documents of min(1, weight): a document at least as
    likely under the target counts whole; but at least ``share`` of all. Rows tied with the last place are all kept. Texts without words, null among
    them, have weight 1. Rows that share id and text share noise and fate; a null id is an id like any other. Without
    targets all weights are 1. Very long texts count whole.
    """
    model = Resampler(docs, targets, **options)
    keyed = staged(model.keyed())
    return keyed.select(F.col("_id").alias("doc_id"), F.col("_weight").alias("log_weight"), F.col("_key").alias("key"), model.kept(keyed, k, share).alias("kept"))


def target_ids(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", most: int = TARGET_DOCS) -> DataFrame:
    """Ids that all their labels call good; the ``most`` with the smallest hashes, a bounded sample to fit on."""
    good = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.min(f"`{quality_col}`").alias("q")).filter("q = 1 and id is not null")
    return good.orderBy(F.xxhash64("id"), "id").limit(most).select("id")


def good_share(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> float:
    """The share of labelled documents that all their labels call good; 0 without labels."""
    judged = labels.filter(f"`{id_col}` is not null and `{quality_col}` is not null").groupBy(f"`{id_col}`").agg(F.min(f"`{quality_col}`").alias("q"))
    return judged.agg(F.avg((F.col("q") == 1).cast("double"))).first()[0] or 0.0


def keep_good(docs: DataFrame, labels: DataFrame, k: int | None = None, **options) -> DataFrame:
    """``docs`` without the rows that resampling towards the well labelled documents rejects; all columns stay.

    Keys depend on id and text alone, so rows are weighed again where they lie instead of joining the decisions.
    """
    model = Resampler(docs, target_ids(labels), **options)
    kept = model.kept(staged(model.keyed()), k, good_share(labels))
    return model.keyed(packed(docs)).filter(kept).select("_row.*")
