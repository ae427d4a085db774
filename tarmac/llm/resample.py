"""Quality selection by importance resampling.

Method: word unigrams and bigrams are hashed into BUCKETS. Two bag-of-n-gram models are
counted over whole texts: the target model from documents labelled good (of at most
MAX_LABELLED labelled ones), the raw model from the whole corpus. A document's log-weight is the sum over its
n-grams of log(target / raw). The kept documents are a weighted sample without
replacement: each gets the key  log-weight / TEMPERATURE + Gumbel noise, and the k largest
keys win. Noise is drawn from a seed and the document's key, so it never depends on the
order of work.

The weight is taken as its mean per n-gram times LENGTH, so that it does not grow with the
text. A bucket's counts are summed per task, then over tasks; the models are
BUCKETS numbers, whatever the corpus. The k-th key is found by counting keys in ever
narrower ranges, without sorting the corpus in one task.

Defined results: null and empty texts have no n-grams and log-weight 0; documents without a
label, or with null labels, count as raw only; a document labelled more than once is
good if all its labels are; equal keys are settled by document key; equal rows share a key and
are kept or left together as far as k allows; an empty table gives an empty table; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import words as w
from tarmac.llm.store import Scratch, row_key

BUCKETS = 1 << 16
#: The target model is fitted on at most so many labelled documents (16 bytes each go to every executor).
MAX_LABELLED = 1_000_000
SMOOTHING = 1.0
TEMPERATURE = 1.0
LENGTH = 200.0
SEED = 17


def _features(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the text of each."""
    text = np.searchsorted(offsets, np.arange(len(hashes)), "right") - 1
    pairs = w.combine(hashes[:-1], hashes[1:]) if len(hashes) > 1 else np.zeros(0, w.U64)
    inside = text[:-1] == text[1:]
    buckets = np.concatenate((hashes, pairs[inside])) & w.U64(BUCKETS - 1)
    return buckets.astype(np.int64), np.concatenate((text, text[:-1][inside]))


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(bucket, target, raw) over documents with a text and a boolean column good."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            good = batch["good"].fill_null(False).to_numpy(zero_copy_only=False)
            for first, hashes, offsets in w.each_text(batch["text"]):
                buckets, text = _features(hashes, offsets)
                own = good[first + text] if len(text) else np.zeros(0, bool)
                sums[0] += np.bincount(buckets[own], minlength=BUCKETS)
                sums[1] += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(sums.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(sums[0][some]), pa.array(sums[1][some])], names=["bucket", "target", "raw"]
        )

    counted = docs.select("text", "good").mapInArrow(w.tidy(run), "bucket int, target long, raw long")
    return counted.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log(target / raw) of every bucket: BUCKETS numbers."""
    rows = counts.toArrow()
    sums = np.zeros((2, BUCKETS))
    sums[0, rows["bucket"].to_numpy()], sums[1, rows["bucket"].to_numpy()] = rows["target"].to_numpy(), rows["raw"].to_numpy()
    shares = (sums + SMOOTHING) / (sums.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(shares[0] / shares[1])


def log_weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, row_key, n_features, log_weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # 8 bytes for each of BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, offsets in w.each_text(batch["text"]):
                n = len(offsets) - 1
                buckets, text = _features(hashes, offsets)
                size = np.bincount(text, minlength=n)
                total = np.bincount(text, shared.value[buckets], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, n), batch["row_key"].slice(first, n), pa.array(size, pa.int64()), pa.array(total / np.maximum(size, 1) * LENGTH)],
                    names=["doc_id", "row_key", "n_features", "log_weight"],
                )

    rows = docs.select("doc_id", row_key("doc_id", "text").alias("row_key"), "text")
    return rows.mapInArrow(w.tidy(run), "doc_id long, row_key long, n_features long, log_weight double")


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise of a key: -ln(-ln u), u from 52 bits of a seeded hash."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def largest(rows: DataFrame, key: str, tie: str, k: int) -> DataFrame:
    """Adds kept: whether a row is among the k largest by (key, tie), found by narrowing ranges of the key."""
    low, high, total = rows.agg(F.min(key), F.max(key), F.count("*")).first()
    k = min(k, total)
    above, inside = 0, rows
    while low is not None and low < high and 0 < k:
        step = (high - low) / 1024
        if step == 0 or low + step == low or high - step == high:
            break
        place = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(step)), F.lit(1023))
        ranges = inside.groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()  # 1024 rows at most
        for r in sorted(ranges, key=lambda r: -r.place):
            if above + r.n >= k:
                break
            above += r.n
        if r.low == low and r.high == high:
            break
        low, high, n = r.low, r.high, r.n
        inside = rows.where((F.col(key) >= low) & (F.col(key) <= high))
        if n <= 1000:
            break
    # the few rows in the last range are ranked; all above are in, all below are out
    edge = rows.where((F.col(key) >= low) & (F.col(key) <= high)) if low is not None else rows.limit(0)
    ranked = edge.withColumn("place", F.row_number().over(Window.orderBy(F.desc(key), tie)))
    sure = (rows.where(F.col(key) > high) if low is not None else rows.limit(0)).withColumn("kept", F.lit(k > 0))
    out = (rows.where(F.col(key) < low) if low is not None else rows).withColumn("kept", F.lit(False))
    return sure.unionByName(ranked.withColumn("kept", F.col("place") <= k - above).drop("place")).unionByName(out)


def bounded(marks: DataFrame, most: int) -> DataFrame:
    """All rows of (doc_id, mark), or a share of them, chosen by a hash of the id, that is at most so many."""
    kept = marks.count()
    share, chosen = 1.0, marks
    while kept > most:
        share *= 0.99 * most / kept
        place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / float(1 << 53)
        chosen = marks.where(place < share)
        kept = chosen.count()
    return chosen


def resample(docs: DataFrame, labels: DataFrame, keep_share: float | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, log_weight, sample_key, kept for every row of docs.

    labels has doc_id, quality and toxic; good is quality 1 and toxic 0. keep_share is
    the share of documents to keep, by default the share of good ones among the labelled.
    """
    scratch = Scratch(docs.sparkSession)
    marks = labels.select("doc_id", "quality", "toxic").where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    marks = marks.agg(F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("mark"))
    if keep_share is None:
        keep_share = marks.agg(F.avg("mark")).first()[0]
        keep_share = 1.0 if keep_share is None else keep_share
    known = F.broadcast(bounded(scratch.save(marks, "marks"), MAX_LABELLED))
    labelled = docs.select("doc_id", "text").join(known, "doc_id", "left").withColumn("good", F.coalesce(F.col("mark") == 1, F.lit(False)))
    ratios = log_ratios(bucket_counts(labelled))
    weighed = log_weights(docs, ratios)
    weighed = weighed.withColumn("sample_key", F.col("log_weight") / TEMPERATURE + gumbel(F.col("row_key"), seed))
    weighed = scratch.save(weighed, "weighed")
    k = round(weighed.count() * keep_share)
    return largest(weighed, "sample_key", "row_key", k).select("doc_id", "n_features", "log_weight", "sample_key", "kept")
