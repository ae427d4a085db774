"""Benchmark decontamination by winnowing.

Method: of every SPAN - K + 1 neighbouring K-grams of words the one with the least hash is
kept as a fingerprint (the last of equals). Any span of SPAN words that a document shares
with a benchmark item holds a fingerprint that both keep. Fingerprints of documents
pass a fixed-size bitmap of the benchmark's fingerprints and are then joined with them.
A hit is extended word by word, up to K-gram's distance to either side, and
counts if at least SPAN words agree. An item of fewer words is a fingerprint as a
whole, sought at every word of a document.

Each fingerprint travels with its neighbourhood of words (as 64-bit hashes), so extending
needs neither text again. A common passage makes a hot fingerprint; rows of the join
carry no group, so Spark splits such a partition by itself.

Defined results: null or empty texts have no words and are clean; equal rows get equal
results; with an empty benchmark all is clean; an empty table gives an empty table; columns
other than the named ones are not read. An item without words is never found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as w
from tarmac.llm.store import Scratch, filter_words, maybe_in, row_key, without

SPAN = 10
K = 5
SIDE = SPAN - K
CONTEXT = K + 2 * SIDE
#: Stand for words before the first and after the last; they equal nothing on the other side.
OUTSIDE_DOCUMENT, OUTSIDE_ITEM = np.uint64(1), np.uint64(2)


def _salted(h: np.ndarray, n: int) -> np.ndarray:
    return w.combine(h, np.full(len(h), n, w.U64))


def winnow(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, fingerprint) of the kept K-grams of all texts, positions counted over the texts in a row."""
    width = SPAN - K + 1
    rolled = _salted(w.grams(hashes, K), K)
    n = len(rolled) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, w.U64)
    best, at = rolled[:n].copy(), np.arange(n)
    for i in range(1, width):
        less = rolled[i : i + n] <= best
        best = np.where(less, rolled[i : i + n], best)
        at[less] = np.flatnonzero(less) + i
    first, stop = offsets[:-1], offsets[1:] - SPAN + 1  # windows that lie inside one text
    inside = np.zeros(n + 1, np.int64)
    some = stop > first
    np.add.at(inside, first[some], 1)
    np.add.at(inside, stop[some], -1)
    kept = np.unique(at[np.cumsum(inside)[:n] > 0])
    return kept, rolled[kept]


def neighbourhood(hashes: np.ndarray, offsets: np.ndarray, at: np.ndarray, outside: np.uint64) -> np.ndarray:
    """CONTEXT words around each kept K-gram, SIDE before and after it."""
    text = np.searchsorted(offsets, at, "right") - 1
    where = at[:, None] + np.arange(-SIDE, K + SIDE)
    own = (where >= offsets[text][:, None]) & (where < offsets[text + 1][:, None])
    return np.where(own, hashes[np.clip(where, 0, max(len(hashes) - 1, 0))], outside)


def extend(mine: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the agreement around the K-gram goes: first and end place in the context; equal if under SPAN words."""
    same = mine == other
    left = np.cumprod(same[:, SIDE - 1 :: -1], axis=1).sum(1) if SIDE else 0
    right = np.cumprod(same[:, SIDE + K :], axis=1).sum(1)
    core = same[:, SIDE : SIDE + K].all(1)
    begin, end = SIDE - left, SIDE + K + right
    return begin, np.where(core & (end - begin >= SPAN), end, begin)


def _list(flat: np.ndarray, ends: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


_ITEM_SCHEMA = "item long, fp long, span int, context array<long>"
_DOC_SCHEMA = "doc_id long, row_key long, n_words long, fps array<long>, spots array<int>, spans array<int>, contexts array<long>"


def item_fingerprints(items: DataFrame) -> DataFrame:
    """(item, fp, span, context): span is SPAN, or the number of words of a shorter item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, offsets in w.each_text(batch["text"], w.ALNUM):
                ids = batch["item_id"].slice(first, len(offsets) - 1)
                at, fps = winnow(hashes, offsets)
                context = neighbourhood(hashes, offsets, at, OUTSIDE_ITEM)
                text, span = np.searchsorted(offsets, at, "right") - 1, np.full(len(at), SPAN)
                short = np.flatnonzero((np.diff(offsets) > 0) & (np.diff(offsets) < SPAN))
                whole = [_salted(w.grams(hashes[offsets[i] : offsets[i + 1]], int(offsets[i + 1] - offsets[i])), int(offsets[i + 1] - offsets[i])) for i in short]
                text, span = np.concatenate((text, short)), np.concatenate((span, np.diff(offsets)[short]))
                fps = np.concatenate((fps, *whole))
                ends = np.concatenate((np.arange(len(at) + 1) * CONTEXT, np.full(len(short), len(at) * CONTEXT)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(text)), pa.array(fps.view(np.int64)), pa.array(span, pa.int32()), _list(context.ravel().view(np.int64), ends, pa.int64())],
                    names=["item", "fp", "span", "context"],
                )

    return items.select("item_id", "text").mapInArrow(w.tidy(run), _ITEM_SCHEMA)


def marked_documents(docs: DataFrame, bitmap: np.ndarray, short_spans: list[int]) -> DataFrame:
    """One row per document with its fingerprints that the bitmap lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # FILTER_BITS / 8 bytes, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch in batches:
            for first, hashes, offsets in w.each_text(batch["text"], w.ALNUM):
                n = len(offsets) - 1
                at, fps = winnow(hashes, offsets)
                found = maybe_in(seen, fps.view(np.int64))
                at, fps, span = at[found], fps[found], np.full(int(found.sum()), SPAN)
                for length in short_spans:
                    rolled = _salted(w.grams(hashes, length), length)
                    here = np.flatnonzero(maybe_in(seen, rolled.view(np.int64)))
                    text = np.searchsorted(offsets, here, "right") - 1
                    here = here[here + length <= offsets[text + 1]]
                    at, fps, span = np.concatenate((at, here)), np.concatenate((fps, rolled[here])), np.concatenate((span, np.full(len(here), length)))
                order = np.argsort(at, kind="stable")
                at, fps, span = at[order], fps[order], span[order]
                context = neighbourhood(hashes, offsets, at, OUTSIDE_DOCUMENT)
                ends = np.searchsorted(at, offsets)
                text = np.searchsorted(offsets, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, n),
                        batch["row_key"].slice(first, n),
                        pa.array(np.diff(offsets), pa.int64()),
                        _list(fps.view(np.int64), ends, pa.int64()),
                        _list(at - offsets[text], ends, pa.int32()),
                        _list(span, ends, pa.int32()),
                        _list(context.ravel().view(np.int64), ends * CONTEXT, pa.int64()),
                    ],
                    names=["doc_id", "row_key", "n_words", "fps", "spots", "spans", "contexts"],
                )

    return docs.select("doc_id", row_key("doc_id", "text").alias("row_key"), "text").mapInArrow(w.tidy(run), _DOC_SCHEMA)


def extended_hits(joined: DataFrame) -> DataFrame:
    """(row_key, item, first, stop) of the agreements around joined fingerprints; word positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot, span = batch["spot"].to_numpy(), batch["span"].to_numpy()
            begin, end = np.zeros(len(spot), np.int64), span.astype(np.int64)
            long = np.flatnonzero(span == SPAN)
            if len(long):
                take = lambda name: batch[name].take(pa.array(long)).flatten().to_numpy(zero_copy_only=False).reshape(-1, CONTEXT)
                a, b = extend(take("doc_context"), take("context"))
                begin[long], end[long] = a - SIDE, b - SIDE
            keep = np.flatnonzero(end > begin)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row_key"].take(pa.array(keep)),
                    batch["item"].take(pa.array(keep)),
                    pa.array((spot + begin)[keep], pa.int64()),
                    pa.array((spot + end)[keep], pa.int64()),
                ],
                names=["row_key", "item", "first", "stop"],
            )

    return joined.mapInArrow(w.tidy(run), "row_key long, item long, first long, stop long")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, items (a sorted array of item ids), spans, for every row of docs.

    docs has doc_id and text, items has item_id and text. spans are the hit stretches
    as (first, stop) word positions, in order, some overlapping.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.save(item_fingerprints(items), "items")
    spans = [r[0] for r in prints.where(F.col("span") < SPAN).select("span").distinct().collect()]  # under SPAN values
    marked = scratch.save(marked_documents(docs, filter_words(prints, "fp"), sorted(spans)), "marked")
    each = F.arrays_zip("fps", "spots", "spans")
    hits = marked.where(F.size("fps") > 0).select("row_key", "contexts", F.posexplode(each).alias("i", "hit"))
    long = F.col("hit.spans") == SPAN
    hits = hits.select(
        "row_key",
        F.col("hit.fps").alias("fp"),
        F.col("hit.spots").alias("spot"),
        F.when(long, F.slice("contexts", F.col("i") * CONTEXT + 1, F.lit(CONTEXT))).otherwise(F.array().cast("array<bigint>")).alias("doc_context"),
        F.col("hit.spans").alias("doc_span"),
    )
    joined = hits.join(prints, (hits["fp"] == prints["fp"]) & (hits["doc_span"] == prints["span"]))
    joined = joined.select("row_key", "spot", "doc_context", "item", "span", "context")
    # one row per stretch and one per item, not all their pairs, go on
    found = scratch.save(extended_hits(joined).distinct(), "hits")
    stretch = F.struct("first", "stop")
    per_row = found.groupBy("row_key").agg(F.sort_array(F.collect_set(stretch)).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("stop"))
    covered = F.aggregate(
        "spans",
        nothing,
        lambda so_far, s: F.struct(
            (so_far["n"] + F.greatest(s["stop"] - F.greatest(s["first"], so_far["stop"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(s["stop"], so_far["stop"]).alias("stop"),
        ),
        lambda so_far: so_far["n"],
    )
    per_row = per_row.select("row_key", "spans", "items", covered.alias("n_hit"))
    result = marked.select("doc_id", "row_key", "n_words").join(per_row, "row_key", "left")
    return result.select(
        "doc_id",
        "row_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:bigint,stop:bigint>>")).alias("spans"),
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, in which no benchmark window occurs."""
    hit = Scratch(docs.sparkSession).save(contamination(docs, items).where("n_hit > 0").select("row_key"), "hit")
    return without(docs, row_key("doc_id", "text"), hit)
