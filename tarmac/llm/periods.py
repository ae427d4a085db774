"""Periodic runs of words: stretches in which the same words come again and again.

A run is a stretch of words with smallest period q, at least max(MIN_LENGTH, EXPONENT * q) long, that
no neighbouring word extends at that period.

Method: seed and extend on diagonals. In a run of period q at least (EXPONENT - 1) * q words
equal the word q places on. So lags are taken by powers of two, and for each range of lags
k-grams are indexed that are as long as the least such overlap. Such a k-gram holds a
whole period, and a period that has no shorter one occurs in its own repetition only at
multiples of its length, so a run shows as two occurrences that follow each other at a
lag of exactly q. These same-document pairs are the seeds; each is extended in both directions
word by word, unless the table of the furthest place covered at its lag says that a run
found before holds it. Work and pairs stay in proportion to the words for each range of lags,
however often a word occurs. (A hash that collides can only add seeds, which are verified.)

Words are runs without white space, compared byte for byte by 64-bit hashes. Collapsing
drops each word that some run holds after its first period, and joins the others by one space.

Defined results: null and empty texts have no words, no runs, and collapse to the empty text;
equal rows get equal results; an empty table gives an empty table; columns other than doc_id and
text are not read. A text is one row, so its runs are found in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as w

MIN_LENGTH, EXPONENT = 6, 4

#: Runs without white space, capitals kept apart.
EXACT = (np.arange(256, dtype=np.uint8), w.SPACED[1])

RUNS = "array<struct<start: long, length: long, period: long>>"


def overlap(low: int, min_length: int, exponent: int) -> int:
    """The least number of words that equal the word q places on, in any run with a period q of low to 2 * low - 1."""
    least = (exponent - 1) * low
    return max(least, min(max(min_length - q, (exponent - 1) * q) for q in range(low, 2 * low))) if low < min_length else least


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Places of the keys that may occur more than once."""
    bits = max(len(keys) * 8, 1024).bit_length()
    slots = (keys >> w.U64(64 - bits)).astype(np.int64)
    return np.flatnonzero(np.bincount(slots, minlength=1 << bits)[slots] > 1)


def seeds(grams: np.ndarray, places: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of k-grams whose next occurrence is low to 2 * low - 1 words on, by lag and place."""
    some = _repeated(grams)
    some = some[np.argsort(grams[some], kind="stable")]
    same = np.flatnonzero(grams[some[:-1]] == grams[some[1:]])
    place = places[some[same]]
    lag = places[some[same + 1]] - place
    near = (lag >= low) & (lag < 2 * low)
    order = np.lexsort((place[near], lag[near]))
    return lag[near][order], place[near][order]


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many words at the front of a and b are equal."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        other = np.flatnonzero(a[at : at + step][: n - at] != b[at : at + step][: n - at])
        if len(other):
            return at + int(other[0])
        at, step = at + step, 2 * step
    return n


def runs_of(hashes: np.ndarray, offsets: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of every run of texts whose words lie between offsets, in this order."""
    found: list[tuple[int, int, int, int]] = []
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(hashes))
    grams, width, low = w.combine(hashes, text.astype(w.U64)), 1, 1  # texts never share a k-gram
    while True:
        # only texts that a run with so long a period fits in
        fits = sizes >= max(min_length, exponent * low)
        if not fits.any():
            return sorted(found)
        keep = fits[text]
        if not keep.all():
            grams, places, text = grams[keep], places[keep], text[keep]
        k = overlap(low, min_length, exponent)
        while 2 * width <= k:  # grams of twice the width; those that reach into the next text are not looked at
            grams = np.concatenate((w.combine(grams[:-width], grams[width:]), grams[len(grams) - width :]))
            width *= 2
        inside = np.flatnonzero(places + k <= offsets[text + 1])
        rest = np.minimum(inside + (k - width), len(grams) - 1)
        lags, at = seeds(w.combine(grams[inside], grams[rest]), places[inside], low)
        found += extended(hashes, offsets, lags, at, min_length, exponent)
        low *= 2


def extended(
    hashes: np.ndarray, offsets: np.ndarray, lags: np.ndarray, at: np.ndarray, min_length: int, exponent: int
) -> Iterator[tuple[int, int, int, int]]:
    """The runs that seeds, ordered by lag and place, lie in."""
    furthest: dict[int, int] = {}  # by lag, the end of what was covered last
    i = 0
    while i < len(at):
        lag, place = int(lags[i]), int(at[i])
        covered = furthest.get(lag, -1)
        if place < covered:
            group = int(np.searchsorted(lags, lag, "right"))
            i += int(np.searchsorted(at[i:group], covered))
            continue
        text = int(np.searchsorted(offsets, place, "right")) - 1
        first, end = int(offsets[text]), int(offsets[text + 1])
        after = place + agreeing(hashes[place : end - lag], hashes[place + lag : end])
        start = place - agreeing(hashes[first:place][::-1], hashes[first + lag : place + lag][::-1])
        furthest[lag] = max(after, place + 1)
        length = after + lag - start
        if length >= max(min_length, exponent * lag):
            yield text, start - first, length, lag
        i += 1


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed for every row of docs; exponent is 3 at least."""
    if exponent < 3:
        raise ValueError("below three periods a run need not hold two neighbouring occurrences of a k-gram")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, stop in w.pieces(batch["text"]):
                data, bounds = w.raw(batch["text"].slice(at, stop - at))
                hashes, _, _, offsets = w.word_spans(data, bounds, EXACT)
                found = np.array(runs_of(hashes, offsets, min_length, exponent), np.int64).reshape(-1, 4)
                ends = np.searchsorted(found[:, 0], np.arange(stop - at + 1))
                # words after the first period of a run are dropped
                change = np.zeros(len(hashes) + 1, np.int64)
                begins = offsets[found[:, 0]] + found[:, 1]
                np.add.at(change, begins + found[:, 3], 1)
                np.add.at(change, begins + found[:, 2], -1)
                kept = np.cumsum(change)[:-1] == 0
                collapsed = []
                for i in range(stop - at):
                    said = data[bounds[i] : bounds[i + 1]].tobytes().split()
                    if ends[i] < ends[i + 1]:
                        said = [x for x, k in zip(said, kept[offsets[i] : offsets[i + 1]].tolist()) if k]
                    collapsed.append(b" ".join(said))
                runs = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(at, stop - at),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(w.tidy(run), f"doc_id long, n_words long, runs {RUNS}, collapsed string")
