"""Fill-in-the-middle: a text's prefix, middle and suffix are written in another order, between marks.

Method: the text's bytes are cut into fixed blocks. Two Fenwick trees over the blocks hold how
many units begin in each and how many code points. The block of a cut is found by binary
lifting on the first tree; the boundary is looked for in that block alone, and the code
points before it come from the second tree. Cuts, form and rate follow from a digest of the
seed and the document's id, so they never depend on the order of work.

Units are characters (code points), words (one begins at each word but the first, which
starts with the text) or lines (one begins after each line feed).

Defined results: a null text is empty; an empty text, and one that holds a mark, stays plain; a
null id has the empty text as its decimal; rows that share an id are cut at the same digests, equal
rows alike; an empty table gives an empty table; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as w

#: Bytes of a block.
BLOCK = 4096
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of 100 texts so many are rearranged, and of 100 of these so many have their suffix first.
RATE, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _characters(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray) -> np.ndarray:
    inside = w.SPACED[1][data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = int(begins.argmax())
    begins[first] = False
    begins[0] = True
    return begins


def _lines(data: np.ndarray) -> np.ndarray:
    begins = np.ones(len(data), bool)
    begins[1:] = data[:-1] == 10
    return begins


#: True at the bytes where a unit of a text that is not empty begins.
UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"characters": _characters, "words": _words, "lines": _lines}


class Fenwick:
    """Sums of counts by block, found from the front in as many steps as the number of blocks has bits."""

    def __init__(self, counts: np.ndarray) -> None:
        sums = np.concatenate(([0], np.cumsum(counts)))
        at = np.arange(len(sums))
        self.tree: list[int] = (sums - sums[at - (at & -at)]).tolist()
        self.blocks = len(counts)

    def before(self, block: int) -> int:
        """How many there are in the blocks before this one."""
        total = 0
        while block:
            total += self.tree[block]
            block &= block - 1
        return total

    def find(self, k: int) -> tuple[int, int]:
        """The block that holds number k (from 0), and its number inside the block."""
        at, step = 0, 1 << self.blocks.bit_length()
        while step:
            if at + step <= self.blocks and self.tree[at + step] <= k:
                at += step
                k -= self.tree[at]
            step >>= 1
        return at, k


class Cutter:
    """Cuts of one text that is not empty, by number of units."""

    def __init__(self, data: np.ndarray, unit: str) -> None:
        self.size = len(data)
        self.begins, self.points = UNITS[unit](data), _characters(data)
        starts = np.arange(0, len(data), BLOCK)
        self.units = Fenwick(np.add.reduceat(self.begins, starts, dtype=np.int64))
        self.chars = Fenwick(np.add.reduceat(self.points, starts, dtype=np.int64))
        self.n = self.units.before(self.units.blocks)

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first k units."""
        block, inside = self.units.find(k)
        if block == self.units.blocks:
            return self.size, self.chars.before(block)
        at = block * BLOCK
        step = int(np.flatnonzero(self.begins[at : at + BLOCK])[inside])
        return at + step, self.chars.before(block) + int(np.count_nonzero(self.points[at : at + step]))


def digests(seed: int) -> list[Column]:
    """h1 to h4: the first four 32-bit numbers of the SHA-256 digest of seed:doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_middle(
    docs: DataFrame, seed: int, unit: str = "characters", marks: tuple[str, str, str] = MARKS, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for every row of docs; n counts units."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")
    if len(set(marks)) < 3 or any(a in b for a in marks for b in marks if a is not b):
        raise ValueError("three marks are needed of which none holds another")
    p, s, m = (mark.encode() for mark in marks)

    def arranged(data: np.ndarray, h: tuple[int, ...]) -> tuple[int, str, int | None, int | None, bytes]:
        text = data.tobytes()
        if not text:
            return 0, PLAIN, None, None, text
        cutter = Cutter(data, unit)
        if h[2] % 100 >= rate or any(mark in text for mark in (p, s, m)):
            return cutter.n, PLAIN, None, None, text
        first, second = sorted((h[0] % (cutter.n + 1), h[1] % (cutter.n + 1)))
        (a, before), (b, upto) = cutter.cut(first), cutter.cut(second)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < suffix_first:
            return cutter.n, SPM, before, upto - before, b"".join((s, suffix, p, prefix, m, middle))
        return cutter.n, PSM, before, upto - before, b"".join((p, prefix, s, suffix, m, middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [batch[f"h{i}"].to_pylist() for i in (1, 2, 3, 4)]
            for at, stop in w.pieces(batch["text"]):
                data, bounds = w.raw(batch["text"].slice(at, stop - at))
                out = [arranged(data[bounds[i] : bounds[i + 1]], h) for i, h in enumerate(list(zip(*numbers))[at:stop])]
                n, form, prefix, middle, output = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(at, stop - at),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *digests(seed))
    return rows.mapInArrow(w.tidy(run), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, "|".join(re.sub(r"([^A-Za-z0-9])", r"\\\1", mark) for mark in marks), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
