"""Vectorised splitting and hashing of whole texts, a bounded piece of bytes at a time.

Words are compared by 64-bit hashes. A hash is a polynomial in the word's bytes,
read off prefix sums of a whole chunk, and mixed with the word's length. Nothing
here works row by row. Hashing takes a bounded piece at a time; the hashes and places of a
text's words are held together, about 24 bytes a word, and its set of shingles 8 bytes each.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        table = np.full(max(n, CHUNK + 1), base, U64)
        table[0] = 1
        have = _powers[base] = np.multiply.accumulate(table)
    return have[:n]


def powers(n: int) -> np.ndarray:
    return _table(_BASE, n)


def inverse_powers(n: int) -> np.ndarray:
    return _table(_INVERSE, n)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of h over the whole word."""
    h = h.astype(U64)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the pair (a, b); the order matters."""
    return mix(a * U64(0xD6E8FEB86659FD93) + (b ^ U64(0xA0761D6478BD642F)))


def _byte_tables(separator) -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.array([not separator(int(b)) for b in lower])
    return lower, inside


#: Runs without white space: [^\x20\x09-\x0D]+
SPACED = _byte_tables(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
#: Runs of digits, letters and all beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = _byte_tables(lambda b: b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column, and len + 1 offsets into them; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def _chunks(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces that end between words, of CHUNK bytes unless one word is longer."""
    at, end = 0, len(data)
    while at < end:
        stop = min(at + CHUNK, end)
        if stop < end:
            first = bounds[np.searchsorted(bounds, at, "right") : np.searchsorted(bounds, stop, "right")]
            gaps = np.flatnonzero(~inside[data[at:stop]])
            cut = max(int(first[-1]) if len(first) else at, at + int(gaps[-1]) + 1 if len(gaps) else at)
            step = stop
            while cut == at and step < end:  # one word longer than a chunk
                gaps = np.flatnonzero(~inside[data[step : step + CHUNK]])
                follow = bounds[np.searchsorted(bounds, step, "left")]
                cut = min(step + int(gaps[0]) + 1 if len(gaps) else end + 1, int(follow))
                if cut > step + CHUNK:
                    cut, step = at, step + CHUNK
            stop = min(cut, end) if cut > at else end
        yield at, stop
        at = stop


def word_spans(data: np.ndarray, bounds: np.ndarray, kind=SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word, and len(bounds) offsets of the texts' words."""
    lower, inside = kind
    hashes, starts, ends = [], [], []
    for at, stop in _chunks(data, bounds, inside):
        piece = lower[data[at:stop]]
        n = stop - at
        here = inside[piece]
        breaks = np.zeros(n + 1, bool)
        own = bounds[np.searchsorted(bounds, at) : np.searchsorted(bounds, stop, "right")]
        breaks[own - at] = True
        breaks[0] = breaks[n] = True
        fresh = here & breaks[:n]
        fresh[1:] |= here[1:] & ~here[:-1]
        last = here & breaks[1:]
        last[:-1] |= here[:-1] & ~here[1:]
        s, e = np.flatnonzero(fresh), np.flatnonzero(last) + 1
        sums = np.zeros(n + 1, U64)
        np.cumsum((piece + U64(1)) * powers(n), out=sums[1:])
        h = (sums[e] - sums[s]) * inverse_powers(n + 1)[s]
        hashes.append(mix(h + (e - s).astype(U64) * U64(0x632BE59BD9B4E019)))
        starts.append(s + at)
        ends.append(e + at)
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    starts_all = np.concatenate(starts)
    return np.concatenate(hashes), starts_all, np.concatenate(ends), np.searchsorted(starts_all, bounds)


def release() -> None:
    """Gives memory that is free in this process back to the system; a Python worker lives on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps what it has
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of Arrow batches that releases its memory at the end of each task."""

    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return inner


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as the bytes that their differences need, a plane for each byte's place."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=keys[:1])
    width = max((int(steps.max()).bit_length() + 7) // 8, 1)
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + np.ascontiguousarray(planes).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if not len(data):
        return np.zeros(0, U64)
    planes = np.frombuffer(data, np.uint8, offset=9).reshape(data[0], -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, : data[0]] = planes.T
    return np.frombuffer(data, "<u8", 1, 1) + np.cumsum(steps.reshape(-1).view("<u8"), dtype=U64)


def pieces(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about limit bytes each; a longer text stands alone."""
    _, bounds = raw(texts)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield at, min(stop, len(texts))
        at = stop


def each_text(texts: pa.Array, kind=SPACED) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, offsets) for bounded runs of texts."""
    for at, stop in pieces(texts):
        data, bounds = raw(texts.slice(at, stop - at))
        hashes, _, _, offsets = word_spans(data, bounds, kind)
        yield at, hashes, offsets


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that begin at each word; len - k + 1 of them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = hashes[:n]
    for i in range(1, k):
        out = combine(out, hashes[i : i + n])
    return out


def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingles of each text; a shorter text is one shingle, an empty one has none."""
    rolled = grams(hashes, k)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif b > a:
            yield grams(combine(hashes[a:b], np.full(b - a, b - a, U64)), int(b - a))
        else:
            yield np.zeros(0, U64)
