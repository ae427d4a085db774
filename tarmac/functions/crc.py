"""CRC-24 parity of a frame as population counts.

The parity is linear over GF(2): each of its 24 bits is the parity of a fixed
subset of the data bits. One AND and one ``bit_count`` per integer and parity
bit replaces a byte loop and stays inside codegen.
"""

from __future__ import annotations

from functools import lru_cache

from tarmac.functions.fixed_values import CRC24_POLYNOMIAL


@lru_cache(maxsize=1)
def _masks() -> list[tuple[int, int]]:
    """Per parity bit: which head bits and which me bits it sums."""
    powers, value = [], 1
    for _ in range(24 + 88):
        powers.append(value)
        value <<= 1
        if value >> 24:
            value ^= CRC24_POLYNOMIAL
    data = powers[24:]
    masks = []
    for j in range(24):
        me = sum(1 << i for i in range(56) if data[i] >> j & 1)
        head = sum(1 << i for i in range(32) if data[56 + i] >> j & 1)
        masks.append((head, me))
    return masks


def parity24(head: str, me: str) -> str:
    """24-bit parity of an 88-bit payload (head: 32 bits, me: 56 bits).

    A short frame is the same polynomial with its 32 header bits in the low
    part: ``parity24('0L', 'head')``.
    """
    terms = [
        f"shiftleft((bit_count({head} & {h}L) + bit_count({me} & {m}L)) & 1, {j})"
        for j, (h, m) in enumerate(_masks())
    ]
    return " | ".join(terms)
