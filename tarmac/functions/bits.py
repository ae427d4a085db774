"""Bit fields of a 112-bit frame held as two integers, as SQL expressions.

``head`` holds frame bits 0-31 (format, capability, address) and ``me`` bits
32-87 (the message field). Both fit a BIGINT, so every field is shift and mask
arithmetic inside whole-stage codegen. The builders return SQL text: a frame
has dozens of fields and text reaches the JVM in one call per column.
"""

from __future__ import annotations


def head_bits(start: int, stop: int) -> str:
    """Frame bits [start, stop) for stop <= 32."""
    return f"cast(shiftright(head, {32 - stop}) & {(1 << (stop - start)) - 1}L as int)"


def me_bits(start: int, stop: int) -> str:
    """Frame bits [start, stop) for 32 <= start < stop <= 88."""
    return f"cast(shiftright(me, {88 - stop}) & {(1 << (stop - start)) - 1}L as int)"


def hex_to_long(text: str) -> str:
    """Value of up to 15 hex digits. Zero for null, so that fields cut from it need no null checks."""
    return f"coalesce(cast(conv({text}, 16, 10) as bigint), 0L)"


def long_to_hex(value: str, digits: int) -> str:
    return f"lpad(hex({value}), {digits}, '0')"
