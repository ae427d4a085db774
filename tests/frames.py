"""Hand-made frames for tests, built bit by bit in plain Python."""

from __future__ import annotations

import base64


def crc(payload: int, bits: int) -> int:
    value = payload << 24
    for shift in range(bits - 1, -1, -1):
        if value >> (shift + 24) & 1:
            value ^= 0x1FFF409 << shift
    return value


def to_message(hex_text: str) -> str:
    return base64.b64encode(bytes.fromhex(hex_text)).decode()


def long_frame(df: int, ca: int, icao: int, me: int) -> str:
    payload = (((df << 3 | ca) << 24 | icao) << 56) | me
    return to_message(f"{payload:022x}{crc(payload, 88):06x}")


def short_frame(df: int, ca: int, icao: int) -> str:
    payload = (df << 3 | ca) << 24 | icao
    return to_message(f"{payload:08x}{crc(payload, 32):06x}")


def field(value: int, stop: int) -> int:
    """A value whose last bit is frame bit ``stop - 1`` of the message field."""
    return value << (88 - stop)


def surface(icao: int, movement: int, tc: int = 7) -> str:
    return long_frame(17, 4, icao, field(tc, 37) | field(movement, 44) | field(40000, 71) | field(70000, 88))


def ident(icao: int, tc: int, cat: int, letter: int = 1) -> str:
    return long_frame(17, 5, icao, field(tc, 37) | field(cat, 40) | field(letter, 46))


def speed(icao: int, code: int) -> str:
    return long_frame(17, 5, icao, field(19, 37) | field(3, 40) | field(1, 46) | field(code, 67))


def airborne(icao: int, lat_code: int, lon_code: int, odd: int = 0, alt: int = 0, tc: int = 11) -> str:
    me = field(tc, 37) | field(alt, 52) | field(odd, 54) | field(lat_code, 71) | field(lon_code, 88)
    return long_frame(17, 5, icao, me)


def log(spark, rows):
    """Raw log of (seq, ts, message) rows."""
    return spark.createDataFrame(rows, "seq long, ts_kafka long, message string")
