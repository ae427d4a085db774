"""Message content as SQL expressions over ``tc``, ``ca``, ``head`` and ``me``."""

from __future__ import annotations

from tarmac.functions.bits import me_bits
from tarmac.functions.fixed_values import (
    ALTITUDE_BAROMETRIC,
    ALTITUDE_GNSS,
    CALLSIGN_ALPHABET,
    CATEGORY_LABELS,
    CPR_FORMAT,
    FEET_PER_METRE,
    SURVEILLANCE_STATUS,
)

ON_GROUND = "case ca when 4 then 1 when 5 then 0 end"


def label_at(index: str, labels: list[str]) -> str:
    """Label at a zero-based index; null index or out of range gives null."""
    quoted = ", ".join("'" + label.replace("'", "''") + "'" for label in labels)
    return f"get(array({quoted}), {index})"


def callsign() -> str:
    letters = [f"substr('{CALLSIGN_ALPHABET}', {me_bits(i, i + 6)} + 1, 1)" for i in range(40, 88, 6)]
    return f"rtrim(replace(concat({', '.join(letters)}), '#', ''))"


def category_label(category: str) -> str:
    """Wake category label of type codes 1-4; other type codes give null."""
    flat = [label for code in sorted(CATEGORY_LABELS) for label in CATEGORY_LABELS[code]]
    return f"case when tc between 1 and 4 then {label_at(f'(tc - 1) * 8 + {category}', flat)} end"


def movement_speed(code: str) -> str:
    """Surface speed in knots; null when not available or reserved.

    Above the two lowest codes speed grows linearly inside each range of
    (first code, code after the last, knots at the first, knots per code).
    """
    ranges = [
        (2, 9, 0.125, 0.125),
        (9, 13, 1, 0.25),
        (13, 39, 2, 0.5),
        (39, 94, 15, 1),
        (94, 109, 70, 2),
        (109, 124, 100, 5),
    ]
    cases = [
        f"when {code} between {first} and {stop - 1} then {base}D + ({code} - {first}) * {step}D"
        for first, stop, base, step in ranges
    ]
    return f"case when {code} = 1 then 0D {' '.join(cases)} when {code} = 124 then 175D end"


def ground_track() -> str:
    return f"if({me_bits(44, 45)} = 1, {me_bits(45, 52)} * 360D / 128D, null)"


def altitude_steps() -> dict[str, str]:
    """Columns, in order, that ``altitude_feet`` needs: the code and its two Gray-coded counts.

    Code bits from the top are C1 A1 C2 A2 C4 A4 B1 Q B2 D2 B4 D4. The D, A and
    B bits count 500 ft steps, the C bits 100 ft steps.
    """

    def gather(positions: list[int]) -> str:
        top = len(positions) - 1
        picked = [f"shiftleft(shiftright(__code, {p}) & 1, {top - i})" for i, p in enumerate(positions)]
        return " | ".join(picked)

    return {
        "__code": f"if(msg_type = 'airborne', {me_bits(40, 52)}, 0)",
        "__gray": gather([2, 0, 10, 8, 6, 5, 3, 1]),
        "__half": "__gray ^ shiftright(__gray, 1)",
        "__quarter": "__half ^ shiftright(__half, 2)",
        "__fives": "__quarter ^ shiftright(__quarter, 4)",
        "__gray3": gather([11, 9, 7]),
        "__ones": "__gray3 ^ shiftright(__gray3, 1) ^ shiftright(__gray3, 2)",
        "__step": "case when __ones in (0, 5, 6) then null when __ones = 7 then 5 else __ones end",
    }


def altitude_feet() -> str:
    """Altitude of an airborne position: barometric for TC 9-18, GNSS height for TC 20-22."""
    return (
        "cast(case when __code = 0 then null "
        f"when tc between 20 and 22 then __code * {FEET_PER_METRE}D "
        "when (__code & 16) != 0 then (shiftright(__code, 5) * 16 + (__code & 15)) * 25 - 1000 "
        "else __fives * 500 + if(__fives % 2 = 1, 6 - __step, __step) * 100 - 1300 end as double)"
    )


def altitude_type() -> str:
    return (
        f"case when tc between 9 and 18 then '{ALTITUDE_BAROMETRIC}' "
        f"when tc between 20 and 22 then '{ALTITUDE_GNSS}' end"
    )


def surveillance_status(code: str) -> str:
    return label_at(code, SURVEILLANCE_STATUS)


def cpr_format(bit: str) -> str:
    return label_at(bit, CPR_FORMAT)


def velocity_steps() -> dict[str, str]:
    """Columns, in order, that the TC 19 fields share: subtype, its factor and the two components."""
    return {
        "__subtype": me_bits(37, 40),
        "__factor": "if(__subtype in (2, 4), 4, 1)",
        "__first": me_bits(46, 56),
        "__second": me_bits(57, 67),
        "__east": f"(__first - 1) * __factor * (1 - 2 * {me_bits(45, 46)})",
        "__north": f"(__second - 1) * __factor * (1 - 2 * {me_bits(56, 57)})",
    }


_KNOWN = "__subtype in (1, 2) and __first != 0 and __second != 0"


def speed() -> str:
    """Whole knots over ground (subtypes 1, 2) or through the air (3, 4)."""
    return (
        f"cast(case when {_KNOWN} then floor(hypot(__east, __north)) "
        "when __subtype in (3, 4) and __second != 0 then (__second - 1) * __factor end as int)"
    )


def heading() -> str:
    """Degrees from north of the track (subtypes 1, 2) or the magnetic heading (3, 4)."""
    return (
        f"case when {_KNOWN} then pmod(degrees(atan2(cast(__east as double), cast(__north as double))), 360D) "
        f"when __subtype in (3, 4) and {me_bits(45, 46)} = 1 then __first * 360D / 1024D end"
    )


def velocity_fields(compat: bool = False) -> dict[str, str]:
    """Common TC 19 fields. ``compat`` reads the vertical-rate source at bit 37."""
    down, rate = me_bits(68, 69), me_bits(69, 78)
    below, difference = me_bits(80, 81), me_bits(81, 88)
    return {
        "speed": "__speed",
        "heading": "__heading",
        "vertical_rate": f"if({rate} = 0, null, ({rate} - 1) * 64 * (1 - 2 * {down}))",
        "speed_type": "case when __subtype in (1, 2) then 'GS' "
        f"when __subtype in (3, 4) then if({me_bits(56, 57)} = 1, 'TAS', 'IAS') end",
        "subtype": "__subtype",
        "intent_change": me_bits(40, 41),
        "ifr": me_bits(41, 42),
        "nuc": me_bits(42, 45),
        "vr_source": me_bits(37, 38) if compat else me_bits(67, 68),
        "vr_sign": down,
        "vr_raw": rate,
        "sdif": below,
        "dalt": f"if({difference} = 0, null, ({difference} - 1) * 25 * (1 - 2 * {below}))",
    }


def ground_speed_fields() -> dict[str, str]:
    return {
        "dew": me_bits(45, 46),
        "vew": "(__first - 1) * __factor",
        "dns": me_bits(56, 57),
    }


def airspeed_fields() -> dict[str, str]:
    return {
        "heading_status": me_bits(45, 46),
        "heading_raw": "__first",
        "airspeed_type": me_bits(56, 57),
    }
