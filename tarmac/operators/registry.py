"""Message types: which type codes they cover and which fields they carry.

One entry per type drives classification, decoding and the state merge; a new
message type is one more entry. Predicates and groups are SQL expressions over
the frame columns ``tc``, ``ca``, ``head``, ``me`` and the values that the
decode evaluates apart (``__lat``, ``__lon``, ``__alt_feet``, ``__callsign``,
``__label``, ``__moved``, ``__speed``, ``__heading``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from tarmac.functions import fields
from tarmac.functions.bits import head_bits, me_bits


@dataclass(frozen=True)
class MessageType:
    name: str
    matches: str
    groups: dict[str, Callable[[bool], str]]
    """Field groups a message overwrites as a whole: name -> struct for a ``compat`` flag."""


def _struct(columns: dict[str, str]) -> str:
    pairs = ", ".join(f"'{name}', {text}" for name, text in columns.items())
    return f"named_struct({pairs})"


def _ident(compat: bool) -> str:
    return _struct({"callsign": "__callsign", "category": me_bits(37, 40), "vortex": "__label"})


def _surface(compat: bool) -> str:
    return _struct(
        {
            "lat": "__lat",
            "lon": "__lon",
            "speed": "__moved",
            "movement_code": me_bits(37, 44),
            "ground_track": fields.ground_track(),
        }
    )


def _airborne(compat: bool) -> str:
    # compat: offsets counted from the frame start, so they fall into the header
    return _struct(
        {
            "lat": "__lat",
            "lon": "__lon",
            "alt_feet": "__alt_feet",
            "altitude_type": fields.altitude_type(),
            "surveillance_status": fields.surveillance_status(head_bits(5, 7) if compat else me_bits(37, 39)),
            "single_antenna": head_bits(7, 8) if compat else me_bits(39, 40),
            "time_bit": head_bits(20, 21) if compat else me_bits(52, 53),
            "cpr_format": fields.cpr_format(head_bits(21, 22) if compat else me_bits(53, 54)),
        }
    )


def _velocity(compat: bool) -> str:
    return _struct(fields.velocity_fields(compat))


def _ground_speed(compat: bool) -> str:
    return f"if(__subtype in (1, 2), {_struct(fields.ground_speed_fields())}, null)"


def _airspeed(compat: bool) -> str:
    return f"if(__subtype in (3, 4), {_struct(fields.airspeed_fields())}, null)"


MESSAGE_TYPES = {
    "surface": MessageType("surface", "tc between 5 and 8", {"surf": _surface}),
    "airborne": MessageType("airborne", "tc between 9 and 18 or tc between 20 and 22", {"air": _airborne}),
    "velocity": MessageType("velocity", "tc = 19", {"vel": _velocity, "gs": _ground_speed, "asp": _airspeed}),
    "ident": MessageType("ident", "tc between 1 and 4", {"ident": _ident}),
}


def message_type() -> str:
    """Name of the message type; null for unknown or missing type codes."""
    cases = " ".join(f"when {kind.matches} then '{kind.name}'" for kind in MESSAGE_TYPES.values())
    return f"case {cases} end"
