"""Base64 frames to typed columns, as native expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import cpr, fields
from tarmac.functions.bits import head_bits, hex_to_long, me_bits
from tarmac.functions.crc import parity24
from tarmac.functions.fixed_values import RECEIVER_LAT, RECEIVER_LON
from tarmac.functions.steps import Steps
from tarmac.operators.registry import MESSAGE_TYPES, message_type

REJECT_REASONS = ["bad_time", "malformed_base64", "bad_length", "corrupted"]


def _header_steps() -> Steps:
    long = "coalesce(length(message_hex) = 28, false)"
    return (
        Steps()
        .once({"message_hex": "lower(hex(try_to_binary(message, 'base64')))"})
        .once(
            {
                "__long": long,
                "head": hex_to_long("substring(message_hex, 1, 8)"),
                "me": hex_to_long(f"if({long}, substring(message_hex, 9, 14), null)"),
                "__parity": hex_to_long(f"if({long}, substring(message_hex, 23, 6), substring(message_hex, 9, 6))"),
            }
        )
        # a short frame has its 32 header bits where a long one ends its message field
        .once({"__high": "if(__long, head, 0L)", "__low": "if(__long, me, head)"})
        .once(
            {
                "__intact": f"({parity24('__high', '__low')}) = __parity",
                "dl": f"if(message_hex is null, null, least({head_bits(0, 5)}, 24))",
                "ca": f"if(message_hex is null, null, {head_bits(5, 8)})",
                "icao": "substring(message_hex, 3, 6)",
            }
        )
        .once(
            {
                "reject_reason": "case when ts_kafka is null then 'bad_time' "
                "when message_hex is null then 'malformed_base64' "
                "when length(message_hex) not in (14, 28) then 'bad_length' "
                "when not __long and dl in (17, 18) then 'bad_length' "
                "when not __intact then 'corrupted' end",
                "tc": f"if(dl in (17, 18) and __long, {me_bits(32, 37)}, null)",
                "on_ground": fields.ON_GROUND,
            }
        )
        .once({"msg_type": f"if(reject_reason is null, {message_type()}, null)"})
    )


def frame_header(raw: DataFrame) -> DataFrame:
    """Adds the integers of the frame, its header fields, message type and reject reason.

    Keeps every input row. ``reject_reason`` is null for a frame whose length
    and parity are right and whose time could be read.
    """
    return _header_steps().apply(raw)


def decode(
    raw: DataFrame,
    ref_lat: float = RECEIVER_LAT,
    ref_lon: float = RECEIVER_LON,
    compat: bool = False,
) -> DataFrame:
    """Decodes ``(ts_kafka, message[, seq])`` rows; every input row is kept.

    Message content comes as one nullable struct per field group (``ident``,
    ``surf``, ``air``, ``vel``, ``gs``, ``asp``), so that a group can be carried
    or overwritten as a whole. Columns a query does not use are pruned.

    ``compat`` keeps three historical readings: position flags and the
    vertical-rate source at header offsets, and the aircraft type looked up by
    transponder capability in place of the emitter category.
    """
    steps = _header_steps()
    if "seq" not in raw.columns:
        # replayable tie-break for logs without an ingest number
        steps = steps.add({"seq": "xxhash64(message)"})
    steps = steps.add(
        {
            "__bit": f"if(msg_type in ('surface', 'airborne'), {me_bits(53, 54)}, null)",
            "__lat_code": me_bits(54, 71),
            "__lon_code": me_bits(71, 88),
            "__zone": f"if(msg_type = 'surface', {cpr.SURFACE_ZONE}, {cpr.AIRBORNE_ZONE})",
        }
    )
    # Values that take more than a few instructions are evaluated at their own
    # boundary, for the rows that have them: every generated method then stays
    # below the size the JVM compiles, also when a query needs all groups.
    steps = (
        steps.once({"__lat": cpr.reference_latitude("__zone", "__bit", "__lat_code", ref_lat)})
        .once({"__dlon": cpr.longitude_step("__zone", "__bit", "__lat")})
        .once({"__lon": cpr.reference_longitude("__dlon", "__lon_code", ref_lon)})
        .add(fields.altitude_steps())
        .once({"__alt_feet": f"if(msg_type = 'airborne', {fields.altitude_feet()}, null)"})
        .once({"__callsign": f"if(msg_type = 'ident', {fields.callsign()}, null)"})
        .once({"__label": f"if(msg_type = 'ident', {fields.category_label(me_bits(37, 40))}, null)"})
        .once({"__moved": f"if(msg_type = 'surface', {fields.movement_speed(me_bits(37, 44))}, null)"})
        .add(fields.velocity_steps())
        .once({"__speed": f"if(msg_type = 'velocity', {fields.speed()}, null)"})
        .once({"__heading": f"if(msg_type = 'velocity', {fields.heading()}, null)"})
    )
    groups = {
        name: f"if(msg_type = '{kind.name}', {build(compat)}, null)"
        for kind in MESSAGE_TYPES.values()
        for name, build in kind.groups.items()
    }
    groups |= {
        "cpr": "if(msg_type in ('airborne', 'surface'), named_struct('odd', __bit, 'lat', __lat_code, 'lon', __lon_code), null)",
        "version": f"if(tc = 31 and reject_reason is null, {me_bits(72, 75)}, null)",
        "aircraft_type": fields.category_label("ca") if compat else "__label",
        "ts": "timestamp_millis(ts_kafka)",
        "date": "to_date(timestamp_millis(ts_kafka))",
        "hour": "hour(timestamp_millis(ts_kafka))",
    }
    return steps.add(groups).apply(raw)


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with their reason)."""
    good = decoded.filter(F.col("reject_reason").isNull())
    rejects = decoded.filter(F.col("reject_reason").isNotNull()).select(
        "ts_kafka", "seq", "message", "reject_reason"
    )
    return good, rejects


def valid_allcall(decoded: DataFrame) -> DataFrame:
    """Intact all-call replies (DF 11) that state ground or air."""
    return decoded.filter(
        (F.col("dl") == 11) & F.col("reject_reason").isNull() & F.col("on_ground").isNotNull()
    )


def valid_frames(decoded: DataFrame) -> DataFrame:
    """Intact frames of DF 11, 17 and 18."""
    return decoded.filter(F.col("dl").isin(11, 17, 18) & F.col("reject_reason").isNull())


def valid_adsb(decoded: DataFrame) -> DataFrame:
    """Intact DF 17 and 18 frames of a known message type."""
    return decoded.filter(F.col("dl").isin(17, 18) & F.col("msg_type").isNotNull())
