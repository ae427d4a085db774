"""Deterministic message logs derived from the ``events`` table.

In the plain log each event becomes one frame of one of twelve aircraft, so that the decode path
runs on every row of the given table. In the fleet log each event becomes a burst of four
frames within 1.2 s: an even and an odd position from one place, a name, a speed or a status,
and a ground or airborne reply. It has 61 aircraft, one of them with a third of the bursts, and states bits that the
plain log leaves 0. The recipe uses native columns and works on batch and streaming
frames alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions import cpr
from tarmac.functions.bits import long_to_hex
from tarmac.functions.crc import parity24
from tarmac.functions.steps import Steps

START_MS = 1704067200000
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _pack(parts: list[tuple[str, int]]) -> str:
    """Message field from (value, frame bit after the value's last bit) pairs."""
    return " | ".join(f"shiftleft(cast({value} as bigint), {88 - stop})" for value, stop in parts)


_TIME = f"{START_MS}L + floor((unix_millis(cast(ts as timestamp)) - {START_MS}L) / 4)"
_K = "cast(get_json_object(props, '$.k') as int)"


def frames(events: DataFrame) -> DataFrame:
    """The plain log ``(seq, ts_kafka, message)``, one row per event."""
    inputs = {
        "e": "event_id",
        "place": "event_id",
        "call": "floor(event_id / 300)",
        "k": _K,
        "u": "cast(user_id % 12 as int)",
        "what": "event_type",
        "ts_kafka": _TIME,
        "rich": "0L",
    }
    return _encoded(events, Steps().add(inputs))


def fleet_frames(events: DataFrame) -> DataFrame:
    """The fleet log ``(seq, ts_kafka, message)``, four rows per event."""
    burst = {
        "e": "event_id * 4 + part",
        "place": "event_id",
        "u": "cast(if(user_id % 3 = 0, 0, 1 + user_id % 60) as int)",
        "ts_kafka": f"{_TIME} + 400 * part",
        "rich": "1L",
    }
    kinds = {
        "call": "floor(ts_kafka / 345600000)",
        "what": "case when part < 2 then if(k % 4 = 0, 'click', 'error') when part = 3 then 'view' "
        "when place % 3 = 0 then 'signup' when place % 3 = 1 or k % 10 != 8 then 'purchase' else 'error' end",
    }
    known = Steps().once({"k": _K}).apply(events)
    parts = known.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    return _encoded(parts, Steps().add(burst).add(kinds))


def _encoded(rows: DataFrame, inputs: Steps) -> DataFrame:
    """Frames of rows with their number, place, call sign block, attribute ``k``, aircraft ``u`` and time."""
    where = {
        "kind": "case what when 'view' then 'allcall' when 'click' then 'surface' when 'signup' then 'ident' "
        "when 'purchase' then 'velocity' else if(k % 10 = 8, 'status', 'airborne') end",
        "odd": "e % 2",
        "lat": "40.45D + ((place * 7919) % 1000) * 0.00009D",
        "lon": "-3.59D + ((place * 104729) % 1000) * 0.00007D",
        "zone": f"if(what = 'click', {cpr.SURFACE_ZONE}, {cpr.AIRBORNE_ZONE})",
    }
    position = [("odd", 54), ("lat_code", 71), ("lon_code", 88)]
    barometric = "shiftleft(floor(((e * 13) % 1600) / 16), 5) + 16 + ((e * 13) % 1600) % 16"
    letters = ["6", "1 + call % 3", "20", "48", "48", "48 + floor(u / 10)", "48 + u % 10", "32"]
    airspeed = "k % 4 = 3"
    content = {
        "surface": [
            ("5 + e % 4", 37),
            ("if(k % 2 = 0, 1, (k * 7) % 128)", 44),
            ("floor(k / 2) % 2", 45),
            ("e % 128", 52),
            *position,
        ],
        "ident": [("1 + e % 4", 37), ("k % 8", 40)] + [(c, 46 + 6 * i) for i, c in enumerate(letters)],
        "velocity": [
            ("19", 37),
            (f"if({airspeed}, 3, 1) + if(rich = 1 and e % 8 >= 4, 1, 0)", 40),
            ("rich * (place % 2)", 41),
            ("1", 42),
            ("rich * (place % 8)", 45),
            (f"if({airspeed}, 1, e % 2)", 46),
            (f"if({airspeed}, (e * 11) % 1024, 1 + (e * 37) % 600)", 56),
            (f"if({airspeed}, e % 2, k % 2)", 57),
            (f"if({airspeed}, 1 + (k * 5) % 500, 1 + (e * 53) % 600)", 67),
            ("k % 2", 68),
            ("e % 2", 69),
            ("1 + e % 200", 78),
            ("rich * (place % 2)", 81),
            ("1 + k % 50", 88),
        ],
        "status": [("31", 37), ("e % 3", 75)],
        "airborne": [
            ("if(k % 10 = 9, 20 + e % 3, 9 + e % 10)", 37),
            ("rich * (place % 4)", 39),
            ("rich * (floor(place / 4) % 2)", 40),
            (f"if(k % 10 = 9, (e * 13) % 4096, {barometric})", 52),
            ("rich * (floor(place / 8) % 2)", 53),
            *position,
        ],
    }
    cases = " ".join(f"when '{kind}' then {_pack(parts)}" for kind, parts in content.items())
    capability = (
        "case when kind = 'surface' then 4 when kind != 'allcall' then 5 "
        "when k % 10 = 9 then 0 when k % 4 = 0 then 4 else 5 end"
    )
    payload = {
        "me": f"case kind {cases} else 0L end",
        "head": "shiftleft(cast(if(kind = 'allcall', 11, if(rich = 1 and place % 5 = 0, 18, 17)) as bigint), 27) "
        f"| shiftleft(cast({capability} as bigint), 24) | cast({0x340000} + u as bigint)",
    }
    words = {"high": "if(kind = 'allcall', 0L, head)", "low": "if(kind = 'allcall', head, me)"}
    text = {
        "sent": "if(e % 37 = 0, parity ^ 1, parity)",
        "text": f"concat({long_to_hex('head', 8)}, if(kind = 'allcall', '', {long_to_hex('me', 14)}), "
        f"{long_to_hex('sent', 6)})",
    }
    # boundaries, as in decode: each generated method stays below the size the JVM compiles
    stages = inputs.once(where)
    for name, value in cpr.position_codes("zone", "odd", "lat", "lon").items():
        stages = stages.once({name: value})
    stages = stages.once(payload).once(words).once({"parity": parity24("high", "low")}).add(text)
    return stages.apply(rows).selectExpr("e as seq", "ts_kafka", "base64(unhex(text)) as message")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events dealt out evenly: a file is small for the work its rows are, and has few row groups to deal out."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    # by number, as else small partitions are put together again
    return events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")


def fleet_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet_frames(_events(spark, sf_dir))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(_events(spark, sf_dir))
