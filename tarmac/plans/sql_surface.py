"""Views and functions for users who query from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators.decode import decode, split_rejects, valid_frames
from tarmac.operators.occupancy import occupancy
from tarmac.operators.state import known_state
from tarmac.operators.takeoffs import takeoffs, with_runway
from tarmac.operators.windows import map_states

# name: arguments, result type, body
FUNCTIONS = {
    "message_hex": ("message STRING", "STRING", "lower(hex(try_to_binary(message, 'base64')))"),
    "downlink_format": (
        "message STRING",
        "INT",
        "CASE WHEN length(try_to_binary(message, 'base64')) > 0 THEN "
        "least(shiftright(conv(substring(hex(try_to_binary(message, 'base64')), 1, 2), 16, 10), 3), 24) END",
    ),
    "message_icao": ("message STRING", "STRING", "substring(lower(hex(try_to_binary(message, 'base64'))), 3, 6)"),
    "day_text": ("ms BIGINT", "STRING", "date_format(timestamp_millis(ms), 'dd/MM/yyyy')"),
    "message_hour": ("ms BIGINT", "INT", "hour(timestamp_millis(ms))"),
}

#: name: arguments, result columns, body over the views; a range of ts_kafka reaches the scan of the log
TABLE_FUNCTIONS = {
    "messages_between": (
        "start_ms BIGINT, end_ms BIGINT",
        "ts_kafka BIGINT, seq BIGINT, icao STRING, dl INT, tc INT, on_ground INT, msg_type STRING",
        "SELECT ts_kafka, seq, icao, cast(dl AS INT), cast(tc AS INT), cast(on_ground AS INT), msg_type FROM frames "
        "WHERE ts_kafka BETWEEN messages_between.start_ms AND messages_between.end_ms",
    ),
    "takeoffs_between": (
        "start_ms BIGINT, end_ms BIGINT",
        "icao STRING, last_stopped_ms BIGINT, takeoff_ms BIGINT, wait_s DOUBLE",
        """
        WITH marks AS (
          SELECT icao, ts_kafka, seq, dl = 11 AND coalesce(on_ground = 0, false) AS reply, coalesce(surf.speed = 0, false) AS stopped
          FROM frames WHERE ts_kafka BETWEEN takeoffs_between.start_ms AND takeoffs_between.end_ms),
        legs AS (
          SELECT *, coalesce(sum(if(reply, 1, 0)) OVER (PARTITION BY icao ORDER BY ts_kafka, seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS leg FROM marks WHERE reply OR stopped),
        stops AS (
          SELECT *, max(if(stopped, ts_kafka, null)) OVER (PARTITION BY icao, leg ORDER BY ts_kafka, seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM legs)
        SELECT icao, stop, ts_kafka, (ts_kafka - stop) / 1000D FROM stops WHERE reply AND stop IS NOT NULL""",
    ),
    "known_state_of": (
        "aircraft STRING, start_ms BIGINT, end_ms BIGINT",
        "ts_kafka BIGINT, seq BIGINT, callsign STRING, lat DOUBLE, lon DOUBLE, alt_feet DOUBLE, speed INT",
        """
        SELECT ts_kafka, seq, (last_value(ident, true) OVER o).callsign, (last_value(air, true) OVER o).lat, (last_value(air, true) OVER o).lon,
          cast((last_value(air, true) OVER o).alt_feet AS DOUBLE), cast((last_value(vel, true) OVER o).speed AS INT)
        FROM frames WHERE icao = known_state_of.aircraft AND msg_type IS NOT NULL
          AND ts_kafka BETWEEN known_state_of.start_ms AND known_state_of.end_ms
        WINDOW o AS (PARTITION BY icao ORDER BY ts_kafka, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
}


def register(spark: SparkSession, raw: DataFrame) -> None:
    """Temporary views of a raw log and of its products, and temporary functions on messages and times."""
    decoded = decode(raw)
    views = {
        "messages": raw,
        "decoded": decoded,
        "frames": valid_frames(decoded),
        "rejects": split_rejects(decoded)[1],
        "occupancy": occupancy(decoded),
        "takeoffs": with_runway(takeoffs(decoded)),
        "known_state": known_state(decoded),
        "map_states": map_states(decoded),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    for name, (arguments, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    for name, (arguments, columns, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({columns}) RETURN {body}")
