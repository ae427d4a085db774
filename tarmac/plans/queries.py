"""Registered queries: each runs over the whole message log of a data folder."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators import features, occupancy as occ, profile, routes, state, takeoffs as tk, waits, windows
from tarmac.operators.decode import decode, split_rejects, valid_adsb, valid_allcall, valid_frames
from tarmac.plans import sql_surface
from tarmac.session import HOUR_MS, MINUTE_MS, configure, shared_dir
from tarmac.sources import dims, products
from tarmac.sources.event_frames import event_log, fleet_log
from tarmac.sources.raw import on_days, read_raw_range, write_raw_spans

# The derived log holds one message per aircraft and quarter of an hour or so,
# hence windows and gaps longer than the library defaults.
WINDOW_MS = HOUR_MS
GAP_MS = 30 * MINUTE_MS
TTL_MS = 30 * MINUTE_MS
DAY, OTHER_DAY = "02/01/2024", "05/01/2024"
RANGE_START_MS = 1704240000000
AIRCRAFT = "340005"
MEDIUM = "Medium 1 (between 7000 kg and 34000 kg)"


def stable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Result columns in types that compare across engines: BIGINT, DOUBLE to 6 digits, text."""
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.BooleanType)):
            c = c.cast("int").cast("bigint")
        elif isinstance(field.dataType, T.DoubleType):
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            c = F.unix_millis(c)
        columns.append(c.alias(field.name))
    return df.select(*columns)


# --- inputs shared by the queries ---------------------------------------------


def _decoded(raw: DataFrame) -> DataFrame:
    return decode(raw)


def _facts(raw: DataFrame) -> DataFrame:
    return occ.occupancy(_decoded(raw))


def _events(raw: DataFrame) -> DataFrame:
    """Take-offs with runways."""
    return tk.with_runway(tk.takeoffs(_decoded(raw)))


def _clean(raw: DataFrame) -> DataFrame:
    return tk.drop_repeats(tk.plausible(_events(raw)), GAP_MS)


def _states(raw: DataFrame) -> DataFrame:
    """The map table: one row per aircraft and window."""
    return windows.map_states(_decoded(raw), WINDOW_MS)


def _plain_states(raw: DataFrame) -> DataFrame:
    """The map table without directions, for reports that do not show them."""
    return windows.window_states(_decoded(raw), WINDOW_MS)


def _selected(raw: DataFrame) -> DataFrame:
    """Take-offs after a wait of more than a minute and less than half an hour."""
    return tk.plausible(_events(raw), max_wait_s=1800, min_wait_s=60)


def _max_hist(raw: DataFrame, ground: int, column: str) -> DataFrame:
    """Distribution over aircraft of their largest values in the air or on the ground."""
    return profile.histogram(profile.max_speed(_plain_states(raw)).filter(F.col("ground") == ground), column)


def _of_aircraft(raw: DataFrame, icao: str) -> DataFrame:
    """One aircraft's messages; its state needs no other's, so the choice comes before any shuffle."""
    return _decoded(raw).filter(F.col("icao") == icao)


def _points(raw: DataFrame) -> DataFrame:
    """Points that can be drawn, by aircraft and day as the route operators want them."""
    return routes.complete_points(windows.spanned_states(_decoded(raw), WINDOW_MS))


def _map_points(raw: DataFrame) -> DataFrame:
    return routes.complete_points(_states(raw))


# --- decode --------------------------------------------------------------------


def decode_messages(raw: DataFrame) -> DataFrame:
    return valid_frames(_decoded(raw)).select("seq", "ts_kafka", "icao", "dl", "ca", "tc", "on_ground", "msg_type")


def rejects(raw: DataFrame) -> DataFrame:
    return split_rejects(_decoded(raw))[1].select("seq", "ts_kafka", "reject_reason")


def decode_ident(raw: DataFrame) -> DataFrame:
    rows = valid_adsb(_decoded(raw)).filter(F.col("msg_type") == "ident")
    return rows.select("seq", "icao", "tc", "ident.callsign", "ident.category", "ident.vortex", "aircraft_type")


def decode_surface(raw: DataFrame) -> DataFrame:
    rows = valid_adsb(_decoded(raw)).filter(F.col("msg_type") == "surface")
    return rows.select("seq", "icao", "tc", *[f"surf.{c}" for c in ("lat", "lon", "speed", "movement_code", "ground_track")])


def decode_airborne(raw: DataFrame) -> DataFrame:
    names = ["lat", "lon", "alt_feet", "altitude_type", "surveillance_status", "single_antenna", "time_bit", "cpr_format"]
    rows = valid_adsb(_decoded(raw)).filter(F.col("msg_type") == "airborne")
    return rows.select("seq", "icao", "tc", *[f"air.{c}" for c in names])


def decode_velocity(raw: DataFrame) -> DataFrame:
    rows = valid_adsb(_decoded(raw)).filter(F.col("msg_type") == "velocity")
    return rows.select("seq", "icao", "vel.*", "gs.*", "asp.*")


# --- state ---------------------------------------------------------------------

def _state_report(known: DataFrame) -> DataFrame:
    return known.drop("msg_type")


def known_state(raw: DataFrame) -> DataFrame:
    return _state_report(state.known_state(_decoded(raw)))


def known_state_ttl(raw: DataFrame) -> DataFrame:
    return _state_report(state.known_state_ttl(_decoded(raw), TTL_MS))


def height_profile(raw: DataFrame) -> DataFrame:
    return routes.height_profile(_points(raw))


def takeoffs_product(raw: DataFrame) -> DataFrame:
    """The take-off table written in two runs and read back."""
    base, events = shared_dir(raw.sparkSession), _events(raw)
    for run in (0, 1):
        part = events.filter(F.col("seq") % 2 == run)
        products.write_product(part, "takeoffs", base, mode="append", sort_by="icao")
    return products.read_product(raw.sparkSession, "takeoffs", base)


def window_states_product(raw: DataFrame) -> DataFrame:
    """The later days of the written map table, read by partition; the earlier ones are not read."""
    base = shared_dir(raw.sparkSession)
    products.write_product(windows.window_states(_decoded(raw), WINDOW_MS), "window_states", base, sort_by="icao")
    back = products.read_product(raw.sparkSession, "window_states", base)
    return back.filter(F.col("date") >= F.lit("2024-01-03").cast("date")).drop("date")


def window_states_roundtrip(raw: DataFrame) -> DataFrame:
    """The whole map table written and read back."""
    base = shared_dir(raw.sparkSession)
    products.write_product(_plain_states(raw), "window_states", base, sort_by="icao")
    return products.read_product(raw.sparkSession, "window_states", base).drop("date")


def flights(raw: DataFrame) -> DataFrame:
    return routes.flights(_points(raw)).drop("flight_no")


def trails(raw: DataFrame) -> DataFrame:
    rows = routes.trails(_points(raw))
    return rows.select(
        "icao",
        "ts_kafka",
        F.size("trail").alias("n_points"),
        F.element_at("trail", 1)["lon"].alias("first_lon"),
        F.element_at("trail", 1)["lat"].alias("first_lat"),
        F.element_at("trail", -1)["lon"].alias("last_lon"),
        F.element_at("trail", -1)["lat"].alias("last_lat"),
    )


def geojson(raw: DataFrame) -> DataFrame:
    return features.to_geojson(_map_points(raw).withColumns({c: F.round(c, 6) for c in ("lat", "lon", "velocity")}))


def hour_spine(raw: DataFrame) -> DataFrame:
    return routes.hour_spine(raw)


def _points_between(raw: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Map points of a range. Windows follow from all earlier messages, but from none that come more than a window later."""
    known = raw.filter(F.col("ts_kafka") <= end_ms + WINDOW_MS)
    points = routes.in_time_range(_points(known), start_ms, end_ms)
    return points.select("icao", "ts_kafka", "lat", "lon", "ground")


def map_points(raw: DataFrame) -> DataFrame:
    return _points_between(raw, RANGE_START_MS, RANGE_START_MS + 2 * HOUR_MS)


def map_points_day(raw: DataFrame) -> DataFrame:
    return _points_between(raw, RANGE_START_MS, RANGE_START_MS + 24 * HOUR_MS)


def null_profile(raw: DataFrame) -> DataFrame:
    columns = ["icao", "ts_kafka", "velocity", "lat", "lon", "ground", "alt_feet", "callsign", "vortex"]
    return profile.null_profile(stable(_plain_states(raw)).select(*columns))


def null_corr(raw: DataFrame) -> DataFrame:
    return profile.null_corr(_states(raw))


def ground_and_air_rows(raw: DataFrame) -> DataFrame:
    points = _points(raw)
    kept = routes.rows_of(points, routes.seen_ground_and_air(points, MEDIUM))
    return kept.groupBy("icao").agg(F.count("*").alias("n"))


def window_hist(raw: DataFrame) -> DataFrame:
    return profile.histogram(_points(raw), "alt_feet")


def takeoff_runway_table(raw: DataFrame) -> DataFrame:
    """Take-offs whose runway comes from a table of outlines."""
    return tk.with_runway(tk.takeoffs(_decoded(raw)), dims.runways(raw.sparkSession))


def decoded_csv(raw: DataFrame) -> DataFrame:
    """The decoded table written as text and read back with its times and dates."""
    base = shared_dir(raw.sparkSession)
    products.write_product(products.decoded_columns(valid_frames(_decoded(raw))), "decoded", base, file_format="csv")
    return products.read_decoded(raw.sparkSession, f"{base}/decoded", "csv").drop("message", "message_hex")


def raw_range_scan(raw: DataFrame) -> DataFrame:
    """Messages of two days from a text log of a file a day; the other days' files are not read."""
    folder = f"{shared_dir(raw.sparkSession)}/raw"
    write_raw_spans(raw, folder)
    rows = read_raw_range(raw.sparkSession, folder, RANGE_START_MS, RANGE_START_MS + 2 * 24 * HOUR_MS - 1)
    return rows.select("ts_kafka", F.length("message").alias("n_chars"), "line")


def first_messages(raw: DataFrame) -> DataFrame:
    """The ten oldest intact messages."""
    return products.preview(products.by_time(valid_frames(_decoded(raw))), 10).select("seq", "ts_kafka", "icao", "dl")


def time_order(raw: DataFrame) -> DataFrame:
    """How many messages the global sort by time gives, and whether any task saw time go backwards."""
    rows = products.by_time(valid_frames(_decoded(raw))).select("ts_kafka")

    def steps(batches):
        last = None
        for batch in batches:
            times = batch["ts_kafka"]
            yield pd.DataFrame({"backwards": [bool((times.diff() < 0).any()) or (last is not None and times.iloc[0] < last)], "n": [len(times)]})
            last = times.iloc[-1]

    checked = rows.mapInPandas(steps, "backwards boolean, n long")
    return checked.agg(F.sum("n").alias("n"), F.max("backwards").alias("backwards"))


def occupancy_sketch(raw: DataFrame) -> DataFrame:
    """Distinct aircraft a day by state: counted, and merged from the hours' kept sketches."""
    base, facts = shared_dir(raw.sparkSession), _facts(raw)
    products.write_product(occ.occupancy_sketches(facts), "occupancy_sketches", base)
    kept = products.read_product(raw.sparkSession, "occupancy_sketches", base)
    return occ.sketched_beside_exact(facts, kept, "day", "on_ground").drop("n_sketched")


def sql_takeoffs_between(raw: DataFrame) -> DataFrame:
    """A table function asked from SQL."""
    sql_surface.register(raw.sparkSession, raw)
    return raw.sparkSession.sql(f"SELECT * FROM takeoffs_between({RANGE_START_MS}, {RANGE_START_MS + 3 * 24 * HOUR_MS})")


def sql_known_state_of(raw: DataFrame) -> DataFrame:
    sql_surface.register(raw.sparkSession, raw)
    return raw.sparkSession.sql(f"SELECT * FROM known_state_of('{AIRCRAFT}', {RANGE_START_MS}, {RANGE_START_MS + 24 * HOUR_MS})")


def sql_day_hours(raw: DataFrame) -> DataFrame:
    """Scalar functions asked from SQL."""
    sql_surface.register(raw.sparkSession, raw)
    return raw.sparkSession.sql(
        "SELECT day_text(ts_kafka) AS day, message_hour(ts_kafka) AS hour, downlink_format(message) AS dl, count(*) AS n, "
        "count(DISTINCT message_icao(message)) AS n_icao FROM messages GROUP BY ALL"
    )


def pair_positions(raw: DataFrame) -> DataFrame:
    return state.pair_positions(_decoded(raw))


QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "decode_messages": decode_messages,
    "decode_ident": decode_ident,
    "decode_surface": decode_surface,
    "decode_airborne": decode_airborne,
    "decode_velocity": decode_velocity,
    "rejects": rejects,
    "valid_allcall": lambda raw: valid_allcall(_decoded(raw)).select("seq", "icao", "on_ground"),
    "valid_frames": lambda raw: valid_frames(_decoded(raw)).groupBy("dl").agg(F.count("*").alias("n")),
    "valid_adsb": lambda raw: valid_adsb(_decoded(raw)).groupBy("msg_type").agg(F.count("*").alias("n")),
    "adsb_version": lambda raw: state.adsb_version(_decoded(raw)),
    # occupancy
    "occupancy": _facts,
    "hour_ground_counts": lambda raw: occ.hour_ground_counts(_facts(on_days(raw, DAY)), DAY),
    "hourly_dense": lambda raw: occ.hourly_dense(_facts(on_days(raw, DAY)), DAY),
    "axis_max": lambda raw: occ.axis_max(_facts(on_days(raw, DAY, OTHER_DAY)), DAY, OTHER_DAY),
    "weekday_traffic": lambda raw: occ.weekday_traffic(_facts(raw)),
    "day_hour_matrix": lambda raw: occ.day_hour_matrix(_facts(raw)),
    "ground_by_hour": lambda raw: occ.state_by_hour(_facts(raw), 1),
    "air_by_hour": lambda raw: occ.state_by_hour(_facts(raw), 0),
    "day_hour_dense_ground": lambda raw: occ.day_hour_dense(_facts(raw), 1),
    "day_hour_dense_air": lambda raw: occ.day_hour_dense(_facts(raw), 0),
    "distinct_days": lambda raw: occ.distinct_days(_facts(raw)),
    # take-offs
    "takeoffs": lambda raw: tk.takeoffs(_decoded(raw)),
    "takeoff_runway": _events,
    "waits_clean": _clean,
    "aircraft_lookup": lambda raw: tk.with_runway(tk.takeoffs(_of_aircraft(raw, AIRCRAFT))),
    "wait_stats": lambda raw: waits.wait_stats(_events(raw)),
    "takeoffs_weekday_hour": lambda raw: waits.takeoffs_weekday_hour(_clean(raw)),
    "takeoffs_type_weekday_hour": lambda raw: waits.takeoffs_type_weekday_hour(_clean(raw)),
    "wait_type_hour": lambda raw: waits.wait_type_hour(_clean(raw)),
    "wait_weekday_hour": lambda raw: waits.wait_weekday_hour(_clean(raw)),
    "takeoffs_weekday_runway": lambda raw: waits.takeoffs_weekday_runway(_clean(raw)),
    "takeoffs_runway_hour": lambda raw: waits.takeoffs_runway_hour(_clean(raw)),
    "wait_runway_weekday": lambda raw: waits.wait_runway_weekday(_clean(raw)),
    "wait_runway_hour": lambda raw: waits.wait_runway_hour(_clean(raw)),
    "wait_box": lambda raw: waits.wait_box(_events(raw), "aircraft_type"),
    "wait_box_clean": lambda raw: waits.wait_box(_clean(raw), "aircraft_type"),
    "wait_box_selected": lambda raw: waits.wait_box_top(_selected(raw)),
    "wait_box_overall": lambda raw: waits.wait_box(_events(raw)),
    "wait_box_top": lambda raw: waits.wait_box_top(_events(raw)),
    "wait_describe": lambda raw: waits.wait_describe(_events(raw)),
    "wait_hist": lambda raw: profile.histogram(_events(raw), "wait_s"),
    "takeoffs_per_hour": lambda raw: waits.takeoffs_per_hour(_events(raw)),
    "takeoffs_per_weekday": lambda raw: waits.takeoffs_per_weekday(_events(raw)),
    "takeoffs_per_type": lambda raw: waits.value_counts(_events(raw), "aircraft_type"),
    "max_wait_per_type": lambda raw: waits.max_wait_per_type(_events(raw)),
    "top_aircraft": lambda raw: waits.top_aircraft(_events(raw)),
    "types_per_aircraft": lambda raw: profile.types_per_aircraft(_events(raw), "aircraft_type"),
    "multi_type_aircraft": lambda raw: profile.multi_type_aircraft(_events(raw), "aircraft_type"),
    "aircraft_type_crosstab": lambda raw: profile.aircraft_type_crosstab(_events(raw), "aircraft_type", "wait_ms"),
    "aircraft_type_totals": lambda raw: profile.type_totals(
        profile.aircraft_type_crosstab(_plain_states(raw), "vortex", "ts_kafka"), "vortex"
    ),
    # per-aircraft state
    "known_state": known_state,
    "known_state_ttl": known_state_ttl,
    "state_changes": lambda raw: state.state_changes(_decoded(raw)),
    # windows and maps
    "anchor_windows": lambda raw: windows.window_anchors(valid_frames(_decoded(raw)), WINDOW_MS),
    "window_states": lambda raw: windows.window_states(_decoded(raw), WINDOW_MS),
    "direction": lambda raw: _states(raw).select("icao", "ts_kafka", "direction_rad", "bearing_rad"),
    "map_points": map_points,
    "map_points_day": map_points_day,
    "hour_spine": hour_spine,
    "trails": trails,
    "decode_compat": lambda raw: valid_adsb(decode(raw, compat=True))
    .filter(F.col("msg_type") == "ident")
    .select("seq", "aircraft_type"),
    "category_labels": lambda raw: dims.with_category_label(
        valid_adsb(_decoded(raw)).filter(F.col("msg_type") == "ident").select("seq", "tc", "ident.category")
    ),
    "takeoffs_product": takeoffs_product,
    "window_states_product": window_states_product,
    "window_states_roundtrip": window_states_roundtrip,
    "flights": flights,
    "flight_points": lambda raw: routes.flight_points(_points(raw)),
    "current_route": lambda raw: routes.current_route(_points(raw)),
    "segments": lambda raw: routes.segments(_points(raw)),
    "segment_counts": lambda raw: routes.segment_counts(_points(raw)),
    "height_profile": height_profile,
    "latest_state": lambda raw: routes.latest_state(_map_points(raw)),
    "aircraft_series": lambda raw: routes.series(windows.window_states(_of_aircraft(raw, AIRCRAFT), WINDOW_MS), AIRCRAFT),
    "ground_and_air": lambda raw: routes.seen_ground_and_air(_points(raw)),
    "ground_and_air_rows": ground_and_air_rows,
    "geojson": geojson,
    # profiles
    "max_speed_hist_air": lambda raw: _max_hist(raw, 0, "max_speed"),
    "max_speed_hist_ground": lambda raw: _max_hist(raw, 1, "max_speed"),
    "max_altitude_hist": lambda raw: _max_hist(raw, 0, "max_alt_feet"),
    "rows_per_aircraft": lambda raw: waits.value_counts(_plain_states(raw), "icao"),
    "max_speed": lambda raw: profile.max_speed(_plain_states(raw)),
    "altitude_hist": window_hist,
    "null_profile": null_profile,
    "null_corr": null_corr,
    # tables of outlines, sources, sketches, SQL
    "takeoff_runway_table": takeoff_runway_table,
    "decoded_csv": decoded_csv,
    "raw_range_scan": raw_range_scan,
    "first_messages": first_messages,
    "time_order": time_order,
    "occupancy_sketch": occupancy_sketch,
    "sql_takeoffs_between": sql_takeoffs_between,
    "sql_known_state_of": sql_known_state_of,
    "sql_day_hours": sql_day_hours,
}

#: Queries over the fleet log: more aircraft, a hot one, pairs of positions, bits and subtypes that the plain log lacks.
FLEET_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fleet_frames": QUERIES["valid_frames"],
    "fleet_airborne": decode_airborne,
    "fleet_velocity": decode_velocity,
    "fleet_known_state": known_state,
    "fleet_takeoffs": QUERIES["takeoffs"],
    "fleet_window_states": QUERIES["window_states"],
    "fleet_direction": QUERIES["direction"],
    "fleet_trails": trails,
    "fleet_flights": flights,
    "fleet_current_route": QUERIES["current_route"],
    "fleet_segments": QUERIES["segments"],
    "fleet_height_profile": height_profile,
    "fleet_latest_state": QUERIES["latest_state"],
    "fleet_map_points": map_points_day,
    "pair_positions": pair_positions,
}


def batch_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    Query = Callable[[DataFrame], DataFrame]

    def bind(query: Query, log: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: stable(query(log(configure(spark), sf_dir)))

    plain = {name: bind(query, event_log) for name, query in QUERIES.items()}
    return plain | {name: bind(query, fleet_log) for name, query in FLEET_QUERIES.items()}
