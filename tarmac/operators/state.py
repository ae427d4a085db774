"""Known state of each aircraft at every message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import cpr, geo
from tarmac.functions.fixed_values import RECEIVER_LAT, RECEIVER_LON
from tarmac.operators.decode import valid_adsb, valid_frames
from tarmac.operators.registry import MESSAGE_TYPES
from tarmac.operators.scan import SLICE_MS, carry_last, with_halo
from tarmac.session import MINUTE_MS

#: A fix is checked against the aircraft's fix before, if that is not older than this.
CHECK_MS = 10 * MINUTE_MS
MAX_SPEED_KT = 1000.0

GROUPS = [name for kind in MESSAGE_TYPES.values() for name in kind.groups]

# --- Fixed values: output columns of the known state, per field group --------
STATE_COLUMNS = {
    "surf": {
        "latitude": "lat",
        "longitude": "lon",
        "surface_velocity": "speed",
        "movement_code": "movement_code",
        "ground_track": "ground_track",
    },
    "air": {
        "airborne_pos_lat": "lat",
        "airborne_pos_lon": "lon",
        "airborne_pos_altitude_type": "altitude_type",
        "airborne_pos_surveillance_status": "surveillance_status",
        "airborne_pos_single_antenna_flag": "single_antenna",
        "airborne_pos_time": "time_bit",
        "airborne_pos_CPR": "cpr_format",
    },
    "vel": {
        "V": "speed",
        "H": "heading",
        "VS": "vertical_rate",
        "VT": "speed_type",
        "ST": "subtype",
        "IC": "intent_change",
        "IFR": "ifr",
        "NUC": "nuc",
        "VrSrc": "vr_source",
        "Svr": "vr_sign",
        "SDif": "sdif",
        "dAlt": "dalt",
        "VR": "vr_raw",
    },
    "gs": {"Dew": "dew", "Vew": "vew", "Dns": "dns"},
    "asp": {"SH": "heading_status", "HDG": "heading_raw", "T": "airspeed_type"},
    "ident": {"callsign": "callsign", "vortex": "vortex"},
}


def _flat(df: DataFrame, prefix: str) -> DataFrame:
    fields = [
        F.col(f"{prefix}{group}.{field}").alias(column)
        for group, columns in STATE_COLUMNS.items()
        for column, field in columns.items()
    ]
    return df.select(F.col("ts_kafka").alias("timestamp"), "seq", "icao", _type_of_groups().alias("msg_type"), *fields)


def _type_of_groups() -> Column:
    """Message type told by the groups a row carries."""
    kinds = [(kind.name, next(iter(kind.groups))) for kind in MESSAGE_TYPES.values()]
    result = F.when(F.col(kinds[0][1]).isNotNull(), kinds[0][0])
    for name, group in kinds[1:]:
        result = result.when(F.col(group).isNotNull(), name)
    return result


def _messages(decoded: DataFrame) -> DataFrame:
    return valid_adsb(decoded).select("ts_kafka", "seq", "icao", *GROUPS)


def known_state(decoded: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """One row per recognised message with the last known fields of its aircraft.

    A message overwrites its whole field group, nulls included; the other
    groups keep their last value.
    """
    states = {g: F.col(g) for g in GROUPS}
    return _flat(carry_last(_messages(decoded), states, slice_ms=slice_ms), "last_")


def known_state_ttl(decoded: DataFrame, ttl_ms: int = 2000) -> DataFrame:
    """Known state whose groups expire ``ttl_ms`` after their message.

    Nothing older than the time to live matters, so the rows are shuffled once
    with copies near slice borders and no side table is needed.
    """
    rows = with_halo(_messages(decoded), ttl_ms, max(SLICE_MS, 4 * ttl_ms))
    past = (
        Window.partitionBy("icao", "__slice")
        .orderBy("ts_kafka", "seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stamped = {
        f"last_{g}": F.last(
            F.when(F.col(g).isNotNull(), F.struct(F.col("ts_kafka").alias("at"), F.col(g).alias("value"))),
            ignorenulls=True,
        ).over(past)
        for g in GROUPS
    }
    fresh = {
        f"last_{g}": F.when(
            F.col("ts_kafka") - F.col(f"last_{g}.at") <= ttl_ms, F.col(f"last_{g}.value")
        )
        for g in GROUPS
    }
    return _flat(rows.withColumns(stamped).filter("__own").withColumns(fresh), "last_")


def state_changes(decoded: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """Recognised messages without those that repeat their aircraft's known values.

    Position messages are always kept.
    """
    states = {g: F.col(g) for g in ("vel", "gs", "asp")}
    states["ident"] = F.when(F.col("ident").isNotNull(), F.struct("ident.callsign", "ident.vortex"))
    states["place"] = F.when(
        F.col("msg_type").isin("surface", "airborne"), F.struct(F.col("msg_type").alias("kind"))
    )
    rows = carry_last(valid_adsb(decoded), states, strict=tuple(states), slice_ms=slice_ms)

    def differs(group: str) -> Column:
        return F.col(group).isNotNull() & ~F.col(group).eqNullSafe(F.col(f"last_{group}"))

    changed = differs("vel") | differs("gs") | differs("asp") | differs("ident")
    kind = F.coalesce(F.col("place.kind"), F.when(F.col("ident").isNotNull(), "ident").otherwise("velocity"))
    return rows.filter(F.col("place").isNotNull() | changed).select(
        "ts_kafka", "seq", "icao", kind.alias("msg_type")
    )


def adsb_version(decoded: DataFrame) -> DataFrame:
    """Latest stated protocol version per aircraft; 0 when none was stated."""
    rows = valid_frames(decoded)
    latest = F.max_by("version", F.when(F.col("version").isNotNull(), F.struct("ts_kafka", "seq")))
    return rows.groupBy("icao").agg(F.coalesce(latest, F.lit(0)).alias("version"))


def pair_positions(
    decoded: DataFrame,
    max_gap_ms: int = 10_000,
    ref_lat: float = RECEIVER_LAT,
    ref_lon: float = RECEIVER_LON,
    max_speed_kt: float = MAX_SPEED_KT,
) -> DataFrame:
    """Positions from even and odd frames close in time, without assuming where the aircraft is.

    Both frames are airborne, or both on the ground; then the receiver tells the quarter of
    the globe. Frames whose latitudes lie in zones of different counts give nothing. ``plausible`` is
    false if the aircraft would have had to go faster than ``max_speed_kt`` from its
    fix before, one of the last ``CHECK_MS``; null without such a fix.
    """
    rows = valid_adsb(decoded).filter(F.col("cpr").isNotNull()).select("ts_kafka", "seq", "icao", "cpr", (F.col("msg_type") == "surface").alias("ground"))
    rows = with_halo(rows, max_gap_ms, max(SLICE_MS, 4 * max_gap_ms))
    past = (
        Window.partitionBy("icao", "__slice", "ground")
        .orderBy("ts_kafka", "seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def latest(odd: int) -> Column:
        stamped = F.struct(F.col("ts_kafka").alias("at"), F.col("cpr.lat").alias("lat"), F.col("cpr.lon").alias("lon"))
        return F.last(F.when(F.col("cpr.odd") == odd, stamped), ignorenulls=True).over(past)

    paired = rows.withColumns({"even": latest(0), "odd": latest(1)}).filter(
        F.col("__own") & (F.abs(F.col("even.at") - F.col("odd.at")) <= max_gap_ms)
    )
    placed = cpr.pair_position("even", "odd", "cpr.odd = 1", "ground", ref_lat, ref_lon).apply(paired)
    fixes = placed.filter(F.col("pair_lat").isNotNull()).select(
        "ts_kafka", "seq", "icao", F.col("pair_lat").alias("lat"), F.col("pair_lon").alias("lon"), F.col("ground").cast("int").alias("ground")
    )
    near = with_halo(fixes, CHECK_MS, 4 * CHECK_MS)
    before = F.lag(F.struct("ts_kafka", "lat", "lon")).over(Window.partitionBy("icao", "__slice").orderBy("ts_kafka", "seq"))
    near = near.withColumn("__before", before).filter("__own")
    gone_h = F.greatest(F.col("ts_kafka") - F.col("__before.ts_kafka"), F.lit(1)) / F.lit(3_600_000.0)
    speed = geo.nautical_miles(F.col("__before.lat"), F.col("__before.lon"), F.col("lat"), F.col("lon")) / gone_h
    recent = F.col("ts_kafka") - F.col("__before.ts_kafka") <= CHECK_MS
    return near.select(*fixes.columns, F.when(recent, speed <= max_speed_kt).alias("plausible"))
