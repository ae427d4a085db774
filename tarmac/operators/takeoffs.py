"""Take-off events, their runway and their waiting time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import calendar, geo
from tarmac.functions.fixed_values import UNINFORMATIVE_LABELS
from tarmac.operators.decode import valid_frames
from tarmac.operators.places import with_place
from tarmac.operators.scan import SLICE_MS, carry_last
from tarmac.session import MINUTE_MS

MAX_WAIT_S = 1500
DUPLICATE_GAP_MS = 5 * MINUTE_MS


def takeoffs(decoded: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """A row per take-off: last stop on the surface, closed by the first airborne all-call reply.

    A reply closes a wait only if the aircraft stopped after its previous
    airborne reply. Aircraft type and surface position are the last known ones
    and are kept from flight to flight; ``pos_age_s`` tells how old the position
    is.
    """
    airborne_reply = (F.col("dl") == 11) & (F.col("on_ground") == 0)
    # rows that can change nothing are dropped before the shuffle
    rows = valid_frames(decoded).filter(airborne_reply | F.col("msg_type").isin("surface", "ident"))
    known_type = F.col("tc").between(1, 4) & (
        (F.col("tc") != 1) | ~F.coalesce(F.col("aircraft_type").isin(*UNINFORMATIVE_LABELS), F.lit(False))
    )
    moment = F.struct("ts_kafka", "seq")
    states = {
        "stop": F.when(F.col("surf.speed") == 0, moment),
        "reply": F.when(airborne_reply, moment),
        "kind": F.when(known_type, F.struct("aircraft_type")),
        "place": F.when(
            F.col("surf.lat").isNotNull() & F.col("surf.lon").isNotNull(), F.struct("surf.lat", "surf.lon", "ts_kafka")
        ),
    }
    carried = carry_last(rows, states, strict=("reply",), slice_ms=slice_ms)
    stopped_since = F.col("last_reply").isNull() | (F.col("last_stop") > F.col("last_reply"))
    events = carried.filter(F.col("reply").isNotNull() & F.col("last_stop").isNotNull() & stopped_since)
    left, stopped = F.col("ts_kafka"), F.col("last_stop.ts_kafka")
    return events.select(
        "icao",
        "seq",
        stopped.alias("last_stopped_ms"),
        left.alias("takeoff_ms"),
        (left - stopped).alias("wait_ms"),
        ((left - stopped) / F.lit(1000.0)).alias("wait_s"),
        F.col("last_kind.aircraft_type").alias("aircraft_type"),
        F.col("last_place.lat").alias("lat"),
        F.col("last_place.lon").alias("lon"),
        ((left - F.col("last_place.ts_kafka")) / F.lit(1000.0)).alias("pos_age_s"),
        F.to_date(calendar.at(left)).alias("takeoff_date"),
        calendar.hour_of(left).alias("takeoff_hour"),
    )


def with_runway(events: DataFrame, outlines: DataFrame | None = None) -> DataFrame:
    """Adds the runway whose outline holds the last surface position, else null.

    ``outlines`` is a table ``(priority, runway, vertices)`` of another airport, or of many; by default
    the four runways around the receiver are tested in place.
    """
    if outlines is not None:
        return with_place(events, outlines, "runway")
    return events.withColumn("runway", geo.runway_at("lon", "lat"))


def plausible(events: DataFrame, max_wait_s: float = MAX_WAIT_S, min_wait_s: float | None = None) -> DataFrame:
    """Waits below a limit on a known runway."""
    kept = events.filter((F.col("wait_s") < max_wait_s) & F.col("runway").isNotNull())
    return kept if min_wait_s is None else kept.filter(F.col("wait_s") > min_wait_s)


def drop_repeats(events: DataFrame, gap_ms: int = DUPLICATE_GAP_MS) -> DataFrame:
    """Drops a take-off when the same aircraft takes off again less than ``gap_ms`` later.

    Only the next ``gap_ms`` matter, so the windows run over (aircraft, slice)
    with copies of the rows just after a slice border.
    """
    slice_ms = max(SLICE_MS, 4 * gap_ms)
    home = F.floor(F.col("takeoff_ms") / F.lit(slice_ms))
    reach = F.floor((F.col("takeoff_ms") - F.lit(gap_ms)) / F.lit(slice_ms))
    sliced = events.withColumn("__slice", F.explode(F.sequence(reach, home)))
    order = Window.partitionBy("icao", "__slice").orderBy("takeoff_ms", "seq")
    following = F.lead("takeoff_ms").over(order)
    marked = sliced.withColumn("__repeat", F.coalesce(following - F.col("takeoff_ms") < gap_ms, F.lit(False)))
    own = F.col("__slice") == home
    return marked.filter(own & ~F.col("__repeat")).drop("__slice", "__repeat")


def clean_waits(
    decoded: DataFrame, gap_ms: int = DUPLICATE_GAP_MS, max_wait_s: float = MAX_WAIT_S, outlines: DataFrame | None = None
) -> DataFrame:
    """Take-offs as the reports use them: plausible wait, known runway, no repeats."""
    return drop_repeats(plausible(with_runway(takeoffs(decoded), outlines), max_wait_s), gap_ms)
