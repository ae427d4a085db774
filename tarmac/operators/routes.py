"""Trails, flights, routes and latest states behind the maps.

Input is the map table: at most one row per aircraft and window, however many
messages the aircraft sent. Windows run inside a span of a day; runs, numbers and
points that go on from one day to the next are carried over a table of one
row per aircraft and day (``spans``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tarmac.functions import calendar
from tarmac.functions.fixed_values import (
    FLIGHT_FADE,
    ROTORCRAFT,
    SPEED_RED_BELOW,
    SPEED_YELLOW_BELOW,
)
from tarmac.operators.spans import SPAN, beside_spans, by_span, in_span, row_of

TRAIL_POINTS = 10


def complete_points(states: DataFrame) -> DataFrame:
    """Rows that can be drawn: position and ground state known."""
    return states.dropna(subset=["lat", "lon", "ground"])


def in_time_range(states: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """Rows between two times, both included."""
    return states.filter(F.col("ts_kafka").between(start_ms, end_ms))


def hour_spine(states: DataFrame) -> DataFrame:
    """Every hour from the first day's midnight to 23:00 of the last day."""
    bounds = states.agg(
        F.to_date(calendar.at(F.min("ts_kafka"))).alias("first"), F.to_date(calendar.at(F.max("ts_kafka"))).alias("last")
    )
    start = F.col("first").cast("timestamp")
    stop = F.col("last").cast("timestamp") + F.expr("interval 23 hours")
    hours = F.sequence(start, stop, F.expr("interval 1 hour"))
    return bounds.select(F.posexplode(hours).alias("slot", "hour_start"))


def trails(points: DataFrame, n: int = TRAIL_POINTS) -> DataFrame:
    """The last ``n`` points of the aircraft up to each row."""
    rows = by_span(points).select("icao", SPAN, "ts_kafka", "lon", "lat")
    recent = F.collect_list(F.struct("lon", "lat")).over(in_span().rowsBetween(-(n - 1), Window.currentRow))
    newest = F.slice(F.sort_array(F.collect_list(F.struct("ts_kafka", "lon", "lat")), False), 1, max(n - 1, 1))

    def heads(table: DataFrame, side: WindowSpec) -> DataFrame:
        # every span has a point, so n - 1 spans hold as many as are missing
        before = F.flatten(F.collect_list("__newest").over(side.rowsBetween(-max(n - 1, 1), -1)))
        return table.withColumn("__before", F.slice(F.sort_array(before, False), 1, max(n - 1, 1)))

    joined = beside_spans(rows.withColumn("__recent", recent), {"__newest": newest}, heads)
    missing = F.slice("__before", F.lit(1), F.lit(n) - F.size("__recent"))
    earlier = F.transform(F.reverse(missing), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    return joined.select("icao", "ts_kafka", F.concat(earlier, "__recent").alias("trail"))


def _numbered(points: DataFrame, null_breaks: bool) -> DataFrame:
    """Adds to each point its flight and its places.

    ``flight_no`` counts runs of equal callsigns from 1 for the oldest of the ``n_flights``;
    ``route_pos`` is the place in the newest flight, negative for points of older ones; ``height_no`` counts points
    with a height from 0; ``previous`` is the point before.
    """
    rows = by_span(points).drop("flight_no", "n_flights", "route_pos", "height_no", "previous")
    order = in_span()

    def same(mine: Column, before: Column) -> Column:
        return mine.eqNullSafe(before) & mine.isNotNull() if null_breaks else mine.eqNullSafe(before)

    whole = row_of(rows, SPAN)
    place = F.row_number().over(order)
    rows = rows.withColumns({"__place": place, "__same": same(F.col("callsign"), F.lag("callsign").over(order)), "__whole": whole})
    rows = rows.withColumn("__start", F.when((F.col("__place") > 1) & ~F.col("__same"), 1).otherwise(0))
    has_height = F.col("alt_feet").isNotNull().cast("int")
    rows = rows.withColumns({"__starts": F.sum("__start").over(order), "__heights": F.sum(has_height).over(order), "__lag": F.lag("__whole").over(order)})
    tails = {
        "__last": F.max("__whole"),
        "__first": F.min(F.struct("ts_kafka", "callsign")),
        "__n": F.count("*"),
        "__n_starts": F.sum("__start"),
        "__n_heights": F.sum(has_height),
        "__last_start": F.max(F.when(F.col("__start") == 1, F.col("__place"))),
    }

    def heads(table: DataFrame, side: WindowSpec) -> DataFrame:
        earlier = side.rowsBetween(Window.unboundedPreceding, -1)
        aircraft = Window.partitionBy("icao")
        table = table.withColumns(
            {
                "__before": F.lag("__last").over(side),
                "__n_before": F.coalesce(F.sum("__n").over(earlier), F.lit(0)),
                "__heights_before": F.coalesce(F.sum("__n_heights").over(earlier), F.lit(0)),
            }
        )
        goes_on = F.col("__before").isNotNull() & same(F.col("__first.callsign"), F.col("__before.callsign"))
        table = table.withColumn("__opens", F.when(goes_on, 0).otherwise(1))
        starts = F.col("__n_starts") + F.col("__opens")
        newest = F.coalesce("__last_start", F.when(F.col("__opens") == 1, F.lit(1))) + F.col("__n_before") - 1
        return table.withColumns(
            {
                "__flights_before": F.coalesce(F.sum(starts).over(earlier), F.lit(0)) + F.col("__opens"),
                "n_flights": F.sum(starts).over(aircraft),
                "__route_start": F.max(newest).over(aircraft),
            }
        ).drop("__opens")

    joined = beside_spans(rows, tails, heads)
    return joined.withColumns(
        {
            "flight_no": F.col("__flights_before") + F.col("__starts"),
            "route_pos": F.col("__n_before") + F.col("__place") - 1 - F.col("__route_start"),
            "height_no": F.when(F.col("alt_feet").isNotNull(), F.col("__heights_before") + F.col("__heights") - 1),
            "previous": F.when(F.col("__place") == 1, F.col("__before")).otherwise(F.col("__lag")),
        }
    )


def _point() -> list[Column]:
    rounded = [F.round(c, 3).alias(c) for c in ("lat", "lon")]
    return [F.col("ts_kafka"), *rounded, *map(F.col, ("velocity", "alt_feet", "callsign"))]


def flights(points: DataFrame, null_breaks: bool = False) -> DataFrame:
    """One row per flight, ``flight_rank`` 0 for the newest, with its extent and drawing opacity.

    ``null_breaks`` starts a new flight at every row without a callsign. The
    route itself comes as rows from ``flight_points``: an aircraft that never
    says its callsign is one flight for the whole log.
    """
    grouped = (
        _numbered(points, null_breaks)
        .groupBy("icao", "flight_no", "n_flights")
        .agg(
            F.min("ts_kafka").alias("first_ms"),
            F.max("ts_kafka").alias("last_ms"),
            F.max("callsign").alias("callsign"),
            F.count("*").alias("n_points"),
        )
    )
    rank = F.col("n_flights") - F.col("flight_no")
    ranked = grouped.withColumn("flight_rank", rank.cast("int")).drop("n_flights")
    return ranked.withColumn("opacity", F.greatest(F.lit(0.0), F.lit(1.0) - F.lit(FLIGHT_FADE) * F.col("flight_rank")))


def flight_points(points: DataFrame, null_breaks: bool = False) -> DataFrame:
    """The points of every flight as rows (aircraft, ``flight_no``, point), in no order."""
    return _numbered(points, null_breaks).select("icao", "flight_no", *_point())


def flight_route(points: DataFrame, icao: str, flight_no: int, null_breaks: bool = False) -> DataFrame:
    """The route of one flight as an array, for drawing it."""
    own = flight_points(points.filter(F.col("icao") == icao), null_breaks).filter(F.col("flight_no") == flight_no)
    point = F.struct(*[c for c in own.columns if c not in ("icao", "flight_no")])
    return own.groupBy("icao", "flight_no").agg(F.array_sort(F.collect_list(point)).alias("route"))


def current_route(points: DataFrame, null_breaks: bool = False) -> DataFrame:
    """The points of each aircraft's newest flight, in order."""
    rows = _numbered(points, null_breaks).filter(F.col("route_pos") >= 0)
    return rows.select("icao", F.col("route_pos").cast("int").alias("pos"), *_point())


def speed_color(speed: Column) -> Column:
    return (
        F.when(speed < SPEED_RED_BELOW, "red").when(speed < SPEED_YELLOW_BELOW, "yellow").otherwise("green")
    )


def segments(points: DataFrame, null_breaks: bool = False) -> DataFrame:
    """Consecutive point pairs of the current route, coloured by the starting speed."""
    rows = _numbered(points, null_breaks).filter((F.col("route_pos") > 0) & F.col("lat").isNotNull())
    return rows.select(
        "icao",
        (F.col("route_pos") - 1).cast("int").alias("pos"),
        F.round("previous.lat", 3).alias("from_lat"),
        F.round("previous.lon", 3).alias("from_lon"),
        F.round("lat", 3).alias("to_lat"),
        F.round("lon", 3).alias("to_lon"),
        speed_color(F.col("previous.velocity")).alias("color"),
        F.col("previous.callsign").alias("callsign"),
    )


def segment_counts(points: DataFrame, null_breaks: bool = False) -> DataFrame:
    """Number of route segments per aircraft: points of the current route less one."""
    return current_route(points, null_breaks).groupBy("icao").agg((F.count("*") - 1).alias("n_segments"))


def height_profile(points: DataFrame, null_breaks: bool = False) -> DataFrame:
    """All known heights of an aircraft by number, beside the current route's point of the same number."""
    rows = _numbered(points, null_breaks)
    no_height, no_place = F.lit(None).cast("double"), F.lit(None).cast("double")
    height = F.struct(F.col("height_no").alias("pos"), F.col("alt_feet").cast("double").alias("height"), no_place.alias("lat"), no_place.alias("lon"))
    place = F.struct(F.col("route_pos").alias("pos"), no_height.alias("height"), F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon"))
    both = F.array(F.when(F.col("height_no").isNotNull(), height), F.when(F.col("route_pos") >= 0, place))
    cells = rows.select("icao", F.explode(both).alias("cell")).filter("cell IS NOT NULL").select("icao", "cell.*")
    met = cells.groupBy("icao", F.col("pos").cast("int").alias("pos")).agg(*[F.max(c).alias(c) for c in ("height", "lat", "lon")])
    return met.filter(F.col("height").isNotNull())


def latest_state(points: DataFrame) -> DataFrame:
    """The newest row of each aircraft as a marker: place, attitude, icon class and tooltip fields."""
    fields = ["ts_kafka", "lat", "lon", "ground", "direction_rad", "velocity", "callsign", "vortex"]
    newest = points.groupBy("icao").agg(F.max_by(F.struct(*fields), "ts_kafka").alias("s"))
    speed = F.col("s.velocity")
    return newest.select(
        "icao",
        F.col("s.ts_kafka").alias("ts_kafka"),
        F.round("s.lat", 3).alias("lat"),
        F.round("s.lon", 3).alias("lon"),
        F.col("s.ground").alias("ground"),
        F.degrees("s.direction_rad").alias("rotation_deg"),
        speed.alias("velocity"),
        F.col("s.callsign").alias("callsign"),
        F.col("s.vortex").alias("vehicle_type"),
        F.coalesce(F.col("s.vortex") == ROTORCRAFT, F.lit(False)).alias("is_rotorcraft"),
        F.when(speed != 0, F.format_string("%.3f", speed)).otherwise("-").alias("speed_text"),
        calendar.second_text(F.col("s.ts_kafka")).alias("time_text"),
    )


def series(states: DataFrame, icao: str) -> DataFrame:
    """Speed, ground and altitude of one aircraft over time."""
    return states.filter(F.col("icao") == icao).select("ts_kafka", "velocity", "ground", "alt_feet").orderBy("ts_kafka")


def seen_ground_and_air(points: DataFrame, category: str | None = None) -> DataFrame:
    """Aircraft with rows both on the ground and in the air, optionally of one category."""
    rows = points if category is None else points.filter(F.col("vortex") == category)
    ground = rows.filter(F.col("ground") == 1).select("icao")
    return ground.intersect(rows.filter(F.col("ground") == 0).select("icao"))


def rows_of(points: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Rows of the aircraft in a key set."""
    return points.join(aircraft.select("icao"), "icao", "left_semi")
