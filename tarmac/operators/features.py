"""GeoJSON features: one text row per marker and per trail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import calendar, geo
from tarmac.operators.routes import TRAIL_POINTS, trails


def markers(points: DataFrame) -> DataFrame:
    """A MultiPoint feature per row, with the fields of its popup."""
    time = calendar.second_text(F.col("ts_kafka"))
    properties = F.struct(
        F.col("icao").alias("id"),
        "callsign",
        geo.significant("lat", 8).alias("lat"),
        geo.significant("lon", 8).alias("lon"),
        geo.significant("velocity", 5).alias("speed"),
        F.round(F.degrees("direction_rad"), 3).alias("rotation"),
        F.col("ground").alias("ground"),
        F.array(time).alias("times"),
    )
    geometry = F.struct(F.lit("MultiPoint").alias("type"), F.array(F.array("lon", "lat")).alias("coordinates"))
    return _feature(points, "marker", properties, geometry)


def trail_lines(points: DataFrame, n: int = TRAIL_POINTS) -> DataFrame:
    """A LineString feature per row over the last ``n`` points."""
    rows = trails(points, n)
    time = calendar.second_text(F.col("ts_kafka"))
    properties = F.struct(F.array_repeat(time, F.size("trail")).alias("times"))
    line = F.transform("trail", lambda p: F.array(p["lon"], p["lat"]))
    geometry = F.struct(F.lit("LineString").alias("type"), line.alias("coordinates"))
    return _feature(rows, "trail", properties, geometry)


def _feature(rows: DataFrame, kind: str, properties, geometry) -> DataFrame:
    body = F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry"))
    return rows.select(F.lit(kind).alias("kind"), "icao", "ts_kafka", F.to_json(body).alias("feature"))


def to_geojson(points: DataFrame, kind: str = "all") -> DataFrame:
    """Features of drawable points: ``marker``, ``trail`` or ``all``."""
    if kind == "marker":
        return markers(points)
    if kind == "trail":
        return trail_lines(points)
    return markers(points).unionByName(trail_lines(points))
