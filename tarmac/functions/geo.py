"""Planar geometry as columns: polygons, directions, significant digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.fixed_values import DIRECTION_EPSILON, RUNWAYS


def strictly_inside(x: str, y: str, vertices: list[tuple[float, float]]) -> str:
    """Whether a point lies inside a convex polygon, its boundary excluded.

    All edges must see the point on the same side, so the test is one signed
    area per edge and no array or join is needed.
    """
    edges = zip(vertices, vertices[1:] + vertices[:1])
    sides = [
        f"({x} - ({ax!r}D)) * {by - ay!r}D - ({y} - {ay!r}D) * {bx - ax!r}D" for (ax, ay), (bx, by) in edges
    ]
    left = " and ".join(f"{s} > 0" for s in sides)
    right = " and ".join(f"{s} < 0" for s in sides)
    return f"(({left}) or ({right}))"


def runway_at(lon: str, lat: str) -> Column:
    """Name of the first runway outline holding the point, else null."""
    cases = " ".join(f"when {strictly_inside(lon, lat, outline)} then '{name}'" for name, outline in RUNWAYS)
    return F.expr(f"case {cases} end")


def angle_to_east(dlat: Column, dlon: Column) -> Column:
    """Unsigned angle (0..pi) between a displacement and east."""
    return F.acos(dlon / (F.lit(DIRECTION_EPSILON) + F.sqrt(dlon * dlon + dlat * dlat)))


def significant(value: str, digits: int) -> Column:
    """Value rounded to a number of significant digits."""
    scale = f"pow(10D, {digits - 1} - floor(log10(abs({value}))))"
    return F.expr(f"if({value} = 0, 0D, rint({value} * {scale}) / {scale})")


def nautical_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance over ground on a sphere of 60 nautical miles a degree."""
    half = lambda a, b: F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2.0))
    chord = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))) * 60
