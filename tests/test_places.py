"""Points in outlines from a table."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tarmac.functions import geo
from tarmac.operators import places
from tarmac.operators.takeoffs import with_runway
from tarmac.sources import dims

OUTLINES = "priority int, name string, vertices array<struct<x: double, y: double>>"
POINTS = "id long, lon double, lat double, place string"


def brute(x, y, vertices):
    """Even-odd rule in plain Python; on an edge is outside."""
    if x is None or y is None or not (math.isfinite(x) and math.isfinite(y)):
        return False
    inside = False
    for (ax, ay), (bx, by) in zip(vertices, vertices[1:] + vertices[:1]):
        if (x - ax) * (by - ay) == (y - ay) * (bx - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return False
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def names(points, outlines):
    out = {}
    for i, x, y in points:
        hits = [(p, n) for p, n, v in outlines if v and len(v) > 2 and brute(x, y, v)]
        out[i] = min(hits)[1] if hits else None
    return out


def run(spark, points, outlines):
    frame = spark.createDataFrame([(*p, "clash") for p in points], POINTS)
    table = spark.createDataFrame([(p, n, v and [(float(x), float(y)) for x, y in v]) for p, n, v in outlines], OUTLINES)
    return {r.id: r.name for r in places.with_place(frame, table, "name").collect()}


def star(rng, cx, cy, size, corners):
    """A concave outline around a centre."""
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return [(cx + size * r * math.cos(a), cy + size * r * math.sin(a)) for a in angles for r in [rng.uniform(0.2, 1)]]


def test_concave_outlines_of_all_sizes(spark):
    rng = random.Random(3)
    outlines = [(i % 5, f"o{i}", star(rng, rng.uniform(-5, 5), rng.uniform(-5, 5), 10 ** rng.uniform(-3, 1), rng.randint(3, 9))) for i in range(60)]
    outlines += [(0, "u", [(0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4)]), (9, "line", [(0, 0), (1, 1)]), (9, "none", None), (9, "void", [])]
    points = [(i, rng.uniform(-6, 6), rng.uniform(-6, 6)) for i in range(1500)]
    points += [(5000 + i, x + rng.uniform(-1, 1) * s, y + rng.uniform(-1, 1) * s) for i, (_, _, v) in enumerate(outlines[:60]) for x, y in [v[0]] for s in [abs(v[1][0] - x)]]
    points += [(9000, None, 1.0), (9001, float("nan"), 1.0), (9002, float("inf"), 0.0), (9003, 0.0, 2.0), (9004, 4.0, 0.5), (9005, 2.0, 2.0), (9006, 0.5, 0.5)]
    expected = names(points, outlines)
    assert run(spark, points, outlines) == expected
    assert sum(n is not None for n in expected.values()) > 300
    assert run(spark, points, [(9, "none", None)]) == dict.fromkeys(expected)


def test_ten_thousand_outlines_meet_points_by_cell(spark):
    rng = random.Random(4)
    outlines = [(1, f"o{i}", [(x, y), (x + 0.4, y), (x + 0.2, y + 0.1), (x + 0.4, y + 0.4), (x, y + 0.4)]) for i in range(10_000) for x, y in [(float(i % 100), float(i // 100))]]
    points = [(i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(2000)]
    frame = spark.createDataFrame([(*p, "c") for p in points], POINTS)
    found = places.with_place(frame, spark.createDataFrame(outlines, OUTLINES), "name")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter, ((__cx0" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    by_cell = {(int(v[0][0]), int(v[0][1])): (n, v) for _, n, v in outlines}
    for r in found.collect():
        n, v = by_cell[int(r.lon), int(r.lat)]
        assert r.name == (n if brute(r.lon, r.lat, v) else None)


def test_runways_from_a_table(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.uniform(-3.6, -3.5), rng.uniform(40.44, 40.55), None) for i in range(4000)] + [(9000, -3.582, 40.51, None)]
    points = spark.createDataFrame(rows, POINTS)
    dims.runways(spark).write.json(str(tmp_path / "outlines"))
    found = with_runway(points, dims.read_outlines(spark, str(tmp_path / "outlines"))).withColumn("fixed", geo.runway_at("lon", "lat"))
    assert found.filter(~F.col("runway").eqNullSafe(F.col("fixed"))).count() == 0
    assert found.filter("runway IS NOT NULL").count() > 500


@pytest.mark.parametrize("empty", ["points", "outlines"])
def test_empty(spark, empty):
    points = [] if empty == "points" else [(1, 0.5, 0.5)]
    outlines = [] if empty == "outlines" else [(1, "a", [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)])]
    assert run(spark, points, outlines) == {p[0]: None for p in points}
