"""Route operators over many days against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tarmac.operators import routes, windows
from tarmac.operators.spans import SPAN_MS

STATES = "icao string, ts_kafka long, lat double, lon double, ground int, velocity double, alt_feet double, callsign string, vortex string"


@pytest.fixture(scope="module")
def points(spark):
    """Aircraft with a row or many a day, days without rows, and one row in all; callsigns go on over midnight."""
    rng = random.Random(12)
    rows = {}
    for number, (count, days) in enumerate([(150, 3), (60, 12), (30, 40), (1, 1), (2, 2), (400, 6)]):
        icao, name = f"a{number}", None
        times = sorted(rng.sample(range(days * SPAN_MS // 1000), count))
        for t in times:
            if rng.random() < 0.15:
                name = rng.choice(["X", "Y", None])
            place = (40 + rng.random(), -3 + rng.random())
            rows.setdefault(icao, []).append((icao, t * 1000, *place, 0, rng.choice([None, 250.0, 400.0, 500.0]), rng.choice([None, 100.0 * t]), name, None))
    flat = [r for own in rows.values() for r in own]
    rng.shuffle(flat)
    return spark.createDataFrame(flat, STATES).repartition(5), rows


@pytest.mark.parametrize("null_breaks", [False, True])
def test_flights_routes_and_segments(points, null_breaks):
    frame, rows = points
    flights, current, segments, heights = set(), set(), set(), set()
    for icao, own in rows.items():
        runs = []
        for r in own:
            same = runs and runs[-1][-1][7] == r[7] and (r[7] is not None or not null_breaks)
            runs[-1].append(r) if same else runs.append([r])
        for number, run in enumerate(runs, 1):
            flights.add((icao, number, len(runs) - number, run[0][1], run[-1][1], run[0][7], len(run)))
        route = runs[-1]
        current |= {(icao, i, r[1], round(r[2], 3)) for i, r in enumerate(route)}
        for i, (a, b) in enumerate(zip(route, route[1:])):
            color = "green" if a[5] is None else "red" if a[5] < 300 else "yellow" if a[5] < 450 else "green"
            segments.add((icao, i, round(a[2], 3), round(b[2], 3), color, a[7]))
        tall = [r[6] for r in own if r[6] is not None]
        heights |= {(icao, i, h, round(route[i][2], 3) if i < len(route) else None) for i, h in enumerate(tall)}
    found = routes.flights(frame, null_breaks).collect()
    assert {(r.icao, r.flight_no, r.flight_rank, r.first_ms, r.last_ms, r.callsign, r.n_points) for r in found} == flights and len(found) == len(flights)
    assert {(r.icao, r.pos, r.ts_kafka, r.lat) for r in routes.current_route(frame, null_breaks).collect()} == current
    assert {(r.icao, r.pos, r.from_lat, r.to_lat, r.color, r.callsign) for r in routes.segments(frame, null_breaks).collect()} == segments
    assert {(r.icao, r.pos, r.height, r.lat) for r in routes.height_profile(frame, null_breaks).collect()} == heights
    assert {(r.icao, r.n_segments) for r in routes.segment_counts(frame, null_breaks).collect()} == {(i, sum(s[0] == i for s in segments)) for i in rows}


@pytest.mark.parametrize("n", [1, 2, 7])
def test_trails(points, n):
    frame, rows = points
    expected = {(icao, r[1]): [(p[3], p[2]) for p in own[max(i - n + 1, 0) : i + 1]] for icao, own in rows.items() for i, r in enumerate(own)}
    found = {(r.icao, r.ts_kafka): [tuple(p) for p in r.trail] for r in routes.trails(frame, n).collect()}
    assert found == expected


def test_direction(points):
    frame, rows = points
    found = {(r.icao, r.ts_kafka): r for r in windows.direction(frame).collect()}
    assert len(found) == frame.count()
    wanted = frame.select("icao", "ts_kafka", "lat", "lon").toPandas().sort_values(["icao", "ts_kafka"])
    for back in (1, 2):
        for c in ("lat", "lon"):
            wanted[f"{c}{back}"] = wanted.groupby("icao")[c].shift(back)
    import numpy as np

    def angle(row, back):
        dlat, dlon = row.lat - row[f"lat{back}"], row.lon - row[f"lon{back}"]
        return np.arccos(dlon / (1e-5 + np.hypot(dlat, dlon)))

    for _, row in wanted.iterrows():
        given = [a for a in (angle(row, 1), angle(row, 2)) if not np.isnan(a)]
        r = found[row.icao, row.ts_kafka]
        if not given:
            assert r.direction_rad is None and r.bearing_rad is None
        else:
            assert r.direction_rad == pytest.approx(sum(given) / len(given))
            assert r.bearing_rad == pytest.approx(np.arctan2(row.lat - row.lat1, row.lon - row.lon1))
