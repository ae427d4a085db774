"""Per-aircraft operators against plain sequential loops on random logs."""

import random

import pytest
from pyspark.sql import functions as F

from tarmac.operators import routes, state, takeoffs, windows
from tarmac.operators.decode import decode, valid_frames
from tarmac.operators.scan import exact_quantiles
from tests.frames import airborne, ident, log, short_frame, speed, surface

SLICE = 5_000


@pytest.fixture(scope="module")
def random_log(spark):
    """Aircraft with different rates; the first holds more than a third of all rows. Times may tie."""
    rng = random.Random(7)
    rows, seq = [], 0
    for number in range(12):
        icao = 0x340000 + number
        count = 700 if number == 0 else 60 if number < 11 else 1
        span = [60_000, 60_000, 400_000, 5_000_000][number % 4]
        for ts in sorted(rng.randrange(span) for _ in range(count)):
            kind = rng.choice(["air_reply", "ground_reply", "other_reply", "surface", "ident", "speed", "airborne"])
            detail = None
            if kind.endswith("reply"):
                ca = {"air_reply": 5, "ground_reply": 4, "other_reply": 0}[kind]
                message, detail = short_frame(11, ca, icao), ca
            elif kind == "surface":
                detail = rng.choice([0, 1, 1, 1, 20, 39])
                message = surface(icao, detail)
            elif kind == "ident":
                detail = (rng.randrange(1, 5), rng.randrange(2), rng.randrange(1, 3))
                message = ident(icao, *detail)
            elif kind == "speed":
                detail = rng.choice([0, 101, 102])
                message = speed(icao, detail)
            else:
                detail = (rng.randrange(131072), rng.randrange(131072))
                message = airborne(icao, *detail)
            rows.append({"seq": seq, "ts": ts, "icao": f"{icao:06x}", "kind": kind, "detail": detail, "message": message})
            seq += 1
    frame = log(spark, [(r["seq"], r["ts"], r["message"]) for r in rows]).repartition(5).persist()
    by_aircraft = {}
    for r in sorted(rows, key=lambda r: (r["ts"], r["seq"])):
        by_aircraft.setdefault(r["icao"], []).append(r)
    return frame, by_aircraft


SPEEDS = {0: None, 1: 0.0, 20: 5.5, 39: 15.0}
CATEGORIES = {
    (1, 0): "No category information",
    (1, 1): "Reserved",
    (2, 0): "No category information",
    (2, 1): "Surface emergency vehicle",
    (3, 0): "No category information",
    (3, 1): "Glider, sailplane",
    (4, 0): "No category information",
    (4, 1): "Light (less than 7000 kg)",
}


def test_known_state(random_log):
    frame, by_aircraft = random_log
    expected = set()
    for icao, rows in by_aircraft.items():
        surf = name = velocity = place = None
        for r in rows:
            if r["kind"] == "surface":
                surf = (SPEEDS[r["detail"]],)
            elif r["kind"] == "ident":
                name = (chr(64 + r["detail"][2]), CATEGORIES[r["detail"][:2]])
            elif r["kind"] == "speed":
                velocity = (r["detail"] - 1 if r["detail"] else None,)
            elif r["kind"] == "airborne":
                place = (r["detail"],)
            else:
                continue
            expected.add((icao, r["seq"], surf, name, velocity, place is not None))
    found = set()
    for r in state.known_state(decode(frame), slice_ms=SLICE).collect():
        found.add(
            (
                r["icao"],
                r["seq"],
                None if r["latitude"] is None else (r["surface_velocity"],),
                None if r["vortex"] is None else (r["callsign"], r["vortex"]),
                None if r["ST"] is None else (r["V"],),
                r["airborne_pos_lat"] is not None,
            )
        )
    assert found == expected


def test_known_state_expires(random_log):
    frame, by_aircraft = random_log
    ttl = 3_000
    expected = set()
    for icao, rows in by_aircraft.items():
        surf = name = None
        for r in rows:
            if r["kind"] == "surface":
                surf = (r["ts"], SPEEDS[r["detail"]])
            elif r["kind"] == "ident":
                name = (r["ts"], chr(64 + r["detail"][2]))
            elif r["kind"].endswith("reply"):
                continue
            fresh = [v and r["ts"] - v[0] <= ttl and (v[1],) or None for v in (surf, name)]
            expected.add((icao, r["seq"], *fresh))
    found = {
        (
            r["icao"],
            r["seq"],
            None if r["latitude"] is None else (r["surface_velocity"],),
            None if r["vortex"] is None else (r["callsign"],),
        )
        for r in state.known_state_ttl(decode(frame), ttl).collect()
    }
    assert found == expected


def test_state_changes(random_log):
    frame, by_aircraft = random_log
    expected = set()
    for rows in by_aircraft.values():
        name = velocity = None
        for r in rows:
            if r["kind"] in ("surface", "airborne"):
                expected.add(r["seq"])
            elif r["kind"] == "ident":
                now = (r["detail"][2], CATEGORIES[r["detail"][:2]])
                if now != name:
                    expected.add(r["seq"])
                name = now
            elif r["kind"] == "speed":
                if r["detail"] != velocity:
                    expected.add(r["seq"])
                velocity = r["detail"]
    assert {r["seq"] for r in state.state_changes(decode(frame), slice_ms=SLICE).collect()} == expected


def brute_takeoffs(by_aircraft):
    events = []
    for icao, rows in by_aircraft.items():
        stopped = kind = None
        for r in rows:
            if r["kind"] == "ident" and (r["detail"][0] != 1):
                kind = CATEGORIES[r["detail"][:2]]
            if r["kind"] == "surface" and SPEEDS[r["detail"]] == 0:
                stopped = r["ts"]
            if r["kind"] == "air_reply" and stopped is not None:
                events.append((icao, r["seq"], stopped, r["ts"], kind))
                stopped = None
    return sorted(events)


def test_takeoffs(random_log):
    frame, by_aircraft = random_log
    rows = takeoffs.takeoffs(decode(frame), slice_ms=SLICE)
    found = rows.select("icao", "seq", "last_stopped_ms", "takeoff_ms", "aircraft_type").collect()
    expected = brute_takeoffs(by_aircraft)
    assert len(expected) > 50
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_repeats_within_five_minutes(spark):
    rng = random.Random(3)
    rows = [(f"{a:06x}", rng.randrange(20_000_000), i) for i, a in enumerate([0] * 60 + [1] * 5 + [2] * 30)]
    expected = set()
    for icao in {r[0] for r in rows}:
        own = sorted((t, s) for i, t, s in rows if i == icao)
        for this, following in zip(own, own[1:] + [None]):
            if following is None or following[0] - this[0] >= takeoffs.DUPLICATE_GAP_MS:
                expected.add(this[1])
    events = spark.createDataFrame(rows, "icao string, takeoff_ms long, seq long")
    assert {r["seq"] for r in takeoffs.drop_repeats(events).collect()} == expected


def brute_anchors(times, threshold):
    anchors = []
    for t in sorted(times):
        if not anchors or t - anchors[-1] >= threshold:
            anchors.append(t)
    return anchors


@pytest.mark.parametrize("fanout,levels", [(2, 1), (2, 3), (3, 2), (32, 2)])
def test_anchors_equal_the_sequential_walk(spark, fanout, levels):
    rng = random.Random(fanout * 10 + levels)
    threshold, rows, expected = 50, [], set()
    shapes = [(800, 3000), (200, 3000), (40, 3000), (10, 20000), (1, 10), (400, 400), (300, 100_000)]
    for number in range(21):
        count, span = shapes[number % len(shapes)]
        offset = rng.randrange(1_000_000)
        times = [offset + rng.randrange(span) for _ in range(count)]
        if number % 5 == 0:
            times = list(range(offset, offset + span, 7))
        rows += [(str(number), t) for t in times]
        expected |= {(str(number), a) for a in brute_anchors(times, threshold)}
    frame = spark.createDataFrame(rows, "icao string, ts_kafka long")
    found = windows.window_anchors(frame, threshold, fanout, fanout, levels).collect()
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_window_states(random_log):
    frame, by_aircraft = random_log
    threshold = 4_000
    expected = {}
    for icao, rows in by_aircraft.items():
        anchor = None
        for r in rows:
            if anchor is None or r["ts"] - anchor >= threshold:
                anchor = r["ts"]
                expected[icao, anchor] = {"n": 0, "ground": None, "velocity": None, "surf": None, "air": None, "name": None}
            now = expected[icao, anchor]
            now["n"] += 1
            now["ts"] = r["ts"]
            if r["kind"].endswith("reply") and now["ground"] != 1:
                now["ground"] = {5: 0, 4: 1, 0: None}[r["detail"]]
            elif r["kind"] == "speed":
                now["velocity"] = float(r["detail"] - 1) if r["detail"] else None
            elif r["kind"] == "surface":
                now["surf"] = (SPEEDS[r["detail"]],)
            elif r["kind"] == "airborne":
                now["air"] = True
            elif r["kind"] == "ident":
                now["name"] = chr(64 + r["detail"][2])
    for now in expected.values():
        if now["ground"] == 1 and now["surf"] is not None:
            now["velocity"] = now["surf"][0] if now["surf"][0] is not None else now["velocity"]
        now["placed"] = bool(now["air"] or (now["ground"] == 1 and now["surf"]))
    found = {
        (r["icao"], r["anchor"]): (r["n_messages"], r["ts_kafka"], r["ground"], r["velocity"], r["callsign"], r["lat"] is not None)
        for r in windows.window_states(decode(frame), threshold).collect()
    }
    wanted = {
        key: (v["n"], v["ts"], v["ground"], v["velocity"], v["name"], v["placed"]) for key, v in expected.items()
    }
    assert found == wanted


def test_window_example(spark):
    """Three-second windows: state is overwritten inside a window and reset between windows."""
    icao = 0x340001
    place = airborne(icao, 93000, 51372)
    rows = [(0, speed(icao, 11)), (1, place), (2, speed(icao, 21)), (3, speed(icao, 26)), (4, place), (5, speed(icao, 31))]
    frame = log(spark, [(t, t * 1000, m) for t, m in rows])
    found = sorted(windows.window_states(decode(frame), 3000).collect(), key=lambda r: r["ts_kafka"])
    assert [(r["ts_kafka"], r["velocity"], r["lat"] is not None) for r in found] == [(2000, 20, True), (5000, 30, True)]


STATES = "icao string, ts_kafka long, lat double, lon double, ground int, velocity double, alt_feet double, callsign string, vortex string"


def states_frame(spark, rows):
    return spark.createDataFrame(rows, STATES)


def test_direction(spark):
    rows = [("a", t, lat, lon, 0, 1.0, None, None, None) for t, lat, lon in
            [(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 1.0), (4, None, None), (5, 1.0, 0.0)]]
    found = {r["ts_kafka"]: r for r in windows.direction(states_frame(spark, rows)).collect()}
    assert found[1]["direction_rad"] is None
    assert found[2]["direction_rad"] == pytest.approx(0.0, abs=0.01) and found[2]["bearing_rad"] == pytest.approx(0.0)
    assert found[3]["direction_rad"] == pytest.approx((1.5708 + 0.7854) / 2, abs=0.01)
    assert found[4]["direction_rad"] is None and found[5]["direction_rad"] == pytest.approx(3.1416, abs=0.01)


def test_flights_and_routes(spark):
    names = ["A", "A", None, None, "B", "B", "B"]
    rows = [("x", i, 40.0 + i / 10, -3.0, 0, [100.0, 350.0, 500.0, None][i % 4], 100.0 * i, n, None) for i, n in enumerate(names)]
    points = states_frame(spark, rows)
    found = {r["flight_rank"]: (r["callsign"], r["n_points"], round(r["opacity"], 2)) for r in routes.flights(points).collect()}
    assert found == {0: ("B", 3, 1.0), 1: (None, 2, 0.55), 2: ("A", 2, 0.1)}
    assert routes.flights(points, null_breaks=True).count() == 4
    colors = [r["color"] for r in routes.segments(points).orderBy("pos").collect()]
    assert colors == ["red", "yellow"]
    heights = routes.height_profile(points).orderBy("pos").collect()
    assert [h["height"] for h in heights] == [100.0 * i for i in range(7)]
    assert [h["lat"] for h in heights] == [40.4, 40.5, 40.6, None, None, None, None]
    assert [len(r["trail"]) for r in routes.trails(points, 3).orderBy("ts_kafka").collect()] == [1, 2, 3, 3, 3, 3, 3]
    assert routes.in_time_range(points, 2, 4).count() == 3
    assert routes.in_time_range(points, 0, 10**15).count() == points.count()


def test_exact_quantiles(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.5 else rng.choice("abc"), rng.randrange(100_000)) for _ in range(4001)]
    rows += [(None, v) for v in (5, 6, 9)] + [("single", 42)]
    frame = spark.createDataFrame(rows, "g string, v long")
    wanted = frame.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.9))).alias("q"))
    expected = {r["g"]: tuple(round(x, 6) for x in r["q"]) for r in wanted.collect()}
    found = exact_quantiles(frame, "v", {"a": 0.25, "b": 0.5, "c": 0.9}, ("g",))
    assert {r["g"]: tuple(round(x, 6) for x in (r["a"], r["b"], r["c"])) for r in found.collect()} == expected


def test_busy_aircraft_is_spread(spark):
    """One aircraft's rows fall into many groups, whatever its share of the log."""
    rows = valid_frames(decode(log(spark, [(i, i * 1000, short_frame(11, 5, 1)) for i in range(2000)])))
    groups = rows.groupBy("icao", F.floor(F.col("ts_kafka") / takeoffs.SLICE_MS)).count()
    assert groups.agg(F.max("count")).first()[0] <= 600
