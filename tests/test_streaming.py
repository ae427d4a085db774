"""Streams over several triggers give what the batch operators give."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarmac.operators.decode import decode
from tarmac.operators.takeoffs import takeoffs
from tarmac.operators.windows import grid_states
from tarmac.sources.raw import read_raw_stream
from tarmac.streaming import jobs
from tests.frames import airborne, ident, short_frame, surface

MINUTE = 60_000


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Eight files in time order whose rows are shuffled inside each file and may be a little late."""
    rng = random.Random(11)
    folder = tmp_path_factory.mktemp("feed")
    rows = []
    for _ in range(900):
        ts, icao = rng.randrange(8 * 60 * MINUTE), 0x340000 + rng.choice([0, 0, 1, 2, 3])
        message = rng.choice(
            [short_frame(11, 5, icao), short_frame(11, 4, icao), surface(icao, 1), surface(icao, 20)]
            + [ident(icao, 4, 1), airborne(icao, rng.randrange(131072), 5)]
        )
        rows.append((ts, message))
    rows.sort()
    for part in range(8):
        chunk = [r for r in rows if (r[0] + rng.randrange(-2 * MINUTE, 2 * MINUTE)) // (60 * MINUTE) == part]
        rng.shuffle(chunk)
        text = "ts_kafka;message;\n" + "".join(f"{ts};{message};\n" for ts, message in chunk)
        (folder / f"part{part}.csv").write_text(text)
    batch = spark.read.option("sep", ";").option("header", True).schema("ts_kafka long, message string, junk string")
    return str(folder), batch.csv(str(folder)).drop("junk")


def stream(spark, folder):
    return read_raw_stream(spark, folder, files_per_trigger=1)


def test_takeoffs(spark, feed):
    folder, rows = feed
    found = jobs.run_to_table(jobs.takeoffs_stream(stream(spark, folder)), "takeoffs")
    names = ["icao", "last_stopped_ms", "takeoff_ms", "aircraft_type"]
    batch = takeoffs(decode(rows)).select(*names)
    limit = rows.agg(F.max("ts_kafka")).first()[0] - 15 * MINUTE
    early = F.col("takeoff_ms") <= limit
    expected = {tuple(r) for r in batch.filter(early).collect()}
    assert len(expected) > 20 and {tuple(r) for r in found.select(*names).filter(early).collect()} == expected


def test_clock_windows(spark, feed):
    folder, rows = feed
    found = jobs.run_to_table(jobs.window_states_stream(stream(spark, folder), 10 * MINUTE), "windows")
    batch = grid_states(decode(rows), 10 * MINUTE).withColumn("window_ms", F.unix_millis("window.start"))
    limit = rows.agg(F.max("ts_kafka")).first()[0] - 25 * MINUTE
    names = ["icao", "window_ms", "ts_kafka", "n_messages", "velocity", "ground", "callsign"]
    early = F.col("window_ms") <= limit
    expected = {tuple(r) for r in batch.select(*names).filter(early).collect()}
    assert len(expected) > 50 and {tuple(r) for r in found.select(*names).filter(early).collect()} == expected


def test_sliding_windows(spark, feed):
    _, rows = feed
    sliding = grid_states(decode(rows), 10 * MINUTE, 5 * MINUTE).agg(F.sum("n_messages")).first()[0]
    tumbling = grid_states(decode(rows), 10 * MINUTE).agg(F.sum("n_messages")).first()[0]
    assert sliding == 2 * tumbling


def test_repeats_and_sessions(spark, feed):
    folder, rows = feed
    kept = jobs.run_to_table(jobs.without_repeats(stream(spark, folder), "1 minute"), "kept")
    limit = rows.agg(F.max("ts_kafka")).first()[0] - 15 * MINUTE
    by_message = {}
    for ts, message in sorted((r["ts_kafka"], r["message"]) for r in rows.collect()):
        by_message.setdefault(message, []).append(ts)
    expected = set()
    for message, times in by_message.items():
        previous = None
        for ts in times:
            if previous is None or ts - previous > MINUTE:
                expected.add((message, ts))
            previous = ts
    expected = {e for e in expected if e[1] <= limit}
    found = {(r["message"], r["ts_kafka"]) for r in kept.collect() if r["ts_kafka"] <= limit}
    assert found == expected
    sessions = jobs.run_to_table(jobs.contact_sessions(stream(spark, folder), "5 minutes"), "sessions")
    assert sessions.count() > 20


def test_takeoff_step_equals_a_row_loop():
    """The carried step gives what playing the rows one by one gives, however they are cut."""
    rng = random.Random(5)
    rows = pd.DataFrame(
        [
            (t, t, rng.random() < 0.3, rng.random() < 0.3, rng.choice([None, "Light", "Heavy"]), *rng.choice([(None, None), (1.0, 2.0), (3.0, None), (5.0, 6.0)]))
            for t in range(400)
        ],
        columns=["ts_kafka", "seq", "stopped", "reply", "kind", "lat", "lon"],
    )
    known, expected = {"stop": None, "kind": None, "place": (None, None)}, []
    for r in rows.itertuples():
        known["kind"] = r.kind or known["kind"]
        known["stop"] = r.ts_kafka if r.stopped else known["stop"]
        known["place"] = (r.lat, r.lon) if pd.notna(r.lat) and pd.notna(r.lon) else known["place"]
        if r.reply and known["stop"] is not None:
            expected.append((r.seq, known["stop"], r.ts_kafka, known["kind"], *known["place"]))
            known["stop"] = None
    for size in (1, 7, 400):
        state, found = {"stop_ms": None, "kind": None, "lat": None, "lon": None}, []
        for at in range(0, 400, size):
            events = jobs._advance("a", state, rows[at : at + size].sample(frac=1, random_state=1))
            found += list(events[["seq", "last_stopped_ms", "takeoff_ms", "aircraft_type", "lat", "lon"]].itertuples(index=False, name=None))
        clean = [tuple(None if pd.isna(v) else v for v in f) for f in found]
        assert clean == expected
