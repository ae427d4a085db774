"""Streams into products: restarts, replays and late rows; the take-off stream however its input is cut."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tarmac.operators.decode import decode
from tarmac.operators.takeoffs import takeoffs
from tarmac.sources.feed import read_feed, write_feed
from tarmac.sources.raw import read_raw_stream
from tarmac.streaming import jobs, ledger
from tests.frames import ident, log, short_frame, surface

MINUTE = 60_000
RAW = "seq long, ts_kafka long, message string"


def messages(rng, n, span_ms, first=0):
    """(seq, ts, message) with stops, replies and names of four aircraft, and some broken ones."""
    rows = []
    for i in range(n):
        icao = 0x340000 + rng.choice([0, 0, 1, 2, 3])
        message = rng.choice([short_frame(11, 5, icao), short_frame(11, 4, icao), surface(icao, 1), surface(icao, 20), ident(icao, 4, 1)])
        rows.append((first + i, first * 1000 + rng.randrange(span_ms), "broken" if rng.random() < 0.05 else message))
    return rows


@pytest.fixture()
def feed(spark, tmp_path):
    rows = messages(random.Random(5), 600, 8 * 60 * MINUTE)
    raw = log(spark, rows)
    late = F.when(F.col("seq") % 17 == 0, F.lit(90 * MINUTE)).otherwise(F.lit(0))
    assert write_feed(raw, F.col("ts_kafka") + late, str(tmp_path / "feed")) == 8
    return rows, str(tmp_path / "feed"), str(tmp_path / "out")


def fates(rows):
    """Watermarks slot by slot in plain Python."""
    arrivals = [(t + (90 * MINUTE if seq % 17 == 0 else 0), seq, t, m) for seq, t, m in rows]
    low, high = min(a[0] for a in arrivals), max(a[0] for a in arrivals)
    slots = {}
    for at, seq, t, m in arrivals:
        slots.setdefault((at - low) * 8 // (high - low + 1), []).append((seq, t, m))
    out, most = {}, None
    for slot in sorted(slots):
        mark = None if most is None else most - ledger.DELAY_MS
        for seq, t, m in slots[slot]:
            out[seq] = "reject" if m == "broken" else "late" if mark is not None and t <= mark else "on_time"
        most = max([t for _, t, m in slots[slot] if m != "broken"] + ([] if most is None else [most]))
    return out


def test_every_message_has_one_fate(spark, feed):
    rows, path, base = feed
    ledger.start_product(read_feed(spark, path), base).awaitTermination()
    found = {r.seq: (r.fate, r.reason) for r in ledger.read_routed(spark, base).collect()}
    expected = fates(rows)
    assert {s: f for s, (f, _) in found.items()} == expected
    assert ledger.read_routed(spark, base).count() == len(rows) and set(expected.values()) == {"on_time", "late", "reject"}
    reasons = {"on_time": {None}, "late": {"behind_watermark"}, "reject": {"malformed_base64", "bad_length"}}
    assert all(reason in reasons[fate] for fate, reason in found.values())
    product = ledger.decoded_product(spark, base)
    assert {r.seq for r in product.collect()} == {s for s, f in expected.items() if f == "on_time"}
    plan = ledger.read_routed(spark, base, "late")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fate" in plan


def test_a_stream_that_dies_and_replays_appends_once(spark, feed, tmp_path):
    rows, path, base = feed
    route = ledger.route_batch(base)
    calls = []

    def dies(raw, batch_id):
        calls.append(batch_id)
        if len(calls) == 4:  # after its rows are written, before the ledger knows
            route(raw, batch_id)
            shutil.rmtree(f"{base}/ledger/batch={batch_id}")
            raise RuntimeError("killed")
        route(raw, batch_id)

    writer = read_feed(spark, path).writeStream.foreachBatch(dies).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
    with pytest.raises(Exception, match="killed"):
        writer.start().awaitTermination()
    assert ledger.read_routed(spark, base).select("batch").distinct().count() == 3  # the half-done trigger is not seen
    ledger.start_product(read_feed(spark, path), base).awaitTermination()
    found = {r.seq: r.fate for r in ledger.read_routed(spark, base).collect()}
    assert found == fates(rows) and ledger.read_routed(spark, base).count() == len(rows)
    # a finished trigger that runs once more replaces what it wrote
    again = spark.read.parquet(f"{path}/slot=2").select("seq", "ts_kafka", "message")
    route(again, 2)
    assert ledger.read_routed(spark, base).count() == len(rows)
    assert {r.seq: r.fate for r in ledger.read_routed(spark, base).collect()} == fates(rows)


def write_files(folder, chunks):
    folder.mkdir()
    for i, rows in enumerate(chunks):
        file = folder / f"part{i:02d}.csv"
        file.write_text("ts_kafka;message;\n" + "".join(f"{t};{m};\n" for _, t, m in rows))
        os.utime(file, (1_700_000_000 + 10 * i,) * 2)  # a file stream reads by file time
    return str(folder)


NAMES = ["icao", "last_stopped_ms", "takeoff_ms", "aircraft_type"]


def found_takeoffs(spark, folder, name, limit, **options):
    stream = read_raw_stream(spark, folder, files_per_trigger=1)
    rows = jobs.run_to_table(jobs.takeoffs_stream(stream, **options), name)
    return sorted((tuple(r) for r in rows.select(*NAMES).filter(F.col("takeoff_ms") <= limit).collect()), key=str)


def test_takeoffs_do_not_depend_on_triggers(spark, tmp_path):
    rows = sorted(messages(random.Random(8), 700, 6 * 60 * MINUTE), key=lambda r: r[1])
    limit = rows[-1][1] - 15 * MINUTE
    batch = takeoffs(decode(spark.createDataFrame([r[1:] for r in rows], "ts_kafka long, message string")))
    expected = sorted((tuple(r) for r in batch.select(*NAMES).filter(F.col("takeoff_ms") <= limit).collect()), key=str)
    assert len(expected) > 30
    many = [rows[i : i + 60] for i in range(0, len(rows), 60)]
    closing = [[(0, rows[-1][1] + 60 * MINUTE, surface(9, 20))], [(0, rows[-1][1] + 120 * MINUTE, surface(9, 20))]]
    late = [(0, rows[0][1] + 1, surface(0x340000, 1)), (0, rows[0][1] + 2, short_frame(11, 5, 0x340000))]
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    assert found_takeoffs(spark, write_files(tmp_path / "many", many), "many", limit) == expected
    assert found_takeoffs(spark, write_files(tmp_path / "huge", [shuffled, *closing]), "huge", limit) == expected
    behind = [*many[:6], [*many[6], *late], *many[7:]]
    assert found_takeoffs(spark, write_files(tmp_path / "late", behind), "late", limit) == expected
    # the closing messages bring what a bounded log holds back
    whole = sorted((tuple(r) for r in batch.select(*NAMES).collect()), key=str)
    assert found_takeoffs(spark, str(tmp_path / "huge"), "closed", 10**15) == whole


def test_a_stream_goes_on_from_a_batch(spark, tmp_path):
    rows = sorted(messages(random.Random(9), 500, 6 * 60 * MINUTE), key=lambda r: r[1])
    cut = 250
    while rows[cut][1] == rows[cut - 1][1]:
        cut += 1
    limit = rows[-1][1] - 15 * MINUTE
    frame = lambda part: spark.createDataFrame([r[1:] for r in part], "ts_kafka long, message string")
    batch = takeoffs(decode(frame(rows))).select(*NAMES).filter((F.col("takeoff_ms") <= limit) & (F.col("takeoff_ms") >= rows[cut][1]))
    expected = sorted((tuple(r) for r in batch.collect()), key=str)
    known = jobs.takeoff_state(frame(rows[:cut]))
    rest = rows[cut:]
    folder = write_files(tmp_path / "rest", [rest[i : i + 80] for i in range(0, len(rest), 80)])
    assert found_takeoffs(spark, folder, "rest", limit, initial=known) == expected and expected


def test_a_trigger_of_one_file_is_dealt_to_many_tasks(spark, feed):
    rows, path, base = feed
    ledger.start_product(read_feed(spark, path), base).awaitTermination()
    for trigger in range(4):  # the last ones have few messages
        assert sum(name.startswith("part-") for name in os.listdir(f"{path}/slot={trigger}")) == 1
        tasks = {name.split("-")[1] for _, _, names in os.walk(f"{base}/routed/batch={trigger}") for name in names if name.startswith("part-")}
        assert len(tasks) > 1
