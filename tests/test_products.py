"""Sources, sinks, reference tables and presentation helpers."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tarmac.functions import calendar, geo
from tarmac.functions.fixed_values import RUNWAYS
from tarmac.operators import features, occupancy, profile, state, waits
from tarmac.operators.decode import decode, split_rejects, valid_frames
from tarmac.operators.takeoffs import takeoffs
from tarmac.operators.windows import window_states
from tarmac.plans import sql_surface
from tarmac.plans.queries import QUERIES
from tarmac.sources import dims, products, raw
from tests.frames import ident, log, short_frame, surface, to_message


def raw_file(folder):
    folder.mkdir()
    lines = ["ts_kafka;message;"]
    lines += [f"{1733000000000 + i};{short_frame(11, 4 + i % 2, 0x340000 + i % 3)};" for i in range(10)]
    (folder / "log.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_raw_text_log(spark, tmp_path):
    path = raw_file(tmp_path / "raw")
    rows = raw.read_raw_csv(spark, path)
    assert rows.columns == ["ts_kafka", "message"] and rows.count() == 10
    first, second = decode(rows), decode(rows.repartition(3))
    # the tie-break of a log without ingest numbers does not depend on how it is read
    assert {(r["ts_kafka"], r["seq"]) for r in first.collect()} == {(r["ts_kafka"], r["seq"]) for r in second.collect()}
    assert valid_frames(first).count() == 10


def test_products_append_and_prune(spark, tmp_path):
    base = str(tmp_path)
    decoded = decode(log(spark, [(1, 1733000000000, short_frame(11, 4, 1)), (2, 1733100000000, ident(2, 4, 7))]))
    flat = products.decoded_columns(decoded)
    products.write_product(flat, "decoded", base)
    products.write_product(flat, "decoded", base, mode="append")
    back = products.read_decoded(spark, f"{base}/decoded")
    assert back.count() == 4
    one_day = products.read_product(spark, "decoded", base).filter(F.col("date") == "2024-11-30")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and one_day.count() == 2
    products.write_product(flat, "decoded_csv", base, file_format="csv", single_file=True)
    text = products.read_decoded(spark, f"{base}/decoded_csv", "csv")
    assert sorted(map(str, text.collect())) == sorted(map(str, flat.select(text.columns).collect()))
    assert [r["tc"] for r in products.by_time(back).collect()] == [None, None, 4, 4]
    assert products.preview(back, 2).count() == 2


def test_product_files_are_sorted_and_few(spark, tmp_path):
    rows = [(i, 1733000000000 + i * 7_000_000, ident(i % 13, 4, 7)) for i in range(200)]
    flat = products.decoded_columns(decode(log(spark, rows).repartition(16)))
    products.write_product(flat, "decoded", str(tmp_path), sort_by="icao")
    files = list((tmp_path / "decoded").glob("date=*/*.parquet"))
    dates = {f.parent.name for f in files}
    assert len(dates) == flat.select("date").distinct().count() and len(files) <= 2 * len(dates)
    for file in files:
        icao = pq.read_table(file, partitioning=None)["icao"].to_pylist()
        assert icao == sorted(icao)


def test_products_derive_their_partition(spark, tmp_path):
    states = spark.createDataFrame([("a", 1733011200000, 1.0), ("b", 1733100000000, 2.0)], "icao string, ts_kafka long, lat double")
    facts = spark.createDataFrame([("01/12/2024", 3, "a", 1), ("02/12/2024", 4, "a", 1)], "day string, hour int, icao string, on_ground int")
    known = states.withColumnRenamed("ts_kafka", "timestamp")
    for name, df in {"window_states": states, "occupancy": facts, "known_state": known}.items():
        products.write_product(df, name, str(tmp_path))
        back = products.read_product(spark, name, str(tmp_path))
        later = back.filter(F.col("date") >= "2024-12-02")
        assert "PartitionFilters: [isnotnull(date" in later._jdf.queryExecution().executedPlan().toString()
        assert later.count() == 1 and back.count() == 2 and dict(back.dtypes)["date"] == "date"
    with pytest.raises(ValueError, match="takeoff_date"):
        products.write_product(states, "takeoffs", str(tmp_path))
    with pytest.raises(ValueError, match="unknown"):
        products.write_product(states, "nothing", str(tmp_path))


def test_bad_times_are_rejected(spark, tmp_path):
    """A line with an unreadable time is quarantined and costs no other row."""
    folder = tmp_path / "raw"
    folder.mkdir()
    good = [(1733000000000 + i * 1000, m) for i, m in enumerate([surface(1, 1), ident(1, 4, 7), short_frame(11, 5, 1)] * 4)]
    lines = [f"{ts};{message};" for ts, message in good]
    bad = [f"abc;{surface(1, 1)};", f";{short_frame(11, 5, 1)};"]
    (folder / "a.csv").write_text("\n".join(["ts_kafka;message;", *lines[:5], *bad, *lines[5:]]) + "\n")
    (folder / "only_good.txt").write_text("\n".join(["ts_kafka;message;", *lines]) + "\n")
    mixed, clean = (decode(raw.read_raw_csv(spark, str(folder / f))) for f in ("a.csv", "only_good.txt"))
    rejects = split_rejects(mixed)[1].collect()
    assert [r["reject_reason"] for r in rejects] == ["bad_time"] * 2
    rows = lambda df: sorted(map(str, df.collect()))
    for operator in (state.known_state, state.known_state_ttl, takeoffs, window_states, occupancy.occupancy, state.state_changes):
        found = rows(operator(mixed))
        assert found and found == rows(operator(clean)), operator


def test_reference_tables(spark):
    assert dims.categories(spark).count() == 32
    assert [r["runway"] for r in dims.runways(spark).collect()] == [name for name, _ in RUNWAYS]
    assert (dims.radars(spark).count(), dims.landing_strips(spark).count(), dims.weekdays(spark).count()) == (1, 4, 7)
    rows = decode(log(spark, [(1, 0, ident(1, 4, 7)), (2, 0, ident(1, 3, 1)), (3, 0, short_frame(11, 4, 1))]))
    named = dims.with_category_label(rows.select("seq", "tc", "ident.category", "aircraft_type"))
    assert {r["seq"]: r["label"] for r in named.collect()} == {1: "Rotorcraft", 2: "Glider, sailplane", 3: None}
    assert named.filter(~F.col("label").eqNullSafe(F.col("aircraft_type"))).count() == 0


def test_runway_borders_are_outside(spark):
    points = [(-3.5757, 40.51), (-3.582, 40.51), (-3.5695, 40.492383), (-3.5, 40.5), (-3.5442, 40.4816), (None, 40.5)]
    rows = spark.createDataFrame(points, "lon double, lat double")
    found = [r[0] for r in rows.select(geo.runway_at("lon", "lat")).collect()]
    assert found == ["18R/36L", None, None, None, "14L/32R", None]


def test_significant_digits(spark):
    rows = spark.createDataFrame([(40.123456789,), (-3.5,), (0.0,), (1234567.0,), (None,)], "v double")
    found = [r[0] for r in rows.select(geo.significant("v", 5)).collect()]
    assert found == [40.123, -3.5, 0.0, 1234600.0, None]


def test_calendar(spark):
    rows = spark.createDataFrame([(1733011200000,)], "ms long").select(
        calendar.day_text(F.col("ms")).alias("day"),
        calendar.minute_text(F.col("ms")),
        calendar.weekday_name(calendar.weekday_number(F.to_date(calendar.at(F.col("ms")))), "es"),
        calendar.parse_day(calendar.day_text(F.col("ms"))).cast("string"),
    )
    assert tuple(rows.first()) == ("01/12/2024", "01/12/2024 00:00", "Domingo", "2024-12-01")


def test_wide_forms(spark):
    facts = spark.createDataFrame(
        [("01/12/2024", 3, "a", 1), ("01/12/2024", 3, "b", 0), ("02/12/2024", 23, "a", 0)],
        "day string, hour int, icao string, on_ground int",
    )
    wide = occupancy.wide_hours(occupancy.day_hour_matrix(facts), "day").orderBy("day").collect()
    assert [len(r) for r in wide] == [25, 25] and (wide[0]["3"], wide[0]["4"], wide[1]["23"]) == (2, 0, 1)
    dense = occupancy.day_hour_dense(facts, 1)
    assert dense.count() == 48 and dense.agg(F.sum("n")).first()[0] == 1
    long = spark.createDataFrame([(0, "x", 1.0), (6, "y", 2.0)], "weekday_no int, runway string, v double")
    assert [r["weekday"] for r in waits.weekday_label(long).collect()] == ["Monday", "Sunday"]
    pivot = waits.pivoted(long, "weekday_no", "runway", "v", ["x", "y"]).orderBy("weekday_no").collect()
    assert [tuple(r) for r in pivot] == [(0, 1.0, None), (6, None, 2.0)]


def test_histogram_of_one_value(spark):
    rows = profile.histogram(spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double"), "v").orderBy("bin").collect()
    assert [r["n"] for r in rows] == [0, 0, 0, 0, 0, 2, 0, 0, 0, 0]


def test_features_are_geojson(spark):
    rows = [("a", 1733011200000, 40.5, -3.5, 1, 10.0, 0.5, "X")]
    points = spark.createDataFrame(
        rows, "icao string, ts_kafka long, lat double, lon double, ground int, velocity double, direction_rad double, callsign string"
    )
    found = {r["kind"]: json.loads(r["feature"]) for r in features.to_geojson(points).collect()}
    assert found["marker"]["geometry"] == {"type": "MultiPoint", "coordinates": [[-3.5, 40.5]]}
    assert found["trail"]["geometry"]["type"] == "LineString"
    assert found["marker"]["properties"]["times"] == ["2024-12-01 00:00:00"]
    assert features.to_geojson(points, "trail").count() == 1


def test_message_helper_is_base64():
    assert to_message("8D40") == "jUA="


def test_sql_surface(spark):
    rows = [(1, 1733011200000, surface(0xABCDEF, 1)), (2, 1733011260000, short_frame(11, 5, 0xABCDEF)), (3, 1733011270000, "????")]
    sql_surface.register(spark, log(spark, rows))
    found = spark.sql("SELECT downlink_format(message) AS df, message_icao(message) AS icao, day_text(ts_kafka) AS day, message_hour(ts_kafka) AS h FROM messages ORDER BY seq")
    assert [tuple(r) for r in found.collect()] == [(17, "abcdef", "01/12/2024", 0), (11, "abcdef", "01/12/2024", 0), (None, None, "01/12/2024", 0)]
    assert spark.sql("SELECT icao, wait_s FROM takeoffs").collect() == [("abcdef", 60.0)]
    assert spark.sql("SELECT reject_reason FROM rejects").first()[0] == "malformed_base64"


def test_days_reach_the_scan(spark, tmp_path):
    rows = [(i, 1704067200000 + i * 3_600_000, short_frame(11, 4 + i % 2, i % 5)) for i in range(24 * 6)]
    path = str(tmp_path / "raw")
    log(spark, rows).write.parquet(path)
    for name in ("hour_ground_counts", "hourly_dense", "axis_max"):
        plan = QUERIES[name](spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(ts_kafka" in plan, name
    for name in ("map_points", "map_points_day"):
        plan = QUERIES[name](spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        assert "LessThanOrEqual(ts_kafka" in plan, name
    for name in ("aircraft_series", "aircraft_lookup"):
        plan = QUERIES[name](spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("= 340005") >= plan.count("Relation [") > 0, name  # a filter over each scan


def test_range_scan_reads_only_files_in_range(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    hour = 3_600_000
    start = 1733011200000  # 2024-12-01 00:00
    frames = [(start + i * hour, short_frame(11, 5, i)) for i in range(72)]
    for day in range(3):
        lines = [f"{t};{m};" for t, m in frames[24 * day : 24 * day + 24]]
        extra = ["what is this;;;;", "not a line"] if day == 1 else []
        (folder / f"2024120{day + 1}0000_2024120{day + 1}2359.csv").write_text("\n".join(["ts_kafka;message;", *lines, *extra]) + "\n")
    (folder / "extra.csv").write_text(f"ts_kafka;message;\n{start + 30 * hour + 1};{short_frame(11, 4, 99)};\n")
    low, high = start + 26 * hour, start + 40 * hour
    files = raw.files_in_range(spark, str(folder), low, high)
    assert [f.rsplit("/", 1)[1] for f in files] == ["202412020000_202412022359.csv", "extra.csv"]
    assert len(raw.files_in_range(spark, str(folder), start + 48 * hour - 1, start + 48 * hour)) == 3
    rows = raw.read_raw_range(spark, str(folder), low, high)
    good = rows.filter("line IS NULL").collect()
    assert sorted(r.ts_kafka for r in good) == sorted([t for t, _ in frames if low <= t <= high] + [start + 30 * hour + 1])
    assert sorted(r.line for r in rows.filter("line IS NOT NULL").collect()) == ["not a line", "what is this;;;;"]
    assert split_rejects(decode(rows))[1].count() == 2
    (tmp_path / "nothing").mkdir()
    assert raw.read_raw_range(spark, str(tmp_path / "nothing"), low, high).count() == 0


def test_spans_written_are_read_by_range(spark, tmp_path):
    rows = [(i, 1733011200000 + i * 3_600_000, short_frame(11, 4, i)) for i in range(60)]
    path = str(tmp_path / "spans")
    raw.write_raw_spans(log(spark, rows), path)
    low, high = rows[25][1], rows[30][1]
    assert len(raw.files_in_range(spark, path, low, high)) == 1
    assert sorted(tuple(r) for r in raw.read_raw_range(spark, path, low, high).select("ts_kafka", "message").collect()) == sorted(r[1:] for r in rows[25:31])


def test_sketches_merge_within_their_bound(spark):
    facts = spark.range(200_000).selectExpr("concat('0', 1 + id % 2, '/12/2024') AS day", "cast(id % 24 AS int) AS hour", "hex(id % 37717) AS icao", "cast(id % 3 = 0 AS int) AS on_ground")
    sketches = occupancy.occupancy_sketches(facts)
    assert sketches.count() == 24  # the number of an hour settles day and state here
    for by in (("day",), ("on_ground",), ("day", "hour")):
        rows = occupancy.sketched_beside_exact(facts, sketches, *by).collect()
        assert rows and all(r.in_bound for r in rows)
        assert any(r.n_exact > 1000 for r in rows)


def test_table_functions_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    hour = 3_600_000
    rows = [(i, 1733011200000 + i * hour, m) for i, m in enumerate([surface(1, 1), short_frame(11, 5, 1), ident(1, 4, 7), surface(1, 1), short_frame(11, 5, 1), surface(2, 1)])]
    log(spark, rows).write.parquet(path)
    sql_surface.register(spark, spark.read.parquet(path))
    asked = spark.sql(f"SELECT * FROM takeoffs_between({rows[2][1]}, {rows[5][1]})")
    assert [tuple(r) for r in asked.collect()] == [("000001", rows[3][1], rows[4][1], 3600.0)]
    assert f"GreaterThanOrEqual(ts_kafka,{rows[2][1]})" in asked._jdf.queryExecution().executedPlan().toString()
    state_of = spark.sql(f"SELECT seq, callsign FROM known_state_of('000001', {rows[0][1]}, {rows[4][1]}) ORDER BY seq").collect()
    assert [r.seq for r in state_of] == [0, 2, 3] and state_of[0].callsign is None
    assert spark.sql(f"SELECT count(*) FROM messages_between({rows[1][1]}, {rows[2][1]})").first()[0] == 2
