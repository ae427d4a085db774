"""Published frames and single fields."""

import math

import pytest
from pyspark.sql import functions as F

from tarmac.operators.decode import decode, split_rejects, valid_frames
from tarmac.operators.state import pair_positions
from tests.frames import airborne, crc, field, log, long_frame, short_frame, to_message

FRAMES = [
    "8D406B902015A678D4D220AA4BDA",
    "8D4840D6202CC371C32CE0576098",
    "8D485020994409940838175B284F",
    "8DA05F219B06B6AF189400CBC33F",
    "8D40058B58C901375147EFD09357",
    "8D40621D58C382D690C8AC2863A7",
    "8D40621D58C386435CC412692AD6",
    "8C4841753A9A153237AEF0F275BE",
    "8C4841753AAB238733C8CD4020B1",
    "8D485020994409940838175B284E",
    "5D4840D6F8740F",
    "5C4840D6D3895C",
]


def decoded(spark, frames, **kwargs):
    rows = [(i, 1000 * i, to_message(f)) for i, f in enumerate(frames)]
    return {r["seq"]: r for r in decode(log(spark, rows), **kwargs).collect()}


def test_published_frames(spark):
    rows = decoded(spark, FRAMES, ref_lat=52.258, ref_lon=3.918)
    assert [rows[i]["reject_reason"] for i in range(12)] == [None] * 9 + ["corrupted", None, None]
    assert rows[0]["icao"] == "406b90" and rows[0]["ident"]["callsign"] == "EZY85MH"
    assert rows[1]["ident"]["callsign"] == "KLM1023" and rows[1]["ident"]["category"] == 0
    ground = rows[2]["vel"]
    assert (ground["speed"], ground["vertical_rate"], ground["vr_source"], ground["speed_type"]) == (159, -832, 0, "GS")
    assert ground["heading"] == pytest.approx(182.88, abs=0.01) and rows[2]["gs"] is not None
    air = rows[3]["vel"]
    assert (air["speed"], air["vertical_rate"], air["vr_source"], air["speed_type"]) == (375, -2304, 1, "TAS")
    assert air["heading"] == pytest.approx(243.98, abs=0.01) and rows[3]["asp"] is not None and rows[3]["gs"] is None
    assert rows[5]["air"]["alt_feet"] == 38000
    assert (rows[5]["air"]["lat"], rows[5]["air"]["lon"]) == pytest.approx((52.25720, 3.91937), abs=1e-5)
    assert (rows[6]["air"]["lat"], rows[6]["air"]["lon"]) == pytest.approx((52.26578, 3.93891), abs=1e-5)
    assert [rows[i]["on_ground"] for i in (10, 11)] == [0, 1]
    assert [rows[i]["dl"] for i in (10, 11)] == [11, 11]


def test_positions_near_other_references(spark):
    row = decoded(spark, FRAMES, ref_lat=49.0, ref_lon=6.0)[4]["air"]
    assert (row["lat"], row["lon"], row["alt_feet"]) == pytest.approx((49.82410, 6.06785, 39000), abs=1e-5)
    rows = decoded(spark, FRAMES, ref_lat=51.990, ref_lon=4.375)
    first, second = rows[7]["surf"], rows[8]["surf"]
    assert (first["movement_code"], first["speed"]) == (41, 17.0)
    assert (first["lat"], first["lon"]) == pytest.approx((52.32056, 4.73574), abs=1e-5)
    assert (second["speed"], second["lat"], second["lon"]) == pytest.approx((18.0, 52.32304, 4.73047), abs=1e-5)


def test_pair_position(spark):
    # the even frame is the newer one: the published result is 52.25720, 3.91937
    rows = log(spark, [(1, 1000, to_message(FRAMES[6])), (2, 3000, to_message(FRAMES[5]))])
    found = pair_positions(decode(rows)).collect()
    assert [(r["seq"], round(r["lat"], 4), round(r["lon"], 4)) for r in found] == [(2, 52.2572, 3.9194)]
    late = log(spark, [(1, 1000, to_message(FRAMES[6])), (2, 12000, to_message(FRAMES[5]))])
    assert pair_positions(decode(late)).count() == 0


def test_rejects(spark):
    rows = [
        (1, 0, "not base64!"),
        (2, 0, None),
        (3, 0, to_message("8D40")),
        (4, 0, to_message(FRAMES[9])),
        (5, 0, to_message(FRAMES[0])),
    ]
    good, bad = split_rejects(decode(log(spark, rows)))
    assert {r["seq"]: r["reject_reason"] for r in bad.collect()} == {
        1: "malformed_base64",
        2: "malformed_base64",
        3: "bad_length",
        4: "corrupted",
    }
    assert [r["seq"] for r in good.collect()] == [5]


def test_every_single_bit_error_is_found(spark):
    frame = int(FRAMES[2], 16)
    rows = [(i, 0, to_message(f"{frame ^ (1 << i):028x}")) for i in range(112)]
    reasons = [r["reject_reason"] for r in decode(log(spark, rows)).collect()]
    assert set(reasons) == {"corrupted"}
    assert crc(frame >> 24, 88) == frame & 0xFFFFFF


def test_movement_codes(spark):
    def expected(code):
        if code == 1:
            return 0.0
        if code == 124:
            return 175.0
        steps = [(2, 0.125, 0.125), (9, 1.0, 0.25), (13, 2.0, 0.5), (39, 15.0, 1.0), (94, 70.0, 2.0), (109, 100.0, 5.0)]
        if code == 0 or code > 124:
            return None
        first, base, step = [s for s in steps if s[0] <= code][-1]
        return base + (code - first) * step

    rows = [(c, 0, long_frame(17, 4, 1, field(5, 37) | field(c, 44))) for c in range(128)]
    found = {r["seq"]: r["surf"]["speed"] for r in decode(log(spark, rows)).collect()}
    assert found == {c: expected(c) for c in range(128)}


def test_gillham_altitudes(spark):
    """All altitudes from -1200 to 50000 ft, encoded in the published Gray code."""

    def code_of(feet):
        steps = (feet + 1200) // 100
        fives, ones = divmod(steps, 5)
        ones = [1, 2, 3, 4, 7][ones] if fives % 2 == 0 else [7, 4, 3, 2, 1][ones]
        ones = {1: 1, 2: 2, 3: 3, 4: 4, 7: 5}[ones]
        gray5 = fives ^ (fives >> 1)
        number = {1: 1, 2: 2, 3: 3, 4: 4, 5: 7}[ones]
        gray1 = number ^ (number >> 1)
        d2, d4, a1, a2, a4, b1, b2, b4 = [gray5 >> i & 1 for i in range(7, -1, -1)]
        c1, c2, c4 = [gray1 >> i & 1 for i in (2, 1, 0)]
        bits = [c1, a1, c2, a2, c4, a4, b1, 0, b2, d2, b4, d4]
        return int("".join(map(str, bits)), 2)

    heights = list(range(-1200, 50001, 100))
    rows = [(i, 0, airborne(1, 0, 0, alt=code_of(h))) for i, h in enumerate(heights)]
    found = {r["seq"]: r["air"]["alt_feet"] for r in decode(log(spark, rows)).collect()}
    # code 0 means no altitude and is not used by any height
    assert [found[i] for i in range(len(heights))] == heights


def test_gnss_height_and_missing_altitude(spark):
    rows = log(spark, [(1, 0, airborne(1, 0, 0, alt=1000, tc=20)), (2, 0, airborne(1, 0, 0, alt=0))])
    found = {r["seq"]: r["air"] for r in decode(rows).collect()}
    assert found[1]["alt_feet"] == pytest.approx(3280.84) and found[1]["altitude_type"] == "airborne_gnss_alt"
    assert found[2]["alt_feet"] is None


def test_supersonic_velocity(spark):
    me = field(19, 37) | field(2, 40) | field(1, 46) | field(31, 56) | field(0, 57) | field(41, 67) | field(5, 88)
    row = decode(log(spark, [(1, 0, long_frame(18, 5, 1, me))])).collect()[0]
    assert row["vel"]["speed"] == math.floor(math.hypot(120, 160)) and row["gs"]["vew"] == 120
    assert row["vel"]["vertical_rate"] is None and row["vel"]["dalt"] == 100


def test_compat_readings(spark):
    me = field(19, 37) | field(4, 40) | field(5, 67) | field(0, 68)
    rows = log(spark, [(1, 0, long_frame(17, 5, 0x000C00, me)), (2, 0, long_frame(17, 5, 1, field(4, 37) | field(1, 40)))])
    plain = {r["seq"]: r for r in decode(rows).collect()}
    compat = {r["seq"]: r for r in decode(rows, compat=True).collect()}
    assert plain[1]["vel"]["vr_source"] == 0 and compat[1]["vel"]["vr_source"] == 1
    assert plain[2]["aircraft_type"] == "Light (less than 7000 kg)"
    assert compat[2]["aircraft_type"] == "Heavy (larger than 136000 kg)"


def test_filters(spark):
    rows = log(spark, [(1, 0, short_frame(11, 4, 1)), (2, 0, short_frame(0, 4, 1)), (3, 0, long_frame(20, 1, 1, 0))])
    assert [r["seq"] for r in valid_frames(decode(rows)).select("seq").collect()] == [1]
    assert decode(rows).filter(F.col("tc").isNotNull()).count() == 0


def test_ground_pair_position(spark):
    """An even and an odd frame on the ground, encoded from one place far from the receiver's quarter."""
    place = {"lat": 52.3236, "lon": 4.7349}

    def codes(odd):
        dlat = 90 / (60 - odd)
        yz = int(131072 * (place["lat"] % dlat) / dlat + 0.5)
        rlat = dlat * (yz / 131072 + place["lat"] // dlat)
        dlon = 90 / max(zones(rlat) - odd, 1)
        xz = int(131072 * (place["lon"] % dlon) / dlon + 0.5)
        return yz % 131072, xz % 131072

    def frame(odd):
        y, x = codes(odd)
        return long_frame(17, 4, 0x484175, field(7, 37) | field(20, 44) | field(odd, 54) | field(y, 71) | field(x, 88))

    rows = log(spark, [(1, 1000, frame(0)), (2, 2000, frame(1)), (3, 3000, frame(0))])
    found = pair_positions(decode(rows), ref_lat=51.99, ref_lon=4.375).orderBy("seq").collect()
    assert [(r["seq"], round(r["lat"], 3), round(r["lon"], 3), r["ground"]) for r in found] == [(2, 52.324, 4.735, 1), (3, 52.324, 4.735, 1)]
    assert [r["plausible"] for r in found] == [None, True]
    south = pair_positions(decode(rows), ref_lat=-37.0, ref_lon=-85.0).orderBy("seq").first()
    assert round(south["lat"], 3) == -37.676 and -130 < south["lon"] < -40  # the quarter nearest the receiver


def zones(lat):
    return int(2 * math.pi / math.acos(1 - (1 - math.cos(math.pi / 30)) / math.cos(math.radians(lat)) ** 2))


def test_pairs_of_different_zone_counts_and_kinds_give_nothing(spark):
    even, odd = FRAMES[5], FRAMES[6]
    ground = long_frame(17, 4, 0x40621D, field(7, 37) | field(20, 44) | field(1, 54) | field(93000, 71) | field(50000, 88))
    rows = log(spark, [(1, 1000, to_message(even)), (2, 2000, ground)])
    assert pair_positions(decode(rows)).count() == 0
    jump = log(spark, [(1, 1000, to_message(odd)), (2, 1400, to_message(even)), (3, 1900, airborne(0x40621D, 74158, 50194, odd=1))])
    found = pair_positions(decode(jump)).orderBy("seq").collect()
    assert found[0]["plausible"] is None and all(r["plausible"] is not None for r in found[1:])
