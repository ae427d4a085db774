"""Executed plans of the map reports: one scan, one shuffle of message rows, no window over a whole aircraft's rows."""

import re

import pytest

from tarmac.plans.queries import QUERIES
from tarmac.sources.event_frames import event_log

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "raw")
    event_log(spark, SF_DIR).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def exchanges(plan):
    """Shuffles that ran; one that is reused says so on its own line."""
    return [line for line in plan.splitlines() if re.search(r"(?<!Reused)Exchange (hash|range|single|Round)", line) and "ReusedExchange" not in line]


@pytest.mark.parametrize(
    "name,most",
    [("anchor_windows", 3), ("window_states", 4), ("direction", 6), ("latest_state", 7), ("flights", 7)]
    + [(n, 6) for n in ("current_route", "segments", "trails", "height_profile")],
)
def test_one_scan_and_few_shuffles(raw, name, most):
    plan = executed(QUERIES[name](raw))
    assert plan.count("Scan parquet") == 1
    assert len(exchanges(plan)) <= most


@pytest.mark.parametrize("name", ["direction", "flights", "segments", "trails", "height_profile"])
def test_only_a_table_of_days_is_ordered_by_aircraft(raw, name):
    df = QUERIES[name](raw)
    optimized = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    for line in optimized:
        window = re.search(r"Window \[.*\], \[(icao#\d+)\], \[(\w+)", line)
        if window:
            assert window[2].startswith(("__span", "_w")) or "__span" in line, line


def test_map_rows_are_shuffled_by_slice_once(raw):
    plan = executed(QUERIES["window_states"](raw))
    by_slice = [line for line in exchanges(plan) if re.search(r"hashpartitioning\(icao#\d+, slice#\d+L?, \d+\), REPARTITION_BY_COL", line)]
    assert len(by_slice) == 1 and plan.count("ReusedExchange") == 1
