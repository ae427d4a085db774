"""Registered queries beside their SQL at a scale where none is empty; ``tests.run_oracle`` runs all."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry
from tarmac.plans.oracle import oracle_queries
from tarmac.plans.queries import batch_queries
from tarmac.plans.stream_queries import stream_queries
from tests.compare import difference, duck, duck_rows, spark_rows

SF_DIR = os.environ.get("TARMAC_SF_DIR", "/root/testdata/sf0.01")
FAMILIES = [
    "decode_messages",
    "decode_airborne",
    "rejects",
    "day_hour_dense_ground",
    "axis_max",
    "wait_stats",
    "wait_weekday_hour",
    "wait_box",
    "wait_hist",
    "top_aircraft",
    "known_state",
    "direction",
    "flights",
    "latest_state",
    "geojson",
    "null_profile",
    "stream_window_states",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", FAMILIES)
def test_query_equals_sql(spark, con, name):
    found = spark_rows(entry.queries()[name](spark, SF_DIR))
    assert found[1]
    assert difference(found, duck_rows(con, entry.oracle_sql()[name])) is None


def test_all_other_statements(spark):
    """Every statement at the smallest scale, four at a time; streams one by one, as they set the session's state store."""
    small = "/root/testdata/sf0.001"
    duckdb = duck(small)
    queries, statements = entry.queries(), entry.oracle_sql()
    names = sorted(set(statements) - set(FAMILIES))
    assert len(names) > 80

    def compare(name: str) -> str | None:
        try:
            found = spark_rows(queries[name](spark, small))
            with duckdb.cursor() as con:
                return difference(found, duck_rows(con, statements[name]))
        except Exception as error:  # the others go on
            return f"{type(error).__name__}: {str(error)[:300]}"

    streams = [n for n in names if n.startswith("stream")]
    rest = [n for n in names if n not in streams]
    with ThreadPoolExecutor(4) as pool:
        found = dict(zip(rest, pool.map(compare, rest)))
    found |= {n: compare(n) for n in streams}
    assert {n: message for n, message in found.items() if message} == {}


def test_every_query_has_sql():
    assert set(oracle_queries()) == set(batch_queries()) | set(stream_queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["takeoff_date", "takeoff_hour", "mean_s", "median_s", "n_takeoffs"]
