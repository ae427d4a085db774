"""The passes over a slice see it batch by batch."""

import numpy as np
import pytest

from tarmac.operators import windows
from tarmac.operators.decode import decode
from tests.frames import log, short_frame, speed

THRESHOLD = 1_000


@pytest.mark.parametrize("span", [3_000, 40_000, 900_000])
def test_transfer_of_batches(span):
    rng = np.random.default_rng(span)
    times = np.unique(rng.integers(0, span, 2_000))
    entries, exits = windows._slice_transfer([times], 0, THRESHOLD)
    for entry, ready in zip(entries, exits):
        while (spot := np.searchsorted(times, entry)) < len(times):
            entry = times[spot] + THRESHOLD
        assert entry == ready
    for size in (1, 7, 500):
        cut = windows._slice_transfer(np.split(times, range(size, len(times), size)), 0, THRESHOLD)
        assert all(np.array_equal(a, b) for a, b in zip(cut, (entries, exits)))


def test_order_is_checked():
    assert list(windows._in_order(np.array([1, 1, 2]), 1)) == [1, 1, 2]
    for times, after in (([2, 1], None), ([1, 2], 2)):
        with pytest.raises(ValueError, match="order of time"):
            windows._in_order(np.array(times), after)


def test_states_do_not_depend_on_batches(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(t), short_frame(11, 4 + i % 2, 0x340000) if i % 3 else speed(0x340000, 1 + i % 200)) for i, t in enumerate(rng.integers(0, 60_000, 900))]
    frame = decode(log(spark, rows))

    def found():
        return sorted(windows.window_states(frame, THRESHOLD).collect(), key=str), sorted(windows.window_anchors(frame, THRESHOLD).collect())

    whole = found()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert found() == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sum(r["n_messages"] for r in whole[0]) == 900
