"""The logs derived from ``events``."""

import pytest

from tarmac.sources.event_frames import event_log, fleet_log

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("log", [event_log, fleet_log])
def test_one_row_group_is_dealt_to_many_tasks(spark, log):
    rows = log(spark, SF_DIR).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(rows) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(rows) < 2 * sum(rows) / len(rows)
