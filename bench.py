"""Times the headline queries and prints one JSON line.

The message log is derived from the ``events`` table and written once as a raw
log of several files, as a receiver would leave it; ``encode_sec`` reports that
step apart. One untimed query warms the JVM up. Every query then runs from raw
messages, with nothing cached from the one before.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tarmac.plans.queries import QUERIES, stable
from tarmac.session import local_session
from tarmac.sources.event_frames import event_log

HEADLINE = [
    "decode_messages",
    "decode_airborne",
    "decode_velocity",
    "occupancy",
    "day_hour_dense_ground",
    "takeoffs",
    "waits_clean",
    "wait_stats",
    "wait_box",
    "takeoffs_weekday_hour",
    "known_state",
    "anchor_windows",
    "window_states",
    "direction",
    "flights",
    "latest_state",
    "null_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, "tarmac-bench")
    raw_path = tempfile.mkdtemp(prefix="tarmac-bench-") + "/raw"

    start = time.perf_counter()
    event_log(spark, sf_dir).repartition(cores).write.parquet(raw_path)
    encode_sec = time.perf_counter() - start
    messages = spark.read.parquet(raw_path).count()

    def seconds(name: str) -> float:
        spark.catalog.clearCache()
        start = time.perf_counter()
        stable(QUERIES[name](spark.read.parquet(raw_path))).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds("takeoffs")
    times = {name: seconds(name) for name in HEADLINE}
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time from raw messages",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "messages": messages,
                "messages_per_sec": {name: round(messages / max(sec, 1e-3)) for name, sec in times.items()},
                "encode_sec": round(encode_sec, 3),
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
