"""Registered streaming queries: each runs the log through a stream into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.queries import WINDOW_MS, stable
from tarmac.session import HOUR_MS, configure, shared_dir
from tarmac.sources.event_frames import EVENTS_SCHEMA, event_log, frames
from tarmac.sources.feed import read_feed, write_feed
from tarmac.streaming import jobs, ledger


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a file source wants a folder or a pattern
    return frames(spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/event[s].parquet"))


def _with_copies(raw: DataFrame) -> DataFrame:
    """The log with every tenth message received a second time, one second later."""
    shifts = F.when(F.col("seq") % 10 == 0, F.array(F.lit(0), F.lit(1000))).otherwise(F.array(F.lit(0)))
    return raw.withColumn("shift", F.explode(shifts)).select(
        "seq", (F.col("ts_kafka") + F.col("shift")).alias("ts_kafka"), "message"
    )


STREAMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "stream_decode": lambda raw: jobs.decoded_stream(raw)[0].select("seq", "ts_kafka", "icao", "dl", "tc", "msg_type"),
    "stream_rejects": lambda raw: jobs.decoded_stream(raw)[1].select("seq", "ts_kafka", "reject_reason"),
    "stream_without_repeats": lambda raw: jobs.without_repeats(_with_copies(raw)).drop("message"),
    "stream_window_states": lambda raw: jobs.window_states_stream(raw, WINDOW_MS),
    "stream_occupancy": jobs.occupancy_stream,
    "stream_takeoffs": jobs.takeoffs_stream,
    "stream_sessions": lambda raw: jobs.contact_sessions(raw, "30 minutes"),
}


def _routed(spark: SparkSession, sf_dir: str, late: bool) -> str:
    """The log through a stream of files into the routed table, below the folder returned."""
    raw, base = event_log(configure(spark), sf_dir), shared_dir(spark)
    delayed = F.when(F.col("seq") % 23 == 0, F.lit(2 * HOUR_MS)).otherwise(F.lit(0)) if late else F.lit(0)
    write_feed(raw, F.col("ts_kafka") + delayed, f"{base}/feed")
    ledger.start_product(read_feed(spark, f"{base}/feed"), base).awaitTermination()
    return base


def stream_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoded product that a stream over eight files or more has appended, a trigger for each file."""
    rows = ledger.decoded_product(spark, _routed(spark, sf_dir, late=False))
    return stable(rows.select("seq", "ts_kafka", "dl", "icao", "ca", "on_ground", "tc", "date", "hour"))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with its fate, when one of 23 arrives two hours late."""
    rows = ledger.read_routed(spark, _routed(spark, sf_dir, late=True))
    return stable(rows.select("seq", "ts_kafka", "fate", "reason"))


def stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str, query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return stable(jobs.run_to_table(query(event_stream(configure(spark), sf_dir)), name))

        return run

    streams = {name: bind(name, query) for name, query in STREAMS.items()}
    return streams | {"stream_product": stream_product, "stream_late_rows": stream_late_rows}
