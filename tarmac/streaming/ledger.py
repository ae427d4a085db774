"""Streams into product tables, each trigger exactly once, with late rows kept.

Every trigger writes its rows into a folder of its own, named by the trigger's number: one that
runs again after a failure replaces what it wrote before. A ledger next to them holds the
largest message time up to each trigger, so that what is late never depends on when a trigger
ran or how often. A message is

* ``reject`` if its frame or time is bad (``reject_reason``),
* ``late`` if its time is not after the watermark, the largest time of earlier triggers less the delay,
* ``on_time`` otherwise;

the three are partitions of one table, written in one pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.operators.decode import decode
from tarmac.session import MINUTE_MS
from tarmac.sources.products import DECODED_SCHEMA

DELAY_MS = 10 * MINUTE_MS
ON_TIME, LATE, REJECT = "on_time", "late", "reject"

_ROUTED = f"seq bigint, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in DECODED_SCHEMA if f.name != 'date')}, reason string"


def _paths(base: str) -> tuple[str, str]:
    return f"{base}/routed", f"{base}/ledger"


def watermark(spark: SparkSession, base: str, batch_id: int, delay_ms: int) -> int | None:
    """The watermark that a trigger works by; null before any message. One row of each earlier trigger is read."""
    ledger = _paths(base)[1]
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    seen = spark.read.schema("batch bigint, max_ms bigint").parquet(ledger).filter(F.col("batch") < batch_id)
    most = seen.agg(F.max("max_ms")).first()[0]
    return None if most is None else most - delay_ms


def route_batch(base: str, delay_ms: int = DELAY_MS) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` does with a trigger's raw messages."""

    def route(raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        mark = watermark(spark, base, batch_id, delay_ms)
        routed, ledger = _paths(base)
        behind = F.lit(False) if mark is None else F.coalesce(F.col("ts_kafka") <= mark, F.lit(False))
        # a trigger is often one file and so one task: its messages are dealt out before they are decoded
        dealt = raw.repartition(spark.sparkContext.defaultParallelism, "ts_kafka", "message")
        rows = decode(dealt).withColumn("behind", behind)
        fate = F.when(F.col("reject_reason").isNotNull(), REJECT).when(F.col("behind"), LATE).otherwise(ON_TIME)
        reason = F.coalesce("reject_reason", F.when(F.col("behind"), F.lit("behind_watermark")))
        own = f"{routed}/batch={batch_id}"
        out = rows.select("seq", *DECODED_SCHEMA.fieldNames(), reason.alias("reason"), fate.alias("fate"))
        out.write.mode("overwrite").partitionBy("fate", "date").parquet(own)
        back = spark.read.schema(f"{_ROUTED}, fate string").parquet(own)
        newest = back.filter(F.col("fate") != REJECT).agg(F.max("ts_kafka").alias("max_ms"))
        newest.write.mode("overwrite").parquet(f"{ledger}/batch={batch_id}")

    return route


def start_product(
    raw: DataFrame, base: str, delay_ms: int = DELAY_MS, available_now: bool = True
) -> StreamingQuery:
    """Starts a stream of raw messages into the routed table below ``base``; its checkpoint lies there too."""
    writer = raw.writeStream.foreachBatch(route_batch(base, delay_ms)).option("checkpointLocation", f"{base}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_routed(spark: SparkSession, base: str, fate: str | None = None) -> DataFrame:
    """Rows of the routed table, of one fate or all, from triggers that the ledger holds.

    A trigger that was stopped half-way is not in the ledger; its rows come when it runs again.
    """
    routed, ledger = _paths(base)
    done = spark.read.schema("batch bigint").parquet(ledger).select("batch").distinct()
    rows = spark.read.schema(f"{_ROUTED}, batch bigint, fate string, date date").option("basePath", routed).parquet(routed)
    rows = rows if fate is None else rows.filter(F.col("fate") == fate)
    return rows.join(done, "batch", "left_semi")


def decoded_product(spark: SparkSession, base: str) -> DataFrame:
    """The decoded product that on-time messages make up."""
    return read_routed(spark, base, ON_TIME).select("seq", *DECODED_SCHEMA.fieldNames())
