"""Raw message logs: ``;``-separated text, Parquet, file streams and Kafka."""

from __future__ import annotations

import re
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions import calendar
from tarmac.session import HOUR_MS, MINUTE_MS

RAW_SCHEMA = T.StructType([T.StructField("ts_kafka", T.LongType()), T.StructField("message", T.StringType())])
# each line ends in a delimiter, which reads as an empty third column
_CSV_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("_junk", T.StringType())])


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(ts_kafka, message)`` of a log with a header line."""
    return spark.read.schema(_CSV_SCHEMA).option("sep", ";").option("header", True).csv(path).drop("_junk")


_SPAN = re.compile(r"(\d{12})_(\d{12})")


def _minute_ms(text: str) -> int:
    return int(datetime.strptime(text, "%Y%m%d%H%M").replace(tzinfo=timezone.utc).timestamp() * 1000)


def files_in_range(spark: SparkSession, folder: str, start_ms: int, end_ms: int) -> list[str]:
    """Files or folders below ``folder`` named by a span ``<first minute>_<last minute>`` that meets the range, both ends included.

    Entries without a span in their name may hold anything and always belong; hidden ones never do.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = []
    for entry in top.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(top):
        name, span = entry.getPath().getName(), _SPAN.search(entry.getPath().getName())
        meets = span is None or (_minute_ms(span[1]) <= end_ms and _minute_ms(span[2]) + MINUTE_MS > start_ms)
        if meets and name[0] not in "._":
            found.append(entry.getPath().toString())
    return sorted(found)


def read_raw_range(spark: SparkSession, folder: str, start_ms: int, end_ms: int) -> DataFrame:
    """``(ts_kafka, message, line)`` of the messages of a time range, both ends included, reading only files that meet it.

    ``line`` is the text of a line that could not be read as a whole, else null. Lines without a readable
    time are kept, whatever the range, for the quarantine.
    """
    files = files_in_range(spark, folder, start_ms, end_ms)
    schema = T.StructType([*_CSV_SCHEMA.fields, T.StructField("line", T.StringType())])
    if not files:
        return spark.createDataFrame([], schema).drop("_junk")
    reader = spark.read.schema(schema).option("sep", ";").option("header", True).option("columnNameOfCorruptRecord", "line")
    rows = reader.csv(files)
    # a line without its last delimiter is whole, though it has a column less than the others
    whole = F.col("ts_kafka").isNotNull() & F.col("message").isNotNull()
    rows = rows.select("ts_kafka", "message", F.when(~whole, F.col("line")).alias("line"))
    return rows.filter(F.col("ts_kafka").between(start_ms, end_ms) | F.col("ts_kafka").isNull())


def write_raw_spans(raw: DataFrame, folder: str, span_ms: int = 24 * HOUR_MS) -> None:
    """Writes a raw log as text, in a folder for each span of time with messages, named as ``files_in_range`` wants it."""
    first = F.floor(F.col("ts_kafka") / F.lit(span_ms)) * F.lit(span_ms)
    minute = lambda ms: F.date_format(F.timestamp_millis(ms), "yyyyMMddHHmm")
    span = F.concat(minute(first), F.lit("_"), minute(first + F.lit(span_ms - MINUTE_MS)))
    lines = raw.select("ts_kafka", "message", F.lit("").alias("_junk"), span.alias("span"))
    lines.repartition("span").write.partitionBy("span").option("sep", ";").option("header", True).option("emptyValue", "").csv(folder)


def read_raw_parquet(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def on_days(raw: DataFrame, *days: str) -> DataFrame:
    """Messages of some ``dd/MM/yyyy`` days, as ranges of the capture time that a scan can skip by."""
    ranges = [F.col("ts_kafka").between(*calendar.day_bounds_ms(day)) for day in days]
    return raw.filter(reduce(or_, ranges))


def read_raw_stream(
    spark: SparkSession,
    path: str,
    file_format: str = "csv",
    schema: T.StructType | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same log as a file stream."""
    reader = spark.readStream.format(file_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if file_format == "csv":
        reader = reader.option("sep", ";").option("header", True)
        return reader.schema(schema or _CSV_SCHEMA).load(path).drop("_junk")
    return reader.schema(schema or RAW_SCHEMA).load(path)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages from a broker; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return (
        reader.options(**options)
        .load()
        .selectExpr("unix_millis(timestamp) as ts_kafka", "base64(value) as message")
    )
