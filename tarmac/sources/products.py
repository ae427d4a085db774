"""Result tables: write once, append per run, read with partition pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Product tables: the column they are partitioned by, and how to derive it where the table lacks it.
PRODUCTS: dict[str, tuple[str, str | None]] = {
    "decoded": ("date", None),
    "known_state": ("date", "to_date(timestamp_millis(timestamp))"),
    "occupancy": ("date", "to_date(day, 'dd/MM/yyyy')"),
    "takeoffs": ("takeoff_date", None),
    "window_states": ("date", "to_date(timestamp_millis(ts_kafka))"),
    "rejects": ("reject_reason", None),
    "occupancy_sketches": ("date", "to_date(day, 'dd/MM/yyyy')"),
}

DECODED_SCHEMA = T.StructType(
    [
        T.StructField("ts_kafka", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("message_hex", T.StringType()),
        T.StructField("dl", T.IntegerType()),
        T.StructField("icao", T.StringType()),
        T.StructField("ca", T.IntegerType()),
        T.StructField("on_ground", T.IntegerType()),
        T.StructField("aircraft_type", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("tc", T.IntegerType()),
    ]
)


def decoded_columns(decoded: DataFrame) -> DataFrame:
    """The flat columns of the decoded product."""
    return decoded.select(*DECODED_SCHEMA.fieldNames())


def write_product(
    df: DataFrame,
    name: str,
    base: str,
    mode: str = "errorifexists",
    file_format: str = "parquet",
    single_file: bool = False,
    sort_by: str | None = None,
) -> None:
    """Writes a product under ``base/name``; ``mode='append'`` adds a run.

    ``single_file`` is for small exports only: it puts the whole result into one
    task. Parquet is partitioned by the product's date, which is derived where
    the table has none; a table without its source column is refused. Rows of a
    date are brought together first, in pieces of Spark's advisory partition
    size, so a run writes few files a date however many tasks made it. Within a
    file rows are ordered by ``sort_by``.
    """
    if file_format == "csv":
        out = df.coalesce(1) if single_file else df
        out = out.sortWithinPartitions(sort_by) if sort_by else out
        out.write.mode(mode).option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSS").csv(f"{base}/{name}")
        return
    if name not in PRODUCTS:
        raise ValueError(f"unknown product {name}")
    partition, derived = PRODUCTS[name]
    out = df if derived is None else df.withColumn(partition, F.expr(derived))
    if partition not in out.columns:
        raise ValueError(f"product {name} is partitioned by {partition}, which the table lacks")
    out = out.coalesce(1) if single_file else out.hint("rebalance", partition)
    # the writer would sort by the partition alone, and undo any other order
    out = out.sortWithinPartitions(partition, *([sort_by] if sort_by else []))
    out.write.mode(mode).partitionBy(partition).format(file_format).save(f"{base}/{name}")


def read_product(spark: SparkSession, name: str, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}")


def read_decoded(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """The decoded table, also from text with its times and dates parsed."""
    if file_format == "csv":
        return (
            spark.read.schema(DECODED_SCHEMA)
            .option("header", True)
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSS")
            .csv(path)
        )
    return spark.read.parquet(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def by_time(df: DataFrame, column: str = "ts_kafka") -> DataFrame:
    """Globally sorted by time; a range shuffle, so for final outputs only."""
    return df.orderBy(F.col(column))
