"""A raw log as files that arrive one after the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Messages of one file, about.
FILE_MESSAGES = 1_000_000
LEAST_FILES = 8


def write_feed(raw: DataFrame, arrival_ms: Column, path: str) -> int:
    """Writes messages as one file for each of equally long stretches of arrival, and returns how many stretches there are.

    File times are set in order of arrival, which is how a file stream reads them.
    """
    spark = raw.sparkSession
    rows = raw.withColumn("__at", arrival_ms)
    low, high, n = rows.agg(F.min("__at"), F.max("__at"), F.count("*")).first()
    files = max(LEAST_FILES, -(-n // FILE_MESSAGES))
    if low is None:
        rows.drop("__at").write.parquet(path)
        return 0
    slot = F.floor((F.col("__at") - low) * files / F.lit(high - low + 1)).cast("int")
    rows.withColumn("slot", slot).drop("__at").repartition(files, "slot").write.partitionBy("slot").parquet(path)
    _set_times(spark, path)
    return files


def _set_times(spark: SparkSession, path: str) -> None:
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = sorted((s.getPath() for s in store.listStatus(top) if s.isDirectory()), key=lambda p: int(p.getName().partition("=")[2]))
    first = 1_700_000_000_000
    for i, folder in enumerate(folders):
        for file in store.listStatus(folder):
            store.setTimes(file.getPath(), first + i * 10_000, -1)


def read_feed(spark: SparkSession, path: str, schema: str = "seq bigint, ts_kafka bigint, message string") -> DataFrame:
    """The files as a stream, one file a trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/slot=*")
