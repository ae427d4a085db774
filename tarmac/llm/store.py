"""Written intermediate tables, and fixed-size filters built from a column."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.session import shared_dir

#: Texts reach Python in batches of so many bytes, however long or many the rows are.
BATCH_BYTES = 1 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bits of a filter. Its size never follows the data: when full it lets more rows through, never fewer.
FILTER_BITS = 1 << 26


class Scratch:
    """A folder that every executor reaches, with one Parquet table per step of a job.

    A written table cuts the lineage: a lost executor costs the tasks of one step.
    Shuffle files of a step are released as soon as its table is written. The folder stays, since results
    are read from it lazily, and so does the session's batch size; what is made inside ``disposed()`` goes at its end.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        spark.conf.set(_BATCH, str(BATCH_BYTES))
        self.base = shared_dir(spark)
        self.count = 0
        for made in _scopes:
            made.append(self)

    def close(self) -> None:
        """Deletes the folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.base}/{self.count:03d}-{name}"

    def save(self, df: DataFrame, name: str, *partitions: str) -> DataFrame:
        path = self.path(name)
        with self._cleaned():
            writer = df.write.option("compression", "zstd")
            (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_by_key(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """As save(), bucketed by key: grouping by it or meeting other rows by it does not shuffle this table again."""
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        entry = f"tarmac_{uuid.uuid4().hex}"
        with self._cleaned():
            writer = df.repartition(parts, key).write.option("compression", "zstd").option("path", self.path(name))
            writer.format("parquet").bucketBy(parts, key).saveAsTable(entry)
        table = self.spark.table(entry)
        self.spark.sql(f"DROP TABLE {entry}")  # the catalog's entry only: a table with a path keeps its files
        return table

    @contextmanager
    def _cleaned(self) -> Iterator[None]:
        before = self.spark.conf.get(_CLEAN, "false")
        self.spark.conf.set(_CLEAN, "true")
        try:
            yield
        finally:
            self.spark.conf.set(_CLEAN, before)


_scopes: list[list[Scratch]] = []


@contextmanager
def disposed(spark: SparkSession) -> Iterator[None]:
    """Deletes the folders that jobs make inside, and restores the session's batch size, once their results are written."""
    before, made = spark.conf.get(_BATCH, None), []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for scratch in made:
            scratch.close()
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)


def row_key(*columns: str) -> Column:
    """A key for rows whose own id may be null or repeated; equal rows share it."""
    return F.xxhash64(*[F.col(c) for c in columns])


def filter_words(keys: DataFrame, key: str) -> np.ndarray:
    """A bitmap of FILTER_BITS bits holding every value of a BIGINT column, gathered as words."""
    words = (
        keys.select(F.pmod(F.col(key), F.lit(FILTER_BITS)).alias("spot"))
        .where("spot IS NOT NULL")
        .groupBy(F.shiftright("spot", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 31 as int))")).alias("bits"))
    ).toArrow()
    bitmap = np.zeros(FILTER_BITS >> 5, np.uint32)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return bitmap


def maybe_in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True for every key that filter_words saw, and for a few more."""
    spots = keys.astype(np.int64) % FILTER_BITS
    return (bitmap[spots >> 5] >> (spots & 31).astype(np.uint32)) & np.uint32(1) == 1


def _maybe(bitmap: Broadcast) -> Callable[[str], Column]:
    """A column's values against a bitmap, as an Arrow function: workers that run it need no pandas."""

    @F.arrow_udf(T.BooleanType())
    def maybe(keys: pa.Array) -> pa.Array:
        return pa.array(maybe_in(bitmap.value, keys.to_numpy(zero_copy_only=False)))

    return maybe


def one_of_each(docs: DataFrame, key: Column, repeated: DataFrame) -> DataFrame:
    """The rows of docs, of those with a key among the values of repeated's only column one for each key.

    As in without(), rows that a bitmap of the repeated keys clears are not shuffled.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(filter_words(repeated, repeated.columns[0]))

    maybe = _maybe(bitmap)

    keyed = docs.withColumn("_key", key)
    sure = keyed.where(~maybe("_key")).drop("_key")
    other = keyed.where(maybe("_key")).groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("_row"))
    return sure.unionByName(other.select("_row.*"))


def without(docs: DataFrame, key: Column, dropped: DataFrame) -> DataFrame:
    """The rows of docs whose key is not among the values of dropped's only column.

    A bitmap of the dropped keys tells for most rows that they stay; only the others meet
    dropped in a join, so the texts of rows that stay are not shuffled.
    """
    name = dropped.columns[0]
    bitmap = docs.sparkSession.sparkContext.broadcast(filter_words(dropped, name))

    maybe = _maybe(bitmap)

    keyed = docs.withColumn("_key", key)
    sure = keyed.where(~maybe("_key")).drop("_key")
    other = keyed.where(maybe("_key")).join(dropped.select(F.col(name).alias("_key")).distinct(), "_key", "left_anti")
    return sure.unionByName(other.drop("_key"))
