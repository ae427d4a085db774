"""Reference tables as DataFrames; all are a few constant rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.fixed_values import (
    CATEGORY_LABELS,
    LANDING_STRIPS,
    RADARS,
    RUNWAYS,
    WEEKDAY_LETTERS,
    WEEKDAYS_EN,
    WEEKDAYS_ES,
)


def categories(spark: SparkSession) -> DataFrame:
    rows = [(tc, cat, label) for tc, labels in CATEGORY_LABELS.items() for cat, label in enumerate(labels)]
    return spark.createDataFrame(rows, "tc int, cat int, label string")


OUTLINES_SCHEMA = "priority int, runway string, vertices array<struct<x: double, y: double>>"


def read_outlines(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Outlines of an airport's runways, for ``takeoffs.with_runway``."""
    return spark.read.schema(OUTLINES_SCHEMA).format(file_format).load(path)


def runways(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, name, list(outline)) for i, (name, outline) in enumerate(RUNWAYS)]
    return spark.createDataFrame(rows, OUTLINES_SCHEMA)


def radars(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RADARS, "name string, lat double, lon double")


def landing_strips(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LANDING_STRIPS, "name string, lat double, lon double")


def weekdays(spark: SparkSession) -> DataFrame:
    rows = list(zip(range(7), WEEKDAYS_EN, WEEKDAYS_ES, WEEKDAY_LETTERS))
    return spark.createDataFrame(rows, "weekday_no int, english string, spanish string, letter string")


def with_category_label(rows: DataFrame, tc: str = "tc", cat: str = "category") -> DataFrame:
    """Label lookup as a join; the dimension has 32 rows, so it is broadcast."""
    dim = categories(rows.sparkSession).withColumnsRenamed({"tc": "__tc", "cat": "__cat"})
    same = (F.col(tc) == F.col("__tc")) & (F.col(cat) == F.col("__cat"))
    return rows.join(F.broadcast(dim), same, "left").drop("__tc", "__cat")
