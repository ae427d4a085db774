"""Air and ground traffic per hour from all-call replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import calendar
from tarmac.functions.fixed_values import GROUND_LABELS
from tarmac.operators.decode import valid_allcall


def occupancy(decoded: DataFrame) -> DataFrame:
    """Distinct (day, hour, aircraft, ground); repeats are merged before the shuffle."""
    ms = F.col("ts_kafka")
    return (
        valid_allcall(decoded)
        .select(calendar.day_text(ms).alias("day"), calendar.hour_of(ms).alias("hour"), "icao", "on_ground")
        .distinct()
    )


def hours(spark) -> DataFrame:
    return spark.range(24).select(F.col("id").cast("int").alias("hour"))


def hour_ground_counts(facts: DataFrame, day: str) -> DataFrame:
    """Aircraft per hour and ground state on one day."""
    return facts.filter(F.col("day") == day).groupBy("hour", "on_ground").agg(F.count("*").alias("n"))


def hourly_dense(facts: DataFrame, day: str) -> DataFrame:
    """The same with a row for each of the 24 x 2 combinations, 0 where nothing was seen."""
    spine = hours(facts.sparkSession).select("hour", F.explode(F.array(F.lit(0), F.lit(1))).alias("on_ground"))
    counts = hour_ground_counts(facts, day)
    return spine.join(counts, ["hour", "on_ground"], "left").fillna(0, ["n"])


def axis_max(facts: DataFrame, first_day: str, second_day: str) -> DataFrame:
    """Largest hourly count of two days, rounded up to a multiple of ten."""
    chosen = facts.filter(F.col("day").isin(first_day, second_day))
    counts = chosen.groupBy("day", "hour", "on_ground").agg(F.count("*").alias("n"))
    return counts.agg((F.ceil(F.coalesce(F.max("n"), F.lit(0)) / F.lit(10)) * 10).alias("axis_max"))


def weekday_traffic(facts: DataFrame) -> DataFrame:
    """Aircraft-hours per day and ground state, with labels in weekday order."""
    counts = facts.groupBy("day", "on_ground").agg(F.count("*").alias("n"))
    number = calendar.weekday_number(calendar.parse_day(F.col("day")))
    return counts.select(
        "day",
        number.alias("weekday_no"),
        calendar.weekday_name(number, "es").alias("weekday"),
        F.when(F.col("on_ground") == 1, GROUND_LABELS[1]).otherwise(GROUND_LABELS[0]).alias("state"),
        "n",
    ).orderBy("weekday_no", "day", "state")


def day_hour_matrix(facts: DataFrame) -> DataFrame:
    """Aircraft per day and hour in long form; ``wide_hours`` turns it into 24 columns."""
    return facts.groupBy("day", "hour").agg(F.count("*").alias("n"))


def wide_hours(long: DataFrame, row: str, value: str = "n", fill: int | None = 0) -> DataFrame:
    """Pivot of an hourly long table to 24 columns; the fixed list saves a job."""
    wide = long.groupBy(row).pivot("hour", list(range(24))).agg(F.first(value))
    return wide if fill is None else wide.fillna(fill)


def state_by_hour(facts: DataFrame, on_ground: int) -> DataFrame:
    """Aircraft per day and hour in one ground state, seen hours only."""
    return facts.filter(F.col("on_ground") == on_ground).groupBy("day", "hour").agg(F.count("*").alias("n"))


def day_hour_dense(facts: DataFrame, on_ground: int) -> DataFrame:
    """``state_by_hour`` with a row for each hour of each day, 0 where nothing was seen."""
    spine = distinct_days(facts).select(
        "day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    )
    return spine.join(state_by_hour(facts, on_ground), ["day", "hour"], "left").fillna(0, ["n"])


def distinct_days(facts: DataFrame) -> DataFrame:
    return facts.select("day").distinct()


#: Registers of a sketch, as a power of two; its standard error is SKETCH_ERROR of the count.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def occupancy_sketches(facts: DataFrame) -> DataFrame:
    """(day, hour, on_ground, sketch): a mergeable count of distinct aircraft, to be kept as a product.

    Sketches of hours merge into those of any days or weeks, without the aircraft.
    """
    return facts.groupBy("day", "hour", "on_ground").agg(F.hll_sketch_agg("icao", F.lit(SKETCH_BITS)).alias("sketch"))


def merged_counts(sketches: DataFrame, *by: str) -> DataFrame:
    """(by..., n): about how many distinct aircraft sketches together hold, three times SKETCH_ERROR off at most, almost always."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.hll_sketch_estimate("sketch").alias("n"))


def sketched_beside_exact(facts: DataFrame, sketches: DataFrame, *by: str) -> DataFrame:
    """(by..., n_exact, n_sketched, in_bound): distinct aircraft counted, and estimated from the kept sketches."""
    exact = facts.select(*by, "icao").distinct().groupBy(*by).agg(F.count("*").alias("n_exact"))
    both = exact.join(merged_counts(sketches, *by).withColumnRenamed("n", "n_sketched"), list(by))
    off = F.abs(F.col("n_sketched") - F.col("n_exact"))
    return both.withColumn("in_bound", off <= F.greatest(F.lit(1.0), F.lit(3 * SKETCH_ERROR) * F.col("n_exact")))
