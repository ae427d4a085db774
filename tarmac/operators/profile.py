"""Data-quality profiles and distributions of the product tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.fixed_values import NO_CATEGORY
from tarmac.operators.scan import beside_one_row

BINS = 10


def histogram(rows: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins between the least and the largest value, empty ones included.

    The bounds are one row, so both joins below are with constant-size tables.
    """
    values = rows.select(F.col(column).cast("double").alias("v")).dropna()
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # a single value gets a bin of width 1 around it
    flat = F.col("lo") == F.col("hi")
    bounds = bounds.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = beside_one_row(values, bounds).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    spine = bounds.select("lo", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def types_per_aircraft(rows: DataFrame, kind: str, key: str = "icao") -> DataFrame:
    """Number of distinct informative categories per aircraft."""
    pairs = rows.select(key, kind).dropna().distinct().filter(F.col(kind) != NO_CATEGORY)
    return pairs.groupBy(key).agg(F.count("*").alias("n_types"))


def multi_type_aircraft(rows: DataFrame, kind: str, key: str = "icao") -> DataFrame:
    """Aircraft that stated more than one informative category."""
    return types_per_aircraft(rows, kind, key).filter(F.col("n_types") > 1)


def aircraft_type_crosstab(rows: DataFrame, kind: str, value: str, key: str = "icao") -> DataFrame:
    """Distinct (aircraft, category, value) rows counted per aircraft and category."""
    distinct = rows.select(key, kind, value).dropna().distinct().filter(F.col(kind) != NO_CATEGORY)
    return distinct.groupBy(key, kind).agg(F.count("*").alias("n"))


def type_totals(crosstab: DataFrame, kind: str) -> DataFrame:
    """Column sums of the cross-tab."""
    return crosstab.groupBy(kind).agg(F.sum("n").alias("n"))


def max_speed(states: DataFrame) -> DataFrame:
    """Largest speed and altitude per aircraft and ground state."""
    rows = states.dropna(subset=["lat", "lon", "ground"])
    return rows.groupBy("icao", "ground").agg(
        F.max("velocity").alias("max_speed"), F.max("alt_feet").alias("max_alt_feet")
    )


def null_profile(rows: DataFrame) -> DataFrame:
    """Per column: rows, nulls and distinct values.

    Distinct values are counted as groups of (column, value), which merges
    repeats before the shuffle and spreads every column over all tasks.
    """
    columns = [c for c in rows.columns]
    cells = rows.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("cell")
    ).select("cell.*")
    values = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    return values.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
    )


def null_corr(rows: DataFrame) -> DataFrame:
    """Correlation of being null between columns; columns without both states are left out."""
    columns = rows.columns
    flags = rows.select(*[F.col(c).isNull().cast("long").alias(c) for c in columns])
    pairs = list(combinations(columns, 2))
    one = flags.agg(
        F.count("*").cast("double").alias("rows"),
        *[F.sum(c).cast("double").alias(f"n_{c}") for c in columns],
        *[F.sum(F.col(a) * F.col(b)).cast("double").alias(f"both_{a}_{b}") for a, b in pairs],
    )
    n = F.col("rows")

    def spread(c: str):
        return F.col(f"n_{c}") * (n - F.col(f"n_{c}"))

    def correlation(a: str, b: str):
        """From the counts alone; null where a column is never or always null."""
        shared = n * F.col(f"both_{a}_{b}") - F.col(f"n_{a}") * F.col(f"n_{b}")
        return F.try_divide(shared, F.sqrt(spread(a) * spread(b)))

    cells = [
        F.struct(
            F.lit(a).alias("left"),
            F.lit(b).alias("right"),
            correlation(a, b).alias("corr"),
        )
        for a, b in pairs
    ]
    return one.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter(F.col("corr").isNotNull())
