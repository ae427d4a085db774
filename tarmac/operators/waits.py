"""Reports on take-offs and waiting times.

Counts and means come in long form, which stays one shuffle with partial
aggregates; ``occupancy.wide_hours`` and ``pivoted`` give the wide form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import calendar
from tarmac.operators.scan import beside_one_row, exact_quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def with_weekday(events: DataFrame) -> DataFrame:
    return events.withColumn("weekday_no", calendar.weekday_number(F.col("takeoff_date")))


def _in_seconds(quantiles: DataFrame, names: list[str]) -> DataFrame:
    return quantiles.withColumns({name: F.col(name) / F.lit(1000.0) for name in names})


def wait_stats(events: DataFrame) -> DataFrame:
    """Mean, median and count of waits per take-off date and hour."""
    keys = ["takeoff_date", "takeoff_hour"]
    medians = _in_seconds(exact_quantiles(events, "wait_ms", {"median_s": 0.5}, tuple(keys)), ["median_s"])
    return medians.select(
        *keys, (F.col("total") / F.col("n") / F.lit(1000.0)).alias("mean_s"), "median_s", F.col("n").alias("n_takeoffs")
    )


def _dense_weekdays(events: DataFrame, cells: DataFrame, other: list[str]) -> DataFrame:
    """Cells for all seven weekdays by each seen value of the other axis, 0 where empty."""
    axis = events.select(*other).dropna().distinct()
    spine = axis.select("*", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("weekday_no"))
    value = [c for c in cells.columns if c not in ("weekday_no", *other)]
    return spine.join(cells, ["weekday_no", *other], "left").fillna(0, value)


def takeoffs_weekday_hour(events: DataFrame) -> DataFrame:
    """Take-offs per weekday and hour; all weekdays, seen hours, 0 where empty."""
    rows = with_weekday(events)
    cells = rows.groupBy("weekday_no", "takeoff_hour").agg(F.count("wait_ms").alias("n"))
    return _dense_weekdays(rows, cells, ["takeoff_hour"])


def takeoffs_type_weekday_hour(events: DataFrame, aircraft_type: str | None = None) -> DataFrame:
    """The same for one aircraft type or, by default, for every type."""
    rows = with_weekday(events).filter(F.col("aircraft_type").isNotNull())
    if aircraft_type is not None:
        rows = rows.filter(F.col("aircraft_type") == aircraft_type)
    keys = ["aircraft_type", "takeoff_hour"]
    cells = rows.groupBy("weekday_no", *keys).agg(F.count("wait_ms").alias("n"))
    return _dense_weekdays(rows, cells, keys)


def mean_wait(events: DataFrame, *axes: str) -> DataFrame:
    """Mean wait per combination of axes that occurs; rows without an axis value are left out."""
    rows = with_weekday(events).dropna(subset=list(axes))
    total = rows.groupBy(*axes).agg(F.sum("wait_ms").alias("__sum"), F.count("wait_ms").alias("__n"))
    return total.select(*axes, (F.col("__sum") / F.col("__n") / F.lit(1000.0)).alias("mean_wait_s"))


def wait_type_hour(events: DataFrame) -> DataFrame:
    return mean_wait(events, "aircraft_type", "takeoff_hour")


def wait_weekday_hour(events: DataFrame) -> DataFrame:
    """All weekdays by seen hours, 0 where empty."""
    cells = mean_wait(events, "weekday_no", "takeoff_hour")
    return _dense_weekdays(with_weekday(events), cells, ["takeoff_hour"])


def takeoffs_weekday_runway(events: DataFrame) -> DataFrame:
    rows = with_weekday(events)
    cells = rows.groupBy("weekday_no", "runway").agg(F.count("takeoff_ms").alias("n"))
    return _dense_weekdays(rows, cells, ["runway"])


def _dense_pairs(events: DataFrame, cells: DataFrame, first: str, second: str) -> DataFrame:
    """Every seen value of one axis by every seen value of the other, 0 where empty.

    Both axes are reports' axes (runways, hours), so their product is small.
    """
    rows = events.dropna(subset=[first, second])
    seconds = rows.agg(F.collect_set(second).alias("__all"))
    firsts = rows.select(first).distinct()
    spine = beside_one_row(firsts, seconds).select(first, F.explode("__all").alias(second))
    value = [c for c in cells.columns if c not in (first, second)]
    return spine.join(cells, [first, second], "left").fillna(0, value)


def takeoffs_runway_hour(events: DataFrame) -> DataFrame:
    cells = events.groupBy("runway", "takeoff_hour").agg(F.count("icao").alias("n"))
    return _dense_pairs(events, cells, "runway", "takeoff_hour")


def wait_runway_weekday(events: DataFrame) -> DataFrame:
    return _dense_weekdays(with_weekday(events), mean_wait(events, "runway", "weekday_no"), ["runway"])


def wait_runway_hour(events: DataFrame) -> DataFrame:
    return _dense_pairs(events, mean_wait(events, "runway", "takeoff_hour"), "runway", "takeoff_hour")


def pivoted(long: DataFrame, row: str, column: str, value: str, columns: list) -> DataFrame:
    """Wide form of a long report with a fixed column list."""
    return long.groupBy(row).pivot(column, columns).agg(F.first(value))


def weekday_label(long: DataFrame) -> DataFrame:
    """Replaces the weekday number by its English name, kept in weekday order."""
    name = calendar.weekday_name(F.col("weekday_no"), "en")
    return long.orderBy("weekday_no").withColumn("weekday", name).drop("weekday_no")


def wait_box(events: DataFrame, by: str | None = None) -> DataFrame:
    """Box-plot numbers of waits: quartiles, whiskers at the last value inside 1.5 IQR, outliers.

    Without ``by`` there is one overall row. Groups without a name are left out.
    """
    keys = [by] if by else []
    rows = events.dropna(subset=keys) if by else events
    boxes = exact_quantiles(rows, "wait_ms", QUARTILES, tuple(keys)).drop("total")
    spread = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    boxes = boxes.withColumns({"__low": F.col("q1") - spread, "__high": F.col("q3") + spread})
    waits = rows.select("wait_ms", *keys)
    joined = waits.join(boxes, keys) if by else beside_one_row(waits, boxes)
    inside = F.col("wait_ms").between(F.col("__low"), F.col("__high"))
    out = joined.groupBy(*keys, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("wait_ms"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("wait_ms"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(1)).alias("n_outliers"),
    )
    return _in_seconds(out, ["q1", "median", "q3", "whisker_low", "whisker_high"])


def wait_describe(events: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of waits."""
    seconds = F.col("wait_ms") / F.lit(1000.0)
    basic = events.agg(
        F.avg(seconds).alias("mean"),
        F.stddev_samp(seconds).alias("std"),
        F.min(seconds).alias("min"),
        F.max(seconds).alias("max"),
    )
    quartiles = _in_seconds(exact_quantiles(events, "wait_ms", QUARTILES), list(QUARTILES))
    return beside_one_row(basic, quartiles).select(
        F.col("n").alias("count"), "mean", "std", "min", "q1", "median", "q3", "max"
    )


def takeoffs_per_hour(events: DataFrame) -> DataFrame:
    return events.groupBy("takeoff_hour").agg(F.count("*").alias("n"))


def takeoffs_per_weekday(events: DataFrame) -> DataFrame:
    counts = with_weekday(events).groupBy("weekday_no").agg(F.count("*").alias("n"))
    return counts.withColumn("weekday", calendar.weekday_name(F.col("weekday_no"), "letter"))


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    counts = rows.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column)


def top_aircraft(events: DataFrame, n: int = 10) -> DataFrame:
    """The aircraft with most take-offs; ties go to the lower address."""
    counts = events.groupBy("icao").agg(F.count("*").alias("n_takeoffs"))
    return counts.orderBy(F.desc("n_takeoffs"), "icao").limit(n)


def wait_box_top(events: DataFrame, n: int = 10) -> DataFrame:
    """Box-plot numbers per aircraft for the ``n`` aircraft with most take-offs."""
    return wait_box(events.join(top_aircraft(events, n).select("icao"), "icao", "left_semi"), "icao")


def max_wait_per_type(events: DataFrame) -> DataFrame:
    return events.dropna(subset=["aircraft_type"]).groupBy("aircraft_type").agg(F.max("wait_s").alias("max_wait_s"))
