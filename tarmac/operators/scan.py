"""Ordered per-key operators that never put a whole key into one task.

A window over ``(key)`` alone hands all rows of a busy key to one task. Here the
time line of every key is cut into slices and rows are grouped by
``(key, slice)``. What a slice needs to know of the others travels in a small
side table with one row per (key, slice), or as a copy of the few rows near a
slice border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import MINUTE_MS

SLICE_MS = 10 * MINUTE_MS
"""Ten minutes: a key with a third of a week of rows has 0.03 % of all rows per slice."""


def carry_last(
    df: DataFrame,
    states: dict[str, Column],
    strict: tuple[str, ...] = (),
    key: str = "icao",
    time: str = "ts_kafka",
    tie: str = "seq",
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Per row and state, the row's own value and the latest non-null one at its time.

    The result has the key, time and tie columns and, per state, ``<name>`` (own)
    and ``last_<name>``. A state is a nullable struct, so that a known null inside
    it still overwrites older values. Names in ``strict`` look only at earlier
    rows; the others include the row itself.

    The rows are shuffled once, by (key, slice). The last values of each slice are
    carried across slices on a table of one row per (key, slice), whose size per
    key depends on the time span and not on the number of rows. That table reads
    the same shuffle: both uses need exactly the same columns.
    """
    sliced = df.select(
        key,
        F.floor(F.col(time) / F.lit(slice_ms)).alias("__slice"),
        time,
        tie,
        *[value.alias(name) for name, value in states.items()],
    )
    # stated here and not left to the join, so that both uses have one plan and share the shuffle
    sliced = sliced.filter(F.col(key).isNotNull() & F.col("__slice").isNotNull()).repartition(key, "__slice")
    order = F.struct(time, tie)
    tails = sliced.groupBy(key, "__slice").agg(
        *[F.max_by(name, F.when(F.col(name).isNotNull(), order)).alias(f"__tail_{name}") for name in states]
    )
    before = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    heads = tails.select(
        key, "__slice", *[F.last(f"__tail_{n}", ignorenulls=True).over(before).alias(f"__head_{n}") for n in states]
    )
    inside = Window.partitionBy(key, "__slice").orderBy(time, tie)

    def upto(name: str) -> Column:
        stop = -1 if name in strict else Window.currentRow
        return F.last(name, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, stop))

    filled = sliced.withColumns({f"__fill_{name}": upto(name) for name in states})
    return filled.join(heads, [key, "__slice"]).select(
        key,
        time,
        tie,
        *states,
        *[F.coalesce(f"__fill_{n}", f"__head_{n}").alias(f"last_{n}") for n in states],
    )


def with_halo(df: DataFrame, back_ms: int, slice_ms: int, time: str = "ts_kafka") -> DataFrame:
    """Adds ``__slice`` and ``__own``: rows plus copies in the later slices they can reach.

    A row is copied to each slice that begins within ``back_ms`` after it. A
    window over (key, ``__slice``) then sees everything up to ``back_ms`` ago;
    keep the rows with ``__own`` afterwards. With a slice several times longer
    than ``back_ms`` only the rows near a border are copied.
    """
    home = F.floor(F.col(time) / F.lit(slice_ms))
    reach = F.floor((F.col(time) + F.lit(back_ms)) / F.lit(slice_ms))
    return df.withColumn("__slice", F.explode(F.sequence(home, reach))).withColumn(
        "__own", F.col("__slice") == home
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: tuple[str, ...] = (),
    slice_width: int = 1000,
    fanout: int = 1000,
) -> DataFrame:
    """Exact interpolated quantiles of a whole-number column per group.

    Equal values are counted before the shuffle. The value axis is cut into
    slices of ``slice_width`` values and those into spans of ``fanout`` slices.
    Running counts go over the spans of a group, the slices of a span and the
    values of a slice, so the largest window holds one row per span: a million
    times fewer than values at the defaults. Groups come as columns ``by`` plus
    ``n``, ``total`` (the values' sum) and one DOUBLE column per name.
    """
    group = list(by) or ["__all"]
    source = df if by else df.withColumn("__all", F.lit(0))
    counts = (
        source.filter(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).alias("__v"))
        .agg(F.count("*").alias("__c"))
        .withColumn("__slice", F.floor(F.col("__v") / F.lit(slice_width)))
        .withColumn("__span", F.floor(F.col("__slice") / F.lit(fanout)))
    )

    def before(order: str, *inside: str) -> Column:
        window = Window.partitionBy(*group, *inside).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__c").over(window), F.lit(0))

    def beside(rows: DataFrame, side: DataFrame, *keys: str) -> DataFrame:
        # groups may be null, so the side table is matched null-safely
        renamed = side.select(*[F.col(k).alias(f"__k_{k}") for k in (*group, *keys)], *[c for c in side.columns if c not in (*group, *keys)])
        same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in (*group, *keys)]
        return rows.join(renamed, same).drop(*[f"__k_{k}" for k in (*group, *keys)])

    slices = counts.groupBy(*group, "__span", "__slice").agg(F.sum("__c").alias("__c"))
    spans = slices.groupBy(*group, "__span").agg(F.sum("__c").alias("__c"))
    totals = spans.groupBy(*group).agg(F.sum("__c").alias("n"))
    span_heads = spans.select(*group, "__span", before("__span").alias("__before_span"))
    slice_heads = slices.select(*group, "__span", "__slice", before("__slice", "__span").alias("__before_slice"))
    heads = beside(beside(slice_heads, span_heads, "__span"), totals).select(
        *group, "__slice", "n", (F.col("__before_span") + F.col("__before_slice")).alias("__before")
    )
    running = Window.partitionBy(*group, "__slice").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = beside(counts.withColumn("__upto", F.sum("__c").over(running)), heads, "__slice").withColumn(
        "__upto", F.col("__upto") + F.col("__before")
    )
    bounds = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("n") - 1)
        bounds.append(F.min(F.when(F.col("__upto") > F.floor(place), F.col("__v"))).alias(f"__lo_{name}"))
        bounds.append(F.min(F.when(F.col("__upto") > F.ceil(place), F.col("__v"))).alias(f"__hi_{name}"))
    found = ranked.groupBy(*group, "n").agg(*bounds, F.sum(F.col("__v") * F.col("__c")).alias("total"))
    outputs = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        outputs.append((low + (high - low) * (place - F.floor(place))).cast("double").alias(name))
    return found.select(*by, "n", "total", *outputs)


def beside_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds the columns of a one-row table (a global aggregate) to every row.

    The side is one row by construction, so broadcasting it is always safe.
    """
    side = one_row.withColumn("__one", F.lit(1))
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(side), "__one").drop("__one")
