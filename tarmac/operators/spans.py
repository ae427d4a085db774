"""Ordered operators over the map table, a day of an aircraft at a time.

The map table has at most one row per aircraft and window. Its rows are grouped by
(aircraft, span); what a span must know of the ones before travels in a table of
one row per (aircraft, span), as in ``scan.carry_last``. Only that table is ever put
in order by aircraft alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tarmac.session import HOUR_MS

SPAN = "__span"
SPAN_MS = 24 * HOUR_MS


def by_span(rows: DataFrame) -> DataFrame:
    """Rows brought together by (aircraft, span); the map table comes so already."""
    if SPAN in rows.columns:
        return rows
    span = F.floor(F.col("ts_kafka") / F.lit(SPAN_MS))
    return rows.withColumn(SPAN, span).filter(F.col("icao").isNotNull() & F.col(SPAN).isNotNull()).repartition("icao", SPAN)


def in_span() -> WindowSpec:
    return Window.partitionBy("icao", SPAN).orderBy("ts_kafka")


def row_of(rows: DataFrame, *leave: str) -> Column:
    """The whole row as a value that orders by time.

    Used on both sides of ``beside_spans``, so that both need the same columns of one shuffle.
    """
    return F.struct("ts_kafka", *[c for c in rows.columns if c not in ("ts_kafka", *leave)])


def beside_spans(
    rows: DataFrame, tails: dict[str, Column], heads: Callable[[DataFrame, WindowSpec], DataFrame]
) -> DataFrame:
    """Adds to every row the columns that ``heads`` gives its (aircraft, span).

    ``tails`` are aggregates of a span; ``heads`` gets one row per (aircraft, span) with
    them, and the window that orders an aircraft's spans.
    """
    table = rows.groupBy("icao", SPAN).agg(*[value.alias(name) for name, value in tails.items()])
    side = heads(table, Window.partitionBy("icao").orderBy(SPAN)).drop(*tails)
    return rows.join(side, ["icao", SPAN])


def two_before(rows: DataFrame, fields: tuple[str, ...]) -> tuple[DataFrame, Column, Column]:
    """Rows with what is needed to tell the two previous rows of the aircraft, and these as structs of ``fields``."""
    newest = F.row_number().over(Window.partitionBy("icao", SPAN).orderBy(F.desc("ts_kafka")))
    numbered = rows.withColumns({"__newest": newest, "__place": F.row_number().over(in_span())})
    whole, wanted = row_of(rows, SPAN), F.struct(*fields)
    tails = {
        "__last": F.max(F.when(F.col("__newest") == 1, whole)),
        "__second": F.max(F.when(F.col("__newest") == 2, whole)),
    }

    def heads(table: DataFrame, side: WindowSpec) -> DataFrame:
        earlier = F.coalesce(F.lag("__second").over(side), F.lag("__last", 2).over(side))
        return table.withColumns({"__one": F.lag("__last").over(side), "__two": earlier})

    placed = numbered.withColumns({"__in_one": F.lag(wanted, 1).over(in_span()), "__in_two": F.lag(wanted, 2).over(in_span())})
    out = beside_spans(placed, tails, heads)

    def of(name: str) -> Column:
        return F.struct(*[F.col(f"{name}.{f}").alias(f) for f in fields])

    one = F.when(F.col("__place") == 1, F.when(F.col("__one").isNotNull(), of("__one"))).otherwise(F.col("__in_one"))
    two = (
        F.when(F.col("__place") == 1, F.when(F.col("__two").isNotNull(), of("__two")))
        .when(F.col("__place") == 2, F.when(F.col("__one").isNotNull(), of("__one")))
        .otherwise(F.col("__in_two"))
    )
    return out, one, two
