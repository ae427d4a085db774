"""Calendar columns of an epoch-millisecond column (UTC session)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.fixed_values import WEEKDAY_LETTERS, WEEKDAYS_EN, WEEKDAYS_ES


def at(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def day_text(ms: Column) -> Column:
    return F.date_format(at(ms), "dd/MM/yyyy")


def minute_text(ms: Column) -> Column:
    return F.date_format(at(ms), "dd/MM/yyyy HH:mm")


def second_text(ms: Column) -> Column:
    return F.date_format(at(ms), "yyyy-MM-dd HH:mm:ss")


def hour_of(ms: Column) -> Column:
    return F.hour(at(ms))


def weekday_number(date: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(date)


def weekday_name(number: Column, language: str = "en") -> Column:
    names = {"en": WEEKDAYS_EN, "es": WEEKDAYS_ES, "letter": WEEKDAY_LETTERS}[language]
    return F.get(F.array(*[F.lit(n) for n in names]), number)


def day_bounds_ms(text: str) -> tuple[int, int]:
    """First and last epoch millisecond of a ``dd/MM/yyyy`` day."""
    start = datetime.strptime(text, "%d/%m/%Y").replace(tzinfo=timezone.utc)
    first = int(start.timestamp() * 1000)
    return first, first + 86_400_000 - 1


def parse_day(text: Column) -> Column:
    return F.to_date(text, "dd/MM/yyyy")
