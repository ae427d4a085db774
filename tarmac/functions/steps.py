"""Stacked projections written as one SQL statement.

A decode has some twenty dependent stages. Adding them one DataFrame call at a
time analyses the growing plan again each time; one statement is analysed once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class Steps:
    """Stages of a projection; each may use the columns of the earlier ones."""

    _text: str = "{source}"
    _hidden: list[str] = field(default_factory=list)

    def add(self, columns: dict[str, str]) -> Steps:
        """Adds columns; a later column of the same call may use an earlier one."""
        items = ", ".join(f"{text} AS {name}" for name, text in columns.items())
        return self._wrap(f"*, {items}", columns)

    def once(self, columns: dict[str, str]) -> Steps:
        """Adds columns that filters and projections above must not expand again.

        Spark moves a filter below a projection by copying the projected
        expressions into it, so a filter on the parity check would decode the
        message dozens of times per row. A one-row generator is a boundary for that.
        """
        fields = ", ".join(f"'{name}', {text}" for name, text in columns.items())
        return self._wrap(f"*, inline(array(named_struct({fields})))", columns)

    def apply(self, df: DataFrame) -> DataFrame:
        """Runs the stages on a DataFrame and drops the helper columns (``__name``)."""
        kept = f" EXCEPT ({', '.join(self._hidden)})" if self._hidden else ""
        return df.sparkSession.sql(f"SELECT *{kept} FROM ({self._text})", source=df)

    def _wrap(self, items: str, names: Iterable[str]) -> Steps:
        source = self._text if self._text == "{source}" else f"({self._text})"
        hidden = [*self._hidden, *[n for n in names if n.startswith("__")]]
        return Steps(f"SELECT {items} FROM {source}", hidden)
