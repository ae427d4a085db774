"""Runs registered queries beside their DuckDB statements and compares values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), _rows(columns, result.fetchall())


def difference(spark_side, duck_side) -> str | None:
    if spark_side[0] != duck_side[0]:
        return f"columns {spark_side[0]} != {duck_side[0]}"
    if len(spark_side[1]) != len(duck_side[1]):
        return f"rows {len(spark_side[1])} != {len(duck_side[1])}"
    for a, b in zip(spark_side[1], duck_side[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{spark_side[0]}: {a} != {b}"
    return None
