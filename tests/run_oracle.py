"""Command line check: python -m tests.run_oracle SF_DIR [query ...]"""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from tarmac.session import local_session
from tests.compare import difference, duck, duck_rows, spark_rows


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = local_session(), duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(queries):
        start = time.time()
        try:
            found = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - start
            start = time.time()
            message = difference(found, duck_rows(con, oracle[name])) if name in oracle else "no SQL"
            sql_took = time.time() - start
        except Exception as error:  # report every query
            message, took, sql_took, found = f"{type(error).__name__}: {str(error)[:600]}", time.time() - start, 0, ([], [])
        bad += message not in (None, "no SQL")
        print(f"{'ok ' if message is None else 'BAD' if message != 'no SQL' else '-- '} {name} rows={len(found[1])} {took:.1f}s sql {sql_took:.1f}s {message or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
