"""Compare registered queries with their SQL counterparts on DuckDB: python tests/oracle.py SF [key …]."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from boardlake.plans.views import TEST_TABLES  # noqa: E402


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TEST_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted."""
    frame = frame[sorted(frame.columns)]
    text = pd.DataFrame({c: [_text(v) for v in frame[c]] for c in frame.columns})
    return text.sort_values(list(text.columns), ignore_index=True)


def _text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "<null>"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float) and value == int(value) and abs(value) < 1e15:
        return str(int(value))
    return str(value)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)}"
    left, right = normal(spark_rows), normal(sql_rows)
    for column in left.columns:
        unequal = left[column] != right[column]
        if unequal.any():
            at = unequal.idxmax()
            return f"{column}: {unequal.sum()} differ, e.g.\n  spark {dict(left.loc[at])}\n  sql   {dict(right.loc[at])}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from boardlake.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    spark = local_session("oracle")
    con = connection(sf_dir)
    bad = 0
    for key in sys.argv[2:] or queries:
        start = time.time()
        try:
            rows = queries[key](spark, sf_dir).toPandas()
            took = time.time() - start
            if key not in oracles:
                print(f"rows  {key:24s} {len(rows):7d} rows {took:6.2f}s")
                continue
            sql_rows = con.execute(oracles[key]).df()
            problem = differences(rows, sql_rows)
        except Exception as error:  # noqa: BLE001
            problem, took, rows = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - start, []
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '}  {key:24s} {len(rows):7d} rows {took:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
