"""Compare every registered query with its SQL in DuckDB:  python tests/compare.py [sf_dir]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from wordloom.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return con


def differences(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """None if both hold the same bag of rows, doubles bit for bit."""
    columns = sorted(left.columns)
    if columns != sorted(right.columns):
        return f"columns {columns} / {sorted(right.columns)}"
    kinds = [(c, left[c].dtype, right[c].dtype) for c in columns if left[c].dtype != right[c].dtype]
    if kinds:
        return f"types {kinds}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    left, right = (
        f[columns].sort_values(columns, ignore_index=True) for f in (left, right)
    )
    return None if left.equals(right) else "values"


def main(sf_dir: str) -> int:
    spark = local_session(8)
    con, sql, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        start = time.time()
        result = query(spark, sf_dir).toArrow().to_pandas()
        spent = time.time() - start
        if name in sql:
            start = time.time()
            expected = con.sql(sql[name]).to_arrow_table().to_pandas()
            verdict = differences(result, expected) or "equal"
            verdict += f" (sql {time.time() - start:.1f} s)"
        else:
            verdict = "no sql"
        failed += not verdict.startswith(("equal", "no sql"))
        print(f"{name:28s} {len(result):9d} rows {spent:6.1f} s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"))
