"""Compare every query with its SQL: column names, types as text or number, row count and values.

Usage: python tests/check_queries.py <sf_dir> [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(found: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    """What differs, or None. Values must be equal; decimals were rounded by the queries."""
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} and {sorted(wanted.columns)}"
    if len(found) != len(wanted):
        return f"{len(found)} and {len(wanted)} rows"
    found, wanted = normalised(found), normalised(wanted)
    for c in found.columns:
        a, b = found[c], wanted[c]
        if a.dtype.kind == "f" and b.dtype.kind == "i" and a.isna().any():
            # a column of whole numbers with nulls comes from Spark as floats
            a = a.astype("Int64")
        if a.dtype.kind != b.dtype.kind:
            return f"column {c}: types {a.dtype} and {b.dtype}"
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            at = int(np.argmin(same.to_numpy()))
            return f"column {c}: {int((~same).sum())} values, for example {a[at]!r} and {b[at]!r}"
    return None


def main() -> int:
    import __spark_entry__ as entry

    from gradlake.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session("check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.perf_counter()
        try:
            found = query(spark, sf_dir).toPandas()
            spent = time.perf_counter() - started
            message = difference(found, con.execute(entry.oracle_sql()[name]).df())
        except Exception as e:
            spent, message = time.perf_counter() - started, f"{type(e).__name__}: {str(e)[:600]}"
        bad += message is not None
        print(f"{'ok ' if message is None else 'BAD'} {spent:6.2f} s {name} {message or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
