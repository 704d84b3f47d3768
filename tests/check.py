"""Compare registered queries with their DuckDB statements: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
ROOT = "/root/testdata"


def connection(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True) if len(frame) else frame


def difference(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> str | None:
    """None if both hold the same columns, rows and exact values."""
    a, b = ordered(spark_frame), ordered(duck_frame)
    if list(a.columns) != list(b.columns):
        return f"columns {list(a.columns)} / {list(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    for c in a.columns:
        left, right = a[c], b[c]
        if pd.api.types.is_datetime64_any_dtype(left):
            left, right = left.astype("datetime64[us]"), right.astype("datetime64[us]")
        unlike = ~((left == right) | (left.isna() & right.isna()))
        if unlike.any():
            i = unlike.idxmax()
            return f"{c}: {int(unlike.sum())} of {len(a)} differ, e.g. {left[i]!r} / {right[i]!r}"
        if left.dtype.kind != right.dtype.kind:
            return f"{c}: type {left.dtype} / {right.dtype}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from wattlake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"{ROOT}/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connection(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            if name in sql:
                verdict = difference(got, con.execute(sql[name]).df()) or "same"
            else:
                verdict = "rows only"
        except Exception as error:  # noqa: BLE001
            got, verdict = [], f"FAILED {type(error).__name__}: {str(error)[:600]}"
        bad += verdict not in ("same", "rows only")
        print(f"{name:24} {len(got):7} rows {time.time() - start:6.2f} s  {verdict}", flush=True)
    print("differences:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
