"""Compare every named query with its SQL in DuckDB: ``python tests/parity.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in a fixed order, missing values alike."""
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None)
    order = df.map(repr).sort_values(list(df.columns)).index
    return df.loc[order].reset_index(drop=True)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    left, right = canonical(spark_rows), canonical(sql_rows)
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} vs {list(right.columns)}"
    if len(left) != len(right):
        return f"{len(left)} vs {len(right)} rows"
    for name in left.columns:
        kinds = [{type(v).__name__ for v in side[name] if v is not None} for side in (left, right)]
        if kinds[0] != kinds[1]:
            return f"{name}: types {kinds[0]} vs {kinds[1]}"
    unequal = (left != right) & ~(left.isna() & right.isna())
    if unequal.any().any():
        row = unequal.any(axis=1).idxmax()
        return f"row {row}: {left.loc[row].to_dict()} vs {right.loc[row].to_dict()}"
    return None


def rows_of(df) -> pd.DataFrame:
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns, dtype=object)


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    cursor = con.execute(sql)
    return pd.DataFrame(
        cursor.fetchall(), columns=[c[0] for c in cursor.description], dtype=object
    )


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    import __spark_entry__ as contract
    from flightlens.session import build_session

    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            got = rows_of(query(spark, sf_dir))
            problem = differences(got, sql_rows(con, sql[name])) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001  (shown and counted)
            got, problem = [], f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:24s} {len(got):7d} rows {time.time() - began:6.2f}s  {problem or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
