"""Compares a registered query with its SQL in DuckDB."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def cell(v) -> str:
    if v is None or str(v) in ("nan", "NaT", "<NA>"):
        return "NULL"
    if isinstance(v, bool) or type(v).__name__ == "bool":
        return str(int(v))
    if isinstance(v, float):
        return f"{v:.6f}" if math.isfinite(v) else str(v)
    return str(v)


def rows(df) -> list[tuple[str, ...]]:
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


def assert_same(df, con, sql: str) -> None:
    got, want = df.toPandas(), con.execute(sql).df()
    # Whole numbers with nulls are floats on Spark's side.
    want = want.astype({c: "float64" for c, kind in want.dtypes.items() if str(kind) == "Int64"})
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
