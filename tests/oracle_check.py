"""Comparing a Spark result with DuckDB's on the same tables."""

import glob
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def differences(spark_df, con, sql: str, tolerance: float = 0.0) -> list[str]:
    """What differs, as text; empty when schema names, row count and all values agree."""
    cursor = con.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    theirs = canonical(cursor.fetchall(), theirs_columns)
    ours = canonical([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if sorted(spark_df.columns) != sorted(theirs_columns):
        return [f"columns {sorted(spark_df.columns)} / {sorted(theirs_columns)}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} / {len(theirs)}"]
    names = sorted(spark_df.columns)
    found = []
    for a, b in zip(ours, theirs):
        for name, x, y in zip(names, a, b):
            same = x == y and type(x) is type(y)
            if not same and isinstance(x, float) and isinstance(y, float):
                same = abs(x - y) <= tolerance
            if not same:
                found.append(f"{name}: {x!r} / {y!r}")
    return found
