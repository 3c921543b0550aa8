"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import glob
import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date()
    return value


def rows_by_name(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement; empty when nothing does."""
    relation = con.sql(sql)
    found = []
    spark_types = {n: DUCK_TYPES.get(t, t) for n, t in df.dtypes}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != duck_types:
        wrong = set(spark_types.items()) ^ set(duck_types.items())
        found.append(f"schema: {sorted(wrong)}")
    ours = rows_by_name(df.columns, df.collect())
    theirs = rows_by_name(relation.columns, con.execute(sql).fetchall())
    if ours != theirs:
        found.append(
            f"rows: {sum(ours.values())} and {sum(theirs.values())}, "
            f"only here {list((ours - theirs).items())[:2]}, "
            f"only there {list((theirs - ours).items())[:2]}"
        )
    return found
