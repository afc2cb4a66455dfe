"""Compare one query with its SQL twin, value by value."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(rows, columns, wanted):
    order = [columns.index(c) for c in wanted]
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    relation = con.sql(sql)
    ours, theirs = spark_df.columns, relation.columns
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} and {sorted(theirs)}"
    wanted = sorted(ours)
    left = normal([tuple(r) for r in spark_df.collect()], ours, wanted)
    right = normal(relation.fetchall(), theirs, wanted)
    if len(left) != len(right):
        return f"{len(left)} rows and {len(right)}"
    for a, b in zip(left, right):
        if repr(a) != repr(b):  # so that -0.0 is not 0.0
            return f"{a} and {b}"
    return None
