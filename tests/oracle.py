"""Run a registered query in Spark and its SQL in DuckDB, and compare the row multisets."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def rows(table) -> Counter:
    table = table.select(sorted(table.column_names))
    return Counter(zip(*[c.to_pylist() for c in table.columns])) if table.num_columns else Counter()


def kinds(table) -> dict[str, str]:
    return {n: str(table.schema.field(n).type) for n in sorted(table.column_names)}


def difference(spark, sf_dir: str, query, sql: str, con) -> str:
    """Empty when equal, otherwise a short account of what differs."""
    got = query(spark, sf_dir).toArrow()
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} / {sorted(want.column_names)}"
    note = "" if kinds(got) == kinds(want) else f"types {kinds(got)} / {kinds(want)}; "
    a, b = rows(got), rows(want)
    if a == b:
        return note
    return note + f"rows {sum(a.values())}/{sum(b.values())}; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}"
