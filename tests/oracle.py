"""Runs registered queries beside their SQL and compares the results."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def database(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    for types, name in (
        (int, "int"), (float, "float"), (decimal.Decimal, "decimal"), (str, "str"), (dt.datetime, "timestamp"),
        (dt.date, "date"), (list, "list"), (dict, "map"),
    ):
        if isinstance(value, types):
            return name
    return type(value).__name__


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(value, float):
        return repr(value)
    return f"{kind(value)}:{value}"


def rows_of(records: list[dict]) -> list[tuple]:
    return sorted(tuple((k, plain(r[k])) for k in sorted(r)) for r in records)


def compare(spark_df, con, sql_text: str) -> tuple[str | None, int]:
    """First difference between the two results, and the number of rows."""
    ours = spark_df.toArrow().to_pylist()
    result = con.execute(sql_text)
    names = [d[0] for d in result.description]
    theirs = [dict(zip(names, row, strict=True)) for row in result.fetchall()]
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}", len(ours)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows", len(ours)
    a, b = rows_of(ours), rows_of(theirs)
    for x, y in zip(a, b, strict=True):
        if x != y:
            diff = [(p, q) for p, q in zip(x, y, strict=True) if p != q]
            return f"row differs: {diff[:4]} in {x[:3]}", len(ours)
    return None, len(ours)


def data_dir(sf: str) -> str | None:
    path = os.path.join(os.environ.get("TESTDATA", "/root/testdata"), f"sf{sf}")
    return path if glob.glob(f"{path}/*.parquet") else None
