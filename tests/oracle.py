"""Side-by-side comparison of a query and its SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "tzinfo") and v is not None and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of_sql(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(_plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)


def rows_of_df(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(r[c]) for c in names) for r in df.collect()), key=repr)


def compare(spark, query, sql: str, sf_dir: str) -> None:
    an, a = rows_of_df(query(spark, sf_dir))
    bn, b = rows_of_sql(sql, sf_dir)
    assert an == bn, (an, bn)
    in_a, in_b = set(a), set(b)
    only_a, only_b = [x for x in a if x not in in_b][:3], [x for x in b if x not in in_a][:3]
    assert a == b, f"{len(a)} and {len(b)} rows; only the query: {only_a}; only SQL: {only_b}"
