"""Runs registered queries and their SQL side by side and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if x is None or isinstance(x, (bool, str)):
        return x
    return float(x) if type(x).__name__ == "Decimal" else x


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def difference(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """What differs, or None."""
    got = run(spark, sf_dir)
    a = rows_of(got.columns, got.collect())
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    b = rows_of(names, want.fetchall())
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} and {sorted(names)}"
    if a != b:
        only_a, only_b = [x for x in a if x not in b[:2000]][:3], [x for x in b if x not in a[:2000]][:3]
        return f"{len(a)} rows and {len(b)}; {only_a} against {only_b}"
    return None
