"""Run registered queries beside their SQL and compare rows as multisets.

    python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if value is None:
        return None
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, build, sql, folder) -> str | None:
    df = build(spark, folder)
    got = rows_of(df.columns, (tuple(r) for r in df.collect()))
    if sql is None:
        return None if sum(got.values()) else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if got != want:
        return (
            f"rows {sum(got.values())} / {sum(want.values())}; "
            f"only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
        )
    return None if got else "no rows on both sides"


def main(folder: str, names: list[str]) -> int:
    from tablemill.queries import ORACLES, QUERIES
    from tablemill.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, build in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, build, ORACLES.get(name), folder)
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name} ({kind}) {time.time() - start:.2f}s", problem or "", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
