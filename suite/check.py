"""Compare every query with its oracle: python -m suite.check [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from pagecat.session import build

from .base import BASE, ORACLES, QUERIES


def norm(value):
    if isinstance(value, float):
        return f"{value:.6g}" if value == value else "nan"
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(norm(r[i]) for i in order) for r in rows])


def connect(sf_dir):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name):
    """None if equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None, len(got[1])
    cur = con.execute(ORACLES[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1])
    if got[1] != want[1]:
        only_got = [r for r in got[1] if r not in set(want[1])][:3]
        only_want = [r for r in want[1] if r not in set(got[1])][:3]
        return f"rows {len(got[1])} vs {len(want[1])}; only spark {only_got}; only sql {only_want}", len(got[1])
    return None, len(got[1])


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            diff, n = compare(spark, con, sf_dir, name)
        except Exception as err:
            diff, n = f"{type(err).__name__}: {str(err)[:1500]}", -1
        bad += diff is not None
        mark = "ok" if diff is None else "DIFF"
        kind = "" if name in ORACLES else " (no sql)"
        print(f"{mark} {name} {n} rows {time.time() - t0:.2f}s{kind}{' ' + diff if diff else ''}", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    from . import load_all

    load_all()
    sys.exit(1 if main(sys.argv[1:]) else 0)
