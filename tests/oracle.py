"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, list | tuple):
        return tuple(_norm(x) for x in v)
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _typed(v):
    return type(v).__name__


def compare(df, con, sql: str) -> list[str]:
    """Differences as texts; empty when columns and rows agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    order = sorted(names)
    want = [tuple(_norm(r[names.index(n)]) for n in order) for r in cur.fetchall()]
    got = [tuple(_norm(r[n]) for n in order) for r in df.collect()]
    out = []
    types = lambda rows: [{_typed(v) for v in col if v is not None} for col in zip(*rows)] if rows else []
    for n, a, b in zip(order, types(got), types(want)):
        if a != b and a and b:
            out.append(f"type of {n}: {a} != {b}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    a, b = Counter(got), Counter(want)
    if a != b:
        extra, missing = list((a - b).items())[:2], list((b - a).items())[:2]
        out.append(f"{order}\n  only spark {extra}\n  only sql   {missing}\n  differing {sum((a - b).values())}")
    return out


if __name__ == "__main__":
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from wardline.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    con = duck(sf)
    qs, os_ = e.queries(), e.oracle_sql()
    wanted = sys.argv[1:] or list(qs)
    bad = 0
    for name in wanted:
        t = time.time()
        try:
            df = qs[name](spark, sf)
            if name in os_:
                diff = compare(df, con, os_[name])
            else:
                diff, n = [], df.count()
                print(f"  (no sql) rows={n}")
            n = df.count() if os.environ.get("COUNT") else ""
        except Exception as ex:  # noqa: BLE001
            diff = [f"{type(ex).__name__}: {str(ex)[:1500]}"]
        bad += bool(diff)
        print(("ok  " if not diff else "BAD ") + f"{name} {n if not diff else ''} {time.time() - t:.1f}s", flush=True)
        for x in diff:
            print("   ", x[:3000])
    print("queries", len(wanted), "bad", bad)
