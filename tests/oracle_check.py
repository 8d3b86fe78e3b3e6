"""Run every registered query in Spark and its SQL oracle in DuckDB, compare.

Comparison: same column names, same row count, same multiset of rows after
normalising values (doubles to 6 decimals, ints and floats compared as
numbers, NaN as null). Usable from pytest and from the command line:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import numpy as np
        if isinstance(v, np.generic):
            v = v.item()
    except ImportError:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return ("n", round(v, 6) + 0.0)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", float(v))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return ("s", str(v))


def _rows(pdf, cols):
    import pandas as pd
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (not isinstance(x, (list, tuple)) and not hasattr(x, "__len__") and pd.isna(x)) else x)
                         for x in rec))
    return sorted(out, key=repr)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    du = con.execute(sql).df()
    if sorted(sp.columns) != sorted(du.columns):
        return False, f"columns differ: spark={list(sp.columns)} duck={list(du.columns)}"
    if len(sp) != len(du):
        return False, f"row count spark={len(sp)} duck={len(du)}"
    cols = sorted(sp.columns)
    a, b = _rows(sp, cols), _rows(du, cols)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(sp)} rows, spark {t1 - t0:.1f}s"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    from flurry.session import get_session
    import __spark_entry__ as ent
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, orc = ent.queries(), ent.oracle_sql()
    con = duck(sf_dir)
    fails = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in orc:
            n = fn(spark, sf_dir).count()
            print(f"  --   {name}: no oracle, {n} rows")
            continue
        try:
            ok, msg = compare(spark, con, name, fn, orc[name], sf_dir)
        except Exception as e:  # report and keep going
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:300]}"
        fails += not ok
        print(f"  {'ok' if ok else 'FAIL'} {name}: {msg}", flush=True)
    print(f"{fails} failing")
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
