"""Developer tool: run registered queries in Spark and their oracle SQL in
DuckDB on the same parquet, compare rows/columns/values.

usage: python tools_oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from clickfeat.plans.registry import ORACLE, QUERIES, load_all
from clickfeat.session import get_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


# Values are compared exactly (doubles bit for bit); CHECK_ROUND=<places> loosens it.
ROUND = int(os.environ["CHECK_ROUND"]) if os.environ.get("CHECK_ROUND") else None


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return (round(v, ROUND) if ROUND is not None else v) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name: str, sf_dir: str):
    """(ok, message) for one registered query against its oracle SQL."""
    sdf = QUERIES[name](spark, sf_dir)
    rows, cols = sdf.collect(), sdf.columns
    if name not in ORACLE:
        return True, f"{len(rows)} rows (no oracle)"
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(cols) != sorted(dcols):
        return False, f"columns spark={cols} duck={dcols}"
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = sorted((tuple(norm(r[i]) for i in si) for r in rows), key=repr)
    b = sorted((tuple(norm(r[i]) for i in di) for r in drows), key=repr)
    if a == b:
        return True, f"{len(a)} rows"
    sa, sb = set(a), set(b)
    return False, (f"spark {len(a)} rows, duck {len(b)} rows; only-spark {list(sa - sb)[:3]} "
                   f"only-duck {list(sb - sa)[:3]}")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    load_all()
    spark = get_session("local[8]", shuffle_partitions=int(os.environ.get("CHECK_SHUFFLE_PARTITIONS", "8")))
    con = duck(sf_dir)
    bad = 0
    for name in (names or sorted(QUERIES)):
        t0 = time.time()
        try:
            ok, msg = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:400]}"
        tag = "OK  " if ok and name in ORACLE else ("ROWS" if ok else "FAIL")
        print(f"{tag} {name}: {msg} {time.time() - t0:.1f}s")
        bad += 0 if ok else 1
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
