"""python tests/oracle.py SF_DIR [NAME...]: compares queries with their SQL in DuckDB, as rows with columns sorted by name."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings law_norms law_versions law_version_blocks law_source_objects feedback_reports projection_removals eval_items size_limits".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if type(v).__name__ == "Decimal":
        return int(v) if v == int(v) else float(f"{float(v):.9g}")
    return v


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(plain(r.asDict(True)[c]) for c in cols) for r in df.collect())


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    at = [names.index(c) for c in sorted(names)]
    return sorted(names), Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall())


def main(args: list[str]) -> int:
    import __spark_entry__ as e
    from strataq.session import local_session

    spark = local_session("oracle", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(args[0]), 0
    qs, sqls = e.queries(), e.oracle_sql()
    for name in args[1:] or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, args[0])
            got = spark_rows(df)
            took = time.time() - t
            if name not in sqls:
                print(f"{name}: {sum(got[1].values())} rows, no SQL, {took:.1f} s", flush=True)
                continue
            t = time.time()
            want = sql_rows(con, sqls[name])
            ok = got == want
            print(f"{name}: {'ok' if ok else 'DIFFERS'} {sum(got[1].values())} rows, {took:.1f} s, sql {time.time() - t:.1f} s", flush=True)
            if not ok:
                bad += 1
                print("  columns", got[0], want[0])
                print("  only spark", sum((got[1] - want[1]).values()), list(got[1] - want[1])[:4])
                print("  only sql  ", sum((want[1] - got[1]).values()), list(want[1] - got[1])[:4])
        except Exception as x:
            bad += 1
            print(f"{name}: FAILED {str(x)[:600]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
