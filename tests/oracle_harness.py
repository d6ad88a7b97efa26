"""Run registered Spark queries and their DuckDB oracle side by side.

Mirrors the driver's check: same column names, same row count, and the same
multiset of rows after normalising values (floats rounded, columns sorted by
name).  Usable from pytest and as a script:

    python -m tests.oracle_harness [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 4):.4f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 4):.4f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows)


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return cols, sorted(rows)


def compare(spark, sf_dir, names=None, verbose=True):
    from editsurge.plans.registry import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            scols, srows = spark_rows(qs[name](spark, sf_dir))
        except Exception as exc:  # noqa: BLE001
            results[name] = ("spark-error", repr(exc)[:400])
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", f"{len(srows)} rows {t1 - t0:.1f}s")
            if verbose:
                print(name, *results[name], flush=True)
            continue
        try:
            dcols, drows = duck_rows(con, sqls[name])
        except Exception as exc:  # noqa: BLE001
            results[name] = ("sql-error", repr(exc)[:400])
            continue
        if scols != dcols:
            results[name] = ("columns", f"spark={scols} duck={dcols}")
        elif len(srows) != len(drows):
            results[name] = ("rowcount", f"spark={len(srows)} duck={len(drows)}")
        elif srows != drows:
            diff = [(a, b) for a, b in zip(srows, drows) if a != b][:3]
            results[name] = ("values", f"{len(srows)} rows; first diffs {diff}")
        else:
            results[name] = ("ok", f"{len(srows)} rows {t1 - t0:.1f}s")
        if verbose:
            print(name, *results[name], flush=True)
    return results


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from editsurge.session import get_spark
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or None
    # ORACLE_TZ / ORACLE_ANSI / ORACLE_PARTITIONS emulate a differently
    # configured driver session (results must not depend on them).
    import os as _os
    extra = {}
    if _os.environ.get("ORACLE_TZ"):
        extra["spark.sql.session.timeZone"] = _os.environ["ORACLE_TZ"]
    if _os.environ.get("ORACLE_ANSI"):
        extra["spark.sql.ansi.enabled"] = _os.environ["ORACLE_ANSI"]
    spark = get_spark("local[8]", shuffle_partitions=int(_os.environ.get("ORACLE_PARTITIONS", "8")), extra=extra)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    print(f"SUMMARY ok={sum(v[0] == 'ok' for v in res.values())} rows-only={sum(v[0] == 'rows-only' for v in res.values())} bad={len(bad)}")
    for k, v in bad.items():
        print("BAD", k, *v)
