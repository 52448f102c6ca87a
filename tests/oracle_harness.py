"""Run registered Spark queries and their DuckDB oracles side by side.

Mirrors the driver's check: row count, column names, and an order-insensitive
hash of the values (floats rounded to 9 decimals).
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).fetchdf()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not isinstance(v, str)):
        return tuple(_norm(x) for x in (v.tolist() if hasattr(v, "tolist") else v))
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return v


def digest(df: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.to_dict("records"))
    return len(df), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, name, qfn, sql, sf_dir):
    t = time.time()
    sdf = qfn(spark, sf_dir).toPandas()
    ts = time.time() - t
    t = time.time()
    ddf = duck(sql, sf_dir)
    td = time.time() - t
    a, b = digest(sdf), digest(ddf)
    ok = a == b
    return ok, ts, td, a, b, sdf, ddf


def main(names=None, sf_dir="/root/testdata/sf0.01"):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from msgsift.session import get_spark

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus), extra={"spark.driver.memory": "16g"})
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in os_:
            t = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"{name:32s} rows-only {n} rows {time.time()-t:.1f}s", flush=True)
            continue
        try:
            ok, ts, td, a, b, sdf, ddf = compare(spark, name, qs[name], os_[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad += 1
            continue
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows {a[0]}/{b[0]} spark {ts:.1f}s duck {td:.1f}s", flush=True)
        if not ok:
            bad += 1
            if a[1] != b[1]:
                print("   cols", a[1], b[1])
            else:
                m = sdf.merge(ddf, how="outer", indicator=True)
                print(m[m["_merge"] != "both"].head(6).to_string()[:1500])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:] or None) else 0)
