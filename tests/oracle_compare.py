"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per key: status, rows (spark / duckdb), seconds.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


STRICT = "--strict" in sys.argv


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v + 0.0) if STRICT else repr(round(v, 9) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha1("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, keys=None, con=None, verbose=True) -> dict:
    import __spark_entry__ as entry
    qs, sql = entry.queries(), entry.oracle_sql()
    con = con or duck(sf_dir)
    results = {}
    for key in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[key](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            n_s, h_s = digest(cols, rows)
        except Exception as exc:  # noqa: BLE001
            results[key] = ("SPARK_ERROR", str(exc)[:300])
            if verbose:
                print(f"{key:24s} SPARK_ERROR {str(exc)[:300]}", flush=True)
            continue
        ts = time.time() - t0
        if key not in sql:
            results[key] = ("ROWS_ONLY", n_s)
            if verbose:
                print(f"{key:24s} ROWS_ONLY  spark={n_s} {ts:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(sql[key])
            dcols = list(rel.columns)
            drows = rel.fetchall()
            n_d, h_d = digest(dcols, drows)
        except Exception as exc:  # noqa: BLE001
            results[key] = ("SQL_ERROR", str(exc)[:300])
            if verbose:
                print(f"{key:24s} SQL_ERROR {str(exc)[:300]}", flush=True)
            continue
        ok_cols = sorted(cols) == sorted(dcols)
        status = "OK" if (ok_cols and n_s == n_d and h_s == h_d) else "MISMATCH"
        results[key] = (status, n_s, n_d, ok_cols)
        if verbose:
            extra = "" if ok_cols else f" cols spark={sorted(cols)} duck={sorted(dcols)}"
            print(f"{key:24s} {status:9s} spark={n_s} duck={n_d} {ts:.1f}s{extra}", flush=True)
    return results


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if a not in ("--vanilla", "--strict")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or None
    if "--vanilla" in sys.argv:
        # A plain session, as a caller that knows nothing of encore's defaults builds it.
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        from encore.session import get_session
        spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, keys)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    print("SUMMARY", len(res), "keys,", len(bad), "not ok:", sorted(bad))
