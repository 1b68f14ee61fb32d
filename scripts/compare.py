"""Run every registered query on Spark and its SQL on DuckDB; compare.

Usage: python scripts/compare.py [sf_dir] [name ...]
Rows are compared order-free after rounding doubles; prints one line per query.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from stratum.plans.oracle import oracle_sql  # noqa: E402
from stratum.plans.queries import queries  # noqa: E402
from stratum.session import get_spark  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].round(4)
    df = df.astype(object).where(pd.notnull(df), None).astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark("local[8]", "compare", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sql = oracle_sql()
    ok = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            s = fn(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {str(e)[:300]}")
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name}: rows={len(s)} (no oracle) {ts:.1f}s")
            continue
        try:
            d = con.execute(sql[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SQL ERROR {str(e)[:400]}")
            continue
        if sorted(s.columns) != sorted(d.columns):
            print(f"{name}: COLUMNS spark={sorted(s.columns)} sql={sorted(d.columns)}")
            continue
        a, b = norm(s), norm(d)
        same = len(a) == len(b) and a.equals(b)
        ok += same
        msg = "OK" if same else f"MISMATCH rows spark={len(a)} sql={len(b)}"
        if not same and len(a) == len(b):
            diff = (a != b).any(axis=1)
            msg += f" differing={int(diff.sum())}\n  spark: {a[diff].head(3).to_dict('records')}\n  sql:   {b[diff].head(3).to_dict('records')}"
        print(f"{name}: {msg} rows={len(s)} {ts:.1f}s", flush=True)
    print(f"{ok} matched")
    spark.stop()


if __name__ == "__main__":
    main()
