"""Run registered queries and their DuckDB oracles side by side (like the driver's check).

Usage: python scripts/check_oracle.py [sf_dir] [key-substring ...]
"""
from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from panelkit.plans.registry import oracle_sql, queries  # noqa: E402
from panelkit.session import get_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v) or v.is_integer():
            return v if math.isinf(v) else int(v)
        return v  # both sides already round to 6 places in the query text
    if hasattr(v, "isoformat"):
        return str(v)[:10] if type(v).__name__ in ("date", "Timestamp", "datetime") else str(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    import os
    extra = dict(kv.split("=", 1) for kv in os.environ.get("CHECK_CONF", "").split(",") if kv)
    spark = get_session("local[8]", shuffle_partitions=8, conf=extra)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sq = queries(), oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if pats and not any(p in k for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sq:
            print(f"{k:32s} rows={len(sdf):7d} (no oracle) {ts:5.1f}s")
            continue
        try:
            odf = con.execute(sq[k]).fetchdf()
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} SQL ERROR {str(e)[:300]}")
            bad += 1
            continue
        sc, sr = canon(sdf)
        oc, orr = canon(odf)
        ok = sc == oc and sr == orr
        msg = "OK " if ok else "MISMATCH"
        extra = ""
        if not ok:
            bad += 1
            if sc != oc:
                extra = f" cols spark={sc} oracle={oc}"
            else:
                diff = [(a, b) for a, b in zip(sr, orr) if a != b][:2]
                extra = f" rows {len(sr)} vs {len(orr)}; first diffs {diff}"
        print(f"{k:32s} {msg} rows={len(sdf):7d} {ts:5.1f}s{extra[:600]}")
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
