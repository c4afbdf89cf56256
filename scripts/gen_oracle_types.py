"""Record the DOUBLE output columns of every oracle query (DuckDB DESCRIBE, binding only).

Writes panelkit/plans/oracle_doubles.json, used to round oracle doubles like the Spark side.
Usage: python scripts/gen_oracle_types.py [sf_dir]
"""
from __future__ import annotations

import json
import sys

import duckdb

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from panelkit.plans.registry import _TYPES_FILE, oracle_sql  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    out = {}
    for k, sql in sorted(oracle_sql(raw=True).items()):
        rows = con.execute(f"DESCRIBE {sql}").fetchall()
        out[k] = [r[0] for r in rows if r[1] in ("DOUBLE", "FLOAT")]
    _TYPES_FILE.write_text(json.dumps(out, indent=1, sort_keys=True) + "\n")
    print(f"wrote {_TYPES_FILE} ({len(out)} queries)")


if __name__ == "__main__":
    main()
