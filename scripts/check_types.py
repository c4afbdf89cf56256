"""Compare each query's Spark output types with its DuckDB oracle's types (no execution).

Usage: python scripts/check_types.py [sf_dir]
"""
from __future__ import annotations

import sys

import duckdb

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from panelkit.plans.registry import oracle_sql, queries  # noqa: E402
from panelkit.session import get_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
                 "StringType": "VARCHAR", "DateType": "DATE", "BooleanType": "BOOLEAN",
                 "FloatType": "FLOAT", "ShortType": "SMALLINT", "ByteType": "TINYINT"}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[4]", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sq = queries(), oracle_sql()
    bad = 0
    for k in sorted(sq):
        st = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
              for f in qs[k](spark, sf).schema.fields}
        dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sq[k]}").fetchall()}
        diff = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
        if diff:
            bad += 1
            print(f"{k:30s} {diff}")
    print("types differ in", bad, "queries")


if __name__ == "__main__":
    main()
