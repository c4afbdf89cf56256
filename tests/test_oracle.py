"""Every registered query against its DuckDB oracle on the smallest driver tables.

Both sides round doubles to 6 places in the query text; values are compared exactly,
order-insensitively, after sorting columns by name (as the driver does).
"""

import math

import duckdb
import pandas as pd
import pytest

from conftest import SF_SMALL
from panelkit.plans.registry import oracle_sql, queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

QUERIES = queries()
ORACLE = oracle_sql()


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else v
    if hasattr(v, "item"):
        return _norm(v.item())
    if type(v).__name__ in ("date", "datetime", "Timestamp"):
        return str(v)[:10]
    return v


def _canon(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_model_based():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"model_fit_run"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    got = QUERIES[key](spark, SF_SMALL).toPandas()
    exp = con.execute(ORACLE[key]).fetchdf()
    assert _canon(got) == _canon(exp)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_model_queries_run(spark, key):
    assert QUERIES[key](spark, SF_SMALL).count() > 0
