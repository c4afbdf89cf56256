"""Registered queries: one Spark plan and one DuckDB oracle per SURVEY section-2 key.

Every query reads the driver tables through the proxies in
:mod:`panelkit.sources.fixtures`, so its work grows with the tables. Doubles are rounded
to 6 decimals on both sides before comparison; dates are DATE on both sides.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.sources import fixtures as fx
from panelkit.sources.fixtures import with_proxies as W_

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Job parameters shared by the universe queries.
START, END, EXCHANGE = "1995-01-01", "2000-12-31", ""


def _round6(c, places: int = 6):
    r = F.round(c, places)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)  # -0.0 -> 0.0


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round double columns (and fold -0.0 into 0.0) for a stable comparison."""
    return df.select(*[_round6(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = lambda spark, d, _fn=fn: rounded(_fn(spark, d.rstrip("/")))
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def _load_all():
    # Import for side effects: each module registers its queries.
    from panelkit.plans import (q_universe, q_panel, q_labels, q_features,  # noqa: F401
                                q_split, q_profile, q_ml)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


_TYPES_FILE = Path(__file__).with_name("oracle_doubles.json")


def _round_wrap(sql: str, doubles: list[str]) -> str:
    """Round the oracle's DOUBLE columns exactly like :func:`rounded` on the Spark side."""
    if not doubles:
        return sql
    reps = ", ".join(f'CASE WHEN ROUND("{c}", 6) = 0 THEN 0.0 ELSE ROUND("{c}", 6) END AS "{c}"'
                     for c in doubles)
    return f"SELECT * REPLACE ({reps}) FROM ({sql}) AS _oracle"


def oracle_sql(raw: bool = False) -> dict[str, str]:
    _load_all()
    if raw:
        return dict(ORACLE)
    doubles = json.loads(_TYPES_FILE.read_text()) if _TYPES_FILE.exists() else {}
    return {k: _round_wrap(v, doubles.get(k, [])) for k, v in ORACLE.items()}


__all__ = ["QUERIES", "ORACLE", "register", "W_", "fx", "START", "END", "EXCHANGE",
           "queries", "oracle_sql", "rounded"]
