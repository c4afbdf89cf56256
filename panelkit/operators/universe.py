"""Listing / delisting universe.

Interval joins are equi-joins on the firm or company key with a residual range
predicate; Spark plans them as hash or sort-merge joins (AQE broadcasts a side that is
small at run time and splits skewed keys); events and intervals meet in a dyadic index over
days, so a key with many of both forms no quadratic number of pairs. "First row per firm" is a
hash aggregate of the order column, then a rank among the rows that reach the extreme.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from panelkit.functions import cleaning as C
from panelkit.functions.scalar import add_years, coalesce_pref
from panelkit.operators.intervals import date_interval_join, days_of
from panelkit.operators.ordered import _ORDERABLE


#: First and last date that there is, and log2 of the days of a leaf for windows of years.
DATES = ("0001-01-01", "9999-12-31")
YEARS_LEAF = 8

_PRIMITIVE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             descending: bool = False) -> DataFrame:
    """One row per key: the first in ``order`` (ascending, nulls last) or the last
    (``descending``: descending, nulls last). Remaining columns break ties, in column
    order and in the same direction, so the pick is deterministic.

    The extreme of the first order column is a hash aggregate (fixed-width values are
    combined on the map side without sorting); it selects the few rows per key that can
    win, and only among those ties are ranked.
    """
    keys, order = list(keys), list(order)
    tiebreak = [f.name for f in df.schema.fields
                if f.name not in keys and f.name not in order and isinstance(f.dataType, _ORDERABLE)]
    rows = df
    if isinstance(df.schema[order[0]].dataType, _PRIMITIVE):
        extreme = (F.max if descending else F.min)(order[0])
        best = df.groupBy(*keys).agg(extreme.alias("_best"))
        best = best.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
        cond = df[order[0]].eqNullSafe(best["_best"])
        for i, k in enumerate(keys):
            cond = cond & df[k].eqNullSafe(best[f"_k{i}"])
        rows = df.join(best, cond, "left_semi")
    by = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in order + tiebreak]
    # row_number() = 1 keeps one row per key already before the shuffle (window group limit)
    return (rows.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*by)))
            .filter("_rn = 1").drop("_rn").select(*df.columns))


def link_join(company: DataFrame, link: DataFrame, how: str = "left") -> DataFrame:
    """Company -> link on gvkey; link restricted to accepted types and primacy first."""
    lk = link.filter(F.col("linktype").isin(*C.LINK_TYPES) & F.col("linkprim").isin(*C.LINK_PRIMS))
    return company.join(lk, on="gvkey", how=how)


def valid_on(names: DataFrame, date_col, open_start: bool = False):
    """Predicate: the names row is valid on ``date_col`` (null end = still open)."""
    start_ok = F.col("namedt") <= date_col
    if open_start:
        start_ok = F.col("namedt").isNull() | start_ok
    return start_ok & (F.col("nameenddt").isNull() | (F.col("nameenddt") >= date_col))


def year_buckets(df: DataFrame, start: str, end: str, lo: int, hi: int, out: str = "_yb") -> DataFrame:
    """Rows repeated once per calendar year that [start, end] covers between the years ``lo``
    and ``hi`` (null ends are open). Dates outside those years have no bucket."""
    first = F.greatest(F.coalesce(F.year(start), F.lit(lo)), F.lit(lo))
    last = F.least(F.coalesce(F.year(end), F.lit(hi)), F.lit(hi))
    return df.withColumn("_s", first).withColumn("_e", last).filter("_s <= _e").withColumn(
        out, F.explode(F.sequence("_s", "_e"))).drop("_s", "_e")


def year_range(df: DataFrame, date_col: str) -> tuple[int, int] | None:
    """First and last calendar year of a date column (one aggregate of one column)."""
    r = df.agg(F.min(F.year(date_col)).alias("lo"), F.max(F.year(date_col)).alias("hi")).first()
    return None if r["lo"] is None else (int(r["lo"]), int(r["hi"]))


def _validity_join(events, names, date_col, key, names_key, how, open_start, bucketed, years=None):
    if bucketed:
        days = years and days_of(f"{years[0]:04d}-01-01", f"{years[1]:04d}-12-31")
        return date_interval_join(events, names, date_col, key, names_key, "namedt", "nameenddt", how,
                                  open_start, days)
    n = names.withColumnRenamed(names_key, "_nk")
    cond = (F.col(key) == F.col("_nk")) & valid_on(n, F.col(date_col), open_start=open_start)
    return events.join(n, cond, how).drop("_nk")


def validity_join_left(events: DataFrame, names: DataFrame, date_col: str,
                       key: str = "permno", names_key: str = "permno",
                       bucketed: bool = True, years: tuple[int, int] | None = None) -> DataFrame:
    """Attach the names row valid on the event date (LEFT; namedt must be known).

    ``bucketed`` joins by the dyadic index of :mod:`panelkit.operators.intervals`, so pairs
    are formed only where an interval holds a date, also for keys with many events *and* many
    intervals. ``years`` gives the events' first and last year if they are known; otherwise
    one aggregate finds them. Same result without.
    """
    return _validity_join(events, names, date_col, key, names_key, "left", False, bucketed, years)


def validity_join_inner(events: DataFrame, names: DataFrame, date_col: str, key: str = "permno",
                        bucketed: bool = True, years: tuple[int, int] | None = None) -> DataFrame:
    """Event x names row, null-open at both ends (INNER); ``bucketed`` as in J2."""
    return _validity_join(events, names, date_col, key, key, "inner", True, bucketed, years)


def _years_of(start: str, end: str) -> tuple[int, int]:
    return int(str(start)[:4]), int(str(end)[:4])


def ipo_from_names(names: DataFrame, exchange: str | None, start: str, end: str) -> DataFrame:
    """Earliest names row per firm among ordinary shares on the chosen exchanges,
    then (outside the dedupe) the IPO date range; ordered by IPO date."""
    n = C.exchange_filter(C.share_class_filter(names), exchange)
    first = first_by(n.select("permno", "comnam", "ticker", F.col("namedt").alias("ipo_date"),
                              "exchcd", "shrcd"), ["permno"], ["ipo_date"])
    return C.date_range_filter(first, "ipo_date", start, end)


def ipo_from_company(company: DataFrame, link: DataFrame, names: DataFrame,
                     exchange: str | None, start: str, end: str) -> DataFrame:
    """Company IPO date + link + name valid on that date; date range *before* the
    dedupe; one row per firm, earliest IPO date first."""
    c = C.date_range_filter(C.not_null_filter(company, "ipodate"), "ipodate", start, end)
    linked = link_join(c, link, "left")
    n = names.select(F.col("permno").alias("_np"), "namedt", "nameenddt",
                     F.col("ticker").alias("_ticker"), "exchcd", "shrcd", F.col("permno"))
    # The WHERE on the names side turns the LEFT joins into inner ones (trap T5).
    j = _validity_join(linked, n, "ipodate", "lpermno", "_np", "inner", False, True, _years_of(start, end))
    j = C.exchange_filter(C.share_class_filter(j), exchange)
    rows = j.select("gvkey", F.col("conm").alias("comnam"), F.col("_ticker").alias("ticker"),
                    F.col("ipodate").alias("ipo_date"), "exchcd", "shrcd", "permno")
    return first_by(rows, ["permno"], ["ipo_date"])


def delist_latest(delist_events: DataFrame, names: DataFrame, exchange: str | None,
                  start: str, end: str) -> DataFrame:
    """Delistings in the date range (filtered first), names valid on the date,
    ordinary shares on the chosen exchanges, latest delisting per firm."""
    d = C.date_range_filter(delist_events.select("permno", "dlstdt", "dlstcd"), "dlstdt", start, end)
    j = validity_join_inner(d, names, "dlstdt", years=_years_of(start, end))
    j = C.exchange_filter(C.share_class_filter(j), exchange)
    rows = j.select("permno", "comnam", "ticker", F.col("dlstdt").alias("delist_date"),
                    "exchcd", "shrcd", "dlstcd")
    return first_by(rows, ["permno"], ["delist_date"], descending=True)


def delist_within_years(ipo_df: DataFrame, delist_df: DataFrame, years: int = 5,
                        ordered: bool = True) -> DataFrame:
    """Firms delisted within ``years`` calendar years after the IPO.

    Inner join on permno (no uniqueness enforced: trap T6); name and ticker prefer the
    IPO side; keep ipo <= delist <= ipo + years; ordered by ipo date, delist date, permno
    (``ordered=False`` skips the global sort when the result only feeds a join). IPO windows
    and delistings meet in the dyadic index, so a firm with many of both forms no pairs
    beyond those that overlap (up to a leaf of 256 days).
    """
    i = C.standardize_ipo(ipo_df)
    d = C.standardize_delist(delist_df)
    i = i.filter(F.col("ipo_date").isNotNull()).withColumn("_last", add_years("ipo_date", years))
    i = i.withColumnRenamed("permno", "_firm")
    m = date_interval_join(d, i, "delist_date", "permno", "_firm", "ipo_date", "_last",
                           days=days_of(*DATES), leaf=YEARS_LEAF, span=366 * years).drop("_last")
    out = [F.col("permno"), coalesce_pref("comnam", "comnam_delist").alias("comnam"),
           coalesce_pref("ticker", "ticker_delist").alias("ticker"), F.col("ipo_date"),
           F.col("delist_date")]
    out += [F.col(c) for c in ("exchcd", "shrcd") if c in m.columns]
    res = m.select(*out)
    return res.orderBy("ipo_date", "delist_date", "permno") if ordered else res
