"""Queries: the firm-month panel fetch."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.operators import panel as P
from panelkit.operators.features import BUCKET_ROWS
from panelkit.plans.registry import W_, fx, register
from panelkit.sources.bucketed import FirmLayout, per_firm
from panelkit.sources.fallback import fallback_by_key, fallback_for_keys


def sources(spark, d) -> P.FactSources:
    v = fx.source_variants(spark, d)
    return P.FactSources(
        ratios=fx.ratios(spark, d), link=fx.link(spark, d),
        assets=[v["annual_b"], v["annual_c"]],
        revenue=[v["quarter_a"], v["quarter_b"]],
        liabilities=[v["annual_a"], v["annual_b"]],
        shares=[v["shares_a"], v["shares_b"]],
        price=[(v["annual_linked"], False), (v["annual_a"], True), (v["annual_b"], True)])


@fx.memo
def stages(spark, d):
    """The step-by-step fetch stages, each planned once per session (queries pick one)."""
    return P.panel_stages(fx.ipo(spark, d), sources(spark, d))


# --- oracle SQL for the fetch stage -------------------------------------------------------

_STD = "f.indfmt = 'INDL' AND f.datafmt = 'STD' AND f.popsrc = 'D' AND f.consol = 'C'"
_WIN = "{d} >= e.ipo_date AND {d} <= e.ipo_date + 1825"


def _facts(name, srcs, values, not_null=None):
    parts = []
    for i, (t, std) in enumerate(srcs):
        conds = [_STD] if std else []
        if not_null:
            conds.append(f'f."{not_null}" IS NOT NULL')
        where = ("WHERE " + " AND ".join(conds)) if conds else ""
        vals = ", ".join(f'f."{s}" AS {o}' for o, s in values.items())
        parts.append(
            f"SELECT l.lpermno AS permno, f.datadate, {vals}, {i} AS prio FROM {t} f "
            f"JOIN lk l ON f.gvkey = l.lg AND f.datadate >= l.linkdt "
            f"AND (l.linkenddt IS NULL OR f.datadate <= l.linkenddt) "
            f"JOIN ev e ON l.lpermno = e.permno AND {_WIN.format(d='f.datadate')} {where}")
    return _fallback(name, " UNION ALL ".join(parts))


def _fallback(name, union):
    return [(f"{name}_u", union),
            (name, f"SELECT u.* EXCLUDE (prio) FROM {name}_u u JOIN (SELECT permno, MIN(prio) AS p "
                   f"FROM {name}_u GROUP BY permno) m ON u.permno = m.permno AND u.prio = m.p")]


def growth_sql(cur, prev):
    return (f"CASE WHEN ({cur}) IS NULL OR ({prev}) IS NULL THEN NULL WHEN ({prev}) = 0 THEN "
            f"(CASE WHEN ({cur}) > 0 THEN CAST('inf' AS DOUBLE) WHEN ({cur}) < 0 THEN "
            f"CAST('-inf' AS DOUBLE) END) ELSE ({cur}) / ({prev}) - 1 END")


_PREV = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _initial_run_sql(src, period):
    return (f"SELECT s.* FROM {src} s JOIN (SELECT permno, per, "
            f"DENSE_RANK() OVER (PARTITION BY permno ORDER BY per) AS dr, "
            f"MIN(per) OVER (PARTITION BY permno) AS p0 FROM (SELECT DISTINCT permno, "
            f"{period.format(d='public_date')} AS per FROM {src}) t) r "
            f"ON s.permno = r.permno AND {period.format(d='s.public_date')} = r.per "
            "WHERE r.per - r.p0 = r.dr - 1 AND r.dr <= {limit}")


_YEAR = "YEAR({d})"
_QUARTER = "(YEAR({d}) * 4 + QUARTER({d}) - 1)"


@lru_cache(maxsize=None)
def _stage_ctes():
    ctes = [("ev", "SELECT permno, ipo_date FROM ipo"),
            ("lk", "SELECT gvkey AS lg, lpermno, linkdt, linkenddt FROM link "
                   "WHERE linktype IN ('LU', 'LC') AND linkprim IN ('P', 'C')"),
            ("st_window", "SELECT r.*, e.ipo_date FROM ratios r JOIN ev e ON r.permno = e.permno "
                          f"AND {_WIN.format(d='r.public_date')}")]
    ctes += _facts("assets", [("annual_b", True), ("annual_c", True)], {"total_assets": "at"}, "at")
    ctes.append(("st_assets", "SELECT w.*, a.total_assets FROM st_window w LEFT JOIN assets a "
                              "ON w.permno = a.permno AND w.public_date = a.datadate"))
    ctes += _facts("revenue", [("quarter_a", True), ("quarter_b", True)], {"revtq": "revtq"}, "revtq")
    ctes.append(("st_revenue", "SELECT s.*, q.revtq FROM st_assets s LEFT JOIN revenue q "
                               "ON s.permno = q.permno AND s.public_date = q.datadate"))
    ctes.append(("st_years", _initial_run_sql("st_revenue", _YEAR).format(limit=5)))
    ctes += _facts("price", [("annual_linked", False), ("annual_a", True), ("annual_b", True)],
                   {"prcc_c": "prcc_c", "pstk": "pstk"})
    ctes += _facts("liab", [("annual_a", True), ("annual_b", True)],
                   {"total_liabilities": "lt"}, "lt")
    sh = " UNION ALL ".join(
        f"SELECT m.permno, m.date AS datadate, m.shrout, {i} AS prio FROM {t} m JOIN ev e "
        f"ON m.permno = e.permno AND {_WIN.format(d='m.date')}"
        for i, t in enumerate(["shares_a", "shares_b"]))
    ctes += _fallback("shares", sh)
    ctes.append(("st_month_end", """SELECT s.*, p.prcc_c, p.pstk, l.total_liabilities, h.shrout
        FROM st_years s
        LEFT JOIN price p ON s.permno = p.permno AND LAST_DAY(s.public_date) = LAST_DAY(p.datadate)
        LEFT JOIN liab l ON s.permno = l.permno AND LAST_DAY(s.public_date) = LAST_DAY(l.datadate)
        LEFT JOIN shares h ON s.permno = h.permno AND LAST_DAY(s.public_date) = LAST_DAY(h.datadate)"""))
    ctes.append(("st_tobinq", """SELECT *, CASE WHEN prcc_c IS NULL OR shrout IS NULL
        OR total_assets IS NULL OR total_assets = 0 THEN NULL ELSE (shrout * 1000.0 * prcc_c / 1e6
        + COALESCE(pstk, 0.0) + COALESCE(total_liabilities, 0.0)) / total_assets END AS tobinq
        FROM st_month_end"""))
    ctes.append(("st_growth", f"""SELECT * EXCLUDE (pv_rev, pv_at),
        {growth_sql('revtq', 'pv_rev')} AS revenue_growth,
        {growth_sql('COALESCE(total_assets, pv_at)', 'pv_at')} AS total_asset_growth
        FROM (SELECT *, LAST_VALUE(revtq IGNORE NULLS) OVER w AS pv_rev,
              LAST_VALUE(total_assets IGNORE NULLS) OVER w AS pv_at FROM st_tobinq
              WINDOW w AS (PARTITION BY permno ORDER BY public_date {_PREV})) t"""))
    ctes.append(("st_attrs", "SELECT g.*, i.comnam, i.ticker, i.exchcd, i.shrcd, i.gvkey "
                             "FROM st_growth g LEFT JOIN ipo i ON g.permno = i.permno"))
    missing = [c for c in C.PANEL_COLUMNS if c in
               ("pe_op_basic", "pe_op_dil", "pe_exi", "pe_inc", "ptb", "bm", "curr_ratio",
                "at_turn", "inv_turn")]
    ctes.append(("st_panel", "SELECT *, " + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in missing)
                 + " FROM st_attrs"))
    return ctes


_PROXIES = ("ipo", "link", "ratios", "annual_b", "annual_c", "annual_a", "quarter_a",
            "quarter_b", "annual_linked", "shares_a", "shares_b")


def stage_sql(stage: str) -> str:
    return W_(f"SELECT * FROM st_{stage}", *_PROXIES, extra=_stage_ctes())


def _stage_query(key, stage):
    @register(key, stage_sql(stage))
    def q(spark, d):
        return stages(spark, d)[stage]
    q.__name__ = f"q_{key}"
    return q


for _key, _stage in [("event_window_join", "window"), ("exact_date_left_join", "assets"),
                     ("quarter_left_join", "revenue"), ("initial_run_years", "years"),
                     ("tobins_q", "tobinq"),
                     ("attach_event_attrs", "attrs")]:
    _stage_query(_key, _stage)


@fx.memo
def month_end_tables(spark, d):
    """Panel rows and month-end facts, written once by firm."""
    st = stages(spark, d)
    names = ["years", "price", "liab", "shares"]
    layout = FirmLayout.of([fx.ratios(spark, d), fx.source_variants(spark, d)["shares_b"]], rows_per_bucket=BUCKET_ROWS)
    return [layout.write(st[n], ["public_date" if n == "years" else "datadate"]) for n in names]


@register("month_end_left_join", stage_sql("month_end"))
def q_month_end_left_join(spark, d):
    """J8 over tables written by firm: no exchange in the joins."""
    return per_firm(P.join_month_end, *month_end_tables(spark, d))


@register("panel_build", stage_sql("panel"))
def q_panel_build(spark, d):
    """The whole fetch stage as planned for scale (one fact join, one fallback, two panel
    joins); the oracle is the step-by-step definition."""
    return P.build_panel(fx.ipo(spark, d), sources(spark, d))


@register("conform_columns", stage_sql("panel"))
def q_conform_columns(spark, d):
    return C.conform_columns(stages(spark, d)["attrs"])


@register("link_interval_join", W_(
    """SELECT f.*, l.lpermno AS permno FROM funda f JOIN link l ON f.gvkey = l.gvkey
    AND l.linktype IN ('LU', 'LC') AND l.linkprim IN ('P', 'C') AND f.datadate >= l.linkdt
    AND (f.datadate <= l.linkenddt OR l.linkenddt IS NULL)""", "funda", "link"))
def q_link_interval_join(spark, d):
    return P.link_interval_join(fx.funda(spark, d), fx.link(spark, d))


@register("fallback_by_key", W_(
    """SELECT u.* FROM facts_src u JOIN (SELECT permno, MIN(src) AS p FROM facts_src
    GROUP BY permno) m ON u.permno = m.permno AND u.src = m.p""", "facts_src"))
def q_fallback_by_key(spark, d):
    return fallback_by_key(fx.facts_by_source(spark, d), "permno")


@register("fallback_for_keys", W_(
    """SELECT u.* FROM facts_src u JOIN (SELECT permno, MIN(src) AS p FROM facts_src
    GROUP BY permno) m ON u.permno = m.permno AND u.src = m.p
    WHERE u.permno IN (SELECT permno FROM ipo WHERE exchcd = 1)""", "facts_src", "ipo"))
def q_fallback_for_keys(spark, d):
    """S4 for the firms of one exchange, later sources read only for firms still without rows."""
    return fallback_for_keys(fx.facts_by_source(spark, d), fx.ipo(spark, d).filter("exchcd = 1"), "permno")


@register("growth_over_nonnull", W_(
    f"""SELECT * EXCLUDE (pv), {growth_sql('revtq', 'pv')} AS revenue_growth FROM (
    SELECT *, LAST_VALUE(revtq IGNORE NULLS) OVER (PARTITION BY permno ORDER BY public_date
    {_PREV}) AS pv FROM panel) t""", "panel"))
def q_growth_over_nonnull(spark, d):
    return P.revenue_growth(fx.panel(spark, d))


@register("pct_change_row", W_(
    f"""SELECT * EXCLUDE (pv), {growth_sql('COALESCE(quick_ratio, pv)', 'pv')}
    AS quick_ratio_growth FROM (SELECT *, LAST_VALUE(quick_ratio IGNORE NULLS) OVER
    (PARTITION BY permno ORDER BY public_date {_PREV}) AS pv FROM panel) t""", "panel"))
def q_pct_change_row(spark, d):
    return P.pct_change(fx.panel(spark, d), "quick_ratio", "quick_ratio_growth", fill="pad")


@register("initial_run_quarters", W_(
    _initial_run_sql("panel", _QUARTER).format(limit=20), "panel"))
def q_initial_run_quarters(spark, d):
    return P.initial_run_quarters(fx.panel(spark, d))


@register("add_days", W_(
    "SELECT permno, ipo_date, ipo_date + 1825 AS window_end FROM ipo", "ipo"))
def q_add_days(spark, d):
    from panelkit.functions.scalar import add_days
    return fx.ipo(spark, d).select("permno", "ipo_date", add_days("ipo_date", 1825).alias("window_end"))


@register("month_end", W_(
    "SELECT gvkey, datadate, LAST_DAY(datadate - 40) AS prev_month_end FROM funda", "funda"))
def q_month_end(spark, d):
    from panelkit.functions.scalar import month_end
    f = fx.funda(spark, d)
    return f.select("gvkey", "datadate", month_end(F.date_sub("datadate", 40)).alias("prev_month_end"))


@register("quarter_index", W_(
    "SELECT gvkey, datadate, CAST(YEAR(datadate) * 4 + QUARTER(datadate) - 1 AS INTEGER) AS qidx "
    "FROM fundq", "fundq"))
def q_quarter_index(spark, d):
    from panelkit.functions.scalar import quarter_index
    return fx.fundq(spark, d).select("gvkey", "datadate", quarter_index("datadate").alias("qidx"))
