"""Queries: profiling statistics and scalar functions."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from panelkit.functions import scalar as X
from panelkit.operators import profile as PR
from panelkit.plans.q_labels import events, lab_sql, labelled
from panelkit.plans.registry import W_, fx, register


@register("firm_status_counts", lab_sql(
    "SELECT status, COUNT(*) AS n_firms FROM (SELECT permno, MAX(delist) AS status FROM lab "
    "GROUP BY permno) t GROUP BY status"))
def q_firm_status_counts(spark, d):
    return PR.firm_status_counts(labelled(spark, d))


@register("delist_rate_by_year", lab_sql(
    "SELECT public_year, AVG(delist) AS delist_rate FROM lab GROUP BY public_year"))
def q_delist_rate_by_year(spark, d):
    return PR.delist_rate_by_year(labelled(spark, d))


def _dbl(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def _cut_sql(x: str) -> str:
    e = X.ROA_BIN_EDGES
    whens = []
    for i in range(len(e) - 1):
        lo, hi = _dbl(e[i]), _dbl(e[i + 1])
        cond = f"{x} >= {lo} AND {x} <= {hi}" if i == 0 else f"{x} > {lo} AND {x} <= {hi}"
        whens.append(f"WHEN {cond} THEN {i}")
    return f"CASE {' '.join(whens)} END"


def _clip_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE GREATEST(LEAST({x}, 1.0), -1.0) END"


_BIN_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS bin, '{X.bin_label(X.ROA_BIN_EDGES[i], X.ROA_BIN_EDGES[i + 1])}' AS bin_label"
    for i in range(len(X.ROA_BIN_EDGES) - 1))


@register("delist_rate_by_bin", lab_sql(
    f"""SELECT b.bin, b.bin_label, s.delist_rate, COALESCE(s.n_obs, 0) AS n_obs,
    CASE WHEN s.delist_rate IS NULL THEN NULL ELSE printf('%.1f%%', s.delist_rate * 100)
      || chr(10) || '(n=' || CAST(s.n_obs AS VARCHAR) || ')' END AS annotation
    FROM ({_BIN_ROWS}) b LEFT JOIN (SELECT bin, AVG(delist) AS delist_rate, COUNT(*) AS n_obs
      FROM (SELECT {_cut_sql(_clip_sql('roa'))} AS bin, delist FROM lab) t
      WHERE bin IS NOT NULL GROUP BY bin) s ON b.bin = s.bin"""))
def q_delist_rate_by_bin(spark, d):
    return PR.delist_rate_by_bin(labelled(spark, d), "roa")


_CORR_PRESENT = [c for c in PR.CORR_COLUMNS
                 if c in ("revtq", "roa", "roe", "npm", "tobinq", "quick_ratio", "de_ratio")]


def _corr_sql():
    parts = []
    for a, b in combinations_with_replacement(_CORR_PRESENT, 2):
        parts.append(f"SELECT '{a}' AS var_row, '{b}' AS var_col, CORR({a}, {b}) AS corr FROM lab")
        if a != b:
            parts.append(f"SELECT '{b}' AS var_row, '{a}' AS var_col, CORR({a}, {b}) AS corr FROM lab")
    return " UNION ALL ".join(parts)


@register("correlation_matrix", lab_sql(_corr_sql()))
def q_correlation_matrix(spark, d):
    return PR.correlation_matrix(labelled(spark, d))


def _hist_sql(col: str, zoom: bool) -> str:
    filt = f"{col} IS NOT NULL" + (f" AND {col} >= 0 AND {col} <= 10" if zoom else "")
    edge = "CASE WHEN {i} >= 40 THEN hi ELSE CAST({i} AS DOUBLE) * step + lo END"
    return f"""WITH hd AS (SELECT {col} AS x FROM lab WHERE {filt}),
    hb AS (SELECT MIN(x) AS lo0, MAX(x) AS hi0 FROM hd),
    hp AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
                  CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM hb),
    hq AS (SELECT lo, hi, (hi - lo) / 40.0 AS step FROM hp),
    h0 AS (SELECT x, lo, hi, step,
           CAST(FLOOR((x - lo) / (hi - lo) * 40.0) AS INTEGER) AS i0 FROM hd, hq),
    h1 AS (SELECT *, CASE WHEN i0 = 40 THEN 39 ELSE i0 END AS i1 FROM h0),
    h2 AS (SELECT *, CASE WHEN x < {edge.format(i='i1')} THEN i1 - 1 ELSE i1 END AS i2 FROM h1),
    h3 AS (SELECT CASE WHEN x >= {edge.format(i='(i2 + 1)')} AND i2 <> 39 THEN i2 + 1 ELSE i2 END
           AS bin FROM h2),
    hc AS (SELECT bin, COUNT(*) AS cnt FROM h3 GROUP BY bin),
    hf AS (SELECT CAST(r.range AS INTEGER) AS bin, {edge.format(i='r.range')} AS bin_lo,
           {edge.format(i='(r.range + 1)')} AS bin_hi FROM range(40) r, hq)
    SELECT f.bin, f.bin_lo, f.bin_hi, COALESCE(c.cnt, 0) AS count FROM hf f
    LEFT JOIN hc c ON f.bin = c.bin"""


def _lab_with(body_with: str) -> str:
    # Splice the histogram's own WITH list after the proxy CTEs.
    inner = body_with[len("WITH "):]
    head, _, tail = inner.partition("\n    SELECT f.bin")
    full = lab_sql("SELECT 1")
    return full[: -len("SELECT 1")].rstrip() + ",\n" + head + "\n    SELECT f.bin" + tail


@register("histogram", _lab_with(_hist_sql("tobinq", False)))
def q_histogram(spark, d):
    return PR.histogram(labelled(spark, d), "tobinq")


@register("positive_range_zoom", _lab_with(_hist_sql("tobinq", True)))
def q_positive_range_zoom(spark, d):
    """F22 + A12: the 0..10 zoom histogram; bounds come from the zoomed subset."""
    return PR.histogram(labelled(spark, d), "tobinq", zoom=(0.0, 10.0))


_BOX = """WITH bx AS (SELECT CASE WHEN delist = 0 THEN 'Not Delisted' WHEN delist = 1 THEN 'Delisted'
      END AS grp, roa AS x FROM lab WHERE roa IS NOT NULL),
    bq AS (SELECT grp, COUNT(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
           quantile_cont(x, 0.75) AS q3 FROM bx WHERE grp IS NOT NULL GROUP BY grp),
    bl AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM bq),
    bw AS (SELECT b.grp, AVG(b.x) AS mean, MIN(CASE WHEN b.x >= q.lo THEN b.x END) AS wlo,
           MAX(CASE WHEN b.x <= q.hi THEN b.x END) AS whi,
           COUNT(CASE WHEN b.x < q.lo OR b.x > q.hi THEN 1 END) AS n_outliers
           FROM bx b JOIN bl q ON b.grp = q.grp GROUP BY b.grp)
    SELECT q.grp AS "group", q.n, q.q1, q.median, q.q3, q.iqr, w.mean,
      COALESCE(w.wlo, q.q1) AS whisker_lo, COALESCE(w.whi, q.q3) AS whisker_hi, w.n_outliers
    FROM bl q JOIN bw w ON q.grp = w.grp"""


def _lab_with2(body_with: str, marker: str) -> str:
    inner = body_with[len("WITH "):]
    head, _, tail = inner.partition(marker)
    full = lab_sql("SELECT 1")
    return full[: -len("SELECT 1")].rstrip() + ",\n" + head + marker + tail


@register("boxplot_stats", _lab_with2(_BOX, "\n    SELECT q.grp"))
def q_boxplot_stats(spark, d):
    return PR.boxplot_stats(labelled(spark, d), "roa", "delist")


@register("row_count", lab_sql(
    "SELECT 'ipo' AS stage, COUNT(*) AS n_rows FROM ipo UNION ALL "
    "SELECT 'delist', COUNT(*) FROM delist UNION ALL SELECT 'matched', COUNT(*) FROM j10 "
    "UNION ALL SELECT 'panel', COUNT(*) FROM lab"))
def q_row_count(spark, d):
    return PR.row_counts({"ipo": fx.ipo(spark, d), "delist": fx.delist(spark, d),
                          "matched": events(spark, d), "panel": labelled(spark, d)})


# --- scalar functions -------------------------------------------------------------------------

@register("clip", lab_sql(f"SELECT permno, public_year, public_month, {_clip_sql('roa')} AS roa_clip FROM lab"))
def q_clip(spark, d):
    return labelled(spark, d).select("permno", "public_year", "public_month",
                                     X.clip("roa", -1.0, 1.0).alias("roa_clip"))


@register("cut_bins", lab_sql(
    f"SELECT permno, public_year, public_month, {_cut_sql(_clip_sql('roa'))} AS roa_bin FROM lab"))
def q_cut_bins(spark, d):
    return labelled(spark, d).select(
        "permno", "public_year", "public_month",
        X.cut_bins(X.clip("roa", -1.0, 1.0), X.ROA_BIN_EDGES).alias("roa_bin"))


@register("map_label", lab_sql(
    "SELECT permno, public_year, public_month, CASE WHEN delist = 0 THEN 'Not Delisted' "
    "WHEN delist = 1 THEN 'Delisted' END AS status FROM lab"))
def q_map_label(spark, d):
    return labelled(spark, d).select("permno", "public_year", "public_month",
                                     X.map_label("delist").alias("status"))


@register("percent_label", lab_sql(
    "SELECT public_year, printf('%.1f%%', AVG(delist) * 100) || chr(10) || '(n=' || "
    "CAST(COUNT(*) AS VARCHAR) || ')' AS annotation FROM lab GROUP BY public_year"))
def q_percent_label(spark, d):
    g = labelled(spark, d).groupBy("public_year").agg(F.avg("delist").alias("r"),
                                                      F.count(F.lit(1)).alias("n"))
    return g.select("public_year", X.percent_label("r", "n").alias("annotation"))


@register("string_normalise", "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def q_string_normalise(spark, d):
    c = fx.table(spark, d, "customer")
    messy = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    return c.select("c_custkey", X.string_normalise(messy).alias("segment"))


@register("to_date_coerce", W_(
    "SELECT permno, CASE WHEN permno % 7 = 0 THEN NULL ELSE ipo_date END AS ipo_date FROM ipo", "ipo"))
def q_to_date_coerce(spark, d):
    i = fx.ipo(spark, d)
    text = F.when(F.col("permno") % 7 == 0, F.lit("not a date")).otherwise(
        F.date_format("ipo_date", "yyyy-MM-dd"))
    return i.select("permno", X.to_date_coerce(text).alias("ipo_date"))


@register("year_month_parts", W_(
    "SELECT permno, public_date, CAST(YEAR(public_date) AS INTEGER) AS y, "
    "CAST(MONTH(public_date) AS INTEGER) AS m FROM panel", "panel"))
def q_year_month_parts(spark, d):
    y, m = X.year_month_parts("public_date")
    return fx.panel(spark, d).select("permno", "public_date", y.alias("y"), m.alias("m"))


@register("date_from_year", lab_sql(
    "SELECT permno, MAKE_DATE(MIN(public_year), 1, 1) AS first_day FROM lab GROUP BY permno"))
def q_date_from_year(spark, d):
    g = labelled(spark, d).groupBy("permno").agg(F.min("public_year").alias("y"))
    return g.select("permno", X.date_from_year("y").alias("first_day"))


@register("coalesce_pref", W_(
    "SELECT permno, COALESCE(comnam, ticker) AS name FROM delist", "delist"))
def q_coalesce_pref(spark, d):
    return fx.delist(spark, d).select("permno", X.coalesce_pref("comnam", "ticker").alias("name"))


@register("add_years", W_(
    "SELECT permno, ipo_date, CAST(ipo_date + INTERVAL 5 YEAR AS DATE) AS horizon FROM ipo", "ipo"))
def q_add_years(spark, d):
    return fx.ipo(spark, d).select("permno", "ipo_date", X.add_years("ipo_date", 5).alias("horizon"))


@register("sketched_quantiles", lab_sql(
    """SELECT CAST(COUNT(roa) AS BIGINT) AS n, QUANTILE_CONT(roa, 0.25) AS q1, QUANTILE_CONT(roa, 0.5) AS median,
       QUANTILE_CONT(roa, 0.75) AS q3, delist FROM lab WHERE roa IS NOT NULL AND public_year IS NOT NULL
       GROUP BY delist"""))
def q_sketched_quantiles(spark, d):
    """Exact quartiles by label from the sketches that are kept per year."""
    from panelkit.operators.sketches import YearSketches
    from panelkit.session import intermediate_path
    lab = labelled(spark, d)
    kept = YearSketches(spark, intermediate_path(spark), "roa", ["delist"])
    kept.add(lab)
    return kept.exact_quantiles(lab, {"q1": 0.25, "median": 0.5, "q3": 0.75})
