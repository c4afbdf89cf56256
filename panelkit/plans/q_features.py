"""Queries: firm-year features and next-year label."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.operators import features as FE
from panelkit.operators.panel import semi_membership
from panelkit.plans.q_labels import PANEL_COLS, lab_sql, labelled
from panelkit.plans.registry import fx, register
from panelkit.sources.bucketed import per_firm

FEATS = [c for c in C.BASE_FEATURES if c in PANEL_COLS]
STD = [c for c in C.STD_FEATURES if c in FEATS]
SLOPE = [c for c in C.SLOPE_FEATURES if c in FEATS]


def _clean(c):
    return f"CASE WHEN isinf({c}) THEN NULL ELSE {c} END AS {c}"


def _slope_sql(c):
    sc = "(sd + 1e-6)"
    return (f"CASE WHEN n_{c} >= 2 THEN ((smv_{c} - mu * s_{c}) / {sc}) / "
            f"((smm_{c} - 2.0 * mu * sm_{c} + n_{c} * mu * mu) / ({sc} * {sc}) + 1e-6) END")


def yearly_ctes(src="lab", cutoff=None, label=True):
    where = "permno IS NOT NULL AND public_year IS NOT NULL"
    if cutoff is not None:
        where += f" AND public_month <= {cutoff}"
    base = (f"SELECT permno, public_year, public_month, delist, "
            f"{', '.join(_clean(c) for c in FEATS)} FROM {src} WHERE {where}")
    aggs = [f"arg_max({c}, {{'m': public_month, 'v': {c}}}) FILTER (WHERE {c} IS NOT NULL) AS {c}_last"
            for c in FEATS]
    aggs += [f"AVG({c}) AS {c}_mean" for c in FEATS]
    aggs += [f"STDDEV_SAMP({c}) AS {c}_std" for c in STD]
    aggs += ["AVG(CAST(public_month AS DOUBLE)) AS mu", "STDDEV_POP(CAST(public_month AS DOUBLE)) AS sd"]
    for c in SLOPE:
        aggs += [f"COUNT({c}) AS n_{c}", f"SUM({c}) AS s_{c}",
                 f"SUM(CAST(public_month AS DOUBLE) * {c}) AS smv_{c}",
                 f"SUM(CAST(public_month AS DOUBLE)) FILTER (WHERE {c} IS NOT NULL) AS sm_{c}",
                 f"SUM(CAST(public_month AS DOUBLE) * CAST(public_month AS DOUBLE)) "
                 f"FILTER (WHERE {c} IS NOT NULL) AS smm_{c}"]
    aggs += ["COUNT(*) AS obs_count_in_year",
             "arg_min(delist, {'m': public_month, 'v': delist}) AS lbl"]
    grouped = f"SELECT permno, public_year, {', '.join(aggs)} FROM ybase GROUP BY permno, public_year"
    cols = ([f"{c}_last" for c in FEATS] + [f"{c}_mean" for c in FEATS] + [f"{c}_std" for c in STD]
            + [f"{_slope_sql(c)} AS {c}_slope" for c in SLOPE] + ["obs_count_in_year"])
    stitched = f"SELECT permno, public_year, {', '.join(cols)}, lbl FROM ygroup"
    labelled_sql = ("SELECT * EXCLUDE (lbl) FROM (SELECT *, CAST(LEAD(lbl) OVER (PARTITION BY permno "
                    "ORDER BY public_year) AS INTEGER) AS y_next_year FROM ystitched) t "
                    "WHERE y_next_year IS NOT NULL")
    return [("ybase", base), ("ygroup", grouped), ("ystitched", stitched), ("yearly", labelled_sql)]


_YEARLY = yearly_ctes()


def yearly(spark, d):
    return FE.yearly_features(labelled(spark, d))


@register("yearly_features", lab_sql("SELECT * FROM yearly", _YEARLY))
def q_yearly_features(spark, d):
    """Flagship: firm-year features with the next-year delisting label."""
    return yearly(spark, d)


@register("attach_next_label", lab_sql("SELECT * FROM yearly", _YEARLY))
def q_attach_next_label(spark, d):
    """Features joined with the next-year label, non-null kept, as int."""
    return yearly(spark, d)


@register("stitch_aggregates", lab_sql("SELECT * EXCLUDE (lbl) FROM ystitched", _YEARLY))
def q_stitch_aggregates(spark, d):
    """last/mean/std/slope/count side by side for every firm-year."""
    return FE.stitch_aggregates(*FE.prepared(labelled(spark, d)))


@fx.memo
def prepared_by_firm(spark, d):
    """The rows that the yearly aggregates read, written once by firm: every aggregate by
    firm and year reads them without an exchange."""
    rows = labelled(spark, d)
    return FE.by_firm(FE.prepared(rows)[0])


def _agg_query(key, sql_cols, build):
    @register(key, lab_sql(f"SELECT permno, public_year, {sql_cols} FROM ystitched", _YEARLY))
    def q(spark, d):
        return per_firm(build, prepared_by_firm(spark, d))
    q.__name__ = f"q_{key}"


_agg_query("yearly_last", ", ".join(f"{c}_last" for c in FEATS), lambda d: FE.yearly_last(d, FEATS))
_agg_query("yearly_mean", ", ".join(f"{c}_mean" for c in FEATS), lambda d: FE.yearly_stats(d, mean=FEATS))
_agg_query("yearly_std", ", ".join(f"{c}_std" for c in STD), lambda d: FE.yearly_stats(d, std=STD))
_agg_query("yearly_slope", ", ".join(f"{c}_slope" for c in SLOPE), lambda d: FE.yearly_stats(d, slope=SLOPE))
_agg_query("yearly_obs_count", "obs_count_in_year", lambda d: FE.yearly_stats(d, count=True))
_agg_query("yearly_label", "CAST(lbl AS INTEGER) AS delist", FE.yearly_label)


@register("next_year_label", lab_sql(
    """SELECT permno, public_year, CAST(lbl AS INTEGER) AS delist, y_next_year FROM (
    SELECT *, CAST(LEAD(lbl) OVER (PARTITION BY permno ORDER BY public_year) AS INTEGER)
    AS y_next_year FROM ygroup) t WHERE y_next_year IS NOT NULL""", _YEARLY))
def q_next_year_label(spark, d):
    """The label of the firm's next available year (not next calendar year)."""
    return FE.next_year_label(FE.yearly_label(FE.prepared(labelled(spark, d))[0]), "delist")


@register("first_year", lab_sql(
    "SELECT permno, MIN(public_year) AS first_year FROM lab GROUP BY permno"))
def q_first_year(spark, d):
    return FE.first_year(labelled(spark, d))


_CUT = yearly_ctes(cutoff=6)


@register("cutoff_month", lab_sql("SELECT * FROM yearly", _CUT))
def q_cutoff_month(spark, d):
    """F18 (T11): only months <= 6; this can change which year is 'next'."""
    return FE.yearly_features(labelled(spark, d), cutoff_month=6)


@register("default_month", lab_sql(
    "SELECT permno, public_year, 12 AS public_month FROM lab"))
def q_default_month(spark, d):
    lab = labelled(spark, d).drop("public_month")
    return C.default_month(lab).select("permno", "public_year", "public_month")


@register("infer_column", lab_sql("SELECT * FROM yearly", _YEARLY))
def q_infer_column(spark, d):
    """without ``public_year`` the year column is inferred (here ``fyear``)."""
    lab = labelled(spark, d).withColumnRenamed("public_year", "fyear")
    return FE.yearly_features(lab)


@register("select_features", lab_sql(
    "SELECT permno, public_year, roa_last, tobinq_mean, quick_ratio_std FROM yearly", _YEARLY))
def q_select_features(spark, d):
    y = yearly(spark, d)
    feats = C.select_features(y.columns, "roa_last, tobinq_mean, quick_ratio_std, no_such_feature")
    return y.select("permno", "public_year", *feats)


@register("to_numeric_clean", lab_sql(
    """SELECT permno, public_year, public_month, CASE WHEN isinf(TRY_CAST(t AS DOUBLE)) THEN NULL
    ELSE TRY_CAST(t AS DOUBLE) END AS roa FROM (SELECT permno, public_year, public_month,
    CASE WHEN permno % 13 = 0 THEN 'n/a' WHEN permno % 17 = 0 THEN 'Infinity'
    ELSE CAST(roa AS VARCHAR) END AS t FROM lab) s"""))
def q_to_numeric_clean(spark, d):
    lab = labelled(spark, d)
    k = F.col("permno")
    text = (F.when(k % 13 == 0, F.lit("n/a")).when(k % 17 == 0, F.lit("Infinity"))
            .otherwise(F.col("roa").cast("string")).alias("roa"))
    return lab.select("permno", "public_year", "public_month", text).select(
        "permno", "public_year", "public_month", C.to_numeric_clean("roa"))


@register("stable_sort", lab_sql(
    """SELECT permno, public_year, arg_max(roa, {'m': q, 'v': roa}) FILTER (WHERE roa IS NOT NULL)
    AS roa_last FROM (SELECT permno, public_year, CAST(CEIL(public_month / 3.0) * 3 AS INTEGER) AS q,
    CASE WHEN isinf(roa) THEN NULL ELSE roa END AS roa FROM lab) t GROUP BY permno, public_year"""))
def q_stable_sort(spark, d):
    """O4: 'last' with ties in the month order (months folded to quarter ends) is made
    deterministic by an explicit tie-break (the larger value), not by input order."""
    lab = labelled(spark, d).withColumn(
        "public_month", (F.ceil(F.col("public_month") / 3.0) * 3).cast("int"))
    return FE.yearly_last(FE.prepared(lab, ["roa"])[0], ["roa"])


@register("semi_membership", lab_sql(
    "SELECT l.* FROM lab l WHERE EXISTS (SELECT 1 FROM yearly y WHERE y.permno = l.permno "
    "AND y.public_year = l.public_year)", _YEARLY))
def q_semi_membership(spark, d):
    """Keep panel rows whose (firm, year) is in a kept set (here: the labelled firm-years)."""
    kept = yearly(spark, d).select("permno", "public_year")
    return semi_membership(labelled(spark, d), kept, ["permno", "public_year"])


@register("yearly_incremental", lab_sql("SELECT * FROM yearly", _YEARLY))
def q_yearly_incremental(spark, d):
    """A1-A5, A7, W4 from stored firm-year partials to which the panel came in two parts: the
    first half of every year, then the rest."""
    from panelkit.operators.partials import FirmYearStore
    from panelkit.session import intermediate_path
    rows, feats = FE.prepared(labelled(spark, d))
    rows = per_firm(lambda t: t, FE.by_firm(rows))      # both parts read it, without an exchange
    store = FirmYearStore(spark, intermediate_path(spark), feats)
    store.add(rows.filter("public_month <= 6"))
    store.add(rows.filter("public_month > 6"))
    return FE.next_year_label(store.features(), "first_label").drop("first_label")
