"""Queries: firm-level and chronological splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import split as S
from panelkit.plans.q_features import _YEARLY, yearly
from panelkit.plans.q_labels import lab_sql, labelled
from panelkit.plans.registry import fx, register
from panelkit.sources.bucketed import stored

R_TRAIN, R_VAL, R_TEST = 0.7, 0.15, 0.15


def clamp_sql(r: str, n: str) -> str:
    i1 = f"LEAST(GREATEST(FLOOR({n} * CAST({R_TRAIN!r} AS DOUBLE)), 0), GREATEST({n} - 2, 0))"
    i2 = (f"LEAST(GREATEST(FLOOR({n} * CAST({R_TRAIN + R_VAL!r} AS DOUBLE)), {i1} + 1), "
          f"GREATEST({n} - 1, 1))")
    return f"CASE WHEN {r} < {i1} THEN 'train' WHEN {r} < {i2} THEN 'val' ELSE 'test' END"


_SPLIT = _YEARLY + [
    ("fk", "SELECT permno, MAKE_DATE(MIN(public_year), 1, 1) AS sk FROM yearly GROUP BY permno"),
    ("fr", "SELECT permno, ROW_NUMBER() OVER (ORDER BY sk, permno) - 1 AS r, COUNT(*) OVER () AS n "
           "FROM fk"),
    ("ft", f"SELECT permno, {clamp_sql('r', 'n')} AS split FROM fr"),
    ("sp", "SELECT y.*, t.split FROM yearly y LEFT JOIN ft t ON y.permno = t.permno"),
]


def split_sql(body, extra=()):
    return lab_sql(body, _SPLIT + list(extra))


@fx.memo
def split_yearly(spark, d):
    """The split firm-year table, checkpointed once per session (it feeds the class
    checks, the fit and the scoring)."""
    return stored(S.firm_level_split(yearly(spark, d), "permno", None, "public_year",
                                     (R_TRAIN, R_VAL, R_TEST)), spark)


@register("earliest_key_per_firm", split_sql("SELECT permno, sk AS _sort_key FROM fk"))
def q_earliest_key_per_firm(spark, d):
    return S.earliest_key_per_firm(yearly(spark, d), "permno", "ipodate", "public_year")


@register("firm_level_split", split_sql("SELECT permno, public_year, y_next_year, split FROM sp"))
def q_firm_level_split(spark, d):
    return split_yearly(spark, d).select("permno", "public_year", "y_next_year", "split")


@register("resumed_split", split_sql("SELECT permno, public_year, y_next_year, split FROM sp"))
def q_resumed_split(spark, d):
    """M9: the split table of a run that stopped after it, as the next run finds it."""
    from panelkit.plans.resume import Resumable
    from panelkit.session import intermediate_path

    def split():
        return S.firm_level_split(yearly(spark, d), "permno", None, "public_year", ratios)

    ratios, folder = (R_TRAIN, R_VAL, R_TEST), intermediate_path(spark)
    inputs = [f"{d}/customer.parquet", f"{d}/orders.parquet"]
    Resumable(spark, folder, inputs).table("split", split, ratios=ratios)
    again = Resumable(spark, folder, inputs)
    rows = again.table("split", split, ratios=ratios)
    assert again.found == ["split"]
    return rows.select("permno", "public_year", "y_next_year", "split")


@register("map_split_back", split_sql("SELECT * FROM sp"))
def q_map_split_back(spark, d):
    return split_yearly(spark, d)


@register("chronological_split", lab_sql(
    f"""SELECT permno, public_year, public_month, {clamp_sql('r', 'n')} AS split FROM (
    SELECT permno, public_year, public_month,
      ROW_NUMBER() OVER (PARTITION BY permno ORDER BY public_year, public_month) - 1 AS r,
      COUNT(*) OVER (PARTITION BY permno) AS n FROM lab) t"""))
def q_chronological_split(spark, d):
    lab = labelled(spark, d).select("permno", "public_year", "public_month")
    return S.chronological_split(lab, "permno", "public_year", (R_TRAIN, R_VAL, R_TEST))


_ZEROED = [("z", "SELECT permno, public_year, split, CASE WHEN split = 'train' THEN 0 "
                 "ELSE y_next_year END AS y FROM sp"),
           ("mv", "SELECT MIN(permno) AS m FROM z WHERE split = 'val' AND y = 1")]


@register("ensure_two_classes", split_sql(
    "SELECT permno, public_year, y, CASE WHEN permno = (SELECT m FROM mv) THEN 'train' "
    "ELSE split END AS split FROM z", _ZEROED))
def q_ensure_two_classes(spark, d):
    """W12 on a split whose training labels are all 0: the first positive val firm moves."""
    sp = split_yearly(spark, d).select(
        "permno", "public_year", "split",
        F.when(F.col("split") == "train", F.lit(0)).otherwise(F.col("y_next_year")).alias("y"))
    moved, _ = S.ensure_two_classes(sp, "y")
    return moved


@register("two_class_check", split_sql(
    "SELECT COUNT(DISTINCT y_next_year) AS n_classes FROM sp WHERE split = 'train'"))
def q_two_class_check(spark, d):
    """A15 as a table: the number of label values in train (>= 2 is required)."""
    return S.split_filter(split_yearly(spark, d), "train").agg(
        F.count_distinct("y_next_year").alias("n_classes"))


@register("class_distribution", split_sql(
    "SELECT split, y_next_year, COUNT(*) AS n FROM sp GROUP BY 1, 2"))
def q_class_distribution(spark, d):
    return S.class_distribution(split_yearly(spark, d), "y_next_year")


@register("distinct_pairs", split_sql("SELECT DISTINCT permno, public_year FROM sp"))
def q_distinct_pairs(spark, d):
    return S.distinct_pairs(split_yearly(spark, d))


@register("positive_firms", split_sql(
    "SELECT DISTINCT permno, split FROM sp WHERE split IN ('val', 'test') AND y_next_year = 1"))
def q_positive_firms(spark, d):
    return S.positive_firms(split_yearly(spark, d), "y_next_year")


@register("split_filter", split_sql("SELECT * FROM sp WHERE split = 'val'"))
def q_split_filter(spark, d):
    return S.split_filter(split_yearly(spark, d), "val")
