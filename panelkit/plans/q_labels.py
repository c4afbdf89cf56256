"""Queries: event labels, union, fill and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.operators import labels as L
from panelkit.operators import universe as U
from panelkit.plans.q_universe import _J10_SQL
from panelkit.plans.registry import W_, fx, register
from panelkit.session import cut_lineage

# The labelled monthly panel: panel proxy + matched delistings within 5 years.
PANEL_COLS = ["revtq", "roa", "roe", "npm", "tobinq", "quick_ratio", "de_ratio"]

LAB_EXTRA = [
    ("j10", _J10_SQL),
    ("lab", """SELECT p.* EXCLUDE (public_date),
      CAST(YEAR(p.public_date) AS INTEGER) AS public_year,
      CAST(MONTH(p.public_date) AS INTEGER) AS public_month,
      CAST(CASE WHEN j.ipo_date IS NOT NULL AND YEAR(p.public_date) = YEAR(j.ipo_date)
        + CAST(ROUND_EVEN(datediff('day', j.ipo_date, j.delist_date) / 365.0, 0) AS INTEGER)
        THEN 1 ELSE 0 END AS INTEGER) AS delist,
      CAST(CASE WHEN j.ipo_date IS NOT NULL
        THEN ROUND_EVEN(datediff('day', j.ipo_date, j.delist_date) / 365.0, 0) ELSE 0 END
        AS INTEGER) AS delist_year
      FROM panel p LEFT JOIN j10 j ON p.permno = j.permno"""),
    ("parts", """SELECT * FROM lab WHERE permno % 3 = 0
      UNION ALL BY NAME SELECT * EXCLUDE (tobinq) FROM lab WHERE permno % 3 = 1
      UNION ALL BY NAME SELECT * FROM lab WHERE permno % 3 = 2"""),
]
LAB_PROXIES = ("panel", "ipo", "delist")


def lab_sql(body: str, extra=None) -> str:
    return W_(body, *LAB_PROXIES, extra=LAB_EXTRA + list(extra or []))


def events(spark, d):
    return U.delist_within_years(fx.ipo(spark, d), fx.delist(spark, d), 5, ordered=False)


@fx.memo
def labelled(spark, d):
    return L.event_label(fx.panel(spark, d), events(spark, d))


def parts(spark, d):
    lab = labelled(spark, d)
    return [lab.filter(F.col("permno") % 3 == 0),
            lab.filter(F.col("permno") % 3 == 1).drop("tobinq"),
            lab.filter(F.col("permno") % 3 == 2)]


def fill_sql(src: str, cols, key="permno", order="public_year, public_month", both=True) -> str:
    w = f"PARTITION BY {key} ORDER BY {order}"
    outs = []
    for c in cols:
        nxt = (f"FIRST_VALUE({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN 1 FOLLOWING AND "
               "UNBOUNDED FOLLOWING), ") if both else ""
        prv = f"LAST_VALUE({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        outs.append(f"COALESCE({c}, {nxt}{prv}) AS {c}")
    return f"SELECT {key}, {', '.join(outs)} FROM {src} WHERE {key} IS NOT NULL"


_FILL_COLS = PANEL_COLS + ["public_year", "public_month", "delist", "delist_year"]


@register("label_join", lab_sql(
    "SELECT p.*, j.ipo_date AS evt_ipo_date, j.delist_date AS evt_delist_date "
    "FROM panel p LEFT JOIN j10 j ON p.permno = j.permno"))
def q_label_join(spark, d):
    return L.label_join(fx.panel(spark, d), events(spark, d))


@register("event_label", lab_sql("SELECT * FROM lab"))
def q_event_label(spark, d):
    return labelled(spark, d)


@register("years_between_rounded", lab_sql(
    "SELECT permno, ipo_date, delist_date, CAST(ROUND_EVEN(datediff('day', ipo_date, delist_date)"
    " / 365.0, 0) AS INTEGER) AS years_to_event FROM j10"))
def q_years_between_rounded(spark, d):
    from panelkit.functions.scalar import years_between_rounded
    e = events(spark, d)
    return e.select("permno", "ipo_date", "delist_date",
                    years_between_rounded("ipo_date", "delist_date").alias("years_to_event"))


@register("union_by_name", lab_sql("SELECT * FROM parts"))
def q_union_by_name(spark, d):
    return L.union_by_name(parts(spark, d))


@register("dedupe_subset", lab_sql(
    """SELECT permno, public_year, public_month, roa FROM (SELECT permno, public_year,
    public_month, roa, ROW_NUMBER() OVER (PARTITION BY permno, public_year ORDER BY
    public_month ASC NULLS LAST, roa ASC NULLS LAST) AS rn FROM lab) t WHERE rn = 1"""))
def q_dedupe_subset(spark, d):
    lab = labelled(spark, d).select("permno", "public_year", "public_month", "roa")
    return L.dedupe_subset(lab, ["permno", "public_year"], ["public_month"])


@register("backfill_then_forwardfill", lab_sql(fill_sql("parts", _FILL_COLS)))
def q_backfill_then_forwardfill(spark, d):
    u = cut_lineage(L.union_by_name(parts(spark, d)))      # the fill reads its input more than once
    return L.fill_by_group(u, ["permno"], ["public_year", "public_month"])


@register("forward_fill", lab_sql(fill_sql("parts", _FILL_COLS, both=False)))
def q_forward_fill(spark, d):
    """W9 with ``direction="forward"`` (no look-ahead, trap T13)."""
    u = cut_lineage(L.union_by_name(parts(spark, d)))      # the fill reads its input more than once
    return L.fill_by_group(u, ["permno"], ["public_year", "public_month"], direction="forward")


_MERGED = [("filled", fill_sql("parts", _FILL_COLS)),
           ("merged", "SELECT * FROM filled WHERE tobinq IS NOT NULL AND quick_ratio IS NOT NULL "
                      "AND de_ratio IS NOT NULL AND roa IS NOT NULL AND roe IS NOT NULL "
                      "AND npm IS NOT NULL")]


@register("merge_clean", lab_sql("SELECT * FROM merged", _MERGED))
def q_merge_clean(spark, d):
    return L.merge_clean(parts(spark, d))


@register("drop_all_null_rows", lab_sql(
    "SELECT * FROM lab WHERE permno % 50 <> 0"))
def q_drop_all_null_rows(spark, d):
    lab = labelled(spark, d)
    blank = F.col("permno") % 50 == 0
    nulled = lab.select(*[F.when(~blank, F.col(c)).alias(c) for c in lab.columns])
    return C.drop_all_null_rows(nulled)


@register("drop_all_null_cols", lab_sql("SELECT * FROM lab"))
def q_drop_all_null_cols(spark, d):
    lab = labelled(spark, d).withColumn("pe_exi", F.lit(None).cast("double"))
    return C.drop_all_null_cols(lab)


@register("drop_constant_cols", lab_sql("SELECT * EXCLUDE (delist_year) FROM lab"))
def q_drop_constant_cols(spark, d):
    """F15 over the whole labelled panel: ``delist_year`` is made constant and must be
    dropped; every other column varies (the oracle lists the surviving columns)."""
    lab = labelled(spark, d).withColumn("delist_year", F.lit(0))
    return C.drop_constant_cols(lab)


@register("trim_column_names", lab_sql("SELECT * FROM lab"))
def q_trim_column_names(spark, d):
    lab = labelled(spark, d)
    spaced = lab.toDF(*[f" {c} " if i % 2 else c for i, c in enumerate(lab.columns)])
    return C.trim_column_names(spaced)


@register("cast_keys", lab_sql("SELECT * FROM lab"))
def q_cast_keys(spark, d):
    lab = labelled(spark, d)
    as_text = lab.withColumn("permno", F.col("permno").cast("string")).withColumn(
        "public_year", F.col("public_year").cast("string"))
    return C.cast_keys(as_text).select(*lab.columns)


@register("drop_if_exists", lab_sql("SELECT * EXCLUDE (tobinq) FROM lab"))
def q_drop_if_exists(spark, d):
    lab = labelled(spark, d).withColumnRenamed("tobinq", "total_assets")
    return C.drop_if_exists(lab, C.REDUNDANT_COLUMNS)


@register("dropna_subset", lab_sql(
    "SELECT * FROM lab WHERE tobinq IS NOT NULL AND quick_ratio IS NOT NULL AND de_ratio IS NOT NULL"
    " AND roa IS NOT NULL AND roe IS NOT NULL AND npm IS NOT NULL"))
def q_dropna_subset(spark, d):
    return C.dropna_subset(labelled(spark, d), C.KEY_RATIOS)
