"""Firm-year features with a next-period label.

The statistics are hash aggregates by (permno, year): every buffer is a fixed-width value
that is combined on the map side, so a firm-year with many rows never lands whole in one
task and nothing is sorted. The trend slope uses a one-pass closed form of the reference's
formula. The next-year label is a ``lead`` over the firm-year table, which has at most one
row per firm and calendar year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelkit.functions import cleaning as C
from panelkit.sources.bucketed import FirmLayout, FirmTable, per_firm

EPS = 1e-6
#: Prepared rows in a bucket on average, at most: a task aggregates one bucket.
BUCKET_ROWS = 150_000


KEYS = ("permno", "public_year")


def _by_month(df: DataFrame, month: str, aggs: Sequence[Column], keys: Sequence[str]) -> DataFrame:
    """One row per key and month; rows without a month come after all others."""
    return df.groupBy(*keys, F.coalesce(F.col(month).cast("int"), F.lit(2**31 - 1)).alias("_m")).agg(*aggs)


def yearly_last(df: DataFrame, cols: Sequence[str], month: str = "public_month",
                keys: Sequence[str] = KEYS) -> DataFrame:
    """A1 (O4): last non-null value in month order per firm-year, ``{c}_last`` (ties within a
    month: the larger value). Two hash aggregates: per month, then over the months."""
    monthly = _by_month(df, month, [F.max(c).alias(c) for c in cols], keys)
    return monthly.groupBy(*keys).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_m"))).alias(f"{c}_last")
                                        for c in cols])


def yearly_label(df: DataFrame, label: str = "delist", month: str = "public_month",
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """Label of the first month per firm-year (ties within the month: the smaller)."""
    monthly = _by_month(df, month, [F.min(label).alias(label)], keys)
    return monthly.groupBy(*keys).agg(F.min_by(F.col(label), F.col("_m")).alias(label))


def next_year_label(yearly: DataFrame, label: str, out: str = "y_next_year") -> DataFrame:
    """The label of the firm's next available year; rows without one are dropped. The
    window runs over firm-years, at most one row per firm and calendar year."""
    nxt = F.lead(label).over(W.partitionBy("permno").orderBy("public_year"))
    return yearly.withColumn(out, nxt.cast("int")).filter(F.col(out).isNotNull())


def slope_expr(col: str, month: str) -> Column:
    """A4: the reference's standardised trend, in closed form.

    x = (m - mean(m)) / (std_pop(m) + 1e-6) over all rows of the group; over rows with y:
    slope = sum(x*y) / (sum(x*x) + 1e-6); fewer than two values -> NULL.
    """
    y, m = F.col(col), F.col(month).cast("double")
    has = y.isNotNull()
    mu, sd = F.avg(m), F.stddev_pop(m)
    n = F.count(y)
    sv, smv = F.sum(y), F.sum(m * y)
    sm, smm = F.sum(F.when(has, m)), F.sum(F.when(has, m * m))
    scale = sd + F.lit(EPS)
    sxy = (smv - mu * sv) / scale
    sxx = (smm - F.lit(2.0) * mu * sm + n * mu * mu) / (scale * scale)
    return F.when(n >= 2, sxy / (sxx + F.lit(EPS)))


def yearly_stats(df: DataFrame, mean: Sequence[str] = (), std: Sequence[str] = (), slope: Sequence[str] = (),
                 count: bool = False, month: str = "public_month", keys: Sequence[str] = KEYS) -> DataFrame:
    """A2-A5: means, sample deviations, trend slopes and row count per firm-year, one hash
    aggregate."""
    aggs = ([F.avg(c).alias(f"{c}_mean") for c in mean] + [F.stddev_samp(c).alias(f"{c}_std") for c in std]
            + [slope_expr(c, month).alias(f"{c}_slope") for c in slope]
            + ([F.count(F.lit(1)).alias("obs_count_in_year")] if count else []))
    return df.groupBy(*keys).agg(*aggs)


def prepared(df: DataFrame, features: Sequence[str] | None = None, label_col: str = "delist",
             cutoff_month: int | None = None) -> tuple[DataFrame, list[str]]:
    """F20, F19, F17, F18 and the null-key filter (trap T8): the rows that the yearly
    aggregates read, and the features they hold."""
    if "permno" not in df.columns:
        raise ValueError("the panel has no permno")
    year_col = "public_year" if "public_year" in df.columns else C.infer_column(
        df.columns, C.TIME_CANDIDATES, "year")
    if label_col not in df.columns:
        raise ValueError(f"the panel has no {label_col} to lead by a year")
    month = "public_month"
    df = C.default_month(df, month)
    feats = [c for c in (features or C.BASE_FEATURES) if c in df.columns]
    d = df.select("permno", F.col(year_col).alias("public_year"), month, label_col,
                  *[C.to_numeric_clean(c) for c in feats])
    d = C.cutoff_month(d, cutoff_month, month)
    return d.filter(F.col("permno").isNotNull() & F.col("public_year").isNotNull()), feats


def stitch_aggregates(d: DataFrame, feats: Sequence[str]) -> DataFrame:
    """Last, mean, std, slope and count of every firm-year side by side. Both parts are
    aggregates by (permno, year), so joining them moves no rows again."""
    last = yearly_last(d, feats)
    stats = yearly_stats(d, feats, [c for c in C.STD_FEATURES if c in feats],
                         [c for c in C.SLOPE_FEATURES if c in feats], count=True)
    return last.join(stats, on=list(KEYS))


def yearly_features(df: DataFrame, cutoff_month: int | None = None,
                    features: Sequence[str] | None = None,
                    label_col: str = "delist") -> DataFrame:
    """``build_yearly_from_monthly``: F19, F17, F18, A1-A5, J12, A7, W4, J13."""
    d, feats = prepared(df, features, label_col, cutoff_month)

    def work(rows: DataFrame) -> DataFrame:
        labels = yearly_label(rows, label_col).withColumnRenamed(label_col, "_lbl")
        yearly = stitch_aggregates(rows, feats).join(labels, on=list(KEYS))
        return next_year_label(yearly, "_lbl").drop("_lbl")

    return per_firm(work, by_firm(d))


def by_firm(d: DataFrame) -> FirmTable:
    """Prepared rows written once by firm: the aggregates, the joins between them and the
    next-year window read them without an exchange."""
    return FirmLayout.of([d], rows_per_bucket=BUCKET_ROWS).write(d, ["public_year", "public_month"])


def first_year(df: DataFrame, by: str = "permno", year_col: str = "public_year") -> DataFrame:
    """First year per firm."""
    return df.groupBy(by).agg(F.min(year_col).alias("first_year"))
