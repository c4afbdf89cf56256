"""Leakage-safe chronological splits.

Ranks come from :func:`panelkit.operators.ordered.ordered_scan`: firms are ranked over
the whole table without a one-partition window, and rows within a firm without putting
a large firm into one task. Only bounded values reach the driver (class counts, one
firm id).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.scalar import date_from_year
from panelkit.operators.ordered import global_rank, ordered_scan
from panelkit.session import cut_lineage

TRAIN, VAL, TEST = "train", "val", "test"


def _check_ratios(ratios: Sequence[float]) -> tuple[float, float, float]:
    r_train, r_val, r_test = ratios
    if not math.isclose(r_train + r_val + r_test, 1.0, rel_tol=0, abs_tol=1e-8):
        raise ValueError(f"split ratios {tuple(ratios)} do not add up to 1")
    return r_train, r_val, r_test


def clamp_tag(rank: Column, n: Column, r_train: float, r_val: float) -> Column:
    """Split tag from a 0-based rank among n items, with the reference's boundary clamps:
    i1 = min(max(floor(n*train), 0), max(n-2, 0));
    i2 = min(max(floor(n*(train+val)), i1+1), max(n-1, 1))."""
    zero = F.lit(0).cast("long")
    i1 = F.least(F.greatest(F.floor(n * F.lit(r_train)), zero), F.greatest(n - 2, zero))
    i2 = F.least(F.greatest(F.floor(n * F.lit(r_train + r_val)), i1 + 1),
                 F.greatest(n - 1, F.lit(1).cast("long")))
    return F.when(rank < i1, TRAIN).when(rank < i2, VAL).otherwise(TEST)


def earliest_key_per_firm(df: DataFrame, company: str = "permno", ipo_col: str | None = None,
                          year_col: str = "public_year") -> DataFrame:
    """Per firm, the earliest non-null IPO date, else January 1 of its first year."""
    fallback = date_from_year(F.min(year_col))
    if ipo_col and ipo_col in df.columns:
        key = F.coalesce(F.min(F.to_date(F.col(ipo_col))), fallback)
    else:
        key = fallback
    return df.groupBy(company).agg(key.alias("_sort_key"))


def firm_level_split(df: DataFrame, company: str = "permno", ipo_col: str | None = "ipodate",
                     year_col: str = "public_year",
                     ratios: Sequence[float] = (0.7, 0.15, 0.15)) -> DataFrame:
    """W11 + J14: firms ordered by (sort key, id); the first share train, the next val,
    the rest test; every row of a firm gets its firm's tag in column ``split``."""
    r_train, r_val, _ = _check_ratios(ratios)
    for c in (company, year_col):
        if c not in df.columns:
            raise ValueError(f"no column {c} to split by")
    # one row per firm, written once: the rank reads it more than once
    firms = cut_lineage(earliest_key_per_firm(df, company, ipo_col, year_col))
    ranked = global_rank(firms, ["_sort_key", company], rank="_r", size="_n")
    tags = ranked.select(company, clamp_tag(F.col("_r"), F.col("_n"), r_train, r_val).alias("split"))
    return map_split_back(df, tags, company)


def map_split_back(df: DataFrame, tags: DataFrame, company: str = "permno") -> DataFrame:
    """Firm -> tag joined to all rows (AQE broadcasts the firm table when small)."""
    return df.join(tags, on=company, how="left")


def chronological_split(df: DataFrame, group_col: str, time_col: str,
                        ratios: Sequence[float] = (0.7, 0.15, 0.15)) -> DataFrame:
    """Within each group, rows in time order; first share train, next val, rest test."""
    r_train, r_val, _ = _check_ratios(ratios)
    order = [time_col]
    if time_col == "public_year" and "public_month" in df.columns:
        order.append("public_month")
    ranked = ordered_scan(df, [group_col], order, rank="_r", size="_n")
    return ranked.withColumn("split", clamp_tag(F.col("_r"), F.col("_n"), r_train, r_val)).drop(
        "_r", "_n")


def has_two_classes(df: DataFrame, label: str, split_col: str = "split", tag: str = TRAIN) -> bool:
    """Does the training part hold at least two label values (one small job)."""
    return df.filter(F.col(split_col) == tag).agg(
        F.count_distinct(label).alias("k")).first()["k"] >= 2


def positive_firms(df: DataFrame, label: str, company: str = "permno",
                   split_col: str = "split") -> DataFrame:
    """Distinct firms with a positive label in val or test, with their tag."""
    return (df.filter(F.col(split_col).isin(VAL, TEST) & (F.col(label) == 1))
            .select(company, split_col).distinct())


def ensure_two_classes(df: DataFrame, label: str, company: str = "permno",
                       split_col: str = "split") -> tuple[DataFrame, object | None]:
    """If train has one class, move all rows of the first firm (lowest id) with a
    positive label -- from val first, then test -- into train. Returns (df, moved id)."""
    if has_two_classes(df, label, split_col):
        return df, None
    for tag in (VAL, TEST):
        row = (df.filter((F.col(split_col) == tag) & (F.col(label) == 1))
               .agg(F.min(company).alias("c")).first())
        if row is None or row["c"] is None:
            continue
        moved = df.withColumn(split_col, F.when(F.col(company) == F.lit(row["c"]), TRAIN)
                              .otherwise(F.col(split_col)))
        if has_two_classes(moved, label, split_col):
            return moved, row["c"]
        df = moved
    raise ValueError(f"{label}: one class to train on, and no firm to move there")


def class_distribution(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """Rows per (split, class)."""
    return df.groupBy(split_col, label).agg(F.count(F.lit(1)).alias("n"))


def distinct_pairs(df: DataFrame, company: str = "permno", year_col: str = "public_year") -> DataFrame:
    """A16."""
    return df.select(company, year_col).distinct()


def split_filter(df: DataFrame, tag: str, split_col: str = "split") -> DataFrame:
    """F23."""
    return df.filter(F.col(split_col) == tag)
