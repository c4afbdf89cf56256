"""Event labels, union, fill and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.functions.scalar import years_between_rounded
from panelkit.operators.ordered import ordered_scan
from panelkit.operators.universe import first_by
from panelkit.session import cut_lineage


def label_join(panel: DataFrame, events: DataFrame) -> DataFrame:
    """Panel LEFT JOIN (permno, ipo_date, delist_date) of the matched events.

    The event dates are named ``evt_ipo_date`` / ``evt_delist_date`` so the panel keeps
    its own ``ipo_date`` (the reference's ``_x`` / ``_y`` suffixes, trap T14).
    """
    ev = events.select("permno", F.col("ipo_date").alias("evt_ipo_date"),
                       F.col("delist_date").alias("evt_delist_date"))
    return panel.join(ev, on="permno", how="left")


def event_label(panel: DataFrame, events: DataFrame, date_col: str = "public_date") -> DataFrame:
    """X8 (``clean_finance``): year / month parts, then ``delist`` = 1 only in rows whose
    year is the IPO year + round(days to delisting / 365) for firms in the event table,
    and ``delist_year`` = that rounded number of years (0 without an event).
    The date columns used are dropped."""
    p = panel.withColumn("public_year", F.year(date_col)).withColumn("public_month", F.month(date_col))
    j = label_join(p, events)
    has = F.col("evt_ipo_date").isNotNull()
    yrs = F.when(has, years_between_rounded("evt_ipo_date", "evt_delist_date")).otherwise(F.lit(0))
    event_year = F.year("evt_ipo_date") + yrs
    flag = F.when(has & (F.col("public_year") == event_year), 1).otherwise(0)
    return (j.withColumn("delist", flag.cast("int")).withColumn("delist_year", yrs.cast("int"))
            .drop("evt_ipo_date", "evt_delist_date", date_col))


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns missing in a part become NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def dedupe_subset(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order`` -- deterministic, unlike dropDuplicates."""
    return first_by(df, keys, order)


def fill_by_group(df: DataFrame, by: Sequence[str], order: Sequence[str],
                  direction: str = "both", cols: Sequence[str] | None = None) -> DataFrame:
    """Per group, in time order, fill each column from the next value and then from
    the previous one (``direction="both"``, the reference's default, which looks ahead:
    trap T13) or only from the previous one (``"forward"``).

    Rows with a NULL group key are dropped, as pandas ``groupby`` does. Without a group
    key the whole table is one sequence (still no single-partition step).
    """
    by = list(by)
    if direction not in ("both", "forward"):
        raise ValueError("direction must be 'both' or 'forward'")
    if by:
        df = df.dropna(subset=by)
    cols = [c for c in (cols or df.columns) if c not in by]
    prev = {f"_pf_{i}": c for i, c in enumerate(cols)}
    nxt = {f"_nf_{i}": c for i, c in enumerate(cols)} if direction == "both" else {}
    s = ordered_scan(df, by, list(order), prev_nonnull=prev, next_nonnull=nxt)
    out = []
    for i, c in enumerate(df.columns):
        if c in cols:
            j = cols.index(c)
            parts = [F.col(c)] + ([F.col(f"_nf_{j}")] if nxt else []) + [F.col(f"_pf_{j}")]
            out.append(F.coalesce(*parts).alias(c))
        else:
            out.append(F.col(c))
    return s.select(*out)


def merge_clean(parts: Sequence[DataFrame], direction: str = "both") -> DataFrame:
    """``merge_final_tables``: U1, F13, F14, F11, F12, (O1 via the fill order), W9, F10, F16.

    The union is written once to the shared folder: the search for all-NULL columns (F14)
    and the fill, which reads its input more than once, scan that table.
    """
    df = union_by_name(parts)
    df = cut_lineage(C.drop_all_null_rows(df))
    df = C.drop_all_null_cols(df)
    df = C.trim_column_names(df)
    df = C.cast_keys(df)
    key = ["permno"] if "permno" in df.columns else (["gvkey"] if "gvkey" in df.columns else [])
    order = [c for c in ("public_year", "public_month") if c in df.columns]
    df = fill_by_group(df, key, order, direction)
    df = C.drop_if_exists(df, C.REDUNDANT_COLUMNS)
    return C.dropna_subset(df, C.KEY_RATIOS)
