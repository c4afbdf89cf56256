"""Joins of dates with intervals by a dyadic index over days.

Days are the leaves of a binary tree. An interval is stored at the nodes whose leaves make
it up, of which there are at most two per level; a date lies under one node per level. A
date and an interval that holds it therefore share exactly one node, and an equi-join on
(key, node) finds each pair once, without forming the pairs of a key that do not overlap.
Repeated rows are sorted and merged, not broadcast: Spark sizes them as if they were not
repeated, so a table just under its broadcast limit would fill the driver and the tasks.
Rows per interval are bounded by twice the logarithm of its span, whether it covers a week
or sixty years; a date is looked up once per level. Everything is a column expression.

Leaves may hold several days (``leaf`` = log2 of them): fewer levels and rows, and the
exact comparison of dates that follows drops the pairs that share only a leaf.

Where the dates are the large side and windows are short (statement facts), repeating the
window for each calendar year moves fewer rows than looking every fact up on each level;
:func:`panelkit.operators.universe.year_buckets` stays the way there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a leaf, as log2: 32.
LEAF = 5
_EPOCH = dt.date(1970, 1, 1)


def day_number(c: Column) -> Column:
    return F.datediff(c, F.lit(_EPOCH))


def _as_day(d: dt.date | str) -> int:
    d = dt.date.fromisoformat(d[:10]) if isinstance(d, str) else d
    return (d - _EPOCH).days


def levels(days: tuple[int, int], leaf: int = LEAF, span: int | None = None) -> int:
    """Highest level that intervals between the two days use, or of ``span`` days at most."""
    leaves = (days[1] >> leaf) - (days[0] >> leaf) + 1
    if span is not None:
        leaves = min(leaves, (span >> leaf) + 2)
    return (leaves - 1).bit_length()


def day_range(df: DataFrame, date_col: str) -> tuple[int, int] | None:
    """First and last day of a date column (one aggregate of one column); None without any."""
    r = df.agg(F.min(day_number(F.col(date_col))).alias("lo"), F.max(day_number(F.col(date_col))).alias("hi")).first()
    return None if r["lo"] is None else (r["lo"], r["hi"])


def _node(index: Column, level: int) -> Column:
    return index.cast("bigint") * 64 + level


def cover(first: Column, last: Column, top: int, leaf: int = LEAF) -> Column:
    """Nodes that make up the days ``first`` to ``last`` (day numbers), null if there are none.

    On level k the leaves before ceil(a / 2**k) and from floor((b + 1) / 2**k) on are outside
    or covered below; an odd one at either end has no parent inside, so it is stored here.
    """
    nodes = []
    for k in range(top + 1):
        left = F.shiftright(F.shiftright(first, leaf) + ((1 << k) - 1), k)
        right = F.shiftright(F.shiftright(last, leaf) + 1, k)
        inside = left < right
        nodes.append(F.when(inside & (left.bitwiseAND(F.lit(1)) == 1), _node(left, k)))
        nodes.append(F.when(inside & (right.bitwiseAND(F.lit(1)) == 1), _node(right - 1, k)))
    return F.when(first <= last, F.array_compact(F.array(*nodes)))


def path(day: Column, top: int, leaf: int = LEAF) -> Column:
    """The node over a day on each level."""
    return F.array(*[_node(F.shiftright(day, leaf + k), k) for k in range(top + 1)])


def indexed_intervals(df: DataFrame, start: str, end: str, days: tuple[int, int], leaf: int = LEAF,
                      span: int | None = None, out: str = "_node") -> DataFrame:
    """Rows repeated for each node of [start, end]; null ends are open, and all are cut to the
    days (first, last) that the dates can have. Intervals outside of them are left out.
    ``span`` is the most days from start to end, if there is a bound and no end is open."""
    first = F.greatest(F.coalesce(day_number(F.col(start)), F.lit(days[0])), F.lit(days[0]))
    last = F.least(F.coalesce(day_number(F.col(end)), F.lit(days[1])), F.lit(days[1]))
    return df.withColumn(out, F.explode(cover(first, last, levels(days, leaf, span), leaf)))


def indexed_dates(df: DataFrame, date_col: str, days: tuple[int, int], leaf: int = LEAF,
                  span: int | None = None, out: str = "_node") -> DataFrame:
    """Rows repeated for each level; rows outside of the days (null dates, too) are left out."""
    day = day_number(F.col(date_col))
    return df.filter(day.between(*days)).withColumn(out, F.explode(path(day, levels(days, leaf, span), leaf)))


def days_of(start: dt.date | str, end: dt.date | str) -> tuple[int, int]:
    """Day numbers of two dates."""
    return _as_day(start), _as_day(end)


def holds(date_col: Column, start: Column, end: Column, open_start: bool) -> Column:
    """The interval holds the date; a null end is open, a null start only with ``open_start``."""
    begun = start <= date_col
    return ((start.isNull() | begun) if open_start else begun) & (end.isNull() | (end >= date_col))


def date_interval_join(dates: DataFrame, intervals: DataFrame, date_col: str, key: str, interval_key: str,
                       start: str, end: str, how: str = "inner", open_start: bool = False,
                       days: tuple[int, int] | None = None, leaf: int = LEAF, span: int | None = None) -> DataFrame:
    """``dates`` with the columns of every interval of their key that holds their date.

    ``how`` is ``inner`` or ``left`` (rows without an interval keep nulls). ``days`` are the
    first and last day number that dates can have; if they are not known, one aggregate finds
    them. ``span`` bounds the days from start to end where no end is open. Null keys and null dates match nothing; repeated rows each match. Key columns and
    interval columns must have other names than those of ``dates``, up to an equal key name.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    days = days or day_range(dates, date_col) or (0, 0)
    own = intervals.withColumnRenamed(interval_key, "_ik")
    own = indexed_intervals(own.filter(F.col("_ik").isNotNull()), start, end, days, leaf, span).hint("merge")
    held = holds(F.col(date_col), F.col(start), F.col(end), open_start)
    if how == "inner":
        found = indexed_dates(dates, date_col, days, leaf, span).withColumnRenamed("_node", "_dn")
        cond = (F.col(key) == F.col("_ik")) & (F.col("_dn") == F.col("_node")) & held
        return found.join(own, cond, "inner").drop("_ik", "_dn", "_node")
    # A row without a match must come back once, not once per level: match the distinct
    # (key, date) pairs first, then join by equality.
    pairs = dates.select(F.col(key).alias("_k"), F.col(date_col).alias("_d")).distinct()
    pairs = indexed_dates(pairs, "_d", days, leaf, span).withColumnRenamed("_node", "_dn")
    held = holds(F.col("_d"), F.col(start), F.col(end), open_start)
    matched = pairs.join(own, (F.col("_k") == F.col("_ik")) & (F.col("_dn") == F.col("_node")) & held, "inner")
    matched = matched.drop("_ik", "_dn", "_node")
    return dates.join(matched, (F.col(key) == F.col("_k")) & (F.col(date_col) == F.col("_d")), "left").drop("_k", "_d")
