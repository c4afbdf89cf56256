"""Scalar column expressions (X1-X16). All built-in, JVM-side; no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_date_coerce(x) -> Column:
    """Parse to date; unparseable values become NULL (never an error under ANSI)."""
    return F.to_date(F.try_to_timestamp(_c(x).cast("string")))


def year_month_parts(d) -> tuple[Column, Column]:
    """(year, month) of a date."""
    return F.year(_c(d)), F.month(_c(d))


def month_end(d) -> Column:
    """Month-end date key."""
    return F.last_day(_c(d))


def quarter_index(d) -> Column:
    """Quarter period as an integer index; consecutive quarters differ by 1."""
    return F.year(_c(d)) * 4 + F.quarter(_c(d)) - 1


def add_years(d, n: int) -> Column:
    """Calendar years; Feb 29 maps to Feb 28."""
    return F.add_months(_c(d), 12 * int(n))


def add_days(d, n: int) -> Column:
    """Plus n days."""
    return F.date_add(_c(d), int(n))


def years_between_rounded(a, b) -> Column:
    """round(days / 365) as int, half-to-even like numpy."""
    return F.bround(F.datediff(_c(b), _c(a)) / F.lit(365.0)).cast("int")


def safe_ratio_growth(cur, prev) -> Column:
    """cur / prev - 1 with pandas' zero-base rule: x/0 -> +-inf, 0/0 -> NULL (trap T3)."""
    cur, prev = _c(cur), _c(prev)
    zero_base = (F.when(cur > 0, F.lit(_INF)).when(cur < 0, F.lit(-_INF))
                 .otherwise(F.lit(None).cast("double")))
    return F.when(prev == 0, zero_base).otherwise(cur / prev - 1)


def tobins_q(shrout, prcc_c, pstk, total_liabilities, total_assets) -> Column:
    """(shrout*1000*prcc_c/1e6 + nvl(pstk,0) + nvl(lt,0)) / at.

    NULL when price, shares or assets are missing, or when assets are 0.
    """
    shrout, prcc_c, at = _c(shrout), _c(prcc_c), _c(total_assets)
    num = (shrout * 1000.0 * prcc_c / 1e6 + F.coalesce(_c(pstk), F.lit(0.0))
           + F.coalesce(_c(total_liabilities), F.lit(0.0)))
    ok = prcc_c.isNotNull() & shrout.isNotNull() & at.isNotNull() & (at != 0)
    return F.when(ok, num / at)


def date_from_year(y) -> Column:
    """January 1 of the year."""
    return F.make_date(_c(y), F.lit(1), F.lit(1))


def coalesce_pref(*cols) -> Column:
    """X11: first non-null, preferring the earlier argument."""
    return F.coalesce(*[_c(c) for c in cols])


def clip(x, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (least/greatest skip nulls, so guard)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(hi)), F.lit(lo)))


def linspace_edges(lo: float, hi: float, n_bins: int) -> list[float]:
    """Equal-width edges computed like numpy.linspace (float64)."""
    import numpy as np
    return [float(v) for v in np.linspace(lo, hi, n_bins + 1)]


# Clip range and bin count of the ROA event-rate profile; edges follow numpy.linspace.
ROA_BIN_EDGES = linspace_edges(-1.0, 1.0, 10)


def bin_label(lo: float, hi: float) -> str:
    return f"{lo:.1f} ~ {hi:.1f}"


def cut_bins(x, edges: list[float]) -> Column:
    """Right-closed bins (lo, hi], the lowest edge included; 0-based bin id or NULL."""
    x = _c(x)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = (x >= lo) & (x <= hi) if i == 0 else (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def map_label(x) -> Column:
    """0/1 -> 'Not Delisted'/'Delisted', else NULL."""
    x = _c(x)
    return F.when(x == 0, "Not Delisted").when(x == 1, "Delisted")


def string_normalise(x) -> Column:
    """Trim + upper."""
    return F.upper(F.trim(_c(x)))


def percent_label(rate, n) -> Column:
    """X16: '12.3%' and the sample size on a second line, like the bar annotations.

    The percentage is rounded half-to-even first, as Python's format does for exact ties.
    """
    rate = _c(rate)
    return F.when(rate.isNotNull(),
                  F.format_string("%.1f%%\n(n=%d)", F.bround(rate * 100, 1), _c(n)))
