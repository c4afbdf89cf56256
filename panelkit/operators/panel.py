"""Firm-month panel construction.

The reference fetches each firm's facts in a sequential loop of remote queries. Here all
firms are processed at once: one event-window join per fact table, per-firm source
fallback by aggregation, and the ordered scans of :mod:`panelkit.operators.ordered` for
growth rates. Nothing is gathered per firm.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.functions.scalar import month_end, quarter_index, safe_ratio_growth, tobins_q
from panelkit.operators.ordered import ordered_scan
from panelkit.operators.universe import year_buckets, year_range
from panelkit.session import cut_lineage
from panelkit.sources.bucketed import FirmLayout, per_firm, stored
from panelkit.sources.fallback import fallback_by_key

# Days in the post-IPO window (5 x 365) and calendar years kept.
WINDOW_DAYS = 1825
MAX_YEARS = 5
MAX_QUARTERS = 20

# Revenue columns in order of preference.
REVENUE_CANDIDATES = ["revtq", "revt_sale", "sale_equity", "sale_invcap"]


def link_interval_join(facts: DataFrame, link: DataFrame, date_col: str = "datadate",
                       years: tuple[int, int] | None = None) -> DataFrame:
    """Map company facts to firms through the link valid on the fact date.

    A link interval meets a fact by (company, calendar year), so a company with many facts
    and many intervals forms no quadratic number of pairs. ``years`` gives the facts' first
    and last year if known; otherwise one aggregate finds them.
    """
    lk = link.filter(F.col("linktype").isin(*C.LINK_TYPES) & F.col("linkprim").isin(*C.LINK_PRIMS))
    lk = lk.filter(F.col("linkdt").isNotNull()).select(
        F.col("gvkey").alias("_lg"), F.col("lpermno").alias("permno"),
        F.col("linkdt").alias("_ld"), F.col("linkenddt").alias("_le"))
    d = F.col(date_col)
    # Spark sizes the repeated rows as if they were not, so it must not broadcast them.
    lk = year_buckets(lk, "_ld", "_le", *(years or year_range(facts, date_col) or (0, 0))).hint("merge")
    cond = ((F.col("gvkey") == F.col("_lg")) & (F.year(d) == F.col("_yb")) & (d >= F.col("_ld"))
            & (F.col("_le").isNull() | (d <= F.col("_le"))))
    return facts.join(lk, cond, "inner").drop("_lg", "_ld", "_le", "_yb")


def event_window_join(events: DataFrame, facts: DataFrame, date_col: str,
                      days: int = WINDOW_DAYS, key: str = "permno",
                      event_date: str = "ipo_date") -> DataFrame:
    """Facts dated within [event, event + days] of their firm's event, all firms at once.
    An event meets a fact by (firm, calendar year), once for each year its window covers."""
    ev = events.filter(F.col(event_date).isNotNull()).select(F.col(key).alias("_ek"), F.col(event_date))
    ev = ev.withColumn("_last", F.date_add(F.col(event_date), days)).withColumn(
        "_yb", F.explode(F.sequence(F.year(event_date), F.year("_last"))))
    ev = ev.hint("merge")      # sized as if not repeated: never broadcast
    d = F.col(date_col)
    cond = ((F.col(key) == F.col("_ek")) & (F.year(d) == F.col("_yb")) & (d >= F.col(event_date))
            & (d <= F.col("_last")))
    return facts.join(ev, cond, "inner").drop("_ek", "_last", "_yb")


def exact_date_left_join(panel: DataFrame, facts: DataFrame, value_cols: Sequence[str],
                         fact_date: str = "datadate", date_col: str = "public_date") -> DataFrame:
    """Add fact values on the exact (firm, date); unmatched rows keep NULL.
    No uniqueness is enforced on the facts (trap T6). Facts grow with the panel and Spark
    sizes a stored table by its compressed files, so it must not broadcast them."""
    f = facts.select("permno", F.col(fact_date).alias(date_col), *value_cols).hint("merge")
    return panel.join(f, on=["permno", date_col], how="left")


def month_end_left_join(panel: DataFrame, facts: DataFrame, value_cols: Sequence[str],
                        fact_date: str = "datadate", date_col: str = "public_date") -> DataFrame:
    """Add fact values on (firm, month end of the date). Facts are not broadcast, as above."""
    f = facts.select("permno", month_end(fact_date).alias("_mm"), *value_cols).hint("merge")
    p = panel.withColumn("_mm", month_end(date_col))
    return p.join(f, on=["permno", "_mm"], how="left").drop("_mm")


def attach_event_attrs(panel: DataFrame, events: DataFrame, key: str = "permno") -> DataFrame:
    """Every event column not already in the panel, on the firm key. The events (a row with
    names per firm) fill many times their compressed size, so they are not broadcast."""
    extra = [c for c in events.columns if c != key and c not in panel.columns]
    if not extra:
        return panel
    return panel.join(events.select(key, *extra).hint("merge"), on=key, how="left")


def semi_membership(df: DataFrame, kept: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``kept`` (no row is repeated, whatever ``kept`` holds)."""
    return df.join(kept, on=list(on), how="left_semi")


#: Periods that one word of a calendar bitmap holds (a bigint without its upper bits).
WORD = 60


def initial_run_years(df: DataFrame, by: str = "permno", date_col: str = "public_date",
                      max_years: int = MAX_YEARS) -> DataFrame:
    """Rows in the first unbroken run of calendar years of each firm, at most ``max_years``
    (1 to 60). See :func:`first_run`."""
    return _initial_run(df, by, F.year(F.col(date_col)), max_years)


def initial_run_quarters(df: DataFrame, by: str = "permno", date_col: str = "public_date",
                         max_quarters: int = MAX_QUARTERS) -> DataFrame:
    """The same over calendar quarters."""
    return _initial_run(df, by, quarter_index(date_col), max_quarters)


def first_run(df: DataFrame, by: str, period: Column, limit: int) -> DataFrame:
    """(by, first, length): per key the first period and the length of the unbroken run that
    begins there, at most ``limit`` periods.

    Each key has a bitmap of its periods in words of 60: a hash aggregate that is combined on
    the map side sets the bits, whatever the number of rows and the span of the periods. A run
    of at most 60 periods lies in the first word that has a bit and the word after it, so a
    second aggregate, over words, keeps those two; the run is the lowest set bits from the
    first one on. Rows without a key or a period count nowhere.
    """
    if not 1 <= limit <= WORD:
        raise ValueError(f"a run is limited to 1 to {WORD} periods")
    per = period.cast("bigint")
    word = F.floor(per / WORD).cast("bigint")
    words = (df.select(F.col(by), word.alias("_w"), F.pmod(per, F.lit(WORD)).cast("int").alias("_b"))
             .filter(F.col(by).isNotNull() & F.col("_w").isNotNull())
             .groupBy(by, "_w").agg(F.bit_or(F.expr("shiftleft(1L, _b)")).alias("_bits")))
    # Each word also stands as the upper half of the word before it.
    nothing = F.lit(0).cast("bigint")
    halves = words.select(by, F.inline(F.array(
        F.struct(F.col("_w"), F.col("_bits").alias("_low"), nothing.alias("_high")),
        F.struct((F.col("_w") - 1).alias("_w"), nothing.alias("_low"), F.col("_bits").alias("_high")))))
    both = halves.groupBy(by, "_w").agg(F.bit_or("_low").alias("_low"), F.bit_or("_high").alias("_high"))
    first = both.filter("_low <> 0").groupBy(by).agg(
        F.min("_w").alias("_w"), F.min_by("_low", "_w").alias("_low"), F.min_by("_high", "_w").alias("_high"))
    # Zeros below the lowest bit, then ones above it; no number here uses the sign bit.
    first = first.withColumn("_z", F.expr("bit_count(~_low & (_low - 1))"))
    ones = f"((shiftrightunsigned(_low, _z) | shiftleft(_high, {WORD} - _z)) & {(1 << WORD) - 1}L)"
    length = F.expr(f"bit_count({ones} & ~({ones} + 1))")
    return first.select(by, (F.col("_w") * WORD + F.col("_z")).alias("first"),
                        F.least(length, F.lit(limit)).alias("length"))


def _initial_run(df: DataFrame, by: str, period, limit: int) -> DataFrame:
    run = first_run(df, by, period, limit).withColumnRenamed(by, "_firm")
    per = period.cast("bigint")
    keep = (F.col(by) == F.col("_firm")) & (per >= F.col("first")) & (per < F.col("first") + F.col("length"))
    return df.join(run, keep, "left_semi")


def revenue_growth(df: DataFrame, by: str = "permno", order: str = "public_date",
                   out: str = "revenue_growth") -> DataFrame:
    """Growth versus the firm's previous non-null revenue, only on non-null rows.

    The revenue column is chosen per firm: the first candidate with any non-null value
    in that firm. Zero base gives +-inf (trap T3).
    """
    return growth_scan(df, by, order, revenue_out=out)


def pct_change(df: DataFrame, col: str, out: str, by: str = "permno",
               order: str = "public_date", fill: str = "pad") -> DataFrame:
    """Change versus the previous row. ``fill="pad"`` forward-fills current and
    previous values first (pandas' long-standing default, trap T4); ``"none"`` does not."""
    return growth_scan(df, by, order, pct={out: col}, fill=fill)


def total_asset_growth(df: DataFrame, by: str = "permno", order: str = "public_date",
                       fill: str = "pad") -> DataFrame:
    """W6 on total assets; a firm without any total assets gets NULL."""
    return pct_change(df, "total_assets", "total_asset_growth", by, order, fill)


def growth_scan(df: DataFrame, by: str, order: str, revenue_out: str | None = None,
                pct: dict[str, str] | None = None, fill: str = "pad") -> DataFrame:
    """W5 and W6 in one ordered scan (one range shuffle for all growth columns)."""
    pct = dict(pct or {})
    if fill not in ("pad", "none"):
        raise ValueError("fill must be 'pad' or 'none'")
    cands = [c for c in REVENUE_CANDIDATES if c in df.columns] if revenue_out else []
    prev = {f"_pv_{c}": c for c in cands}
    lag = {}
    for out_col, src in pct.items():
        if fill == "pad":
            prev[f"_pv_{out_col}"] = src
        else:
            lag[f"_lg_{out_col}"] = src
    # with several candidates, the scan also counts each one's values in the whole firm
    counts = {f"_has_{c}": c for c in cands} if len(cands) > 1 else {}
    s = ordered_scan(df, [by], [order], prev_nonnull=prev, lag=lag, group_count=counts) if (prev or lag) else df
    new_cols = {}
    if revenue_out:
        choice = None
        for c in cands:
            g = F.when(F.col(c).isNotNull(), safe_ratio_growth(F.col(c), F.col(f"_pv_{c}")))
            cond = F.col(f"_has_{c}") > 0 if counts else F.lit(True)
            choice = F.when(cond, g) if choice is None else choice.when(cond, g)
        new_cols[revenue_out] = choice if choice is not None else F.lit(None).cast("double")
    for out_col, src in pct.items():
        if fill == "pad":
            cur = F.coalesce(F.col(src), F.col(f"_pv_{out_col}"))
            prv = F.col(f"_pv_{out_col}")
        else:
            cur, prv = F.col(src), F.col(f"_lg_{out_col}")
        new_cols[out_col] = F.when(cur.isNotNull() & prv.isNotNull(), safe_ratio_growth(cur, prv))
    s = s.withColumns({k: v.cast("double") for k, v in new_cols.items()})
    helpers = [c for c in s.columns if c.startswith(("_pv_", "_lg_", "_has_"))]
    return s.drop(*helpers)


def add_tobins_q(df: DataFrame, out: str = "tobinq") -> DataFrame:
    """X9 on the panel columns."""
    return df.withColumn(out, tobins_q("shrout", "prcc_c", "pstk", "total_liabilities",
                                       "total_assets"))


# --- the whole fetch stage -------------------------------------------------------------------

@dataclass
class FactSources:
    """Ranked sources per fact (first source with rows for a firm wins, per firm)."""
    ratios: DataFrame
    link: DataFrame
    assets: list[DataFrame]            # annual statements with ``at``
    revenue: list[DataFrame]           # quarterly statements with ``revtq``
    liabilities: list[DataFrame]       # annual statements with ``lt``
    shares: list[DataFrame]            # monthly stock file with ``date``, ``shrout``
    price: list[tuple[DataFrame, bool]] = field(default_factory=list)  # (source, std filter?)


def _linked_facts(sources: Sequence[DataFrame | tuple[DataFrame, bool]], link: DataFrame,
                  events: DataFrame, values: dict[str, str], std: bool, not_null: str | None,
                  days: int) -> DataFrame:
    """Statement facts -> firms (J4) -> post-IPO window (J5) -> per-firm fallback.
    A source may be given as ``(df, std)`` to override the standard-format filter. All sources
    are linked at once and written, as the fallback reads them twice."""
    facts = None
    for i, item in enumerate(sources):
        src, use_std = item if isinstance(item, tuple) else (item, std)
        f = C.std_format_filter(src) if use_std else src
        if not_null:
            f = f.filter(F.col(not_null).isNotNull())
        f = f.select("gvkey", "datadate", *[F.col(s).alias(o) for o, s in values.items()], F.lit(i).alias("_src"))
        facts = f if facts is None else facts.unionByName(f)
    linked = event_window_join(events, link_interval_join(facts, link), "datadate", days)
    linked = cut_lineage(linked.select("permno", "datadate", *values, "_src"))
    return _fallback(linked, len(sources))


def _window_facts(sources: Sequence[DataFrame], events: DataFrame, days: int) -> DataFrame:
    """The same for tables that carry the firm itself (the stock files)."""
    facts = None
    for i, s in enumerate(sources):
        f = s.select("permno", F.col("date").alias("datadate"), "shrout", F.lit(i).alias("_src"))
        facts = f if facts is None else facts.unionByName(f)
    linked = event_window_join(events, facts, "datadate", days).drop("ipo_date")
    return _fallback(cut_lineage(linked), len(sources))


def _fallback(linked: DataFrame, n: int) -> DataFrame:
    return fallback_by_key([linked.filter(F.col("_src") == i).drop("_src") for i in range(n)], "permno")


class Steps(dict):
    """Named steps, each planned when it is first asked for (with those it builds on): a step
    that writes a table or looks for bounds costs nothing to whoever needs only earlier ones."""

    def __init__(self, makers: dict[str, Callable[[Steps], DataFrame]]):
        super().__init__()
        self.makers = makers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.makers[name](self)
        return self[name]


def panel_stages(ipo: DataFrame, src: FactSources, days: int = WINDOW_DAYS,
                 max_years: int = MAX_YEARS, fill: str = "pad") -> Steps:
    """The fetch stage as named lazy steps (each later step builds on the earlier ones).

    What a step reads more than once is written first: linked facts (by the fallback), the rows
    whose first run is sought, and those of the growth scan. No plan holds the whole stage.
    """
    events = ipo.select("permno", "ipo_date")

    def linked(sources, values, not_null=None):
        return _linked_facts(sources, src.link, events, values, True, not_null, days)

    return Steps({
        "window": lambda st: event_window_join(events, src.ratios, "public_date", days),
        "assets": lambda st: exact_date_left_join(
            st["window"], linked(src.assets, {"total_assets": "at"}, "at"), ["total_assets"]),
        "revenue": lambda st: exact_date_left_join(
            st["assets"], linked(src.revenue, {"revtq": "revtq"}, "revtq"), ["revtq"]),
        "years": lambda st: initial_run_years(cut_lineage(st["revenue"]), "permno", "public_date", max_years),
        "price": lambda st: linked(src.price, {"prcc_c": "prcc_c", "pstk": "pstk"}),
        "liab": lambda st: linked(src.liabilities, {"total_liabilities": "lt"}, "lt"),
        "shares": lambda st: _window_facts(src.shares, events, days),
        "month_end": lambda st: join_month_end(st["years"], st["price"], st["liab"], st["shares"]),
        "tobinq": lambda st: add_tobins_q(st["month_end"]),
        "growth": lambda st: growth_scan(cut_lineage(st["tobinq"]), "permno", "public_date",
                                         revenue_out="revenue_growth",
                                         pct={"total_asset_growth": "total_assets"}, fill=fill),
        "attrs": lambda st: attach_event_attrs(st["growth"], ipo),
        "panel": lambda st: C.conform_columns(st["attrs"])})


def _fact_union(src: FactSources) -> DataFrame:
    """Every statement source of every fact kind in one table, tagged (kind, priority)."""
    kinds = [("assets", src.assets, True, "at", {"total_assets": "at"}),
             ("revenue", src.revenue, True, "revtq", {"revtq": "revtq"}),
             ("price", src.price, True, None, {"prcc_c": "prcc_c", "pstk": "pstk"}),
             ("liab", src.liabilities, True, "lt", {"total_liabilities": "lt"})]
    value_cols = ["total_assets", "revtq", "prcc_c", "pstk", "total_liabilities"]
    parts = []
    for kind, sources, std, not_null, values in kinds:
        for prio, item in enumerate(sources):
            s, use_std = item if isinstance(item, tuple) else (item, std)
            f = C.std_format_filter(s) if use_std else s
            if not_null:
                f = f.filter(F.col(not_null).isNotNull())
            cols = [F.col(values[v]).cast("double").alias(v) if v in values
                    else F.lit(None).cast("double").alias(v) for v in value_cols]
            parts.append(f.select("gvkey", "datadate", F.lit(kind).alias("_kind"),
                                  F.lit(prio).alias("_prio"), *cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def join_month_end(panel: DataFrame, price: DataFrame, liab: DataFrame, shares: DataFrame) -> DataFrame:
    """J8 for all month-end facts. On tables written by firm no row is shuffled."""
    m = month_end_left_join(panel, price, ["prcc_c", "pstk"])
    m = month_end_left_join(m, liab, ["total_liabilities"])
    return month_end_left_join(m, shares, ["shrout"])


def join_facts(base: DataFrame, facts: DataFrame) -> DataFrame:
    """The facts of each kind to the panel rows. On tables written by firm
    (:mod:`panelkit.sources.bucketed`) none of the five joins shuffles a row."""
    def kind(k, *cols):
        return facts.filter(F.col("_kind") == k).select("permno", "datadate", *cols)

    panel = exact_date_left_join(base, kind("assets", "total_assets"), ["total_assets"])
    panel = exact_date_left_join(panel, kind("revenue", "revtq"), ["revtq"])
    return join_month_end(panel, kind("price", "prcc_c", "pstk"), kind("liab", "total_liabilities"),
                          kind("shares", "shrout"))


def build_panel(ipo: DataFrame, src: FactSources, days: int = WINDOW_DAYS,
                max_years: int = MAX_YEARS, fill: str = "pad") -> DataFrame:
    """The fetched monthly panel, planned for scale (same result as the step-by-step
    :func:`panel_stages`, which the oracle check confirms):

    * one firm-window table (link x IPO window) and ONE interval join for all statement
      facts of all kinds and sources, written once, then ONE per-(firm, kind) fallback;
    * panel rows and chosen facts written once by firm, so that their joins shuffle nothing
      (firms with very many rows beside the buckets);
    * the first unbroken run of years (W7) right after the window join -- left joins never
      change the (firm, year) set, so the filter commutes with them.
    """
    events = ipo.select("permno", "ipo_date")
    lk = src.link.filter(F.col("linktype").isin(*C.LINK_TYPES) & F.col("linkprim").isin(*C.LINK_PRIMS))
    # firm-windows: link interval and event window cut to one interval, repeated by year
    window = lk.select("gvkey", F.col("lpermno").alias("permno"), "linkdt", "linkenddt").join(
        events, on="permno", how="inner")
    window = (window.withColumn("_from", F.greatest("linkdt", "ipo_date"))
              .withColumn("_to", F.least(F.col("linkenddt"), F.date_add(F.col("ipo_date"), days)))
              .filter(F.col("linkdt").isNotNull() & F.col("ipo_date").isNotNull() & (F.col("_from") <= F.col("_to")))
              .withColumn("_yb", F.explode(F.sequence(F.year("_from"), F.year("_to")))).hint("merge"))
    facts = _fact_union(src).withColumnRenamed("gvkey", "_fg")
    d = F.col("datadate")
    cond = ((F.col("_fg") == F.col("gvkey")) & (F.year(d) == F.col("_yb"))
            & (d >= F.col("_from")) & (d <= F.col("_to")))
    values = ["total_assets", "revtq", "prcc_c", "pstk", "total_liabilities"]
    linked = facts.join(window, cond, "inner").select("permno", "datadate", "_kind", "_prio", *values)
    # stock file rows carry the firm itself
    for prio, s in enumerate(src.shares):
        rows = event_window_join(events, s.select("permno", F.col("date").alias("datadate"), "shrout"), "datadate", days)
        linked = linked.unionByName(rows.select("permno", "datadate", F.lit("shares").alias("_kind"),
                                                F.lit(prio).alias("_prio"), F.col("shrout").cast("double")),
                                    allowMissingColumns=True)
    # written once: the fallback reads it twice instead of joining twice
    linked = cut_lineage(linked)
    chosen = linked.groupBy("permno", "_kind").agg(F.min("_prio").alias("_prio"))
    facts = semi_membership(linked, chosen, ["permno", "_kind", "_prio"])
    base = initial_run_years(event_window_join(events, src.ratios, "public_date", days),
                             "permno", "public_date", max_years)
    # panel rows and facts once by firm: the five joins between them shuffle nothing
    layout = FirmLayout.of([linked, src.ratios])
    panel = per_firm(join_facts, layout.write(base, ["public_date"]), layout.write(facts.drop("_prio"), ["datadate"]))
    # the scan below reads its input more than once (bounds, rows, summaries)
    panel = stored(add_tobins_q(panel), layout.spark)
    panel = growth_scan(panel, "permno", "public_date", revenue_out="revenue_growth",
                        pct={"total_asset_growth": "total_assets"}, fill=fill)
    return C.conform_columns(attach_event_attrs(panel, ipo))
