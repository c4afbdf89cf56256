"""Semantic traps T1-T18 and edge rules on tiny hand-made frames."""

import datetime as dt
import math

import numpy as np
import pytest

from panelkit.functions import cleaning as C
from panelkit.functions import scalar as X
from panelkit.operators import features as FE
from panelkit.operators import labels as L
from panelkit.operators import panel as P
from panelkit.operators import universe as U
from panelkit.sources.io import nan_to_null

D = dt.date


def test_t1_t3_zero_base_growth_gives_signed_inf(spark):
    df = spark.createDataFrame(
        [(1, D(2000, 1, 31), 0.0), (1, D(2000, 2, 29), 5.0), (1, D(2000, 3, 31), 0.0),
         (1, D(2000, 4, 30), 0.0), (1, D(2000, 5, 31), -2.0), (1, D(2000, 6, 30), None),
         (1, D(2000, 7, 31), 4.0)], "permno long, public_date date, revtq double")
    out = {r.public_date: r.revenue_growth for r in P.revenue_growth(df).collect()}
    assert out[D(2000, 1, 31)] is None                 # first value
    assert out[D(2000, 2, 29)] == math.inf             # 5 / 0
    assert out[D(2000, 3, 31)] == -1.0
    assert out[D(2000, 4, 30)] is None                 # 0 / 0 -> NaN -> missing
    assert out[D(2000, 5, 31)] == -math.inf            # -2 / 0
    assert out[D(2000, 6, 30)] is None                 # null rows stay null
    assert out[D(2000, 7, 31)] == pytest.approx(-3.0)  # vs previous non-null (-2)


def test_t2_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k int, x double")
    assert [r.x for r in nan_to_null(df).orderBy("k").collect()] == [None, 1.0]


def test_t3_inf_stops_fill_and_survives_dropna(spark):
    df = spark.createDataFrame(
        [(1, 2000, 1, 1.0), (1, 2000, 2, math.inf), (1, 2000, 3, None), (1, 2000, 4, None)],
        "permno long, public_year int, public_month int, tobinq double")
    filled = L.fill_by_group(df, ["permno"], ["public_year", "public_month"])
    vals = [r.tobinq for r in filled.orderBy("public_month").collect()]
    assert vals == [1.0, math.inf, math.inf, math.inf]
    assert C.dropna_subset(filled, ["tobinq"]).count() == 4


def test_t4_pct_change_pad_vs_none(spark):
    df = spark.createDataFrame(
        [(1, D(2000, 1, 31), 10.0), (1, D(2000, 2, 29), None), (1, D(2000, 3, 31), 15.0)],
        "permno long, public_date date, total_assets double")
    pad = [r.total_asset_growth for r in P.total_asset_growth(df).orderBy("public_date").collect()]
    none = [r.total_asset_growth for r in
            P.total_asset_growth(df, fill="none").orderBy("public_date").collect()]
    assert pad == [None, 0.0, 0.5]          # pandas pads before differencing
    assert none == [None, None, None]


def _names(spark):
    return spark.createDataFrame(
        [(1, D(1990, 1, 1), D(1995, 1, 1), "A", "AA", 1, 10),
         (1, D(1995, 1, 1), None, "B", "BB", 1, 11),      # touches the previous interval
         (2, D(1990, 1, 1), None, "C", "CC", 5, 10)],     # exchange 5: filtered out
        "permno long, namedt date, nameenddt date, comnam string, ticker string, exchcd int, shrcd int")


def test_t5_left_join_becomes_inner(spark):
    company = spark.createDataFrame([("g1", "One", D(1996, 1, 1)), ("g2", "Two", D(1996, 1, 1)),
                                     ("g3", "Three", D(1996, 1, 1))],
                                    "gvkey string, conm string, ipodate date")
    link = spark.createDataFrame([("g1", 1, "LU", "P", D(1990, 1, 1), None),
                                  ("g2", 2, "LC", "C", D(1990, 1, 1), None)],
                                 "gvkey string, lpermno long, linktype string, linkprim string, linkdt date, linkenddt date")
    out = U.ipo_from_company(company, link, _names(spark), "", "1990-01-01", "2000-12-31")
    assert [r.permno for r in out.collect()] == [1]      # g2 -> exchange 5, g3 unlinked


def test_t6_t7_fanout_kept_and_ties_deterministic(spark):
    ev = spark.createDataFrame([(1, D(1995, 1, 1), 100)], "permno long, dlstdt date, dlstcd int")
    joined = U.validity_join_inner(ev, _names(spark), "dlstdt")
    assert joined.count() == 2                           # both touching intervals match
    latest = U.delist_latest(ev, _names(spark), "", "1990-01-01", "2000-12-31").collect()
    assert len(latest) == 1 and latest[0].comnam == "B"  # descending tie-break, stable


def test_t8_null_keys_dropped_in_fill(spark):
    df = spark.createDataFrame([(None, 2000, 1, 1.0), (1, 2000, 1, None), (1, 2000, 2, 2.0)],
                               "permno long, public_year int, public_month int, x double")
    out = L.fill_by_group(df, ["permno"], ["public_year", "public_month"]).collect()
    assert sorted(r.x for r in out) == [2.0, 2.0]


def test_t9_std_flavours(spark):
    df = spark.createDataFrame([(1, 2000, 1, 0, 1.0), (2, 2000, 1, 0, 1.0), (2, 2000, 2, 0, 3.0),
                                (2, 2001, 1, 1, 1.0)],
                               "permno long, public_year int, public_month int, delist int, quick_ratio double")
    y = {(r.permno, r.public_year): r for r in
         FE.yearly_features(df).collect()}
    assert (1, 2000) not in y                             # no next year -> dropped
    assert y[(2, 2000)].quick_ratio_std == pytest.approx(math.sqrt(2.0))   # ddof 1
    one = FE.yearly_features(df.union(spark.createDataFrame(
        [(1, 2001, 1, 0, 5.0)], df.schema))).filter("permno = 1").first()
    assert one.quick_ratio_std is None                   # a single value -> NULL


def test_t10_bins_right_closed(spark):
    edges = X.ROA_BIN_EDGES
    df = spark.createDataFrame([(-1.0,), (-0.8,), (-0.79,), (0.0,), (1.0,), (1.5,), (None,)], "x double")
    got = [r.b for r in df.select(X.cut_bins(X.clip("x", -1.0, 1.0), edges).alias("b")).collect()]
    assert got == [0, 0, 1, 4, 9, 9, None]


def test_t11_next_available_year(spark):
    df = spark.createDataFrame([(1, 2000, 1, 0, 1.0), (1, 2002, 1, 1, 1.0), (1, 2003, 1, 0, 1.0)],
                               "permno long, public_year int, public_month int, delist int, roa double")
    y = {r.public_year: r.y_next_year for r in FE.yearly_features(df).collect()}
    assert y == {2000: 1, 2002: 0}                       # 2000 takes 2002's label


def test_t12_label_year_and_rounding(spark):
    panel = spark.createDataFrame([(1, D(2003, 6, 30)), (1, D(2004, 6, 30)), (2, D(2003, 6, 30))],
                                  "permno long, public_date date")
    ev = spark.createDataFrame([(1, D(2000, 3, 1), D(2003, 10, 1))],
                               "permno long, ipo_date date, delist_date date")
    out = {(r.permno, r.public_year): (r.delist, r.delist_year)
           for r in L.event_label(panel, ev).collect()}
    # 1309 days / 365 = 3.59 -> 4 -> event year 2004 (not the delisting's own year 2003)
    assert out == {(1, 2003): (0, 4), (1, 2004): (1, 4), (2, 2003): (0, 0)}


def test_t13_forward_only_fill(spark):
    df = spark.createDataFrame([(1, 2000, 1, None), (1, 2000, 2, 2.0), (1, 2000, 3, None)],
                               "permno long, public_year int, public_month int, x double")
    both = [r.x for r in L.fill_by_group(df, ["permno"], ["public_year", "public_month"])
            .orderBy("public_month").collect()]
    fwd = [r.x for r in L.fill_by_group(df, ["permno"], ["public_year", "public_month"], "forward")
           .orderBy("public_month").collect()]
    assert both == [2.0, 2.0, 2.0] and fwd == [None, 2.0, 2.0]


def test_t17_exchange_parsing():
    assert C.normalize_exchange("") == [1, 2, 3]
    assert C.normalize_exchange(" nasdaq ") == [3]
    assert C.normalize_exchange("2") == [2]
    assert C.normalize_exchange("NYSE, AMEX, FOO") == [1, 2]
    with pytest.raises(ValueError):
        C.normalize_exchange("1,2")
    with pytest.raises(ValueError):
        C.normalize_exchange("LSE")


def test_t18_delist_alias_and_missing_columns(spark):
    df = spark.createDataFrame([(1, "2001-02-03")], "PERMNO long, NameEndt string")
    out = C.standardize_delist(df).first()
    assert out.delist_date == D(2001, 2, 3) and out.comnam_delist is None
    with pytest.raises(ValueError):
        C.standardize_ipo(spark.createDataFrame([(1,)], "permno long"))


def test_feb29_add_years_and_window(spark):
    ipo = spark.createDataFrame([(1, "A", "T", D(2000, 2, 29))],
                                "permno long, comnam string, ticker string, ipo_date date")
    dl = spark.createDataFrame([(1, D(2005, 2, 28)), ], "permno long, delist_date date")
    assert U.delist_within_years(ipo, dl, 5).count() == 1
    dl2 = spark.createDataFrame([(1, D(2005, 3, 1))], "permno long, delist_date date")
    assert U.delist_within_years(ipo, dl2, 5).count() == 0


def test_years_between_rounded_half_even(spark):
    df = spark.createDataFrame([(D(2000, 1, 1), D(2000, 1, 1) + dt.timedelta(days=d))
                                for d in (0, 182, 183, 547, 548)], "a date, b date")
    got = [r.y for r in df.select(X.years_between_rounded("a", "b").alias("y")).collect()]
    assert got == [int(np.round(d / 365)) for d in (0, 182, 183, 547, 548)]


def test_tobins_q_rules(spark):
    df = spark.createDataFrame(
        [(100.0, 2.0, None, None, 10.0), (100.0, 2.0, 1.0, 3.0, 0.0), (None, 2.0, 1.0, 3.0, 10.0)],
        "shrout double, prcc_c double, pstk double, total_liabilities double, total_assets double")
    got = [r.q for r in df.select(X.tobins_q("shrout", "prcc_c", "pstk", "total_liabilities",
                                             "total_assets").alias("q")).collect()]
    assert got[0] == pytest.approx((100 * 1000 * 2 / 1e6) / 10) and got[1] is None and got[2] is None


def test_initial_run_years_vs_loop(spark):
    rng = np.random.default_rng(7)
    rows = []
    for firm in range(30):
        years = sorted(set(rng.integers(1990, 2005, rng.integers(1, 9)).tolist()))
        for y in years:
            rows.append((firm, D(y, 6, 30)))
    df = spark.createDataFrame(rows, "permno long, public_date date")
    got = sorted((r.permno, r.public_date.year) for r in P.initial_run_years(df).collect())
    exp = []
    for firm in range(30):
        ys = sorted({d.year for f, d in rows if f == firm})
        run = [ys[0]]
        for y in ys[1:5]:
            if y == run[-1] + 1:
                run.append(y)
            else:
                break
        exp += [(firm, y) for y in run]
    assert got == sorted(exp)


def test_slope_closed_form_vs_numpy(spark):
    rng = np.random.default_rng(11)
    rows = []
    for firm in range(20):
        for m in range(1, 13):
            if rng.random() < 0.8:
                v = None if rng.random() < 0.3 else float(rng.normal())
                rows.append((firm, 2000, m, 0, v))
    df = spark.createDataFrame(rows, "permno long, public_year int, public_month int, delist int, roa double")
    got = {r.permno: r.roa_slope for r in df.groupBy("permno").agg(
        FE.slope_expr("roa", "public_month").alias("roa_slope")).collect()}
    for firm in range(20):
        g = [(m, v) for f, _, m, _, v in rows if f == firm]
        x = np.array([m for m, _ in g], float)
        y = np.array([np.nan if v is None else v for _, v in g])
        x = (x - np.nanmean(x)) / (np.nanstd(x) + 1e-6)
        mask = np.isfinite(x) & np.isfinite(y)
        exp = float(np.dot(x[mask], y[mask]) / (np.dot(x[mask], x[mask]) + 1e-6)) if mask.sum() >= 2 else None
        if exp is None:
            assert got[firm] is None
        else:
            assert got[firm] == pytest.approx(exp, rel=1e-9, abs=1e-12)


def test_histogram_matches_numpy(spark):
    from panelkit.operators.profile import histogram
    rng = np.random.default_rng(2)
    vals = np.concatenate([rng.lognormal(size=500), [0.0, 10.0, 3.3]])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    got = [r["count"] for r in histogram(df, "x").orderBy("bin").collect()]
    assert got == np.histogram(vals, bins=40)[0].tolist()
    zoom = [r["count"] for r in histogram(df, "x", zoom=(0.0, 10.0)).orderBy("bin").collect()]
    z = vals[(vals >= 0) & (vals <= 10)]
    assert zoom == np.histogram(z, bins=40)[0].tolist()
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert sum(r["count"] for r in histogram(const, "x").collect()) == 2


def test_boxplot_matches_numpy(spark):
    from panelkit.operators.profile import boxplot_stats
    rng = np.random.default_rng(4)
    rows = [(int(rng.random() < 0.2), float(v)) for v in rng.standard_t(3, 400)]
    df = spark.createDataFrame(rows, "delist int, roa double")
    got = {r.group: r for r in boxplot_stats(df).collect()}
    for lab, name in ((0, "Not Delisted"), (1, "Delisted")):
        x = np.array([v for d, v in rows if d == lab])
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        iqr = q3 - q1
        lo, hi = x[x >= q1 - 1.5 * iqr].min(), x[x <= q3 + 1.5 * iqr].max()
        r = got[name]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
        assert (r.whisker_lo, r.whisker_hi) == pytest.approx((lo, hi))
        assert r.n_outliers == int(((x < lo) | (x > hi)).sum())


def test_w5_revenue_column_chosen_per_firm(spark):
    """Firm 1 has revtq, firm 2 only revt_sale: each grows on its own column."""
    df = spark.createDataFrame(
        [(1, D(2000, 1, 31), 10.0, 99.0), (1, D(2000, 2, 29), 12.0, 1.0),
         (2, D(2000, 1, 31), None, 4.0), (2, D(2000, 2, 29), None, 5.0)],
        "permno long, public_date date, revtq double, revt_sale double")
    out = {(r.permno, r.public_date): r.revenue_growth for r in P.revenue_growth(df).collect()}
    assert out[(1, D(2000, 2, 29))] == pytest.approx(0.2)
    assert out[(2, D(2000, 2, 29))] == pytest.approx(0.25)
    assert out[(1, D(2000, 1, 31))] is None and out[(2, D(2000, 1, 31))] is None


def test_w9_fill_is_idempotent(spark):
    """Filling an already filled panel changes nothing."""
    rng = np.random.default_rng(13)
    rows = [(int(f), 2000 + m // 12, m % 12 + 1, None if rng.random() < 0.5 else float(rng.normal()))
            for f in range(6) for m in range(int(rng.integers(1, 30)))]
    df = spark.createDataFrame(rows, "permno long, public_year int, public_month int, x double")
    once = L.fill_by_group(df, ["permno"], ["public_year", "public_month"])
    twice = L.fill_by_group(once, ["permno"], ["public_year", "public_month"])
    key = lambda r: (r.permno, r.public_year, r.public_month)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    assert sorted(once.collect(), key=key) == sorted(twice.collect(), key=key)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_bucketed_validity_join_equals_plain(spark, how):
    """The year-bucketed interval join returns exactly the plain join's rows, including
    open-ended and touching intervals and events without a valid name."""
    from conftest import SF_SMALL
    from panelkit.sources import fixtures as fx
    names = fx.names(spark, SF_SMALL).unionByName(_names(spark))
    if how == "left":
        ev = fx.ipo(spark, SF_SMALL).select("permno", "ipo_date").unionByName(
            spark.createDataFrame([(1, D(1995, 1, 1)), (2, D(1989, 1, 1)), (99, D(2000, 1, 1))],
                                  "permno long, ipo_date date"))
        a = U.validity_join_left(ev, names, "ipo_date")
        b = U.validity_join_left(ev, names, "ipo_date", bucketed=True)
    else:
        ev = fx.delist_events(spark, SF_SMALL).unionByName(
            spark.createDataFrame([(1, D(1995, 1, 1), 100)], "permno long, dlstdt date, dlstcd int"))
        a = U.validity_join_inner(ev, names, "dlstdt")
        b = U.validity_join_inner(ev, names, "dlstdt", bucketed=True)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
