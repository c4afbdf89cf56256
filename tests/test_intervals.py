"""The dyadic interval index, and first runs from calendar bitmaps, against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import intervals as I
from panelkit.operators import panel as P
from panelkit.operators import universe as U

DAY0 = dt.date(1960, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.mark.parametrize("leaf", [0, 3, 5])
def test_cover_and_path_share_one_node(spark, leaf):
    rng = random.Random(leaf)
    days = (-3_000, 9_000)
    top = I.levels(days, leaf)
    rows = [tuple(sorted((rng.randint(*days), rng.randint(*days)))) + (rng.randint(*days),) for _ in range(400)]
    rows += [(a, a, a) for a in (-3_000, -1, 0, 1, 9_000)] + [(-3_000, 9_000, 17), (5, 4, 4)]
    df = spark.createDataFrame(rows, "a int, b int, d int")
    got = df.select("a", "b", "d", I.cover(F.col("a"), F.col("b"), top, leaf).alias("c"),
                    I.path(F.col("d"), top, leaf).alias("p")).collect()
    for r in got:
        shared = len(set(r.c or ()) & set(r.p))
        assert shared == (r.a >> leaf <= r.d >> leaf <= r.b >> leaf and r.a <= r.b), r
        assert len(r.c or ()) == len(set(r.c or ())) <= 2 * max(1, (max(0, r.b - r.a) + 1 >> leaf).bit_length() + 1)


def test_rows_of_open_intervals_over_sixty_years(spark):
    """Twice the logarithm of the span bounds the rows of an interval."""
    days = I.days_of("1960-01-01", "2019-12-31")
    rows = [(i, day(300 * i) if i % 3 else None, day(300 * i + 4_000) if i % 2 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "permno int, namedt date, nameenddt date")
    for leaf in (0, 5):
        most = 2 * I.levels(days, leaf)
        counts = I.indexed_intervals(df, "namedt", "nameenddt", days, leaf).groupBy("permno").count().collect()
        assert len(counts) == 60 and max(r["count"] for r in counts) <= most <= 2 * 15
    # shorter spans need fewer levels
    assert I.levels(days, 5, span=1_830) == 6 and I.levels(days, 8, span=1_830) == 4


def brute(events, names, open_start):
    out = []
    for k, d in events:
        for f, a, b in names:
            if k is not None and k == f and d is not None and (b is None or d <= b):
                if (a is None and open_start) or (a is not None and a <= d):
                    out.append((k, d, a, b))
    return out


@pytest.mark.parametrize("how,open_start", [("inner", False), ("inner", True), ("left", False)])
@pytest.mark.parametrize("days", [None, I.days_of("1960-01-01", "2020-12-31")])
def test_joins_on_odd_rows(spark, how, open_start, days):
    rng = random.Random(7)
    date = lambda: None if rng.random() < 0.1 else day(rng.randint(0, 20_000))
    firm = lambda: None if rng.random() < 0.1 else rng.randint(1, 4)
    events = [(firm(), date()) for _ in range(120)]
    events += events[:10]
    names = [(firm(), date(), date()) for _ in range(90)]
    names += names[:5] + [(1, day(50), day(40)), (2, day(30_000), None), (3, None, None)]
    ev = spark.createDataFrame(events, "permno int, d date")
    nm = spark.createDataFrame(names, "permno int, namedt date, nameenddt date")
    got = I.date_interval_join(ev, nm, "d", "permno", "permno", "namedt", "nameenddt", how, open_start, days)
    assert got.columns == ["permno", "d", "namedt", "nameenddt"]
    want = brute(events, names, open_start)
    if how == "left":
        matched = {(k, d) for k, d, _, _ in want}
        want += [(k, d, None, None) for k, d in events if (k, d) not in matched]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    empty = I.date_interval_join(ev.limit(0), nm, "d", "permno", "permno", "namedt", "nameenddt", how, open_start, days)
    assert empty.count() == 0
    with pytest.raises(ValueError):
        I.date_interval_join(ev, nm, "d", "permno", "permno", "namedt", "nameenddt", "outer")


def test_one_firm_with_many_events_and_intervals(spark):
    """10,000 of both: pairs that are formed stay near the result, not 100,000,000."""
    n = 10_000
    ev = spark.range(n).select(F.lit(1).alias("permno"), F.expr("date_add(date'1960-01-01', cast(id * 2 as int))").alias("d"))
    nm = spark.range(n).select(F.lit(1).alias("permno"), F.expr("date_add(date'1960-01-01', cast(id * 2 as int))").alias("namedt"),
                               F.expr("date_add(date'1960-01-01', cast(id * 2 + 9 as int))").alias("nameenddt"))
    days = I.days_of("1960-01-01", "2019-12-31")
    out = I.date_interval_join(ev, nm, "d", "permno", "permno", "namedt", "nameenddt", days=days, leaf=0)
    held = out.count()
    assert held == sum(min(i, 4) + 1 for i in range(n))
    own = I.indexed_intervals(nm.withColumnRenamed("permno", "_ik"), "namedt", "nameenddt", days, 0)
    found = I.indexed_dates(ev, "d", days, 0).withColumnRenamed("_node", "_dn")
    assert found.join(own, (F.col("permno") == F.col("_ik")) & (F.col("_dn") == F.col("_node"))).count() == held
    # the firm's rows spread over the nodes: no node holds a large part of them
    most = own.groupBy("_node").count().agg(F.max("count")).first()[0]
    assert most <= 10


def test_delistings_of_one_firm_are_not_all_paired(spark):
    n = 3_000
    ipo = spark.range(n).select(F.lit(1).alias("permno"), F.lit("a").alias("comnam"), F.lit("t").alias("ticker"),
                                F.expr("date_add(date'1960-01-01', cast(id * 7 as int))").alias("ipo_date"))
    gone = spark.range(n).select(F.lit(1).alias("permno"), F.lit("b").alias("comnam"), F.lit("u").alias("ticker"),
                                 F.expr("date_add(date'1960-01-01', cast(id * 7 as int))").alias("delist_date"))
    out = U.delist_within_years(ipo, gone, 1, ordered=False)
    days = [dt.date(1960, 1, 1) + dt.timedelta(days=7 * i) for i in range(n)]
    last = [d.replace(year=d.year + 1, day=min(d.day, 28) if d.month == 2 else d.day) for d in days]
    import bisect
    assert out.count() == sum(bisect.bisect_right(days, e) - i for i, e in enumerate(last))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_node" in plan


# -- first runs --------------------------------------------------------------------------

def brute_run(periods, limit):
    have, first = set(periods), min(periods)
    length = 0
    while first + length in have and length < limit:
        length += 1
    return first, length


@pytest.mark.parametrize("limit", [1, 5, 20, 60])
def test_first_run_against_a_loop(spark, limit):
    rng = random.Random(limit)
    firms = {}
    for f in range(120):
        a = rng.randint(-300, 9_000)
        firms[f] = [a + k for k in range(rng.randint(1, 90)) if rng.random() < rng.choice([0.5, 0.9, 1, 1])] or [a]
        firms[f] += [a + 5_000] * rng.randint(0, 3) + firms[f][:4]
    rows = [(f, p) for f, ps in firms.items() for p in ps] + [(None, 3), (1, None), (500, None)]
    df = spark.createDataFrame(rows, "permno int, p int").repartition(5)
    got = {r.permno: (r["first"], r["length"]) for r in P.first_run(df, "permno", F.col("p"), limit).collect()}
    assert got == {f: brute_run(ps, limit) for f, ps in firms.items()}
    for bad in (0, 61):
        with pytest.raises(ValueError):
            P.first_run(df, "permno", F.col("p"), bad)


@pytest.mark.parametrize("run,limit", [(P.initial_run_years, 5), (P.initial_run_quarters, 20)])
def test_runs_have_no_window_and_no_distinct(spark, run, limit):
    rows = [(f, day(31 * k)) for f in range(5) for k in range(0, 200) if (k // 12 + f) % 7] + [(3, None), (None, day(3))]
    df = spark.createDataFrame(rows, "permno int, public_date date")
    out = run(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan and "HashAggregate" in plan
    assert "distinct" not in out._jdf.queryExecution().analyzed().toString().lower()
    period = {5: lambda d: d.year, 20: lambda d: d.year * 4 + (d.month - 1) // 3}[limit]
    want = []
    for f in range(5):
        first, length = brute_run([period(d) for g, d in rows if g == f and d], limit)
        want += [(f, d) for g, d in rows if g == f and d and first <= period(d) < first + length]
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert run(df.limit(0)).count() == 0


def test_repeated_rows_are_not_broadcast(spark):
    """Their estimated size is that of the rows before they are repeated."""
    day = F.expr("date_add(date'1995-01-01', cast(id % 900 as int))")
    firms = spark.range(50).select(F.col("id").alias("permno"), day.alias("ipo_date"))
    facts = spark.range(300).select((F.col("id") % 60).alias("permno"), day.alias("datadate"), F.col("id").alias("x"))
    names = facts.select("permno", F.col("datadate").alias("namedt"), F.date_add("datadate", 40).alias("nameenddt"))
    link = firms.select(F.col("permno").cast("string").alias("gvkey"), F.col("permno").alias("lpermno"), F.lit("LU").alias("linktype"),
                        F.lit("P").alias("linkprim"), F.col("ipo_date").alias("linkdt"), F.lit(None).cast("date").alias("linkenddt"))
    statements = facts.select(F.col("permno").cast("string").alias("gvkey"), "datadate", "x")
    window = P.event_window_join(firms, facts, "datadate", 400)
    linked = P.link_interval_join(statements, link)
    valid = U.validity_join_left(firms, names, "ipo_date")
    for out in (window, linked, valid, U.validity_join_inner(firms, names, "ipo_date")):
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    late = F.col("datadate") >= F.col("ipo_date")
    assert window.count() == facts.join(firms, "permno").filter(late & (F.col("datadate") <= F.date_add("ipo_date", 400))).count() > 0
    assert linked.count() == facts.join(firms, "permno").filter(late).count() > 0
    n = names.withColumnRenamed("permno", "firm")
    want = firms.join(n, (F.col("permno") == F.col("firm")) & F.col("ipo_date").between(F.col("namedt"), F.col("nameenddt")), "left").drop("firm")
    assert valid.exceptAll(want).count() == want.exceptAll(valid).count() == 0
