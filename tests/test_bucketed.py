"""Firm tables: same rows, no exchange between them, hot firms beside the buckets."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelkit.operators import features as FE
from panelkit.operators import panel as P
from panelkit.plans import q_features, q_panel
from panelkit.plans.registry import queries
from panelkit.session import drop_intermediates
from panelkit.sources import bucketed as B


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)
    B.firm_session(spark)


def exchanges(df):
    return re.findall(r"\bExchange hash\w+\([^)]*permno", plan_of(df))


def test_month_end_left_join_shuffles_nothing(spark, no_broadcast):
    out = per = B.per_firm(P.join_month_end, *q_panel.month_end_tables(spark, SF_SMALL))
    plan = plan_of(out)
    assert plan.count("SortMergeJoin") == 3 and not exchanges(per) and "Exchange" not in plan
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    plain = q_panel.stages(spark, SF_SMALL)["month_end"]
    assert out.columns == plain.columns
    assert out.exceptAll(plain).count() == plain.exceptAll(out).count() == 0
    assert exchanges(plain)


def test_panel_build_joins_shuffle_nothing(spark, no_broadcast):
    n = 4_000
    rows = spark.range(n).select((F.col("id") % 37).alias("permno"),
                                 F.expr("last_day(date_add(date'1995-01-01', cast(id % 900 as int)))").alias("public_date"),
                                 F.col("id").alias("x"))
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("assets", "revenue", "price", "liab", "shares")]),
                         (F.col("id") % 5 + 1).cast("int"))
    facts = spark.range(n).select(
        (F.col("id") % 41).alias("permno"), F.expr("date_add(date'1995-01-01', cast(id % 890 as int))").alias("datadate"),
        kinds.alias("_kind"), *[F.col("id").cast("double").alias(c) for c in
                                ("total_assets", "revtq", "prcc_c", "pstk", "total_liabilities", "shrout")])
    layout = B.FirmLayout.of([rows, facts])
    out = B.per_firm(P.join_facts, layout.write(rows, ["public_date"]), layout.write(facts, ["datadate"]))
    plan = plan_of(out)
    assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
    want = P.join_facts(rows, facts)
    assert exchanges(want)
    assert out.exceptAll(want).count() == want.exceptAll(out).count() == 0 and out.count() > n


@pytest.mark.parametrize("key", ["yearly_last", "yearly_mean", "yearly_std", "yearly_slope", "yearly_obs_count",
                                 "yearly_label"])
def test_yearly_aggregates_shuffle_nothing(spark, key):
    out = queries()[key](spark, SF_SMALL)
    plan = plan_of(out)
    assert "Exchange" not in plan and "HashAggregate" in plan and "SortAggregate" not in plan
    assert out.count() > 0


@pytest.mark.parametrize("null_share", [0, 2])
def test_hot_firms_stay_out_of_the_buckets(spark, null_share):
    """A firm (or rows without one) with a third of all rows is joined beside the buckets."""
    firm = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50 + 10)
    if null_share:
        firm = F.when(F.col("id") % 3 != 1, firm)
    rows = spark.range(6_000).select(firm.alias("permno"), F.expr("date_add(date'1995-01-01', cast(id % 700 as int))")
                                     .alias("public_date"), F.col("id").alias("x"))
    facts = rows.filter("x < 900").select("permno", F.col("public_date").alias("datadate"), F.col("x").alias("v"))
    layout = B.FirmLayout.of([rows, facts], buckets=8, hot_rows=500)
    assert layout.hot == [7] and layout.null_is_hot == bool(null_share)
    a, b = layout.write(rows, ["public_date"]), layout.write(facts, ["datadate"])
    assert a.cold.filter("permno = 7").count() == 0 and a.hot.filter("permno = 7").count() == 2_000
    work = lambda p, f: P.exact_date_left_join(p, f, ["v"])
    out, want = B.per_firm(work, a, b), work(rows, facts)
    assert out.exceptAll(want).count() == want.exceptAll(out).count() == 0
    count = lambda t: FE.yearly_stats(t.withColumn("public_year", F.year("public_date")), count=True,
                                      month="x")
    got = B.per_firm(count, a)
    assert got.exceptAll(count(rows)).count() == 0 and got.count() == count(rows).count()


def test_odd_rows_and_settings(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None)], "permno int, s string")
    layout = B.FirmLayout.of([rows])
    table = layout.write(rows)
    assert layout.hot == [] and table.hot is None
    assert sorted(map(str, table.cold.collect())) == sorted(map(str, rows.collect()))
    empty = B.FirmLayout.of([rows.limit(0)]).write(rows.limit(0), ["s"])
    assert empty.cold.count() == 0 and empty.cold.columns == ["permno", "s"]
    # the caller's session keeps its own settings, the firm session follows it otherwise
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    assert B.firm_session(spark).conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert B.firm_session(spark) is B.firm_session(spark)


def test_tables_go_with_the_intermediates(spark, monkeypatch):
    from panelkit import session
    monkeypatch.setattr(session, "_WRITTEN", [])
    rows = spark.createDataFrame([(1, "a")], "permno int, s string")
    table = B.FirmLayout.of([rows]).write(rows)
    assert table.cold.count() == 1 and len(session._TABLES) >= 1
    name = session._TABLES[session._WRITTEN[-1]]
    assert spark.catalog.tableExists(name)
    assert drop_intermediates(spark) == 1 and not spark.catalog.tableExists(name)


def test_yearly_features_and_split_shuffle_no_rows(spark, no_broadcast):
    """The aggregates, the joins between them, the next-year window and the tags of the firms:
    of all tables only the tags are dealt out by firm."""
    rows = spark.range(3_000).select(
        (F.col("id") % 40).alias("permno"), (F.col("id") % 7 + 1990).cast("int").alias("public_year"),
        (F.col("id") % 12 + 1).cast("int").alias("public_month"), (F.col("id") % 3 % 2).cast("int").alias("delist"),
        F.when(F.col("id") % 5 > 0, F.col("id") / 7).alias("roa"), (F.col("id") % 11).cast("double").alias("tobinq"))
    out = FE.yearly_features(rows)
    assert "Exchange" not in plan_of(out)
    d, feats = FE.prepared(rows)
    lbl = FE.yearly_label(d).withColumnRenamed("delist", "_lbl")
    want = FE.next_year_label(FE.stitch_aggregates(d, feats).join(lbl, ["permno", "public_year"]), "_lbl").drop("_lbl")
    rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])
    assert out.columns == want.columns and out.count() == want.count() == 240
    assert rounded(out).exceptAll(rounded(want)).count() == 0
    tags = out.select("permno").distinct().withColumn("split", F.lit("train"))
    assert "Exchange" not in plan_of(out.join(tags, "permno", "left"))


def test_buckets_grow_in_number(spark):
    rows = spark.range(1_000).select((F.col("id") % 90).alias("permno"))
    assert B.FirmLayout.of([rows], buckets=4, rows_per_bucket=150).buckets == 7
    assert B.FirmLayout.of([rows], buckets=8, rows_per_bucket=150).buckets == 8
