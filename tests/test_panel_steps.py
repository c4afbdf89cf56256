"""The steps of the panel fetch: each planned alone, none with a large table broadcast."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from panelkit.functions import cleaning as C
from panelkit.operators import panel as P
from panelkit.sources import fixtures as fx

D = dt.date


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def steps(spark):
    """Three firms: 1 has facts in the first source, 2 in the second alone, 3 is not linked."""
    std = ("INDL", "STD", "D", "C")
    statement = "gvkey string, datadate date, at double, lt double, prcc_c double, pstk double, revtq double, " \
                "indfmt string, datafmt string, popsrc string, consol string"
    months = [D(2000, 1, 31), D(2000, 2, 29), D(2001, 1, 31), D(2003, 1, 31)]
    ipo = spark.createDataFrame([(i, D(2000, 1, 1), f"name {i}") for i in (1, 2, 3)] + [(None, D(2000, 1, 1), None)],
                                "permno long, ipo_date date, comnam string")
    ratios = spark.createDataFrame([(i, m, 0.5) for i in (1, 2, 3) for m in months] + [(None, months[0], 1.0)],
                                   "permno long, public_date date, roa double")
    link = spark.createDataFrame([("g1", 1, "LU", "P", D(1999, 1, 1), None), ("g2", 2, "LC", "P", D(1999, 1, 1), None),
                                  ("g3", 3, "LX", "P", D(1999, 1, 1), None)],
                                 "gvkey string, lpermno long, linktype string, linkprim string, linkdt date, linkenddt date")

    def table(firms, factor):
        rows = [(f"g{i}", m, factor * (i + n), 2.0, 3.0, None, factor * 10.0 * (n + 1), *std)
                for i in firms for n, m in enumerate(months[:3])]
        return spark.createDataFrame(rows + rows[:1] + [(None, months[0], 1.0, 1.0, 1.0, 1.0, 1.0, *std)], statement)

    first, second = table([1], 1.0), table([1, 2, 3], 100.0)
    shares = ratios.select("permno", F.col("public_date").alias("date"), F.lit(7.0).alias("shrout"))
    src = P.FactSources(ratios=ratios, link=link, assets=[first, second], revenue=[first, second],
                        liabilities=[first, second], shares=[shares.filter("permno = 1"), shares],
                        price=[(first, False), (second, True)])
    return ipo, src


@pytest.fixture
def jobs_of(spark):
    def run(work):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        work()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    return run


def test_an_early_step_runs_nothing_of_later_ones(spark, jobs_of):
    ipo, src = steps(spark)
    st = {}
    assert jobs_of(lambda: st.update(all=P.panel_stages(ipo, src))) == 0
    assert jobs_of(lambda: plan_of(st["all"]["window"])) == 0
    assert list(st["all"]) == ["window"]
    assert {r.permno: r.n for r in st["all"]["window"].groupBy("permno").agg(F.count("*").alias("n")).collect()} == {
        1: 4, 2: 4, 3: 4}


def test_late_steps_read_written_rows(spark):
    st = P.panel_stages(*steps(spark))
    # all input is local here: none of it is read again by the first runs, the growth scan or the fallback
    for name in ("years", "growth", "price", "liab", "shares", "month_end"):
        assert "LocalTableScan" not in plan_of(st[name]) and "Scan parquet" in plan_of(st[name]), name


def test_facts_by_firm_from_the_first_source_that_has_any(spark):
    st = P.panel_stages(*steps(spark))
    got = sorted(tuple(r) for r in st["assets"].select("permno", "public_date", "total_assets").collect())
    want = [(1, D(2000, 1, 31), 1.0), (1, D(2000, 1, 31), 1.0), (1, D(2000, 2, 29), 2.0), (1, D(2001, 1, 31), 3.0),
            (2, D(2000, 1, 31), 200.0), (2, D(2000, 2, 29), 300.0), (2, D(2001, 1, 31), 400.0)]
    assert [r for r in got if r[2] is not None] == want
    assert len(got) == len(want) + 2 + 4


def test_steps_equal_the_planned_panel(spark):
    ipo, src = steps(spark)
    a, b = P.panel_stages(ipo, src)["panel"], P.build_panel(ipo, src)
    b = b.select(*a.columns)
    assert a.count() > 0 and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert set(C.PANEL_COLUMNS) <= set(a.columns)


def test_no_fact_or_event_table_is_broadcast(spark):
    panel = spark.range(50).select(F.col("id").alias("permno"), F.lit(D(2000, 1, 31)).alias("public_date"))
    facts = spark.range(50).select(F.col("id").alias("permno"), F.lit(D(2000, 1, 31)).alias("datadate"), F.lit(1.0).alias("v"))
    events = spark.range(50).select(F.col("id").alias("permno"), F.lit("x").alias("comnam"))
    for out in (P.exact_date_left_join(panel, facts, ["v"]), P.month_end_left_join(panel, facts, ["v"]),
                P.attach_event_attrs(panel, events)):
        assert "Broadcast" not in plan_of(out)
        assert out.count() == 50


def test_customers_are_not_broadcast(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2, 1.0, "s")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                          "c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(5, 1, 2.0, D(2000, 1, 1), "p"), (6, 9, 2.0, D(2000, 1, 1), "p")],
                          "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderpriority string"
                          ).write.parquet(str(tmp_path / "orders.parquet"))
    span = fx._cust_span(spark, str(tmp_path))
    assert "Broadcast" not in plan_of(span)
    assert [r.c_custkey for r in span.collect()] == [1]


def test_month_end_buckets_grow_with_the_input(spark, tmp_path, monkeypatch):
    from panelkit.plans import q_panel
    from panelkit.sources.bucketed import FirmLayout
    made = []
    monkeypatch.setattr(FirmLayout, "write", lambda self, df, sort_by=(): made.append(self.buckets))
    monkeypatch.setattr(q_panel, "BUCKET_ROWS", 10, raising=False)
    q_panel.month_end_tables.__wrapped__(spark, "/root/testdata/sf0.001")
    rows = fx.ratios(spark, "/root/testdata/sf0.001").count()
    assert set(made) == {-(-rows // 10)} and made[0] > 4
