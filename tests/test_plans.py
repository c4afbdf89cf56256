"""Plan checks: no Python in the data path, pushdown reaches the scan, and no window
without a partition key except over the bounded per-partition summaries."""

import re

import pytest

from conftest import SF_SMALL
from panelkit.plans.registry import queries

QUERIES = queries()
KEYS = ["delist_within_years", "latest_per_firm", "ipo_from_company", "panel_build", "merge_clean",
        "yearly_features", "firm_level_split", "boxplot_stats", "correlation_matrix", "roc_auc",
        "impute_median"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_python_udf(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF"):
        assert node not in plan, node


@pytest.mark.parametrize("key", KEYS)
def test_unpartitioned_windows_only_over_summaries(spark, key):
    """A Window without partition keys may only run over per-partition summaries
    (``__os_*`` columns): at most one row per range partition."""
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    for line in plan.splitlines():
        m = re.search(r"Window \[.*?\], \[(.*?)\], \[", line)
        if m and not m.group(1).strip():
            assert "__os_" in line, line


def test_filters_and_columns_reach_the_scan(spark):
    from panelkit.functions import cleaning as C
    from panelkit.sources.io import read_table
    names = read_table(spark, f"{SF_SMALL}/orders.parquet")
    df = C.date_range_filter(names.select("o_custkey", "o_orderdate"), "o_orderdate",
                             "1996-01-01", "1996-12-31")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>", plan)


MODEL_KEYS = {"model_run", "model_fit_run", "model_save_load", "logistic_fit", "predict", "top_k_weights",
              "model_config"}


@pytest.mark.parametrize("key", ["yearly_features", "latest_per_firm", "ipo_from_company"])
def test_first_and_last_are_hash_aggregates(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_panel_fetch_scans_each_source_once_or_twice(spark):
    """The facts are linked once and written; later steps read that table."""
    from panelkit.operators import panel as P
    from panelkit.plans.q_panel import sources
    from panelkit.sources import fixtures as fx
    src, ipo = sources(spark, SF_SMALL), fx.ipo(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("panel-plan", "panel-plan")
    panel = P.build_panel(ipo, src)
    plan = _plan(panel)
    panel.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("after", "after")
    link_file = src.link.inputFiles()[0].rsplit("/", 2)[1]
    assert link_file not in plan
    assert plan.count("FileScan") + plan.count("BatchScan") <= 6
    # AQE runs each exchange as a job of its own; no exchange is added unnoticed
    assert len(tracker.getJobIdsForGroup("panel-plan")) <= 36


@pytest.mark.parametrize("key", sorted(set(QUERIES) - MODEL_KEYS))
def test_no_all_pairs_join_or_python(spark, key):
    """No query pairs all rows (nested-loop / cartesian joins) or runs Python per row."""
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
                 "ArrowEvalPython"):
        assert node not in plan, node
