"""The skew-safe ordered scan against pandas / numpy on data with one hot group."""

import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.operators.ordered import exact_quantiles, global_rank, order_bucket, ordered_scan


def _frame(spark, n=3000, seed=0, hot_share=0.4):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < hot_share, 0, rng.integers(1, 25, n))
    t = rng.permutation(n)
    v = np.where(rng.random(n) < 0.4, np.nan, rng.normal(size=n))
    pdf = pd.DataFrame({"g": g, "t": t, "v": v})
    return pdf, spark.createDataFrame(pdf).replace(float("nan"), None)


def test_scan_matches_pandas(spark):
    pdf, df = _frame(spark)
    out = ordered_scan(df, ["g"], ["t"], prev_nonnull={"p": "v"}, next_nonnull={"nx": "v"},
                       lag={"lg": "v"}, lead={"ld": "v"}, cumsum={"cs": "t"},
                       rank="r", size="sz", buckets=7).toPandas()
    out = out.sort_values(["g", "t"]).reset_index(drop=True)
    exp = pdf.sort_values(["g", "t"]).reset_index(drop=True)
    gb = exp.groupby("g")
    exp["p"] = gb["v"].transform(lambda s: s.ffill().shift(1))
    exp["nx"] = gb["v"].transform(lambda s: s.bfill().shift(-1))
    exp["lg"] = gb["v"].shift(1)
    exp["ld"] = gb["v"].shift(-1)
    exp["cs"] = gb["t"].cumsum()
    exp["r"] = gb.cumcount()
    exp["sz"] = gb["t"].transform("size")
    for c in ["p", "nx", "lg", "ld", "cs", "r", "sz"]:
        assert np.allclose(out[c].astype(float), exp[c].astype(float), equal_nan=True), c


@pytest.mark.parametrize("order", ["t", "text", "day"])
def test_hot_group_is_cut_into_segments(spark, order):
    """A group holding 40% of the rows must span several segments of similar size."""
    from panelkit.operators.ordered import order_bucket
    _, df = _frame(spark, n=4000)
    df = df.withColumn("text", F.format_string("k%05d", "t")).withColumn("day", F.date_add(F.lit("1990-01-01"), F.col("t").cast("int")))
    sizes = [r["count"] for r in df.withColumn("b", order_bucket(df, [order], 8)).filter("g = 0").groupBy("b")
             .count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * sum(sizes)


def test_a_heavy_order_value_is_cut_by_the_second_column(spark):
    from panelkit.operators.ordered import order_bucket
    df = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS a", "4000 - id AS b")
    out = df.withColumn("k", order_bucket(df, ["a", "b"], 16))
    assert max(r["count"] for r in out.groupBy("k").count().collect()) < 900
    ranked = global_rank(df, ["a", "b"], rank="r").orderBy("r").collect()
    assert [(r.a, r.b) for r in ranked] == sorted((r.a, r.b) for r in ranked)
    assert [r.r for r in ranked] == list(range(4000))


EXTRA = {"plain": "id", "array": "array(id, id + 1)", "struct": "struct(id AS x, array(id) AS y)", "map": "map(id, id)"}


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("extra", sorted(EXTRA))
def test_no_row_is_lost_and_no_value_wrong(spark, reuse, adaptive, extra):
    """400,000 rows against a plain window, whatever Spark reuses and whatever columns ride along."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled",
                                          "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, (reuse, adaptive, "8")):
            spark.conf.set(k, v)
        df = spark.range(400_000).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 0 ELSE pmod(hash(id), 1000) END AS g", "pmod(xxhash64(id), 100000000) AS t",
            "CASE WHEN id % 5 < 2 THEN NULL ELSE id END AS v", f"{EXTRA[extra]} AS e")
        out = ordered_scan(df, ["g"], ["t"], prev_nonnull={"p": "v"}, next_nonnull={"x": "v"}, rank="r", size="n")
        w = W.partitionBy("g").orderBy("t", F.col("v").asc_nulls_last())
        want = df.select("g", "t", "v", F.last("v", True).over(w.rowsBetween(W.unboundedPreceding, -1)).alias("p"),
                         (F.row_number().over(w) - 1).cast("long").alias("r"),
                         F.count(F.lit(1)).over(W.partitionBy("g")).alias("n"))
        mark = lambda f: f.agg(F.count(F.lit(1)), F.sum(F.xxhash64("g", "t", "v", "p", "r", "n")
                                                        % F.lit(1 << 40))).first()
        assert mark(out) == mark(want)
        assert "e" in out.columns and out.filter("e IS NULL").isEmpty()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_backward_fill_is_linear_in_a_hot_group(spark):
    """One group of 1,000,000 rows: filling both ways costs at most a few times one way."""
    import time

    from panelkit.operators.labels import fill_by_group
    df = spark.range(1_000_000).selectExpr("1 AS g", "id AS t", "CASE WHEN id % 4 = 0 THEN id END AS v")
    took = {}
    for direction in ("forward", "both", "forward", "both"):
        began = time.time()
        out = fill_by_group(df, ["g"], ["t"], direction, cols=["v"])
        assert out.agg(F.count("v")).first()[0] == 1_000_000
        took[direction] = time.time() - began
    assert took["both"] < 3 * took["forward"] + 1
    plan = out._jdf.queryExecution().executedPlan().toString().lower()
    assert not re.search(r"rowframe, (currentrow\$\(\)|-?\d+), unboundedfollowing", plan)


def test_exact_quantiles_linear(spark):
    pdf, df = _frame(spark, seed=3)
    q = exact_quantiles(df, "v", {"q1": 0.25, "med": 0.5, "q3": 0.75}, by=["g"]).toPandas()
    q = q.sort_values("g").reset_index(drop=True)
    exp = pdf.dropna().groupby("g")["v"].quantile([0.25, 0.5, 0.75]).unstack().reset_index()
    assert np.allclose(q[["q1", "med", "q3"]].to_numpy(), exp[[0.25, 0.5, 0.75]].to_numpy())
    assert (q["n"].to_numpy() == pdf.dropna().groupby("g").size().to_numpy()).all()


def test_global_rank_without_single_partition_window(spark):
    _, df = _frame(spark, n=2000)
    out = global_rank(df, ["t"], rank="rk", size="n")
    rows = out.select("t", "rk", "n").toPandas()
    assert (rows["rk"] == rows["t"]).all() and (rows["n"] == 2000).all()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40))
def test_forward_fill_property(spark, rows):
    """prev_nonnull equals a plain loop for arbitrary small inputs (ties broken by value)."""
    df = spark.createDataFrame(rows, "g int, t int, v int")
    out = ordered_scan(df, ["g"], ["t"], prev_nonnull={"p": "v"}, buckets=3).collect()
    got = sorted((r.g, r.t, -99 if r.v is None else r.v, r.p) for r in out)
    exp = []
    for g in sorted({r[0] for r in rows}):
        seq = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1], r[2] is None, r[2] or 0))
        last = None
        for _, t, v in seq:
            exp.append((g, t, -99 if v is None else v, last))
            if v is not None:
                last = v
    assert got == sorted(exp)


def test_scan_rejects_nothing_on_empty(spark):
    df = spark.createDataFrame([], "g int, t int, v double")
    assert ordered_scan(df, ["g"], ["t"], prev_nonnull={"p": "v"}).count() == 0


@pytest.mark.parametrize("by", [[], ["g"]])
def test_rank_and_size_bounded_carry(spark, by):
    _, df = _frame(spark, n=500, seed=5)
    out = ordered_scan(df, by, ["t"], rank="r", size="n").toPandas()
    if by:
        exp = out.sort_values(["g", "t"]).groupby("g").cumcount()
        assert (out.sort_values(["g", "t"])["r"].to_numpy() == exp.to_numpy()).all()
    else:
        assert sorted(out["r"]) == list(range(500))


def test_operators_with_a_hot_firm(spark):
    """Fill, growth and chronological split stay exact when one firm holds ~40% of the rows
    and its rows are spread over several range partitions."""
    import datetime as dt

    from panelkit.operators import labels as L
    from panelkit.operators import panel as P
    from panelkit.operators import split as S
    rng = np.random.default_rng(21)
    rows = []
    for i in range(1200):
        firm = 0 if i < 500 else int(rng.integers(1, 40))
        day = dt.date(1990, 1, 1) + dt.timedelta(days=int(i * 3 + rng.integers(0, 3)))
        v = None if rng.random() < 0.35 else float(rng.uniform(0.5, 2.0))
        rows.append((firm, day, day.year, day.month, v))
    pdf = pd.DataFrame(rows, columns=["permno", "public_date", "public_year", "public_month", "x"])
    pdf = pdf.drop_duplicates(["permno", "public_date"]).reset_index(drop=True)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "permno long, public_date date, public_year int, public_month int, x double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")        # keep 6 range partitions
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        filled = L.fill_by_group(df, ["permno"], ["public_date"], cols=["x"]).toPandas()
        growth = P.pct_change(df.withColumnRenamed("x", "total_assets"), "total_assets", "g",
                              fill="pad").toPandas()
        split = S.chronological_split(df, "permno", "public_date").toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    exp = pdf.sort_values(["permno", "public_date"])
    ex = exp.groupby("permno")["x"].transform(lambda s: s.bfill().ffill())
    got = filled.set_index(["permno", "public_date"])["x"].reindex(
        exp.set_index(["permno", "public_date"]).index)
    assert np.allclose(got.to_numpy(float), ex.to_numpy(float), equal_nan=True)
    eg = exp.groupby("permno")["x"].transform(lambda s: s.ffill() / s.ffill().shift(1) - 1)
    gg = growth.set_index(["permno", "public_date"])["g"].reindex(
        exp.set_index(["permno", "public_date"]).index)
    assert np.allclose(gg.to_numpy(float), eg.to_numpy(float), equal_nan=True)
    sizes = split.groupby(["permno", "split"]).size().unstack(fill_value=0)
    n = sizes.sum(axis=1)
    i1 = np.minimum(np.maximum(np.floor(n * 0.7), 0), np.maximum(n - 2, 0))
    i2 = np.minimum(np.maximum(np.floor(n * 0.85), i1 + 1), np.maximum(n - 1, 1))
    assert (sizes["train"] == i1).all() and (sizes["val"] == i2 - i1).all()


def test_approx_quantiles_scale_option(spark):
    from panelkit.operators.ordered import approx_quantiles
    pdf, df = _frame(spark, n=4000, seed=8)
    a = approx_quantiles(df, "v", {"med": 0.5}, by=["g"], accuracy=10000).toPandas().sort_values("g")
    e = exact_quantiles(df, "v", {"med": 0.5}, by=["g"]).toPandas().sort_values("g")
    assert (a["n"].to_numpy() == e["n"].to_numpy()).all()
    # within the sketch's rank error of the exact answer (values are ~N(0, 1))
    assert np.abs(a["med"].to_numpy() - e["med"].to_numpy()).max() < 0.25


@pytest.mark.parametrize("kind", ["iso", "long_prefix", "one_string", "timestamp_ntz", "timestamp", "long", "decimal"])
def test_lossy_first_columns_keep_their_order(spark, kind):
    value = {"iso": "date_format(date_add(date'2020-01-01', int(k)), 'yyyy-MM-dd')",
             "long_prefix": "concat('a/very/long/prefix/', lpad(k, 4, '0'))",
             "one_string": "if(k < 200, 'ACTIVE and well', 'CLOSED')",
             "timestamp_ntz": "timestampadd(SECOND, int(k), timestamp_ntz'2020-01-05 00:00:01')",
             "timestamp": "timestampadd(MICROSECOND, int(k), timestamp'2900-01-05 00:00:00')",
             "long": "9007199254740992 + k",
             "decimal": "cast(12345678901234567890 as decimal(38, 4)) + k / 1000"}[kind]
    df = spark.range(4000).selectExpr("id", "(id * 7919) % 211 AS k", "(id * 104729) % 4001 AS x").selectExpr(
        f"IF(id % 97 = 0, NULL, {value}) AS o", "x", "id")
    by = W.partitionBy().orderBy(F.col("o").asc_nulls_last(), F.col("x"), F.col("id"))
    want = df.select("id", (F.row_number().over(by) - 1).alias("rank"), F.lag("x").over(by).alias("before"),
                     F.sum("x").over(by.rowsBetween(W.unboundedPreceding, 0)).alias("run"))
    for buckets in (4, 64):
        got = ordered_scan(df, [], ["o", "x"], rank="rank", lag={"before": "x"}, cumsum={"run": "x"}, buckets=buckets)
        assert sorted(map(tuple, got.select("id", "rank", "before", "run").collect())) == sorted(map(tuple, want.collect()))
    if kind != "timestamp":
        cut = df.filter("o IS NOT NULL").select(order_bucket(df, ["o", "x"], 64).alias("b"))
        assert cut.distinct().count() > 10


def test_fill_queries_read_a_written_union(spark):
    """The union is computed once, not for each pass of the scan."""
    from conftest import SF_SMALL
    from panelkit.plans.registry import queries
    for key in ("forward_fill", "backfill_then_forwardfill"):
        plan = queries()[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" not in plan and "delist_date" not in plan
