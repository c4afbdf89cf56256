"""Sources, fallbacks, splits and the model stage on small inputs."""

import datetime as dt
import math
import os

import numpy as np
import pytest

from panelkit.operators import ml as ML
from panelkit.operators import split as S
from panelkit.sources import io
from panelkit.sources.fallback import fallback_by_key

D = dt.date


def test_read_table_csv_fallback_and_missing(spark, tmpdir_session):
    base = os.path.join(tmpdir_session, "ipo_file")
    spark.createDataFrame([(1, "2000-01-01")], "permno long, ipo_date string").write.mode(
        "overwrite").option("header", "true").csv(base + ".csv")
    df = io.read_table(spark, base + ".parquet")            # absent -> same-named CSV
    assert df.count() == 1 and "ipo_date" in df.columns
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, os.path.join(tmpdir_session, "nope.parquet"))
    with pytest.raises(ValueError):
        io.require_columns(df, ["permno", "ipo_date", "gvkey"])


def test_write_table_roundtrip(spark, tmpdir_session):
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "permno long, public_year int")
    path = io.write_table(df, os.path.join(tmpdir_session, "panel.parquet"), partition_by=["public_year"])
    assert io.read_table(spark, path).count() == 2


def test_first_nonempty_source_and_pair(spark, tmpdir_session):
    good = spark.createDataFrame([(1,)], "x int")
    empty = good.filter("x > 5")
    df, name = io.first_nonempty_source(
        spark, [("missing", os.path.join(tmpdir_session, "none.parquet")), ("empty", empty), ("good", good)])
    assert name == "good" and df.count() == 1
    with pytest.raises(RuntimeError):
        io.first_nonempty_source(spark, [("empty", empty)])
    with pytest.raises(FileNotFoundError):
        io.first_nonempty_source(spark, [("missing", os.path.join(tmpdir_session, "none.parquet"))])
    df, names = io.first_nonempty_pair(spark, [("e1", empty), ("g1", good)],
                                       [("e2", empty), ("g2", good)], lambda a, b: a.join(b, "x"))
    assert names == ("g1", "g2")


def test_fallback_by_key(spark):
    a = spark.createDataFrame([(1, 10.0)], "permno long, v double")
    b = spark.createDataFrame([(1, 20.0), (2, 21.0), (2, 22.0)], "permno long, v double")
    c = spark.createDataFrame([(2, 30.0), (3, 31.0)], "permno long, v double")
    got = sorted((r.permno, r.v) for r in fallback_by_key([a, b, c], "permno").collect())
    assert got == [(1, 10.0), (2, 21.0), (2, 22.0), (3, 31.0)]


def test_firm_split_sizes_follow_clamp(spark):
    rows = [(f, 1990 + f % 7, 0) for f in range(23) for _ in range(2)]
    df = spark.createDataFrame(rows, "permno long, public_year int, y int").dropDuplicates()
    out = S.firm_level_split(df, "permno", None, "public_year", (0.7, 0.15, 0.15))
    tags = {r.permno: r.split for r in out.select("permno", "split").distinct().collect()}
    n = 23
    i1 = min(max(math.floor(n * 0.7), 0), max(n - 2, 0))
    i2 = min(max(math.floor(n * 0.85), i1 + 1), max(n - 1, 1))
    order = sorted(range(23), key=lambda f: (1990 + f % 7, f))
    exp = {f: ("train" if i < i1 else "val" if i < i2 else "test") for i, f in enumerate(order)}
    assert tags == exp
    one = spark.createDataFrame([(7, 2000, 0)], "permno long, public_year int, y int")
    assert S.firm_level_split(one, "permno", None).first().split == "val"   # n = 1
    with pytest.raises(ValueError):
        S.firm_level_split(df, "permno", None, "public_year", (0.5, 0.2, 0.2))


def test_chronological_split_per_group(spark):
    rows = [(g, 2000 + i // 12, i % 12 + 1) for g in range(3) for i in range(10 + g)]
    df = spark.createDataFrame(rows, "g int, public_year int, public_month int")
    out = S.chronological_split(df, "g", "public_year").toPandas()
    for g, part in out.groupby("g"):
        n = len(part)
        part = part.sort_values(["public_year", "public_month"])
        i1 = min(max(math.floor(n * 0.7), 0), max(n - 2, 0))
        i2 = min(max(math.floor(n * 0.85), i1 + 1), max(n - 1, 1))
        assert part["split"].tolist() == ["train"] * i1 + ["val"] * (i2 - i1) + ["test"] * (n - i2)


def test_ensure_two_classes_moves_first_positive_firm(spark):
    df = spark.createDataFrame([(1, "train", 0), (2, "train", 0), (5, "val", 1), (3, "val", 1),
                                (4, "test", 1)], "permno long, split string, y int")
    moved, firm = S.ensure_two_classes(df, "y")
    assert firm == 3
    assert {r.permno for r in moved.filter("split = 'train'").collect()} == {1, 2, 3}
    bad = spark.createDataFrame([(1, "train", 0), (2, "val", 0)], "permno long, split string, y int")
    with pytest.raises(ValueError):
        S.ensure_two_classes(bad, "y")


def test_auc_and_metrics_vs_brute_force(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.normal(size=400) + y * 0.7, 1)          # many ties
    p = (s > 0.3).astype(int)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, s, p)],
                               "y int, s double, prediction int")
    auc = ML.roc_auc(df, "y", "s").first().roc_auc
    pos, neg = s[y == 1], s[y == 0]
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert auc == pytest.approx(exp)
    m = ML.evaluate(df, "y").first()
    tp = int(((y == 1) & (p == 1)).sum()); fp = int(((y == 0) & (p == 1)).sum())
    fn = int(((y == 1) & (p == 0)).sum())
    prec, rec = tp / (tp + fp), tp / (tp + fn)
    assert (m.accuracy, m.precision, m.recall, m.f1) == pytest.approx(
        ((y == p).mean(), prec, rec, 2 * prec * rec / (prec + rec)))
    one = spark.createDataFrame([(1, 0.5, 0)], "y int, s double, prediction int")
    assert ML.roc_auc(one, "y", "s").first().roc_auc is None
    assert ML.evaluate(one, "y").first().precision == 0.0


def test_logistic_fit_matches_weighted_objective(spark, tmpdir_session):
    """The Spark fit is the optimum of sklearn's objective: C * sum w*loss + |b|^2 / 2."""
    rng = np.random.default_rng(3)
    n = 600
    X = rng.normal(size=(n, 3))
    y = (X[:, 0] - 0.5 * X[:, 1] + rng.normal(size=n) > 0.8).astype(int)
    X[rng.random(n) < 0.1, 2] = np.nan
    rows = [(float(a) if not np.isnan(a) else None, float(b), float(c) if not np.isnan(c) else None, int(t))
            for (a, b, c), t in zip(X, y)]
    df = spark.createDataFrame(rows, "f1 double, f2 double, f3 double, y int")
    m = ML.fit(df, ["f1", "f2", "f3"], "y", ML.ModelConfig(C=1.0, tol=1e-10))
    # preprocessing as the reference: median impute, population standardisation
    Z = X.copy()
    for j in range(3):
        col = Z[:, j]
        col[np.isnan(col)] = np.nanmedian(X[:, j])
        Z[:, j] = (col - col.mean()) / (col.std() or 1.0)
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    beta = np.array([c for _, c in m.weights()])
    b0 = m.intercept()
    z = Z @ beta + b0
    grad = Z.T @ (w * (1 / (1 + np.exp(-z)) - y)) + beta        # C = 1
    assert np.abs(grad).max() < 1e-3
    path = os.path.join(tmpdir_session, "model")
    m.save(path)
    back = ML.FittedModel.load(spark, path)
    a = sorted(r.proba for r in m.predict(df).collect())
    b = sorted(r.proba for r in back.predict(df).collect())
    assert np.allclose(a, b)
    with pytest.raises(ValueError):
        ML.build_model_config("random_forest")


def test_read_table_falls_back_when_primary_is_unreadable(spark, tmpdir_session):
    base = os.path.join(tmpdir_session, "broken")
    os.makedirs(base + ".parquet", exist_ok=True)
    with open(os.path.join(base + ".parquet", "part-0.parquet"), "w") as fh:
        fh.write("not parquet")
    spark.createDataFrame([(1, "x")], "k long, v string").write.mode("overwrite").option(
        "header", "true").csv(base + ".csv")
    df = io.read_table(spark, base + ".parquet")
    assert df.columns == ["k", "v"] and df.count() == 1


def test_read_table_asks_spark_alone(spark, tmpdir_session, monkeypatch):
    """The driver's disk does not decide whether a path exists (it may be a remote store)."""
    path = os.path.join(tmpdir_session, "remote.parquet")
    spark.range(3).write.mode("overwrite").parquet(path)
    monkeypatch.setattr(os.path, "exists", lambda p: False)
    assert io.read_table(spark, path).count() == 3


def test_csv_types_are_declared(spark, tmpdir_session):
    path = os.path.join(tmpdir_session, "typed.csv")
    spark.createDataFrame([("7", "007", "1.5", "2001-02-03")], "permno string, gvkey string, roa string, datadate string") \
        .write.mode("overwrite").option("header", "true").csv(path)
    df = io.read_table(spark, path)
    assert dict(df.dtypes) == {"permno": "bigint", "gvkey": "string", "roa": "double", "datadate": "date"}
    assert df.first().gvkey == "007"


def test_sources_that_fail_in_any_way_are_passed_over(spark, tmpdir_session):
    corrupt = os.path.join(tmpdir_session, "corrupt.parquet")
    with open(corrupt, "w") as f:
        f.write("not a table")
    good = spark.range(2)

    def broken():
        raise KeyError("no such library")
    df, name = io.first_nonempty_source(spark, [("a", broken), ("b", corrupt), ("c", good.limit(0)), ("d", good)])
    assert name == "d" and df.count() == 2
    with pytest.raises(RuntimeError):
        io.first_nonempty_source(spark, [("c", good.limit(0))])


def test_model_config_rejects_what_it_does_not_do():
    from panelkit.operators import ml as ML
    for bad in ({"solver": "saga"}, {"penalty": "l1"}, {"impute_strategy": "constant"}, {"no_such": 1}):
        with pytest.raises(ValueError):
            ML.build_model_config(params=bad)
    cfg = ML.build_model_config(params={"class_weight": {"0": 1, "1": 3}, "with_std": False})
    assert ML.ModelConfig.from_dict(cfg.to_dict()) == cfg and cfg.class_weight == {0: 1.0, 1: 3.0}


def test_intermediates_can_be_dropped(spark):
    from panelkit import session
    df = session.cut_lineage(spark.range(5))
    path = session._WRITTEN[-1]
    assert df.count() == 5 and os.path.isdir(path.removeprefix("file:"))
    assert session.drop_intermediates(spark) >= 1
    assert not os.path.isdir(path.removeprefix("file:"))


def test_cut_lineage_raises_real_failures(spark):
    from panelkit import session
    bad = spark.range(3).selectExpr("assert_true(id < 2) AS a")
    with pytest.raises(Exception, match="is not true"):
        session.cut_lineage(bad)


def test_bucketed_joins_with_a_hot_key(spark):
    """A company with many facts and intervals: same rows as the plain range join."""
    from pyspark.sql import functions as F

    from panelkit.operators import panel as P
    day = lambda c: F.date_add(F.lit("1990-01-01"), (F.col(c) % 5000).cast("int"))
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50))
                                     .alias("gvkey"), day("id").alias("datadate"), "id")
    link = spark.range(400).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50))
                                   .alias("gvkey"), (F.col("id") % 90).alias("lpermno"), F.lit("LU").alias("linktype"),
                                   F.lit("P").alias("linkprim"), day("id").alias("linkdt"),
                                   F.when(F.col("id") % 5 > 0, F.date_add(day("id"), 900)).alias("linkenddt"))
    got = P.link_interval_join(facts, link).groupBy("gvkey", "permno").agg(F.count("*"), F.sum("id"))
    plain = facts.join(link.withColumnRenamed("gvkey", "k"), F.expr(
        "gvkey = k AND datadate >= linkdt AND (linkenddt IS NULL OR datadate <= linkenddt)"))
    want = plain.groupBy("gvkey", F.col("lpermno").alias("permno")).agg(F.count("*"), F.sum("id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    events = spark.range(60).select((F.col("id") % 40).alias("permno"), day("id").alias("ipo_date"))
    rows = facts.select((F.col("id") % 40).alias("permno"), "datadate", "id")
    got = P.event_window_join(events, rows, "datadate").agg(F.count("*"), F.sum("id")).first()
    want = rows.join(events.withColumnRenamed("permno", "k"), F.expr(
        "permno = k AND datadate >= ipo_date AND datadate <= date_add(ipo_date, 1825)")).agg(F.count("*"), F.sum("id")).first()
    assert got == want


def test_entry_works_without_the_optional_package():
    """Without the training-data package the other queries are all there."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['panelkit.llm'] = None; "
            "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q; "
            "assert set(e.oracle_sql()) <= set(q) and not [k for k in q if k.startswith('op1_')]")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
