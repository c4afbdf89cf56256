"""The four stages chained like the reference's command sequence, on the smallest tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelkit.operators import split as S
from panelkit.plans import q_panel, stages
from panelkit.sources import fixtures as fx


def test_stages_end_to_end(spark):
    d = SF_SMALL
    # 1. universe: IPOs from company + link + names, delistings, and the panel fetch
    ipo = stages.fetch_ipos(fx.names(spark, d), "1995-01-01", "2001-12-31", "",
                            company=fx.company(spark, d), link=fx.link(spark, d))
    delist = stages.fetch_delists(fx.delist_events(spark, d), fx.names(spark, d),
                                  "1995-01-01", "2001-12-31", "")
    assert ipo.count() > 0 and delist.count() > 0
    panel = stages.fetch_panel(ipo, q_panel.sources(spark, d))
    assert {"permno", "ipo_date", "public_date", "tobinq", "revenue_growth"} <= set(panel.columns)
    # 2. IPOs delisted within 5 years
    matched = stages.match_delistings(ipo, delist, 5)
    # 3. label per exchange part, then union + fill + clean
    parts = [stages.label_exchange(panel.filter(F.col("exchcd") == x), matched) for x in (1, 2, 3)]
    merged = stages.merge_parts(parts)
    assert merged.count() > 0
    assert not ({"total_assets", "prcc_c", "shrout"} & set(merged.columns))   # F10 dropped
    # 4. features, split, fit, metrics on the labelled panel proxy (enough positives)
    from panelkit.plans.q_labels import labelled
    res = stages.train_and_evaluate(labelled(spark, d))
    m = {r.split: r for r in res.metrics.collect()}
    assert set(m) == {"val", "test"}
    assert all(0.0 <= r.accuracy <= 1.0 for r in m.values())
    tags = res.data.groupBy("permno").agg(F.countDistinct("split").alias("k"))
    assert tags.filter("k > 1").count() == 0                 # a firm never spans two sets


def test_split_uses_ipo_date_when_present(spark):
    df = spark.createDataFrame(
        [(1, 2000, "1999-05-01"), (1, 2001, None), (2, 1998, None), (3, 1999, "1990-01-01")],
        "permno long, public_year int, ipodate string")
    keys = {r.permno: str(r._sort_key) for r in
            S.earliest_key_per_firm(df, "permno", "ipodate", "public_year").collect()}
    assert keys == {1: "1999-05-01", 2: "1998-01-01", 3: "1990-01-01"}


def test_cli_runs_the_stages_over_files(spark, tmpdir_session):
    """The command line chains the stages through files, like the reference's scripts."""
    import os

    from panelkit.plans import cli
    from panelkit.sources.io import read_table, write_table
    d = SF_SMALL
    base = os.path.join(tmpdir_session, "cli")
    paths = {}
    for name, df in {"names": fx.names(spark, d), "company": fx.company(spark, d),
                     "link": fx.link(spark, d), "events": fx.delist_events(spark, d),
                     "ratios": fx.ratios(spark, d), "funda": fx.funda(spark, d),
                     "fundq": fx.fundq(spark, d), "msf": fx.msf(spark, d),
                     "annual_linked": fx.annual_linked(spark, d)}.items():
        paths[name] = write_table(df, os.path.join(base, f"{name}.parquet"))
    rng = ["--start", "1995-01-01", "--end", "2001-12-31", "--exchange", ""]
    corrupt = os.path.join(base, "corrupt.parquet")
    with open(corrupt, "w") as f:
        f.write("not a table")
    missing = os.path.join(base, "missing.parquet")
    ipo = cli.run(["ipos", "--names", corrupt, missing, paths["names"], "--company", paths["company"],
                   "--link", paths["link"], *rng, "--out", os.path.join(base, "ipo.parquet")], spark)
    dl = cli.run(["delists", "--events", missing, paths["events"], "--names", corrupt, paths["names"], *rng,
                  "--out", os.path.join(base, "delist.parquet")], spark)
    panel = cli.run(["panel", "--ipo", ipo, "--ratios", corrupt, paths["ratios"], "--link", paths["link"],
                     "--funda", paths["funda"], "--fundq", paths["fundq"], "--msf", paths["msf"],
                     "--annual_linked", paths["annual_linked"], "--out", os.path.join(base, "panel.parquet")], spark)
    matched = cli.run(["match", "--ipo", ipo, "--delist", dl,
                       "--out", os.path.join(base, "matched.csv")], spark)
    merged = cli.run(["clean", "--panel", panel, "--matched", matched,
                      "--out", os.path.join(base, "merged.parquet")], spark)
    assert read_table(spark, panel).count() > 0 and read_table(spark, merged).count() >= 0
    assert read_table(spark, matched).count() == stages.match_delistings(
        read_table(spark, ipo), read_table(spark, dl)).count()


def test_cli_train(spark, tmpdir_session):
    import os

    from panelkit.plans import cli
    from panelkit.plans.q_labels import labelled
    from panelkit.sources.io import read_table, write_table
    base = os.path.join(tmpdir_session, "cli_train")
    data = write_table(labelled(spark, SF_SMALL), os.path.join(base, "merged.parquet"))
    out = cli.run(["train", "--data", data, "--C", "0.5", "--max-iter", "200",
                   "--save-model", os.path.join(base, "model"), "--train-ratio", "0.6", "--val-ratio", "0.2",
                   "--test-ratio", "0.2",
                   "--out", os.path.join(base, "metrics.parquet")], spark)
    m = read_table(spark, out)
    assert set(m.columns) >= {"split", "accuracy", "precision", "recall", "f1", "roc_auc"}
    assert m.count() == 2
    assert os.path.isdir(os.path.join(base, "model", "pipeline"))
    weights = read_table(spark, os.path.join(base, "metrics_weights.parquet"))
    classes = read_table(spark, os.path.join(base, "metrics_classes.parquet"))
    assert weights.filter("feature = 'intercept'").count() == 1 and weights.count() > 5
    assert {r.split for r in classes.collect()} == {"train", "val", "test"}


def test_training_on_rows_as_they_are(spark):
    """Without next-year labels: inferred label and time columns, other group column."""
    rows = [(i % 30, 1990 + i % 12, int((i * 7) % 5 == 0), float(i % 13), float((i * i) % 17)) for i in range(600)]
    df = spark.createDataFrame(rows, "firm long, fyear int, is_delist int, roa double, roe double")
    res = stages.train_and_evaluate(df, predict_next_year=False, label=None, time=None, group="firm")
    report = res.report()
    assert set(report["features"]) == {"roa", "roe"} and len(report["weights"]) == 2
    assert sum(report["classes"].values()) == 600


def test_panel_needs_its_columns(spark):
    import pytest
    with pytest.raises(ValueError, match="ipo_date"):
        stages.fetch_panel(spark.createDataFrame([(1,)], "permno long"), None)
