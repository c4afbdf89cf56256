"""Staged publishing, observed counts, quarantine and stored sketches."""

import datetime as dt
import glob
import json
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from panelkit.operators import profile as PR
from panelkit.operators.sketches import YearSketches
from panelkit.sources import io, publish
from panelkit.sources.quarantine import read_quarantined, write_quarantine


# -- publishing ---------------------------------------------------------------------------

def failing(spark, n=2_000):
    """Rows whose last ones raise an error while they are written."""
    return spark.range(n).repartition(4).select(
        "id", F.when(F.col("id") == n - 1, F.raise_error(F.lit("planted"))).otherwise("x").alias("s"))


def hidden(path):
    return glob.glob(os.path.join(os.path.dirname(path), "." + os.path.basename(path) + "*"))


@pytest.mark.parametrize("ext", ["parquet", "csv"])
def test_a_write_that_fails_leaves_the_earlier_table(spark, tmp_path, ext):
    path = str(tmp_path / f"panel.{ext}")
    io.write_table(spark.range(50), path)
    with pytest.raises(Exception, match="planted"):
        io.write_table(failing(spark), path)
    assert io.read_table(spark, path).count() == 50 and not hidden(path)
    assert publish.manifest(spark, path)["rows"] == 50


def test_a_rename_that_fails_brings_the_earlier_table_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    publish.publish(spark.range(7), path)
    rename, calls = publish._Store.rename, []

    def once(self, old, new):
        calls.append((old, new))
        if len(calls) == 2:
            raise OSError("planted")
        rename(self, old, new)
    monkeypatch.setattr(publish._Store, "rename", once)
    with pytest.raises(OSError, match="planted"):
        publish.publish(spark.range(9), path)
    assert spark.read.parquet(path).count() == 7 and not hidden(path)


def test_a_run_that_died_between_renames_is_mended(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    publish.publish(spark.range(7), path)
    os.rename(path, str(tmp_path / ".t.parquet.old-abc"))
    assert io.read_table(spark, path).count() == 7
    os.rename(path, str(tmp_path / ".t.parquet.old-abc"))
    publish.publish(spark.range(8), path)
    assert spark.read.parquet(path).count() == 8 and not hidden(path)
    assert not publish.recover(spark, str(tmp_path / "never"))


def test_fallback_to_csv_keeps_the_partitions(spark, tmp_path):
    df = spark.range(6).select("id", (F.col("id") % 2).alias("public_year"))
    path = io.write_table(df, str(tmp_path / "p.orc"), fmt="no_such_format", partition_by=["public_year"])
    assert path.endswith(".csv") and sorted(os.listdir(path))[-2:] == ["public_year=0", "public_year=1"]
    said = publish.manifest(spark, path)
    assert said["rows"] == 6 and said["partition_by"] == ["public_year"] and said["format"] == "csv"


# -- observed counts ----------------------------------------------------------------------

def jobs(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.range(1_000).filter("id % 3 = 0")
    run = lambda frame, name: frame.write.parquet(str(tmp_path / name))
    spark.sparkContext.setJobGroup("plain", "")
    run(df, "plain")
    spark.sparkContext.setJobGroup("seen", "")
    counts = PR.StageCounts()
    run(counts.watch("stage", df), "seen")
    assert counts.counts() == {"stage": 334}
    spark.sparkContext.setJobGroup("after", "")
    assert jobs(spark, "seen") == jobs(spark, "plain") > 0 == jobs(spark, "after")


def test_counts_of_empty_and_repeated_stages(spark):
    df = spark.range(10)
    out = PR.row_counts({"all": df, "none": df.filter("id < 0"), "no rows": df.limit(0), "again": df.union(df)})
    assert [tuple(r) for r in out.collect()] == [("all", 10), ("none", 0), ("no rows", 0), ("again", 20)]


def test_a_model_is_fitted_and_scores_after_an_observed_count(spark):
    """An observed session cannot be serialized; the model must not carry it into tasks."""
    from panelkit.operators import ml
    PR.row_counts({"some": spark.range(5)})
    rows = spark.range(200).select((F.col("id") % 7).cast("double").alias("roa"), (F.col("id") % 2).cast("int").alias("y"))
    model = ml.fit(rows, ["roa"], "y")
    scored = ml.evaluate(model.predict(rows), "y")
    assert scored.count() == 1 and ml.roc_auc(model.predict(rows), "y", "proba").count() == 1


# -- quarantine ---------------------------------------------------------------------------

def test_bad_csv_lines_go_to_the_quarantine(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    os.mkdir(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("permno,public_date,roa,name\n1,2001-01-31,0.5,x\n2,2001-13-31,0.5,y\n3,2001-01-31\n4,,,\n")
    with open(os.path.join(path, "b.csv"), "w") as f:
        f.write("permno,public_date,roa,name\n5,2001-02-28,1e3,\"q,r\"\nsix,2001-02-28,1,z\n7,2001-02-28,1,z,extra\n")
    good, bad = read_quarantined(spark, path, {"permno": "bigint", "public_date": "date", "roa": "double"})
    assert sorted(map(tuple, good.collect()), key=str) == [
        (1, dt.date(2001, 1, 31), 0.5, "x"), (4, None, None, None), (5, dt.date(2001, 2, 28), 1000.0, "q,r")]
    found = {(os.path.basename(r.file), r.record, r.reason) for r in bad.collect()}
    assert found == {("a.csv", "2,2001-13-31,0.5,y", "public_date is not date: 2001-13-31"),
                     ("a.csv", "3,2001-01-31", "not 4 fields"), ("b.csv", "six,2001-02-28,1,z", "permno is not bigint: six"),
                     ("b.csv", "7,2001-02-28,1,z,extra", "not 4 fields")}
    place = str(tmp_path / "quarantine")
    assert write_quarantine(bad, place) == 4 and write_quarantine(bad, place) == 4
    assert spark.read.parquet(place).count() == 8


@pytest.mark.parametrize("damage", ["truncated", "row group"])
def test_a_damaged_parquet_file_goes_to_the_quarantine(spark, tmp_path, damage):
    path = str(tmp_path / "t.parquet")
    spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s")).repartition(4).write.parquet(path)
    good, bad = read_quarantined(spark, path)
    assert good.count() == 40_000 and bad.count() == 0
    file = sorted(glob.glob(path + "/part-*.parquet"))[1]
    own = spark.read.parquet(file).count()
    data = bytearray(open(file, "rb").read())
    if damage == "truncated":
        data = data[:len(data) // 2]
    else:       # the footer stays whole, so load() alone sees nothing
        middle = len(data) // 2
        data[middle - 20_000:middle + 20_000] = os.urandom(40_000)
    with open(file, "wb") as f:
        f.write(data)
    for crc in glob.glob(path + "/.*.crc"):
        os.remove(crc)
    good, bad = read_quarantined(spark, path)
    entries = bad.collect()
    assert [os.path.basename(r.file) for r in entries] == [os.path.basename(file)] and entries[0].reason
    assert good.count() == 40_000 - own


def test_partitions_and_missing_tables(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(10).select("id", (F.col("id") % 2).alias("year")).write.partitionBy("year").parquet(path)
    good, bad = read_quarantined(spark, path)
    assert sorted(good.columns) == ["id", "year"] and good.count() == 10 and bad.isEmpty()
    with pytest.raises(Exception):
        read_quarantined(spark, str(tmp_path / "none.parquet"))


# -- sketches -----------------------------------------------------------------------------

def quantile(values, p):
    v = sorted(values)
    h = (len(v) - 1) * p
    i = int(h)
    return v[i] + (h - i) * (v[min(i + 1, len(v) - 1)] - v[i])


def sketched(spark, path, rows, k=200):
    df = spark.createDataFrame(rows, "g string, public_year int, x double").repartition(3)
    return df, YearSketches(spark, path, "x", ["g"], k=k)


PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}


def test_merged_sketches_give_exact_quantiles(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice("abb"), rng.choice([2000, 2001, 2002]), rng.choice([rng.gauss(0, 1), 0.0, float(rng.randint(0, 5))]))
            for _ in range(12_000)]
    rows += [(None, 2001, 3.0), ("a", None, 9.0), ("a", 2001, None), ("few", 2002, 1.0)]
    df, kept = sketched(spark, str(tmp_path / "s"), rows)
    kept.add(df)
    assert kept.years() == [2000, 2001, 2002]
    got = {r.g: r for r in kept.exact_quantiles(df, PROBS).collect()}
    for g in ("a", "b", None, "few"):
        values = [x for h, y, x in rows if h == g and y is not None and x is not None]
        assert got[g].n == len(values)
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(quantile(values, p), abs=1e-12)
    some = {r.g: r for r in kept.exact_quantiles(df, PROBS, years=[2001]).collect()}
    values = [x for h, y, x in rows if h == "b" and y == 2001]
    assert some["b"].n == len(values) and some["b"].median == pytest.approx(statistics.median(values))
    near = {r.g: r for r in kept.approx_quantiles({"median": 0.5}).collect()}
    values = sorted(x for h, y, x in rows if h == "b" and y is not None)
    below, upto = sum(v < near["b"].median for v in values), sum(v <= near["b"].median for v in values)
    assert below <= 0.55 * len(values) and upto >= 0.45 * len(values)


def test_a_second_year_adds_a_sketch_without_reading_the_first(spark, tmp_path):
    path = str(tmp_path / "s")
    rng = random.Random(2)
    rows = [("a", 2000, rng.random()) for _ in range(3_000)]
    df, kept = sketched(spark, path, rows)
    kept.add(df)
    before = {f: os.path.getmtime(f) for f in glob.glob(path + "/_year=2000/part-*")}
    more = [("a", 2001, rng.random() + 1) for _ in range(3_000)]
    second, _ = sketched(spark, path, more)
    kept.add(second)          # only the new year's rows are given
    assert before and before == {f: os.path.getmtime(f) for f in glob.glob(path + "/_year=2000/part-*")}
    both = df.union(second)
    got = kept.exact_quantiles(both, PROBS).first()
    assert got.n == 6_000 and got.median == pytest.approx(quantile([x for *_, x in rows + more], 0.5))
    # a year that is summed up again replaces its own sketch
    kept.add(second)
    assert kept.exact_quantiles(both, PROBS).first().n == 6_000
    # bands come from the sketches alone: no value column is scanned
    plan = kept.bands(PROBS)._jdf.queryExecution().executedPlan().toString()
    assert "sketch" in plan and "x#" not in plan.replace("max#", "")


def test_a_band_that_misses_is_seen(spark, tmp_path, monkeypatch):
    """Where a sketch errs beyond its bound the result is computed without it."""
    rng = random.Random(3)
    rows = [("a", 2000, rng.random()) for _ in range(5_000)]
    df, kept = sketched(spark, str(tmp_path / "s"), rows)
    kept.add(df)
    wrong = kept.bands(PROBS).withColumn("_lo1", F.lit(0.9)).withColumn("_hi1", F.lit(0.91))
    monkeypatch.setattr(kept, "bands", lambda *a: wrong)
    got = kept.exact_quantiles(df, PROBS).first()
    assert got.median == pytest.approx(quantile([x for *_, x in rows], 0.5))


def test_sketches_of_nothing(spark, tmp_path):
    df, kept = sketched(spark, str(tmp_path / "s"), [])
    kept.add(df)
    assert kept.exact_quantiles(df, PROBS).count() == 0
    with open(tmp_path / "note.json", "w") as f:
        json.dump({}, f)
