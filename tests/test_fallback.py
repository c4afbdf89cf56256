"""S4 for wanted keys: later sources are read only for keys that earlier ones lack."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.sources.fallback import fallback_by_key, fallback_for_keys


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def brute(sources, wanted):
    out = []
    for k in {k for k in wanted if k is not None}:
        out += next((rows for s in sources if (rows := [r for r in s if r[0] == k])), [])
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    sources = [[(rng.choice([None, *range(lo, 40)]), float(rng.randint(0, 9))) for _ in range(60)] for lo in (30, 15, 0)]
    wanted = [rng.choice([None, *range(50)]) for _ in range(30)]
    frames = [spark.createDataFrame(s, "k long, v double") for s in sources]
    asked = spark.createDataFrame([(k, "x") for k in wanted], "k long, v string")
    got = fallback_for_keys(frames, asked, "k", "source").collect()
    assert sorted((r.k, r.v) for r in got) == brute(sources, wanted)
    rest = fallback_by_key(frames, "k").join(asked.select("k").distinct(), "k", "left_semi").collect()
    assert sorted(map(tuple, rest)) == sorted((r.k, r.v) for r in got)


def test_two_keys_other_columns_and_empty_tables(spark):
    a = spark.createDataFrame([(1, "x", 5.0)], "k long, kind string, v double")
    b = spark.createDataFrame([(1, "x", 6.0, 1), (1, "y", 7.0, 2)], "k long, kind string, v double, more int")
    got = fallback_for_keys([a, b], b.union(b), ["k", "kind"]).collect()
    assert sorted(map(tuple, got)) == [(1, "x", 5.0, None), (1, "y", 7.0, 2)]
    assert fallback_for_keys([a.limit(0), b.limit(0)], b, ["k", "kind"]).count() == 0
    assert fallback_for_keys([a, b], b.limit(0), ["k", "kind"]).columns == ["k", "kind", "v", "more"]


def test_later_sources_are_filtered_before_the_shuffle(spark, tmp_path):
    """With tables above the thresholds the scan of each source has Spark's Bloom filter."""
    n, frames = 100_000, []
    for i, share in enumerate((3, 2, 1)):
        path = str(tmp_path / f"s{i}")
        (spark.range(n).select((F.col("id") % 5_000).alias("k"), F.col("id").alias("v"))
         .filter(F.col("k") % share == 0).write.parquet(path))
        frames.append(spark.read.parquet(path))
    wanted = spark.range(0, 5_000, 5).select(F.col("id").alias("k"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b"}
    before = {c: spark.conf.get(c, None) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        got = fallback_for_keys(frames, wanted, "k", "source")
        assert plan(got).count("might_contain") >= 3
        counts = {r["source"]: (r["n"], r["m"]) for r in got.groupBy("source").agg(
            F.count("*").alias("n"), F.countDistinct("k").alias("m")).collect()}
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    want = fallback_by_key(frames, "k").join(wanted, "k", "left_semi")
    assert sum(n for n, _ in counts.values()) == want.count()
    assert sum(m for _, m in counts.values()) == 1_000


def test_a_source_that_no_key_needs_is_not_read(spark, tmp_path):
    path = str(tmp_path / "gone")
    spark.range(5).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(path)
    first, second = spark.read.parquet(path), spark.read.parquet(path).withColumn("v", F.raise_error(F.lit("read")).cast("long"))
    got = fallback_for_keys([first, second], first, "k")
    assert got.count() == 5 and sorted(r.v for r in got.collect()) == [0, 1, 2, 3, 4]
