"""Firm-year partials that merge: same rows as one run over everything."""

import glob
import math
import os
import random

import pytest

from panelkit.operators import features as FE
from panelkit.operators.partials import FirmYearStore

FEATS = ["roa", "roe", "tobinq"]
SCHEMA = "permno int, public_year int, public_month int, delist int, roa double, roe double, tobinq double"


def panel(rng, years, months, firms=6):
    rows = []
    for f in range(firms):
        for y in years:
            for m in months:
                for _ in range(rng.choice([0, 1, 1, 2])):
                    x = lambda: None if rng.random() < 0.3 else rng.gauss(50, 3)
                    rows.append((f, y, m if rng.random() > 0.05 else None, rng.randint(0, 1), x(), x(), x()))
    return rows


def close(got, want):
    key = lambda r: (r["permno"], r["public_year"])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want) > 0
    for a, b in zip(got, want):
        a, b = a.asDict(), b.asDict()
        assert a.keys() == b.keys()
        for c in a:
            same = a[c] == b[c] or (a[c] is not None and b[c] is not None and math.isclose(a[c], b[c], rel_tol=1e-8, abs_tol=1e-8))
            assert same, (c, a[c], b[c])


def whole(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return FE.stitch_aggregates(df, FEATS).join(
        FE.yearly_label(df).withColumnRenamed("delist", "first_label"), on=list(FE.KEYS)).collect()


def files(path, year):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/public_year={year}/part-*")}


def test_adding_a_month_gives_the_rows_of_a_full_run(spark, tmp_path):
    rng = random.Random(4)
    path = str(tmp_path / "store")
    store = FirmYearStore(spark, path, FEATS)
    rows = panel(rng, [2000, 2001], range(1, 9))
    assert store.add(spark.createDataFrame(rows, SCHEMA)) == [2000, 2001]
    close(store.features().collect(), whole(spark, rows))
    for month in (9, 10):
        more = panel(rng, [2001], [month], firms=8)
        before = files(path, 2000)
        assert store.add(spark.createDataFrame(more, SCHEMA)) == [2001]
        rows += more
        assert before and files(path, 2000) == before      # the untouched year is not written
        close(store.features().collect(), whole(spark, rows))
    # an earlier month that comes late moves the first label
    late = [(1, 2000, 0, 1, 1.0, None, 2.0), (1, 2002, 3, 0, None, None, None), (None, 2000, 1, 1, 1.0, 1.0, 1.0),
            (2, None, 1, 1, 1.0, 1.0, 1.0)]
    assert store.add(spark.createDataFrame(late, SCHEMA)) == [2000, 2002]
    close(store.features().collect(), whole(spark, rows + late[:2]))


def test_only_touched_years_are_read(spark, tmp_path):
    rng = random.Random(5)
    path = str(tmp_path / "store")
    store = FirmYearStore(spark, path, FEATS)
    store.add(spark.createDataFrame(panel(rng, [2000, 2001], [1, 2]), SCHEMA))
    for file in files(path, 2000):      # a year that cannot be read any more
        with open(file, "wb") as f:
            f.write(b"damaged")
    assert store.add(spark.createDataFrame(panel(rng, [2001], [3]), SCHEMA)) == [2001]


def test_store_of_nothing(spark, tmp_path):
    store = FirmYearStore(spark, str(tmp_path / "store"), FEATS)
    assert store.add(spark.createDataFrame([], SCHEMA)) == []
    with pytest.raises(FileNotFoundError):
        store.features()
