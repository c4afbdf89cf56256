"""Registered queries against DuckDB, sharding, and the pipeline against brute force."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import SF, empty_docs, odd_docs
from test_dedup import brute_exact, brute_links
from test_text import LIBRARY, brute_contained

import corpus_pipeline
from panelkit.llm import queries, sharding, simhash, toxicity
from panelkit.llm.common import table


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return c


def test_every_operator_is_registered():
    found = {key.split("_")[0] for key in queries.queries()}
    assert found == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, con, key):
    got = queries.queries()[key](spark, SF).toPandas()
    want = con.execute(queries.oracle_sql()[key]).fetchdf()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got)
    rows = lambda f: sorted(map(tuple, f[columns].astype(object).values.tolist()))
    assert rows(got) == rows(want)


# -- sharding ---------------------------------------------------------------------------

def brute_fill(shards, size):
    orders = []
    for s in shards:
        offset, step = sharding.preference(s, size)
        orders.append([(offset + k * step) % size for k in range(size)])
        assert sorted(orders[-1]) == list(range(size))
    owner = {}
    while len(owner) < size:
        for i, order in enumerate(orders):
            if len(owner) < size:
                owner[next(s for s in order if s not in owner)] = i
    return [owner[s] for s in range(size)]


@pytest.mark.parametrize("n,size", [(1, 2), (3, 7), (5, 101), (7, 211)])
def test_table_fill(n, size):
    names = [f"s{i}" for i in range(n)]
    assert sharding.fill_table(names, size) == brute_fill(names, size)


def test_shares_are_equal_and_few_slots_move():
    before = sharding.fill_table(sharding.SHARDS)
    counts = Counter(before).values()
    assert max(counts) - min(counts) <= 1
    after = sharding.fill_table(sharding.SHARDS[:-1])
    gone = len(sharding.SHARDS) - 1
    moved = np.mean([a != b for a, b in zip(before, after) if a != gone])
    assert moved < 0.25
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 7)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 8)


def test_sharding_is_native_and_moves_no_rows(spark):
    out = sharding.assign_shards(table(spark, SF, "documents"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange") == plan.count("BroadcastExchange")


def test_sharding_odd_rows(spark, tmp_path):
    out = sharding.assign_shards(odd_docs(spark))
    assert out.count() == 11
    assert sorted(out.columns) == sorted(odd_docs(spark).columns)
    same = {(r.doc_id, r.shard) for r in out.collect()}
    assert len(same) == 9
    assert sharding.assign_shards(empty_docs(spark)).count() == 0
    sharding.write_shards(table(spark, SF, "documents"), str(tmp_path / "out"), files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200


# -- pipeline ---------------------------------------------------------------------------

def brute_pipeline(spark, rows, sf):
    model = toxicity.train(table(spark, sf, "documents"), table(spark, sf, "labels"))
    rows = [(i, t) for i, t in rows if model.score(t) < toxicity.THRESHOLD]
    kept = {r[0] for r in brute_exact(rows) if r[3]}
    rows = [(i, t) for i, t in rows if i in kept]
    prints = {i: simhash.fingerprint(t) for i, t in rows}
    roots = brute_links(sorted(set(prints.values())), 3)
    least = {}
    for i, _ in rows:
        least[roots[prints[i]]] = min(least.get(roots[prints[i]], i), i)
    rows = [(i, t) for i, t in rows if least[roots[prints[i]]] == i]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    bad = {x[0] for x in brute_contained(rows, items)}
    return {i: LIBRARY.encode(t or "", add_special_tokens=False).ids for i, t in rows if i not in bad}


def test_pipeline_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == brute_pipeline(spark, rows, SF)


def test_stages_keep_the_columns_and_stand_odd_rows(spark):
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() >= 4, name
        empty = empty_docs(spark)
        assert stage(spark, empty, SF).columns == empty.columns
        assert stage(spark, empty, SF).count() == 0
    assert corpus_pipeline.tokenize(spark, docs, SF).count() == 11
