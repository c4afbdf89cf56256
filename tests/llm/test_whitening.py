"""Whitening against numpy's eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest
from helpers import SF

from panelkit.llm import whitening
from panelkit.llm.common import table


def brute(vectors, components=8):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(0)
    exact = (n * x - sums)
    centred = exact.astype(float) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return ([int(sum(c * c for c in row)) for row in exact], values / np.trace(v),
            centred @ vectors / np.sqrt(values), values)


def frame(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}").repartition(3)


def by_row(out):
    got = {}
    for r in out.collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    return got


def compare(out, ids, vectors, k=8):
    deviation, explained, white, _ = brute(vectors, k)
    got = by_row(out)
    assert sorted(got) == sorted(ids)
    for c in range(1, k + 1):
        own = np.array([got[i][c].whitened for i in ids])
        want = white[:, c - 1]
        want = want if abs(own - want).max() < abs(own + want).max() else -want
        assert np.abs(own - want).max() < 1e-6
        assert abs(got[ids[0]][c].explained / explained[c - 1] - 1) < 1e-9
    for row, i in enumerate(ids):
        assert {r.deviation for r in got[i].values()} == {deviation[row]}
        assert {r.n for r in got[i].values()} == {len(ids)}
    assert len({r.identity_error for g in got.values() for r in g.values()}) == 1
    assert got[ids[0]][1].identity_error < 1e-9


def test_query_against_numpy(spark):
    rows = table(spark, SF, "embeddings").collect()
    compare(whitening.query(spark, SF), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_flat_spectrum_and_far_from_zero(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((400, 80)) * 0.3 + 500).astype(np.float32).tolist()
    compare(whitening.whiten(frame(spark, list(enumerate(vectors)))), list(range(400)), vectors)


def test_steep_spectrum(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((300, 50)) * 10.0 ** -np.linspace(-2, 1.5, 50)).tolist()
    compare(whitening.whiten(frame(spark, list(enumerate(vectors)), "array<double>")), list(range(300)), vectors)


def test_certificate_and_filter(spark):
    blocks, d = whitening.pack(table(spark, SF, "embeddings"))
    model = whitening.fit(blocks, d)
    assert d == 64 and model.residual <= whitening.ROUNDING
    assert np.abs(model.vectors.T @ model.vectors - np.eye(8)).max() < 1e-12
    assert model.passes < 120
    # The filter is worth its passes: fewer than plain subspace iteration takes.
    x = np.array([r.embedding for r in table(spark, SF, "embeddings").collect()])
    x = np.floor(x * 1024)
    x -= x.mean(0)
    v = x.T @ x / len(x)
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((64, 32)))[0]
    plain = 0
    while plain < 1_000:
        values, turn = np.linalg.eigh(q.T @ v @ q)
        u = (q @ turn)[:, ::-1][:, :8]
        if np.linalg.norm(v @ u - u * values[::-1][:8], axis=0).max() < 1e-12 * values[-1]:
            break
        q = np.linalg.qr(v @ q)[0]
        plain += 1
    assert model.passes < plain


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = rng.standard_normal((30, 5)).round(3).tolist()
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4),
             (104, []), (105, [1.0, 2.0]), (None, None), (106, [3e30] * 5)]
    df = frame(spark, rows, "array<double>")
    for name in ("ids", "numbers", "wide", "n", "component", "whitened", "label", "x", "_id", "d", "offset"):
        df = df.withColumn(name, df.vec_id)
    out = whitening.whiten(df)
    compare(out, list(range(30)), good, 5)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_few_directions_ties_and_repeats(spark):
    flat = [(i, [float(i % 3), 2.0, 2.0 * (i % 3)]) for i in range(12)] + [(3, [0.0, 2.0, 0.0]), (None, [1.0, 2.0, 2.0])]
    got = whitening.whiten(frame(spark, flat)).collect()
    assert len(got) == 14 and {r.component for r in got} == {1}
    assert abs(got[0].explained - 1) < 1e-12
    assert sum(r.vec_id == 3 for r in got) == 2 and sum(r.vec_id is None for r in got) == 1
    tied = [(i, [1.0 * (i == 0) - (i == 1), 1.0 * (i == 2) - (i == 3)]) for i in range(4)]
    assert whitening.whiten(frame(spark, tied)).count() == 8
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])], [(1, None)]):
        assert whitening.whiten(frame(spark, rows)).count() == 0


def test_deviation_beyond_a_long():
    rows = np.array([[0, 5], [2 ** 40, 1], [1_500_000_000, 7]], np.int64)
    n, sums = 3, [int(s) for s in rows.sum(0)]
    want = [sum((n * int(x) - s) ** 2 for x, s in zip(r, sums)) for r in rows]
    assert whitening.deviations(rows, n, sums) == [w if w < 1 << 63 else None for w in want]
    near = np.array([[0], [2_000_000_000]], np.int64)
    assert whitening.deviations(near, 2, [2_000_000_000]) == [4 * 10 ** 18] * 2
    edge = np.array([[0], [3_000_000_000]], np.int64)
    assert whitening.deviations(edge, 2, [3_000_000_000]) == [9 * 10 ** 18] * 2


@pytest.mark.parametrize("d", [1, 3])
def test_exact_sums(spark, d):
    big = 2.0 ** 51
    rows = [(i, [big + i] * d) for i in range(40)]
    blocks, got = whitening.pack(frame(spark, rows, "array<double>"))
    n, sums = whitening.exact_sums(blocks, got)
    assert (n, sums) == (40, [sum(1024 * (2 ** 51 + i) + 100_000 for i in range(40))] * d)
