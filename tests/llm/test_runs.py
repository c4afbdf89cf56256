"""Runs against a brute-force version."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import SF, docs_of, empty_docs, odd_docs, words

from panelkit.llm import runs
from panelkit.llm.common import table


def brute_lyndon(w):
    """Longest Lyndon word at each place, from its definition."""
    out = []
    for i in range(len(w)):
        out.append(max(k for k in range(1, len(w) - i + 1)
                       if all(w[i:i + k] < w[i + s:i + k] for s in range(1, k))))
    return out


def brute_runs(w, least):
    """(start, length, period) of every run, period by period."""
    found, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - a
            if length >= 2 * q and not any(s <= a and a + length <= s + m and p < q and q % p == 0
                                           for s, m, p in found):
                found.append((a, length, q))
    return sorted((s, m, p) for s, m, p in found if m >= least)


def random_words(rng, n):
    w = [rng.randrange(rng.choice([2, 3, 9])) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        at, p = rng.randrange(len(w) + 1), rng.randint(1, 9)
        unit = [rng.randrange(4) for _ in range(p)]
        w[at:at] = (unit * 9)[:rng.randint(p, 4 * p)]
    return w


def test_lyndon_arrays():
    rng = random.Random(3)
    for _ in range(300):
        w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(1, 24))]
        assert runs.lyndon_lengths(w) == brute_lyndon(w), w
        assert runs.lyndon_lengths([-x for x in w]) == brute_lyndon([-x for x in w]), w
    assert runs.lyndon_lengths([]) == []


@pytest.mark.parametrize("least", [2, 3, 5, 12])
def test_runs_of_many_texts(least):
    rng = random.Random(least)
    for _ in range(60):
        texts = [random_words(rng, rng.randint(0, 40)) for _ in range(rng.randint(1, 6))]
        count = np.array([len(t) for t in texts])
        begins = np.cumsum(count) - count
        got = runs.runs_of(np.array([x for t in texts for x in t], np.int64), begins, least)
        want = [(a + s, a + s + m, p) for a, t in zip(begins.tolist(), texts) for s, m, p in brute_runs(t, least)]
        assert list(map(tuple, got.tolist())) == want, texts


def thue_morse(n):
    return np.array([bin(i).count("1") & 1 for i in range(n)])


def test_texts_whose_hashes_collide():
    """Prefix hashes modulo 2**64 collide on such sequences; words decide."""
    t = thue_morse(4_096)
    w = np.concatenate([t, [7], t, [7], 1 - t, [7], 1 - t, [8], t])
    got = runs.runs_of(w, np.array([0]), 12)
    want = []
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= max(q, 12 - q) and not any(s <= a and b + q <= e and q % p == 0 for s, e, p in want):
                want.append((a, b + q, q))
    assert list(map(tuple, got.tolist())) == sorted(want, key=lambda r: (r[0], r[2]))


def test_long_texts_take_linear_time():
    unit = list(range(97))
    long = np.array(unit * 2_000 + [500] + [1, 2] * 50_000)
    assert runs.runs_of(long, np.array([0])).tolist() == [
        [0, 194_000, 97], [194_001, 294_001, 2]]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 30_000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    w = np.frombuffer(fibonacci[-1].encode(), np.uint8).astype(np.int64)
    found = runs.runs_of(w, np.array([0]), 2)
    assert 0.7 * len(w) < len(found) < len(w)


def brute_row(doc_id, text):
    w = words(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found, same = [], np.array([hash(x) for x in w], np.int64)
    for q in range(1, n // 2 + 1):
        equal = np.concatenate([[False], same[:-q] == same[q:], [False]])
        edge = np.flatnonzero(equal[1:] != equal[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= max(q, 12 - q) and not any(
                    s <= a and b + q <= s + m and q % p == 0 for s, m, p in found):
                found.append((a, b - a + q, q))
    found.sort(key=lambda r: (r[0], r[2]))
    drop = {i for s, m, p in found for i in range(s + p, s + m)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{p}\n" for s, m, p in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_query_against_brute_force(spark):
    rows = table(spark, SF, "documents").collect()
    got = sorted(tuple(r) for r in runs.query(spark, SF).collect())
    want = sorted(brute_row(r.doc_id, r.text) for r in rows)
    assert got == want
    assert sum(r[1] > 0 for r in want) >= 10


def test_query_on_odd_texts(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["x", "y", "z", " q", "日本"]) for _ in range(rng.randint(0, 50))))
            for i in range(150)] + [(200, None), (None, "a b " * 9), (None, None), (201, " \t\x0b a\x1cb\r\n"), (7, "a " * 30)]
    rows += [(300 + i, rng.choice([" ", "\n\t"]).join(["r", "s", "t"] * rng.randint(1, 12))) for i in range(60)]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(str, (tuple(r) for r in runs.query(spark, str(tmp_path)).collect())))
    assert got == sorted(str(brute_row(i, t)) for i, t in rows)


def test_operator_on_odd_rows(spark):
    got = runs.periodic_runs(odd_docs(spark)).collect()
    assert len(got) == 11 and all(r.n_words or not r.collapsed for r in got)
    texts = {(r.doc_id, " ".join(words(r.text))) for r in odd_docs(spark).collect()}
    assert {(r.doc_id, r.collapsed) for r in got if not r.runs} <= texts
    assert runs.periodic_runs(empty_docs(spark)).count() == 0
    lines = docs_of(spark, [(1, "buy now " * 20 + "end"), (2, "one two three")])
    out = {r.doc_id: r for r in runs.periodic_runs(lines).collect()}
    assert out[1].collapsed == "buy now end" and [tuple(r) for r in out[1].runs] == [(0, 40, 2)]
    assert out[2].runs == [] and out[2].collapsed == "one two three"
    with pytest.raises(ValueError):
        runs.periodic_runs(lines, min_length=1)
