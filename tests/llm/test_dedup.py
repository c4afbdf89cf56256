import hashlib
import random

import pytest
from helpers import docs_of, empty_docs, odd_docs, random_texts, words
from pyspark.sql import functions as F

from panelkit.llm import exact_dedup as exact
from panelkit.llm import simhash
from panelkit.llm import substring_dedup as substring
from panelkit.llm.components import components


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("digest", [exact.sha256, F.length, lambda c: F.lit(1)])
def test_exact_dedup_compares_content(spark, digest):
    rows = list(enumerate(random_texts(3, 300, length=20) + [None, "", "same"] + ["same"] * 50))
    got = exact.exact_dedup(docs_of(spark, rows), digest=digest, salts=3).collect()
    assert sorted(map(tuple, got)) == brute_exact(rows)


def test_exact_dedup_odd_rows(spark):
    got = exact.exact_dedup(odd_docs(spark)).collect()
    assert len(got) == 11
    assert {r.keep_id for r in got if r.doc_id in (1, 7)} == {7}
    assert {r.keep_id for r in got if r.doc_id in (2, 3)} == {3}
    assert [r.kept for r in got if r.doc_id == 7] == [True, True]
    assert not any(r.kept for r in got if r.doc_id is None)
    kept = exact.without_copies(odd_docs(spark))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7, 7, 8]
    assert kept.columns == odd_docs(spark).columns
    assert exact.exact_dedup(empty_docs(spark)).count() == 0


def brute_substring(rows, k):
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = {q for p in range(len(w) - k + 1) if first[tuple(w[p:p + k])] < i for q in range(p, p + k)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("k,vocabulary,hash_bits", [(13, 60, 64), (4, 6, 64), (5, 8, 16)])
def test_substring_dedup(spark, k, vocabulary, hash_bits):
    rows = list(enumerate(random_texts(k, 150, vocabulary) + [None, "a\x0bb\x0cc\xa0d e"]))
    random.Random(1).shuffle(rows)
    got = substring.substring_dedup(docs_of(spark, rows), k=k, hash_bits=hash_bits).collect()
    assert sorted(tuple(r)[:4] for r in got) == brute_substring(rows, k)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_repeated_spans_stand_in_their_sources(spark):
    texts = random_texts(31, 80)
    got = substring.repeated_spans(docs_of(spark, enumerate(texts))).collect()
    covered = {}
    for r in got:
        here, there = words(texts[r.doc_id]), words(texts[r.source_id])
        assert r.source_id < r.doc_id and r.n_words >= 13
        assert here[r.first_word:r.first_word + r.n_words] == there[r.source_word:r.source_word + r.n_words]
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    want = {i: n for i, _, n, _ in brute_substring(list(enumerate(texts)), 13) if n}
    assert {i: len(c) for i, c in covered.items()} == want


def brute_paths(rows, k):
    """The repeated windows, as one set per nonbranching path of their De Bruijn graph."""
    docs = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - k + 1):
            docs.setdefault(tuple(w[p:p + k]), set()).add(i)
    edges = sorted(e for e in docs if len(docs[e]) > 1)
    comes, goes = {}, {}
    for e in edges:
        comes.setdefault(e[1:], []).append(e)
        goes.setdefault(e[:-1], []).append(e)
    root = {e: e for e in edges}

    def find(e):
        while root[e] != e:
            e = root[e]
        return e
    for node in comes:
        if len(comes[node]) == 1 and len(goes.get(node, [])) == 1:
            root[find(comes[node][0])] = find(goes[node][0])
    paths = {}
    for e in edges:
        paths.setdefault(find(e), set()).add(e)
    return sorted(map(sorted, paths.values()))


def found_paths(texts, got, k):
    paths = {}
    for r in got:
        for doc, at in ((r.doc_id, r.first_word), (r.source_id, r.source_word)):
            w = words(texts[doc])
            paths.setdefault(r.path, set()).update(
                tuple(w[p:p + k]) for p in range(at, at + r.n_words - k + 1))
    return sorted(map(sorted, paths.values()))


@pytest.mark.parametrize("k,vocabulary", [(13, 60), (4, 6), (3, 3), (2, 4)])
def test_paths_are_those_of_the_graph(spark, k, vocabulary):
    """Branches end paths, nodes with one edge each way do not, wherever the edges stand first."""
    texts = random_texts(k + 50, 60, vocabulary)
    texts += ["p q r s t u v " * 9, "q r s t u v p " * 9, "z", None, ""]
    got = substring.repeated_spans(docs_of(spark, enumerate(texts)), k=k).collect()
    assert found_paths(texts, got, k) == brute_paths(list(enumerate(texts)), k)


def test_spans_end_at_branches_and_cross_sources(spark):
    w = [f"w{i}" for i in range(60)]
    split = ["x", *w[:20], *[f"a{i}" for i in range(20)]], ["y", *w[:20], *[f"b{i}" for i in range(20)]]
    halves = w[30:50], w[38:60], w[30:60]     # the third's path begins in one source, ends in another
    texts = [" ".join(t) for t in (*split, *split, *halves)]
    got = substring.repeated_spans(docs_of(spark, enumerate(texts))).collect()
    assert found_paths(texts, got, 13) == brute_paths(list(enumerate(texts)), 13)
    spans = {(r.doc_id, r.span_first, r.span_words) for r in got}
    # of document 2 (x, common, a...): before the fork, the fork's common part, after it
    assert {s for s in spans if s[0] == 2} == {(2, 0, 13), (2, 1, 20), (2, 9, 32)}
    assert {s for s in spans if s[0] == 6} == {(6, 0, 30)}
    assert len({r.source_id for r in got if r.doc_id == 6}) == 2


def test_many_sources_of_one_document_meet_in_one_row_a_word(spark):
    """A source that others copy in thousands of pieces gives the graph a row per word at most."""
    rows = [(i + 1, s, 3 + i % 40, 0, s) for i in range(3000) for s in range(0, 50, 7)]
    paths = spark.createDataFrame(rows, substring._PATH_TYPE)
    runs = substring.repeated_edges(paths, 5).collect()
    assert [tuple(r) for r in runs] == [(0, 0, 49 + 42)]


def test_substring_dedup_odd_rows(spark):
    got = substring.substring_dedup(odd_docs(spark)).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[5].n_words == by[5].n_removed == 120_000
    assert by[4].n_removed < by[4].n_words and by[2].n_words == by[3].n_words == by[6].n_words == 0
    assert substring.substring_dedup(empty_docs(spark)).count() == 0
    spans = substring.repeated_spans(odd_docs(spark)).collect()
    assert {(r.doc_id, r.source_id) for r in spans} == {(5, 4)}
    assert substring.repeated_spans(empty_docs(spark)).count() == 0


def brute_links(values, bits):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in values:
        for b in values:
            if a < b and bin(a ^ b).count("1") <= bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


@pytest.mark.parametrize("bits", [3, 2, 1, 0])
def test_pigeonring_loses_no_link(spark, bits):
    rng = random.Random(bits)
    values = set()
    for _ in range(40):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(rng.randint(0, 25)):
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    distinct = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    edges = simhash.links(distinct, bits, block=5)
    assert all(bin((r.a ^ r.b) & ((1 << 64) - 1)).count("1") <= 64 for r in edges.collect())
    found = {r.node: r.root for r in components(edges).collect()}
    want = brute_links([v & ((1 << 64) - 1) for v in signed], bits)
    ours = {v & ((1 << 64) - 1): found.get(v, v) & ((1 << 64) - 1) for v in signed}
    classes = lambda m: sorted(sorted(v for v in m if m[v] == r) for r in set(m.values()))
    assert classes(ours) == classes(want)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1001 + i: 1000 for i in range(200)}


def test_simhash_near_groups(spark):
    rows = list(enumerate(random_texts(11, 200, length=120) + [None, "", "One two", "one  TWO", "É É É É", "é é é é"]))
    got = {r.doc_id: r for r in simhash.near_groups(docs_of(spark, rows)).collect()}
    prints = {i: simhash.fingerprint(t) for i, t in rows}
    roots = brute_links(sorted(set(prints.values())), 3)
    least = {}
    for i, _ in rows:
        r = roots[prints[i]]
        least[r] = min(least.get(r, i), i)
    assert {i: r.component_id for i, r in got.items()} == {i: least[roots[prints[i]]] for i, _ in rows}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert prints[200] == prints[201] == 0 and prints[202] == prints[203] and prints[204] != prints[205]


def test_simhash_odd_rows(spark):
    got = simhash.near_groups(odd_docs(spark)).collect()
    assert len(got) == 11
    assert {r.component_id for r in got if r.doc_id in (2, 3, 6)} == {2}
    kept = simhash.without_near_copies(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 4, 8]
    assert simhash.near_groups(empty_docs(spark)).count() == 0
