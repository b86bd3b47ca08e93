from __future__ import annotations

import itertools
import math
from collections import defaultdict

import pytest

from siltstone.llm import ngram_join
from siltstone.llm.components import components


def shingle_set(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))) if words else frozenset()


def brute(rows):
    """Component of every row by comparing all pairs of sets."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_equals_all_pairs(docs, rows):
    assert result(ngram_join.near_duplicates(docs)) == brute(rows)


@pytest.mark.parametrize("most", [0, 12, 25])
def test_any_boundary_gives_the_same(docs, rows, most, monkeypatch):
    monkeypatch.setattr(ngram_join, "boundary", lambda *_: most)
    assert result(ngram_join.near_duplicates(docs)) == brute(rows)


def test_exact_pass_alone_gives_the_same(docs, rows, monkeypatch):
    full = ngram_join.large_links
    monkeypatch.setattr(ngram_join, "large_links", lambda *a: full(*a, rounds=0))
    assert result(ngram_join.near_duplicates(docs)) == brute(rows)


def test_empty_table(no_docs):
    assert ngram_join.near_duplicates(no_docs).count() == 0


def test_needed_overlap_is_least():
    for n in range(1, 60):
        for m in range(n, 70):
            c = ngram_join.needed(n, m)
            assert 100 * c >= 85 * (n + m - c)
            assert 100 * (c - 1) < 85 * (n + m - (c - 1))
            if c <= n:
                assert c in ngram_join.subset_sizes(n)


def test_boundary_weighs_subsets_against_scans(spark):
    sets = spark.createDataFrame([(k, 30, bytearray(30 * 8)) for k in range(5)], "key long, n long, tokens binary")
    few = spark.createDataFrame([(k, 30, 1, 0) for k in range(5)], "key long, n long, token long, place long")
    assert ngram_join.boundary(sets, few) < 30  # thousands of subsets each, lists of five
    sets = spark.createDataFrame([(k, 6, bytearray(6 * 8)) for k in range(50)], "key long, n long, tokens binary")
    long = spark.createDataFrame([(k, 6, 1, 0) for k in range(50)], "key long, n long, token long, place long")
    assert sum(math.comb(6, c) for c in ngram_join.subset_sizes(6)) < 50
    assert ngram_join.boundary(sets, long) >= 6


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 99), (100, 100)], "a long, b long")
    found = {r.node: r.label for r in components(edges).collect()}
    assert found == {k: 0 for k in range(61)} | {99: 99, 100: 99}
