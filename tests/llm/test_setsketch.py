from __future__ import annotations

import itertools
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from siltstone.llm import setsketch
from siltstone.llm.common import WordHashes


def shingle_set(text: str | None, width: int = 5) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute(rows, width=5, percent=85):
    """Component of every row by comparing all pairs of sets."""
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        least = min(ids) if ids else None
        out += [(rows[i][0], len(sets[i]), least, rows[i][0] == least) for i in members]
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def test_equals_all_pairs(docs, rows):
    assert result(setsketch.near_duplicates(docs)) == brute(rows)


def test_exact_pass_alone_gives_the_same(docs, rows):
    assert result(setsketch.near_duplicates(docs, rounds=0)) == brute(rows)


def test_other_width_and_threshold(docs, rows):
    assert result(setsketch.near_duplicates(docs, width=3, percent=70)) == brute(rows, 3, 70)


def test_group_of_many_near_copies(frame):
    """A chain of edits: neighbours link, ends do not; and many copies around one text, more than a task verifies together."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for k in range(60):
        base[3 * k] = f"new{k}"
        rows.append((1000 + k, " ".join(base)))
    other = [f"v{rng.randrange(10**6)}" for _ in range(300)]
    for k in range(500):
        own = list(other)
        own[rng.randrange(300)] = f"x{k}"
        own[rng.randrange(300)] = f"y{k}"
        rows.append((5000 + k, " ".join(own)))
    assert result(setsketch.near_duplicates(frame(rows))) == brute(rows)


def test_empty_table(no_docs):
    assert setsketch.near_duplicates(no_docs).count() == 0


def test_places_of_words_count():
    hashes = WordHashes()
    found = [setsketch.shingles(t, hashes) for t in (b"a b c d e", b"e b c d a", b"A b c D e", b"a b c d", b"")]
    assert found[0].tolist() == found[2].tolist() and found[0].tolist() != found[1].tolist()
    assert [len(x) for x in found] == [1, 1, 1, 1, 0]


def random_sets(seed, sizes):
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, sum(sizes), dtype=np.int64).astype(np.uint64), np.array(sizes)


def test_registers_merge():
    """The registers of a union are the greater ones, however sets are cut and whatever else is sketched beside them."""
    tokens, sizes = random_sets(4, [1, 7, 300, 5000, 2])
    together = setsketch.registers(tokens, sizes)
    ends = np.cumsum(sizes)
    for k, (end, size) in enumerate(zip(ends, sizes, strict=True)):
        own = tokens[end - size : end]
        assert (setsketch.registers(own, np.array([size]))[0] == together[k]).all()
        cut = size // 2
        if cut:
            halves = setsketch.registers(own, np.array([cut, size - cut]))
            assert (setsketch.merged(halves[0], halves[1]) == together[k]).all()


@pytest.mark.parametrize(("n", "m", "common"), [(1000, 1000, 900), (1000, 1000, 500), (900, 1000, 880), (50, 50, 46), (2000, 1000, 900)])
def test_joint_estimate(n, m, common):
    found = []
    for seed in range(40):
        tokens, _ = random_sets(seed, [n + m - common])
        a, b = setsketch.registers(np.concatenate([tokens[:n], tokens[n - common :]]), np.array([n, m])).astype(int)
        estimate, _ = setsketch.similarity(*(np.array([x.sum()]) for x in (a > b, a < b, a == b)), np.array([float(n)]), np.array([float(m)]))
        found.append(estimate[0])
    share = common / (n + m - common)
    assert abs(np.mean(found) - share) < 4 * math.sqrt(share * (1 - share) / setsketch.REGISTERS / 40) + 0.005


def test_bands_miss_hardly_anything():
    for percent in (70, 80, 85, 95):
        rows = setsketch.band_rows(percent)
        share = percent / 100
        assert (1 - share**rows) ** (setsketch.REGISTERS // rows) <= 1e-9
        assert rows > 1
