from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from siltstone.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(len(own), 10)
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                which = windows.get(tuple(own[k : k + size]))
                if which:
                    hit.update(range(k, k + size))
                    found |= which
        out.append((doc_id, len(own), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=repr)


def made(seed: int = 5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abÉé1") for _ in range(rng.randrange(1, 4)))
    long = [" ".join(word() for _ in range(n)) for n in (10, 11, 14, 25, 40)]
    items = [(k, t) for k, t in enumerate(long)]
    items += [(10, long[1]), (11, "short one"), (12, "five words stand here now"), (13, "one"), (14, None), (15, " .. "), (None, "nobody knows this nine word item at all really"), (16, long[4][5:90])]
    docs = [(None, long[0]), (700, None), (701, "")]
    for k in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            text = rng.choice(long).split()
            lo = rng.randrange(len(text))
            parts.append(" ".join(text[lo : lo + rng.randrange(5, 30)]))
            parts.append(" ".join(word() for _ in range(rng.randrange(0, 12))))
        docs.append((k, rng.choice([" ", ", ", "-"]).join(parts)))
    docs += [(800, long[3].replace("a", "A")), (801, long[3].replace("É", "é")), (802, "A SHORT ONE; one. Five words-stand here\nnow"), (802, "A SHORT ONE; one. Five words-stand here\nnow"), (803, "nobody knows this nine word item at all really?")]
    return docs, items


@pytest.fixture(scope="module")
def benchmark_frame(spark):
    def make(items):
        return spark.createDataFrame(items, "item_id long, text string").withColumns({"key": F.lit(1), "fp": F.lit(2), "words": F.lit(3)})

    return make


@pytest.mark.parametrize("seed", [5, 6])
def test_equals_all_windows(frame, benchmark_frame, seed):
    docs, items = made(seed)
    assert result(decontaminate.report(frame(docs), benchmark_frame(items))) == brute(docs, items)


def test_long_texts_and_copies(frame, benchmark_frame, rows):
    items = [(1, " ".join(rows[-1][1].split()[5:30])), (2, dict(rows)[50][-200:]), (3, "go " * 15)]
    assert result(decontaminate.report(frame(rows), benchmark_frame(items))) == brute(rows, items)


def test_empty_tables(frame, benchmark_frame, no_docs):
    docs, items = made()
    assert decontaminate.report(no_docs, benchmark_frame(items)).count() == 0
    assert result(decontaminate.report(frame(docs), benchmark_frame([]))) == brute(docs, [])


def test_winnowing_meets_every_shared_span():
    """Two sequences that share SPAN words keep a common fingerprint, whatever surrounds them."""
    rng = random.Random(2)

    def kept(text):
        grams = [hash(tuple(text[k : k + decontaminate.GRAM])) for k in range(len(text) - decontaminate.GRAM + 1)]
        return {min(grams[k : k + decontaminate.SIDE + 1]) for k in range(len(grams) - decontaminate.SIDE)}

    for _ in range(200):
        span = [rng.random() for _ in range(decontaminate.SPAN)]
        sides = [[rng.random() for _ in range(rng.randrange(0, 9))] for _ in range(4)]
        assert kept(sides[0] + span + sides[1]) & kept(sides[2] + span + sides[3])
