from __future__ import annotations

import math
from collections import Counter

import pytest

from siltstone.llm import language_model as lm
from siltstone.llm.common import WordHashes


def brute(rows, target):
    """Losses from plain dictionaries of classes and pairs."""
    hashes = WordHashes()
    texts = [(i, [0, *lm.classes((t or "").encode(), hashes).tolist()]) for i, t in rows]
    counts, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for i, c in texts:
        for k in (0, 1) if i in target else (1,):
            if len(c) > 1:
                counts[k].update(c)
                pairs[k].update(zip(c, c[1:], strict=False))
    size = (1 << lm.BITS) - 1
    words = [sum(n for w, n in c.items() if w) for c in counts]
    out = []
    for i, c in texts:
        loss = 0.0
        for v, w in zip(c, c[1:], strict=False):
            p = [(counts[k][w] + 1) / (words[k] + size) for k in (0, 1)]
            both = [-math.log((pairs[k][v, w] + lm.MU * p[k]) / (counts[k][v] + lm.MU)) for k in (0, 1)]
            loss += both[0] - both[1]
        out.append((i, len(c) - 1, loss / (len(c) - 1) if len(c) > 1 else None))
    return sorted(out, key=repr)


def compare(df, want):
    got = sorted(((r.doc_id, r.n_tokens, r.score) for r in df.collect()), key=repr)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for (_, _, g), (_, _, w) in zip(got, want, strict=True):
        assert (g is None) == (w is None)
        assert g is None or g == pytest.approx(w, abs=1e-9)


def test_equals_plain_counts(spark, docs, rows):
    target = spark.createDataFrame([(k,) for k in (20, 21, 41, 50, 303, None, 999)], "doc_id long")
    compare(lm.cross_entropy_difference(docs, target), brute(rows, {20, 21, 41, 50, 303}))


def test_no_target(spark, docs, rows):
    compare(lm.cross_entropy_difference(docs, spark.createDataFrame([], "doc_id long")), brute(rows, set()))


def test_empty_table(spark, no_docs):
    assert lm.cross_entropy_difference(no_docs, spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_target_documents_score_lower(spark):
    rows = [(k, "red green blue " * 20) for k in range(5)] + [(10 + k, "one two three " * 20) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(0,), (1,)], "doc_id long")
    score = {r.doc_id: r.score for r in lm.cross_entropy_difference(docs, target).collect()}
    assert max(score[k] for k in range(5)) < min(score[10 + k] for k in range(5))
