from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import classifier
from siltstone.llm.learn import sample_labels


def made(spark, frame, n=900):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(3, 8))) for _ in range(2000)]
    rows, labels = [], []
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(10, 60))
        kind = k % 9
        if kind == 0:
            words = [w + "###" for w in words]
        elif kind == 1:
            words = [w for w in words[:5] for _ in range(8)]
        elif kind == 2:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(kind > 2)))
    rows += [(9001, None), (9002, ""), (None, "plain words in a row")]
    return rows, frame(rows), spark.createDataFrame([*labels, (None, 0), (4, None)], "doc_id long, quality int").withColumn("text", F.lit("x"))


def test_held_out_accuracy(spark, frame):
    rows, docs, labels = made(spark, frame)
    found = {r.doc_id: r for r in classifier.quality(docs, labels).collect()}
    assert len(found) == len(rows)
    held = [r for i, r in found.items() if i is not None and i < 9000 and r.held_out]
    assert sum(r.predicted == (r.doc_id % 9 > 2) for r in held) >= 0.97 * len(held)
    assert found[9001].score == found[9002].score and 0 <= found[9001].score <= 1


def test_score_is_the_sparse_dot_product():
    table = classifier.Chunks()
    at = classifier.places(b"red ### red red Blue".split(), table, bits=10)
    model = classifier.Model(np.random.default_rng(1).normal(size=1 << 10).astype(np.float32), 0.3)
    dense = np.bincount(at, minlength=1 << 10) / len(at)
    z = 0.3 + classifier.SCALE * float(dense @ model.weights)
    assert model.score(at) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)
    assert model.score(np.empty(0, np.int64)) == pytest.approx(1 / (1 + np.exp(-0.3)))


def test_ftrl_follows_its_definition():
    """Against the per-coordinate recurrence written out with dictionaries."""
    rng = np.random.default_rng(5)
    examples = [(np.sort(rng.choice(16, 4, replace=False)), rng.random(4), int(rng.random() < 0.5)) for _ in range(60)]
    model = classifier.ftrl(examples, bits=4, epochs=2, alpha=0.3, beta=0.7, l1=0.05, l2=0.2)
    z, n = dict.fromkeys(range(17), 0.0), dict.fromkeys(range(17), 0.0)

    def weight(i):
        l1 = 0.0 if i == 16 else 0.05
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((0.7 + n[i] ** 0.5) / 0.3 + 0.2)

    for _ in range(2):
        for at, x, y in examples:
            pairs = [*zip(at.tolist(), x.tolist(), strict=True), (16, 1.0)]
            w = {i: weight(i) for i, _ in pairs}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in pairs)))
            for i, v in pairs:
                g = (p - y) * v
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.3
                z[i] += g - sigma * w[i]
                n[i] += g * g
    assert model.weights.tolist() == pytest.approx([weight(i) for i in range(16)], abs=1e-6)
    assert model.intercept == pytest.approx(weight(16))


def test_sample_is_bounded_and_repeatable(spark):
    labels = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    ids = [sorted(r.doc_id for r in sample_labels(labels.repartition(k), "quality", bound=50).collect()) for k in (1, 4)]
    assert len(ids[0]) == 50 and ids[0] == ids[1]


def test_no_labels_and_no_rows(spark, docs, no_docs, rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = classifier.quality(docs, none).collect()
    assert len(found) == len(rows) and all(r.score == 0.5 for r in found)
    assert classifier.quality(no_docs, none).count() == 0


def test_whole_shapes_count():
    """Shapes that differ beyond any prefix are different features."""
    table = classifier.Chunks()
    same, other = table[b"a" * 30 + b"1"], table[b"a" * 30 + b"-"]
    assert same & 0xFFFFFFFF != other & 0xFFFFFFFF
    assert table[b"b" * 30 + b"7"] & 0xFFFFFFFF == same & 0xFFFFFFFF
