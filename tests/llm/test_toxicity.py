from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from siltstone.llm import toxicity
from siltstone.llm.toxicity import Hits, Lexicon, Matcher, features, quoted


def distance(a: str, b: str) -> int:
    """Edits with swaps of neighbours, each letter edited once."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_matcher_equals_distances():
    rng = random.Random(4)
    terms = ["abcde", "abcab", "ba", "cabbage", "bbbbb", "dcba"]
    matcher = Matcher(Lexicon(terms))
    words = {"".join(rng.choice("abcdeg") for _ in range(rng.randrange(1, 9))) for _ in range(4000)}
    words |= {t[:k] + x + t[k + c :] for t in terms for k in range(len(t) + 1) for c in (0, 1) for x in ("", "a", "z")}
    words |= {t[:k] + t[k + 1] + t[k] + t[k + 2 :] for t in terms for k in range(len(t) - 1)}
    for word in words - {""}:
        best = min((distance(word, t), n) for n, t in enumerate(terms) if len(t) >= toxicity.FUZZY_LENGTH or word == t)
        found = matcher.match(word)
        if best[0] > 1:
            assert found is None, word
        else:
            assert found is not None and found[1] == best[0], word


def test_stems_take_any_ending():
    matcher = Matcher(Lexicon(["stone"], ["vexi"]))
    assert matcher.match("vexiation") == (1, 0)
    assert matcher.match("vexi") == (1, 0)
    assert matcher.match("vxiation") is None  # a stem of four letters needs all of them
    assert matcher.match("stones") == (0, 1)
    assert matcher.match("") is None


def test_states_can_be_forgotten():
    small, large = Matcher(Lexicon(["abcde", "edcba"]), most=5), Matcher(Lexicon(["abcde", "edcba"]))
    for word in ("abcde", "abde", "xyz", "edcbaa", "abcdx", "bacde"):
        assert small.match(word) == large.match(word)


def test_quoted_hits_are_set_apart():
    hits = Hits(Lexicon(["moron"]))
    plain, cited, told = (b"you are a moron indeed".split(), b'they wrote of "a moron indeed" then'.split(), b"she called him moron once".split())
    assert not quoted(plain, 3) and quoted(cited, 4) and quoted(told, 3)
    assert features(plain, hits)[0] > 0 and features(plain, hits)[2] == 0
    assert features(cited, hits)[0] == 0 and features(cited, hits)[2] > 0
    assert features(b"M0RON, maron! (moron)".split(), hits)[1] > 0
    assert features([], hits) == (0.0,) * len(toxicity.FEATURES)


def labelled(spark, frame, n=1500):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(3, 8))) for _ in range(3000)]
    bad = ["blorgan", "fremlik", "quorble"] + ["skarn" + e for e in ("a", "ing", "ed", "est", "ous")]
    rows, labels = [], []
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(20, 60))
        toxic = k % 6 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    rows += [(9001, "a fremlick among us"), (9002, "skarnable people here"), (9003, "a calm and quiet day"), (9004, None), (9005, ""), (None, "one blorgan here")]
    return rows, frame(rows), spark.createDataFrame([*labels, (None, 1), (5, None), (0, 1), (70000, 1)], "doc_id long, toxic int").withColumn("text", F.lit("x"))


def test_learns_terms_stems_and_misspellings(spark, frame):
    rows, docs, labels = labelled(spark, frame)
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(found) == len(rows)
    held = [r for i, r in found.items() if i is not None and i < 9000 and r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.values() if r.doc_id is not None)
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.98 * len(held)
    assert [found[i].predicted for i in (9001, 9002, 9003, 9004, 9005, None)] == [1, 1, 0, 0, 0, 1]
    assert all(0 <= r.score <= 1 for r in found.values())


def test_held_out_labels_are_not_read(spark, frame):
    _, docs, labels = labelled(spark, frame, 600)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted((r.doc_id or -1, r.score) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_no_labels_and_no_rows(spark, frame, docs, no_docs, rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.toxicity(docs, none).collect()
    assert len(found) == len(rows)
    assert all(r.score == pytest.approx(0) and r.predicted == 0 for r in found)
    assert toxicity.toxicity(no_docs, none).count() == 0


def test_clean_rows_keep_their_columns(frame):
    docs = frame([(1, "you idiot"), (2, "fine"), (2, "fine"), (None, None)])
    model = toxicity.Model(Lexicon(["idiot"]), toxicity.np.array([-5.0, 20, 0, 0, 0, 0, 0]))
    out = toxicity.clean_rows(docs, model)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 2, 2]


def test_lexicon_is_not_cut(spark):
    """4,600 terms of equal support: none is left out."""
    names = [f"{a}{b}{c}q{d}" for a in "bcdfghjklm" for b in "aeiou" for c in "nprstvwxz" for d in "bcdfghjklmz"][:4600]
    docs = [" ".join(names[(k * 80 + i) % len(names)] for i in range(80)) for k in range(60 * 16 + 20)]
    rows = [(text, 1) for text in docs] + [(f"calm words {k} here", 0) for k in range(len(docs))]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    covered = set(lexicon.terms) | {n for n in names if any(n.startswith(s) for s in lexicon.stems)}
    assert covered >= set(names)
