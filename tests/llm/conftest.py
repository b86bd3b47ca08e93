from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

CLASHING = ("key", "n", "token", "bucket", "row", "label", "words", "fp", "a", "entries", "score", "path_")


def sentence(rng: random.Random, n: int, letters: str = "abcdefgh") -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(n)]


def odd_rows() -> list[tuple]:
    """doc_id and text: copies, near copies, shared passages, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(7)
    rows: list[tuple] = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one two three"), (6, "ONE two  three"), (None, "no id here at all"), (None, None)]
    base = sentence(rng, 120)
    passage = " ".join(sentence(rng, 70))
    for k in range(12):  # near copies, each with a word or two of its own
        own = list(base)
        for at in rng.sample(range(len(own)), 1 + k % 3):
            own[at] = f"x{k}{at}"
        rows.append((20 + k, " ".join(own)))
    rows += [(40, " ".join(base)), (41, " ".join(base)), (41, " ".join(base)), (None, " ".join(base))]
    for k in range(5):
        rows.append((50 + k, " ".join(sentence(rng, 30)) + " " + passage + ". " + " ".join(sentence(rng, 25))))
    for size in (*range(4, 34), 60):  # short texts with small changes: subsets decide these
        text = sentence(rng, size)
        rows.append((100 + 3 * size, " ".join(text)))
        rows.append((101 + 3 * size, " ".join([*text, "tail"])))
        rows.append((102 + 3 * size, " ".join(text[1:])))
    rows.append((300, "a" * 900))
    rows.append((301, "é" * 333 + "z"))
    rows.append((302, "b" + "é" * 333))
    rows.append((303, " ".join(sentence(rng, 30_000))))
    rows.append((304, rows[-1][1][:50_000] + " changed " + rows[-1][1][50_000:]))
    rows.append((305, "go " * 400))
    rows += [(400 + k, " ".join(sentence(rng, 40))) for k in range(40)]
    return rows


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return odd_rows()


@pytest.fixture(scope="session")
def frame(spark):
    """Makes frames of rows with further columns whose names the operators use themselves."""

    def make(rows, schema="doc_id long, text string"):
        made = spark.createDataFrame(rows, schema)
        return made.select("*", *(F.lit("clash").alias(c) for c in CLASHING if c not in made.columns)).repartition(3)

    return make


@pytest.fixture(scope="session")
def docs(frame, rows):
    return frame(rows)


@pytest.fixture(scope="session")
def no_docs(frame):
    return frame([])
