"""Quality classifier: hashed word n-grams, logistic regression fitted by follow-the-regularised-leader.

Every chunk between spaces gives word and sign tokens and a shape (letters folded to a and A, digits to 0, signs kept);
features are the hashed tokens, shapes, and pairs of neighbours of each, with a mark where both are equal. A
document is the vector of its features' shares, scored as a sparse dot product: the sum of the weights at its
features' places. FTRL-Proximal visits a bounded sample of labelled documents; features are extracted in parallel,
the updates run in one task.

Edge cases: a null or empty text has no features and gets the intercept's score; without labelled rows the model is
all zero (score 0.5); repeated rows are scored once each; a null doc_id is kept; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, mixed, utf8, written
from .learn import SAMPLE, held_out, sample_labels, training_texts

BITS = 18
SCALE = 12.0
EPOCHS = 4
THRESHOLD = 0.3
_TOKENS = re.compile(r"\w+|[^\w\s]+")
_FOLD = [(re.compile(r"[^\W\d_a-zà-ÿ]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"), (re.compile(r"\d+"), "0")]


class Chunks(dict):
    """Per chunk between spaces: hash of its folded text (upper 32 bits) and of its shape."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, chunk: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        text = chunk.decode("utf-8", "replace")
        shape = text
        for pattern, letter in _FOLD:
            shape = pattern.sub(letter, shape)
        word = " ".join(_TOKENS.findall(text.lower()))
        value = (xxhash.xxh32_intdigest(word) << 32) | xxhash.xxh32_intdigest(shape)
        self[chunk] = value
        return value


def places(chunks: list[bytes], table: Chunks, bits: int = BITS) -> np.ndarray:
    """Place of every feature of a text, with repetitions."""
    if not chunks:
        return np.empty(0, np.int64)
    both = np.fromiter(map(table.__getitem__, chunks), dtype=np.uint64, count=len(chunks))
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    found = [word * MIX[0], shape * MIX[1]]
    if len(chunks) > 1:
        found.append(word[:-1] * MIX[2] + word[1:] * MIX[3])
        same = (word[:-1] == word[1:]).astype(np.uint64)
        found.append(shape[:-1] * MIX[4] + shape[1:] * MIX[5] + same * MIX[0])
    return (mixed(np.concatenate(found)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray  # one per place
    intercept: float

    def score(self, found: np.ndarray) -> float:
        z = self.intercept + (SCALE * float(self.weights[found].sum()) / len(found) if len(found) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> Model:
    """FTRL-Proximal over (places, values, label) examples; the last place is the intercept, which is not shrunk."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    bound = np.full(size, l1)
    bound[-1] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * bound[at]) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(zi) <= bound[at]] = 0.0
        return w

    for _ in range(epochs):
        for at, x, y in examples:
            at, x = np.append(at, size - 1), np.append(x, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    final = weights(np.arange(size))
    return Model(final[:-1].astype(np.float32), float(final[-1]))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = Chunks()
    for batch in batches:
        at, x = [], []
        for text in utf8(batch, "text"):
            unique, counts = np.unique(places(text.split(), table), return_counts=True)
            at.append(unique.astype("<i4").tobytes())
            x.append((SCALE * counts / max(1, counts.sum())).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(at, pa.binary()), pa.array(x, pa.binary()), batch.column(2)], names=["label", "at", "x", "turn"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)]
    rows.sort(key=lambda r: (r[3], r[1]))
    examples = [(np.frombuffer(at, "<i4").astype(np.int64), np.frombuffer(x, "<f4").astype(float), label) for label, at, x, _ in rows]
    model = ftrl(examples) if examples else Model(np.zeros(1 << BITS, np.float32), 0.0)
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), pa.array([model.intercept])], names=["weights", "intercept"])


def train_model(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on at most `bound` labelled rows of the training fold."""
    train = training_texts(docs, sample_labels(labels, label, bound, id_col), id_col, text_col)
    train = train.withColumn("turn", F.xxhash64("text"))
    found = written(train.select("text", "label", "turn").mapInArrow(_extract, "label int, at binary, x binary, turn long"))
    # The sample is bounded, so one task can hold it.
    fitted = found.coalesce(1).mapInArrow(_fit, "weights binary, intercept double").first()
    return Model(np.frombuffer(fitted.weights, "<f4"), fitted.intercept) if fitted else Model(np.zeros(1 << BITS, np.float32), 0.0)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and number of features of every document, whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))  # 4 * 2 ** BITS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, own = Chunks(), Model(*sent.value)
        for batch in batches:
            found = [places((t or b"").split(), table) for t in utf8(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([own.score(f) for f in found], pa.float64()), pa.array([len(f) for f in found], pa.int64())], names=["doc_id", "score", "n_features"]
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double, n_features long")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and number of features."""
    scored = score_documents(docs, train_model(docs, labels))
    return scored.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int")})
