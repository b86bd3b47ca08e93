"""Extractive summaries: continuous LexRank (Erkan and Radev, 2004).

A sentence's score is the stationary probability of a walk over the document's sentences, where a step
goes to a sentence in proportion to its cosine similarity. With A the sentence-by-term matrix of
unit-length tf-idf rows, the similarity matrix is A A', so a step is A (A' q): one sum per term and one
per sentence. The pairs of sentences are never formed, and the cost is linear in the text.

Spark splits the texts into sentences and words, row by row; the text is hash partitioned by document once, and nothing is
grouped, sorted or joined. Counting the words of a sentence and the fixed-point iteration run in Python, on Arrow batches that
hold many documents at a time, taken in parts of a bounded number of words.

A document of more than `LARGE_CHARS` characters does not stand in one row: its walk runs over rows of sentences and terms
(`sentence_walk`), to the same scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from .frames import computed_once
from .sentence_walk import NO_TERM, sentence_rows, walk_scores

DAMPING = 0.85
# The walk of a document ends when no score moves by more.
TOLERANCE = 1e-13
# Characters up to which a document's terms stand in one row.
LARGE_CHARS = 4_000_000

# A summary sentence is kept if it mentions one of these.
LEGAL_KEYWORDS = ("putusan", "terdakwa", "hukuman", "pidana", "perdata", "amar")

# Words that a walk takes at a time, whole documents at least.
WORDS_AT_ONCE = 1_000_000

_CUT = "\u0001"


def sentences_of(text: Column) -> Column:
    """Array of sentences: cut after `.`, `!` or `?` followed by whitespace, and at blank lines."""
    cut = F.regexp_replace(strip(text), r"([.!?])\s+|\s*\n\s*\n\s*", f"$1{_CUT}")
    return F.array_remove(F.split(F.regexp_replace(cut, r"\s+", " "), _CUT), "")


def spread_by_document(documents: DataFrame, doc_id: str) -> DataFrame:
    """The rows hash partitioned by document.

    The number of partitions is stated, so that AQE does not merge them by their size in bytes: the work
    per byte is far above that of an ordinary exchange.
    """
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return documents.repartition(partitions, doc_id)


def document_terms(rows: DataFrame, text: str, keep: list[str], all_rows: bool = False) -> DataFrame:
    """The kept columns, the text's sentences, and `terms`, the words of every sentence; rows without sentences are left out
    unless `all_rows`, which gives them empty lists.

    Both are handed through outer generators: for plain ones, and for a filter on a projection, Catalyst repeats the
    expression below, and so splits every text twice.
    """
    sentences = sentences_of(F.col(text))
    if all_rows:
        sentences = F.coalesce(sentences, F.array().cast("array<string>"))
    split = computed_once(rows.select(*keep, sentences.alias("sentences")), keep)
    if not all_rows:
        split = split.where(F.size("sentences") > 0)
    return split.withColumn("terms", F.transform("sentences", lambda s: F.split(F.lower(s), NO_TERM)))


def walk(tolerance: float, damping: float, words_at_once: int = WORDS_AT_ONCE):
    """Function from the words per sentence of documents to the scores per document, for an Arrow batch.

    It is built here, inside another function, so that it travels to the executors by value: they need
    numpy and pyarrow, but not this package.
    """
    stretch, reach = 2 / (2 - damping), damping / (2 - damping)

    def part(terms: pa.Array) -> pa.Array:
        n = np.asarray(pc.list_value_length(terms))
        first = np.concatenate(([0], np.cumsum(n)))
        sentences = terms.flatten()
        words = pc.dictionary_encode(sentences.flatten())
        index, size = np.asarray(words.indices), max(len(words.dictionary), 1)
        holder = np.repeat(np.arange(first[-1]), np.asarray(pc.list_value_length(sentences)))
        named = np.asarray(pc.not_equal(words.dictionary, ""))[index] if len(index) else np.zeros(0, bool)
        entries, tf = np.unique(holder[named] * size + index[named], return_counts=True)
        sentence = entries // size
        document = np.repeat(np.arange(len(n)), n)[sentence]
        keys, term = np.unique(document * size + entries % size, return_inverse=True)
        frequency = np.bincount(term, minlength=len(keys))
        weight = tf * np.log(n[keys // size] / frequency)[term]
        length = np.sqrt(np.bincount(sentence, weight * weight, first[-1]))
        a = weight / np.where(length > 0, length, 1.0)[sentence]

        def similar(values: np.ndarray) -> np.ndarray:
            toward_terms = np.bincount(term, a * values[sentence], len(frequency))
            return np.bincount(sentence, a * toward_terms[term], first[-1])

        per_sentence = np.repeat(n, n).astype(float)
        degree = similar(np.ones(first[-1]))
        out = np.where(degree > 0, 1.0 / np.where(degree > 0, degree, 1.0), 0.0)
        p, before = 1.0 / per_sentence, np.zeros(first[-1])
        # Chebyshev's recurrence, as in `sentence_walk`. A document that rests is left alone: its scores do not depend on its batch.
        moving, omega, turn = np.repeat(n > 0, n), 1.0, 0
        while moving.any():
            step = (1.0 - damping) / per_sentence + damping * similar(p * out)
            omega = 1.0 if turn == 0 else 1 / (1 - reach**2 / 2) if turn == 1 else 1 / (1 - reach**2 * omega / 4)
            new = np.where(moving, omega * (stretch * (step - p) + p - before) + before, p)
            moved = np.zeros(len(n))
            np.maximum.at(moved, np.repeat(np.arange(len(n)), n), np.abs(new - p))
            p, before, moving, turn = new, p, np.repeat(moved > tolerance, n), turn + 1
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(p))

    def scores(terms: pa.Array) -> pa.Array:
        # Words up to each document: parts end where another document would make them too large.
        lengths = np.asarray(pc.list_value_length(terms.flatten()))
        upto = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(terms)))))]
        parts, start = [], 0
        while start < len(terms):
            end = max(start + 1, int(np.searchsorted(upto, upto[start] + words_at_once, "right")) - 1)
            parts.append(part(terms.slice(start, end - start)))
            start = end
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

    return scores


def sentence_scores(
    documents: DataFrame, doc_id: str, text: str, tolerance: float = TOLERANCE, damping: float = DAMPING
) -> DataFrame:
    """(doc_id, scores): the score of every sentence, by position."""
    terms = document_terms(spread_by_document(documents.select(doc_id, text), doc_id), text, [doc_id])
    scores = F.arrow_udf(walk(tolerance, damping), "array<double>")
    return terms.select(doc_id, scores("terms").alias("scores"))


def by_size(documents: DataFrame, text: str, large_chars: int = LARGE_CHARS) -> tuple[DataFrame, DataFrame | None]:
    """(ordinary documents, large ones or None where there are none)."""
    large = documents.where(F.length(text) > large_chars)
    if large.isEmpty():
        return documents, None
    return documents.where(~F.coalesce(F.length(text) > large_chars, F.lit(False))), large


def _rank(score: Column) -> Column:
    """Scores are compared after rounding to 10 digits, so that equal sentences do not trade places when sums are added in another order."""
    return -F.round(score, 10)


def _top_of_large(documents: DataFrame, doc_id: str, text: str, n_sentences: int, tolerance: float, damping: float) -> DataFrame:
    rows = sentence_rows(documents, doc_id, sentences_of(F.col(text)))
    scores = walk_scores(rows, doc_id, tolerance, damping)
    order = Window.partitionBy(doc_id).orderBy(_rank(F.col("score")), "position")
    best = scores.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n_sentences).select(doc_id, "position")
    chosen = F.array_sort(F.collect_list(F.struct("position", "sentence")))
    return best.join(rows.select(doc_id, "position", "sentence"), [doc_id, "position"]).groupBy(doc_id).agg(chosen.alias("chosen"))


def top_sentences(
    documents: DataFrame, doc_id: str, text: str, n_sentences: int, tolerance: float = TOLERANCE, large: bool | None = None
) -> DataFrame:
    """(doc_id, chosen): the n most central sentences per document as (position, sentence), in text order.

    `large` says that all documents are large, or that none is; by default they are told apart by their length.
    """
    if large is None:
        documents, long_ones = by_size(documents, text)
        top = top_sentences(documents, doc_id, text, n_sentences, tolerance, large=False)
        return top if long_ones is None else top.unionByName(top_sentences(long_ones, doc_id, text, n_sentences, tolerance, large=True))
    if large:
        return _top_of_large(documents, doc_id, text, n_sentences, tolerance, DAMPING)
    # As in a join by document, one without an id has no summary.
    rows = spread_by_document(documents.where(F.col(doc_id).isNotNull()).select(doc_id, text), doc_id)
    return row_top_sentences(rows, text, [doc_id], n_sentences, tolerance)


def row_top_sentences(
    rows: DataFrame, text: str, keep: list[str], n_sentences: int, tolerance: float = TOLERANCE, all_rows: bool = False
) -> DataFrame:
    """The kept columns of every row whose text has sentences (or of all rows), and `chosen`, as `top_sentences` gives it; no exchange."""
    scored = document_terms(rows, text, keep, all_rows)
    scores = F.arrow_udf(walk(tolerance, DAMPING), "array<double>")
    scored = scored.select(*keep, "sentences", scores("terms").alias("scores"))
    ranked = F.array_sort(F.transform("scores", lambda s, i: F.struct(_rank(s).alias("rank"), i.alias("position"))))
    best = F.array_sort(F.transform(F.slice(ranked, 1, n_sentences), lambda r: r["position"]))
    chosen = F.transform("best", lambda i: F.struct(i.alias("position"), F.get("sentences", i).alias("sentence")))
    return scored.select(*keep, "sentences", best.alias("best")).select(*keep, chosen.alias("chosen"))


def summaries(
    documents: DataFrame, doc_id: str, text: str, n_sentences: int, tolerance: float = TOLERANCE, large: bool | None = None
) -> DataFrame:
    """(doc_id, summary): the n most central sentences in text order, joined by a space."""
    top = top_sentences(documents, doc_id, text, n_sentences, tolerance, large)
    return top.select(doc_id, _joined().alias("summary"))


def row_summaries(rows: DataFrame, text: str, keep: list[str], n_sentences: int, tolerance: float = TOLERANCE) -> DataFrame:
    """The kept columns of every row and the `summary` of its text, NULL where it has no sentences."""
    top = row_top_sentences(rows, text, keep, n_sentences, tolerance, all_rows=True)
    return top.select(*keep, F.when(F.size("chosen") > 0, _joined()).alias("summary"))


def _joined() -> Column:
    return F.array_join(F.transform("chosen", lambda c: c["sentence"]), " ")


def keyword_sentences(summary: Column, keywords: tuple[str, ...] = LEGAL_KEYWORDS) -> Column:
    """The parts of a summary that mention a keyword, one per line; the whole summary if none does."""
    mentions = "|".join(keywords)
    kept = F.filter(F.split(summary, r"\. "), lambda s: F.lower(s).rlike(mentions))
    return F.when(F.size(kept) > 0, F.array_join(kept, "\n")).otherwise(summary)
