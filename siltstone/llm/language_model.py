"""Cross-entropy difference of two n-gram models over one vocabulary.

Target and background model are interpolated bigram models with the same vocabulary, smoothing and order; the target is counted
on a marked part of the corpus, the background on all of it. A document's score is the mean over its tokens of the
target's loss minus the background's, in nats: the lower, the nearer to the target.

The vocabulary is words hashed into 2**18 classes: shared by both models, closed (no unknown word), and of a
size that does not grow, so unigram counts are one array that every task can hold. Bigrams are not bounded: they are
counted exactly, over all documents, in a packed exchange by bigram. The task that sums a bigram's counts also has
both losses, and sends each document the loss differences of its bigrams, which are added up per document. Tables of
bigrams are neither joined to texts nor broadcast. Texts are read once; what is written and marked are their classes.

Losses: p(w) = (c(w) + 1) / (tokens + classes); p(w | v) = (c(v w) + MU p(w)) / (c(v) + MU); the first word of a
document follows the document mark, class 0, which counts once per document as a context.

Edge cases: a null or empty text has 0 tokens and a null score; without target rows the target model is uniform; repeated rows count
and are scored each; a null doc_id is kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PACKED, PACKED_ARROW, WordHashes, buckets_for, by_bucket, from_planes, mixed, pack, planes, remove_folder, shared_folder, unpacked, utf8, written

BITS = 18
MU = 100.0
_CHUNK = 400_000
# An entry is a bigram (two classes) with its count in the document in the upper 28 bits.
_ID_BITS = np.uint64(2 * BITS)
_PAIR = np.uint64((1 << 2 * BITS) - 1)


def classes(text: bytes | None, hashes: WordHashes, bits: int = BITS) -> np.ndarray:
    """Classes of the words (between ASCII white space, A-Z lower-cased): 1 to 2**bits - 1."""
    words = (text or b"").lower().split()
    size = np.uint64((1 << bits) - 1)
    return (hashes.of(words) % size).astype(np.int64) + 1 if words else np.empty(0, np.int64)


def _classed(bits: int):
    """row, doc_id and the classes (three byte planes) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [classes(t, hashes, bits).astype("<u4") for t in utf8(batch, "text")]
            blobs = [planes(f)[: 3 * len(f)] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(f) for f in found], pa.int64()), pa.array(blobs, pa.binary())], names=["row", "doc_id", "n_tokens", "words"])

    return run


def _words(blob: bytes) -> np.ndarray:
    return from_planes(blob + bytes(len(blob) // 3), np.uint32).astype(np.int64)


def _unigrams(bits: int, pieces: int):
    """Counts of the task's rows as arrays, cut into pieces: target then background."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for blob, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not blob:
                    continue
                found = np.append(_words(blob), 0)
                np.add.at(counts[1], found, 1)
                if target:
                    np.add.at(counts[0], found, 1)
        if counts.any():
            cut = np.split(counts, pieces, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array([c.astype("<i8").tobytes() for c in cut], pa.binary())], names=["piece", "counts"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(counts, "<i8")
            total[piece] = total[piece] + own if piece in total else own
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.astype("<i8").tobytes() for t in total.values()], pa.binary())], names=["piece", "counts"])


def unigram_counts(rows: DataFrame, bits: int = BITS, pieces: int = 64) -> np.ndarray:
    """(2, 2**bits) counts: of the target, and of all rows. Class 0 counts documents with words."""
    schema = "piece int, counts binary"
    partial = rows.select("words", "target").mapInArrow(_unigrams(bits, pieces), schema)
    added = partial.repartition(pieces, "piece").mapInArrow(_added, schema)
    out = np.zeros((2, 1 << bits), np.int64)
    width = (1 << bits) // pieces
    for row in added.collect():  # 2**(bits + 4) bytes in all, whatever the corpus
        out[:, row.piece * width : (row.piece + 1) * width] = np.frombuffer(row.counts, "<i8").reshape(2, width)
    return out


def loss_difference(first: np.ndarray, second: np.ndarray, n_target: np.ndarray, n_all: np.ndarray, unigrams: np.ndarray, mu: float = MU) -> np.ndarray:
    """Target loss minus background loss of bigrams with their counts."""
    size = unigrams.shape[1]
    loss = []
    for counts, n in ((unigrams[0], n_target), (unigrams[1], n_all)):
        words = counts[1:].sum()
        p = (counts[second] + 1) / (words + size - 1)
        loss.append(-np.log((n + mu * p) / (counts[first] + mu)))
    return loss[0] - loss[1]


_ROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64())])
_SENT = pa.schema([*PACKED_ARROW, *_ROW])
_SENT_SQL = f"{PACKED}, row long, doc_id long, n_tokens long"


def _bigrams(buckets: int, bits: int):
    """Document rows, and their packed bigrams with counts; info says whether a document is in the target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys, target, parts = [], [], [], []

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(p) for p in parts], np.int64)
            entries = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            where = mixed(entries & _PAIR) % np.uint64(buckets)
            packed = pack(buckets, where.astype(np.int64), np.repeat(np.arange(len(sizes)), sizes), np.array(keys, np.int64).view(np.uint64), np.array(target, np.int64), entries)
            batch = pa.RecordBatch.from_pylist([*rows, *packed], schema=_SENT)
            for x in (rows, keys, target, parts):
                x.clear()
            return batch

        held = 0
        for batch in batches:
            for row, doc_id, blob, is_target in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                own = _words(blob)
                rows.append({"bucket": row % buckets, "row": row, "doc_id": doc_id, "n_tokens": len(own)})
                if not len(own):
                    continue
                pair = (np.r_[0, own[:-1]].astype(np.uint64) << np.uint64(bits)) | own.astype(np.uint64)
                unique, n = np.unique(pair, return_counts=True)
                keys.append(row), target.append(int(bool(is_target))), parts.append(unique | (n.astype(np.uint64) << _ID_BITS))
                held += len(unique)
                if held >= _CHUNK:
                    yield flush()
                    held = 0
        yield flush()

    return run


def _losses(buckets: int, bits: int, sent):
    """Of one bucket of bigrams: their counts, their loss differences, and each document's sum of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigrams, mask = sent.value, np.uint64((1 << bits) - 1)
        for held, others in by_bucket(batches):
            if others.num_rows:
                yield others
            if not held:
                continue
            for keys, target, entries, _ in unpacked(held).values():
                held.clear()
                own, place = np.unique(keys, return_inverse=True)
                del keys
                sums, slot = np.zeros(len(own)), mixed(entries & _PAIR) >> np.uint64(61)
                for part in range(8):  # a bigram has all its entries in one part; the parts bound what is held at once
                    chosen = np.flatnonzero(slot == part)
                    counts = (entries[chosen] >> _ID_BITS).astype(np.int64)
                    unique, number = np.unique(entries[chosen] & _PAIR, return_inverse=True)
                    n_all = np.bincount(number, weights=counts, minlength=len(unique))
                    n_target = np.bincount(number, weights=counts * target[chosen], minlength=len(unique))
                    first, second = (unique >> np.uint64(bits)).astype(np.int64), (unique & mask).astype(np.int64)
                    loss = loss_difference(first, second, n_target, n_all, unigrams)[number] * counts
                    sums += np.bincount(place[chosen], weights=loss, minlength=len(own))
                where = (own % np.uint64(buckets)).astype(np.int64)
                rows = pack(buckets, where, np.arange(len(own)), own, np.zeros(len(own)), sums.view(np.uint64))
                yield pa.RecordBatch.from_pylist(list(rows), schema=_SENT)

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "doc_id", "n_tokens", "total"]
    for held, others in by_bucket(batches):
        if others.num_rows:
            yield pa.RecordBatch.from_arrays([*(others.column(others.schema.get_field_index(n)) for n in names[:3]), pa.nulls(others.num_rows, pa.float64())], names=names)
        if not held:
            continue
        for keys, _, sums, _ in unpacked(held).values():
            order = np.lexsort((sums, keys))  # one order of adding, whatever the order of arrival
            own, place = np.unique(keys[order], return_inverse=True)
            total = np.bincount(place, weights=sums[order].view(np.float64))
            none = pa.nulls(len(own), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), none, none, pa.array(total)], names=names)


def cross_entropy_difference(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens and score of every document; `target` names the documents of the target model by id."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    wanted = target.select(F.col(target_col).cast("long").alias("wanted")).dropna().distinct()
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    classed = picked.mapInArrow(_classed(BITS), "row long, doc_id long, n_tokens long, words binary")
    # The row number only has to differ between rows; it is fixed by writing.
    rows = classed.join(wanted.hint("shuffle_hash"), F.col("doc_id") == F.col("wanted"), "left")
    rows = written(rows.select("row", "doc_id", "words", F.col("wanted").isNotNull().alias("target")), folder, "classes")
    sent = spark.sparkContext.broadcast(unigram_counts(rows))
    buckets = buckets_for(docs, text_col)
    bigrams = rows.select("row", "doc_id", "words", "target").mapInArrow(_bigrams(buckets, BITS), _SENT_SQL)
    losses = bigrams.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_losses(buckets, BITS, sent), _SENT_SQL)
    sums = losses.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_totals, "row long, doc_id long, n_tokens long, total double")
    sums = written(sums.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("total").alias("total")))
    remove_folder(spark, folder)
    return sums.select("doc_id", "n_tokens", F.when(F.col("n_tokens") > 0, F.col("total") / F.col("n_tokens")).alias("score"))
