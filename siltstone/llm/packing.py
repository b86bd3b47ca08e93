"""Concatenate and cut: documents as one token stream, cut into fixed windows.

Pass 1 tokenises every document inside its scan partition and writes the ids with their place in the
partition. The prefix sum of the partitions' totals gives each partition its global offset; pass 2 cuts
each document at the multiples of the window. Tokens are never shuffled; the only sums that meet in one
place are one row per partition.

Edge cases: a null or empty text is the separator alone; repeated rows are packed once each; a null
doc_id stays null; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import per_batch, shared_folder, utf8, written

WINDOW = 1024
SEPARATOR = 0
# The pre-tokenisation pattern that belongs to byte-level BPE vocabularies of this kind: fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE file as bytes to id. Ids follow the order of the merges, so they are ranks."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]["vocab"]
    return {bytes(byte_of[c] for c in token): number for token, number in model.items() if all(c in byte_of for c in token)}


def added_ids(path: str) -> dict[str, int]:
    """The file's added tokens: strings that are one token wherever they stand in a text."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


class TokenIds:
    """Token ids (uint16 bytes) of whole texts.

    The vocabulary is the tokenizers file's; the merges run in tiktoken, which gives the same ids (see the tests) at
    a quarter of the time. With `added_tokens`, strings of the file's added tokens get those tokens' ids, as that library
    does by default; otherwise they are ordinary text, as with its `encode_special_tokens`.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        import tiktoken

        added = added_ids(path)
        ranks = {k: v for k, v in byte_ranks(path).items() if k.decode("utf-8", "replace") not in added}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added if added_tokens else {})

    def ids(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u2").tobytes()


def tokenised(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass 1: doc_id, partition, its tokens before the document, token count and ids (uint16, little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before, part = TokenIds(tokenizer, added_tokens=True), 0, TaskContext.get().partitionId()
        end = np.array([SEPARATOR], dtype="<u2").tobytes()
        for batch in batches:
            ids = [encoder.ids((t or b"").decode("utf-8", "replace")) + end for t in utf8(batch, "text")]
            counts = np.array([len(x) // 2 for x in ids], dtype=np.int64)
            if not len(counts):
                continue
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(ids), part, dtype=np.int64)),
                    pa.array(starts),
                    pa.array(counts),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "part", "before", "doc_tokens", "ids"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, part long, before long, doc_tokens long, ids binary")


def _cut(window: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: dict[str, list] = {n: [] for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
        for doc_id, at, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            total, start = len(ids) // 2, 0
            wide = np.frombuffer(ids, "<u2").astype("<u4")
            while start < total:
                sequence, offset = divmod(at + start, window)
                length = min(window - offset, total - start)
                piece = wide[start : start + length]
                for name, value in zip(rows, (doc_id, start, length, zlib.crc32(piece.tobytes()), total, sequence, offset, ids[2 * start : 2 * (start + length)]), strict=True):
                    rows[name].append(value)
                start += length
        return pa.RecordBatch.from_arrays(
            [pa.array(v, pa.binary() if n == "ids" else pa.int64()) for n, v in rows.items()], names=list(rows)
        )

    return per_batch(run)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and the ids (uint16)."""
    folder = shared_folder(docs.sparkSession)
    tokens = written(tokenised(docs, tokenizer, id_col, text_col), folder, "tokens")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row per scan partition: neither the window over all of them nor the broadcast holds documents.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead"))
    placed = tokens.join(F.broadcast(offsets), "part").select("doc_id", (F.col("ahead") + F.col("before")).alias("at"), "ids")
    return placed.mapInArrow(
        _cut(window),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )


def sequences(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per sequence: its pieces in order, its length, and the padding up to the window.

    A sequence whose length is a power of two is not padded.
    """
    length = F.sum("length").alias("length")
    order = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length"))).alias("pieces")
    power = F.expr("length > 0 AND (length & (length - 1)) = 0")
    return pieces.groupBy("sequence_id").agg(order, length).withColumn("padding", F.when(power, 0).otherwise(window - F.col("length")))
