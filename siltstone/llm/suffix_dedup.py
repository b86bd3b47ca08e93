"""Bytes of strings of 200 that stand more than once in the corpus, by prefix-free parsing.

A rolling hash over 64-byte grams triggers phrases: the trigger of the 200-byte string that starts at a byte is its
gram of least hash, so equal strings have their trigger at the same place, and neighbouring starts share one. The starts with
one trigger are a phrase. Three facts decide them, each found by sorting fingerprints in buckets of a packed exchange:

* trigger: if it stands once in the corpus, no start of its phrase is repeated;
* parse: if the phrase with the 200 bytes that follow its last start stands twice, all its starts are repeated;
* dictionary: where one trigger has several parses, the suffixes of each distinct parse, with their 200 bytes, are
  sorted one by one (for a repeated parse in one of its texts only).

Suffixes are ordered by the fingerprint of their first 200 bytes, not by the bytes: which suffixes have those in common is
all that deduplication asks of the corpus order, and it needs no neighbours from other buckets. Unique text ends at the
first fact, text inside long repeats at the second; only the rims of repeats reach the third.

Copies of a text are worked out once. Texts are kept in a table bucketed by text key, so that facts join them without
moving them. Fingerprints have 64 bits.

Edge cases: a null or empty text has 0 bytes, nothing removed; texts below 200 bytes keep all; repeated rows are copies
of each other; a null doc_id is kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, PACKED, buckets_for, by_bucket, mixed, pack, packed_batch, partitions, remove_folder, shared_folder, unpacked, written

SPAN = 200
GRAM = 64
SEGMENT = 1 << 20  # starts worked on at once: bounds the memory of a task, whatever the text's length
_REACH = SPAN - GRAM + 1
# The low bits of a parse carry what was found: repeated as a whole, or its suffixes are to be sorted.
_WHOLE, _SORT, _KIND = np.uint64(1), np.uint64(2), np.uint64(3)
_PLACE = np.uint64((1 << 30) - 1)


class Roller:
    """Polynomial hashes of ranges of a byte string, modulo 2**64."""

    def __init__(self):
        size = SEGMENT + 2 * SPAN
        base = 0x5851F42D4C957F2D
        self.table = np.random.default_rng(20250101).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = np.cumprod(np.r_[np.ones(1, np.uint64), np.full(size, base, np.uint64)])
        self.down = np.cumprod(np.r_[np.ones(1, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)])

    def load(self, data: np.ndarray) -> None:
        self.sums = np.r_[np.zeros(1, np.uint64), np.cumsum(self.table[data] * self.up[: len(data)])]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]

    def grams(self, width: int) -> np.ndarray:
        count = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:count]) * self.down[:count])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every `width` consecutive ones, from least values towards both ends of blocks."""
    count = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


class Parse:
    """Phrases of one segment of a text: first and last start, fingerprints of trigger and of parse."""

    def __init__(self, roller: Roller, data: np.ndarray, at: int):
        self.at, self.roller = at, roller
        starts = min(SEGMENT, len(data) - SPAN + 1 - at)
        roller.load(data[at : at + starts - 1 + SPAN])
        grams = roller.grams(GRAM)
        order = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        trigger = (sliding_least(order, _REACH) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.r_[True, np.diff(trigger) != 0])
        self.first, self.last = first, np.r_[first[1:], starts] - 1
        self.trigger = grams[trigger[first]]
        length = (self.last - first).astype(np.uint64)
        self.parse = mixed(roller.of(first, self.last + SPAN) + (length + np.uint64(1)) * MIX[2]) & ~_KIND

    def starts(self, chosen: np.ndarray) -> np.ndarray:
        """All starts of the chosen phrases."""
        sizes = (self.last - self.first + 1)[chosen]
        before = np.cumsum(sizes) - sizes
        return np.repeat(self.first[chosen] - before, sizes) + np.arange(sizes.sum())

    def suffixes(self, starts: np.ndarray) -> np.ndarray:
        return mixed(self.roller.of(starts, starts + SPAN) + MIX[3])


def parses(data: bytes, roller: Roller) -> Iterator[Parse]:
    view = np.frombuffer(data, np.uint8)
    for at in range(0, len(view) - SPAN + 1, SEGMENT):
        yield Parse(roller, view, at)


def _sent(buckets: int, held: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys = np.array([k for k, _, _ in held], np.int64).view(np.uint64)
    entries, extra = (np.concatenate([h[k] for h in held]) for k in (1, 2))
    number = np.repeat(np.arange(len(held)), [len(e) for _, e, _ in held])
    where = (entries % np.uint64(buckets)).astype(np.int64)
    return packed_batch(list(pack(buckets, where, number, keys, np.zeros(len(held)), entries, extra)))


def _send(buckets: int, fingerprints, names: tuple[str, ...], most: int = 400_000):
    """Packs the fingerprints of every text; `fingerprints` takes a text and the facts found so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, held, size = Roller(), [], 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            for row in zip(*columns, strict=True):
                key, *rest = (x.as_py() for x in row)
                for found, extra in fingerprints(roller, *rest):
                    if len(found):
                        held.append((key, found, extra))
                        size += len(found)
                    if size >= most:
                        yield _sent(buckets, held)
                        held, size = [], 0
        if held:
            yield _sent(buckets, held)

    return run


def _phrases(roller: Roller, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for p in parses(text, roller):
        yield p.trigger, p.parse


def _of_kind(p: Parse, facts: np.ndarray, kind: np.uint64) -> np.ndarray:
    return np.isin(p.parse, facts[(facts & kind) != 0] & ~_KIND)


def _suffixes(roller: Roller, text: bytes, facts: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    known = np.frombuffer(facts, np.uint64)
    for p in parses(text, roller):
        # Once per text is enough for a parse that is repeated anyway.
        chosen = _of_kind(p, known, _SORT)
        whole = np.flatnonzero(chosen & _of_kind(p, known, _WHOLE))
        chosen[np.setdiff1d(whole, whole[np.unique(p.parse[whole], return_index=True)[1]])] = False
        found = p.suffixes(p.starts(chosen))
        yield found, np.empty(len(found), np.uint64)


def _several(buckets: int):
    """Of one bucket of triggers: the parses of those that stand twice, with what they are, back to their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, _ in by_bucket(batches):
            for keys, _, triggers, parse in unpacked(held, np.uint64).values():
                order = np.lexsort((keys, parse, triggers))
                keys, triggers, parse = keys[order], triggers[order], parse[order]
                new_trigger = np.r_[True, np.diff(triggers) != 0]
                new_parse = new_trigger | np.r_[True, np.diff(parse) != 0]
                group = np.cumsum(new_trigger) - 1
                kind_of = np.cumsum(new_parse) - 1
                twice = np.bincount(kind_of)[kind_of] > 1
                mixed_up = np.bincount(group[new_parse], minlength=group[-1] + 1)[group] > 1
                kind = np.where(twice, _WHOLE, np.uint64(0)) | np.where(mixed_up & (new_parse | ~twice), _SORT, np.uint64(0))
                kept = kind != 0
                if kept.any():
                    yield _back(buckets, keys[kept], (parse & ~_KIND | kind)[kept])

    return run


def _back(buckets: int, keys: np.ndarray, entries: np.ndarray) -> pa.RecordBatch:
    own, number = np.unique(keys, return_inverse=True)
    where = (own % np.uint64(buckets)).astype(np.int64)[number]
    return packed_batch(list(pack(buckets, where, number, own, np.zeros(len(own)), entries)))


def _repeated(buckets: int):
    """Of one bucket of suffixes: those that stand twice, back to their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, _ in by_bucket(batches):
            for keys, _, entries, _ in unpacked(held, np.uint64).values():
                order = np.argsort(entries, kind="stable")
                keys, entries = keys[order], entries[order]
                new = np.r_[True, np.diff(entries) != 0]
                twice = ~(new & np.r_[new[1:], True])
                if twice.any():
                    yield _back(buckets, keys[twice], entries[twice])

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text with all its facts, sorted."""
    for held, _ in by_bucket(batches):
        for keys, _, entries, _ in unpacked(held, np.uint64).values():
            order = np.lexsort((entries, keys))
            keys, entries = keys[order], entries[order]
            fresh = np.r_[True, (np.diff(keys) != 0) | (np.diff(entries) != 0)]
            keys, entries = keys[fresh], entries[fresh]
            starts = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
            stops = np.r_[starts[1:], len(keys)]
            for at in range(0, len(starts), 2000):
                cut = slice(at, at + 2000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[starts[cut]].view(np.int64)), pa.array([entries[lo:hi].tobytes() for lo, hi in zip(starts[cut], stops[cut], strict=True)], pa.binary())],
                    names=["key", "facts"],
                )


def _facts(sent: DataFrame, buckets: int, found) -> DataFrame:
    """key and the text's sorted facts, as `found` makes them from the buckets."""
    back = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(found(buckets), PACKED)
    return back.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_gathered, "key long, facts binary")


def covered(starts: np.ndarray, size: int) -> np.ndarray:
    """(first, stop) of the runs of bytes covered by strings of SPAN bytes at sorted starts."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    breaks = np.flatnonzero(np.diff(starts) > SPAN)
    return np.c_[starts[np.r_[0, breaks + 1]], starts[np.r_[breaks, len(starts) - 1]] + SPAN]


def _cut(as_text: bool = False):
    """What is left of every text; as text, the odd bytes of cut characters go too."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            out = []
            for key, text, copies, facts, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                facts, more = (np.frombuffer(x or b"", np.uint64) for x in (facts, more))
                starts = []
                if copies > 1:
                    starts = [np.arange(max(0, len(text) - SPAN + 1))]
                elif len(facts):
                    for p in parses(text, roller):
                        whole = _of_kind(p, facts, _WHOLE)
                        each = p.starts(_of_kind(p, facts, _SORT) & ~whole)
                        starts.append(p.at + np.sort(np.r_[p.starts(whole), each[np.isin(p.suffixes(each), more)]]).astype(np.int64))
                runs = covered(np.concatenate(starts) if starts else np.empty(0, np.int64), len(text))
                kept, at = [], 0
                for lo, hi in runs.tolist():
                    kept.append(text[at:lo])
                    at = hi
                kept.append(text[at:])
                left = b"".join(kept)
                out.append({"key": key, "n_bytes": len(text), "n_removed": len(text) - len(left), "n_spans": len(runs), "kept_sha256": hashlib.sha256(left).hexdigest(), "spans": runs.ravel().tolist(), "kept": left.decode("utf-8", "ignore").encode() if as_text else left})
            yield pa.RecordBatch.from_pylist(out, schema=_CUT_ARROW)

    return run


_CUT = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary"
_CUT_ARROW = pa.schema(
    [("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64())), ("kept", pa.binary())]
)


def _texts(rows: DataFrame, folder: str) -> str:
    """Name of a table of the distinct texts, bucketed by key: joins on the key leave them in place."""
    name = f"siltstone_texts_{uuid.uuid4().hex}"
    distinct = rows.groupBy("key").agg(F.first("text").cast("binary").alias("text"), F.count("*").alias("copies"))
    writer = distinct.write.bucketBy(partitions(rows.sparkSession), "key").option("path", f"{folder}/texts").option("compression", "zstd")
    writer.format("parquet").saveAsTable(name)
    return name


def _known(rows: DataFrame, texts: DataFrame, folder: str) -> DataFrame:
    """key, text, copies and both kinds of facts of every distinct text."""
    buckets = buckets_for(rows)
    phrases = texts.select("key", "text").mapInArrow(_send(buckets, _phrases, ("key", "text")), PACKED)
    facts = written(_facts(phrases, buckets, _several), folder, "phrases")
    rims = texts.select("key", "text").join(facts.hint("shuffle_hash"), "key").select("key", "text", "facts")
    rims = rims.mapInArrow(_send(buckets, _suffixes, ("key", "text", "facts")), PACKED)
    more = written(_facts(rims, buckets, _repeated), folder, "suffixes").withColumnRenamed("facts", "more")
    both = facts.join(more, "key", "left")
    return texts.join(both.hint("shuffle_hash"), "key", "left").select("key", "text", "copies", "facts", "more")


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({"siltstone_text": text, "siltstone_key": F.xxhash64(text)})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (first and stop in turn) and the kept bytes of every document."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = _keyed(docs, text_col).select(F.col(id_col).alias("doc_id"), F.col("siltstone_text").alias("text"), F.col("siltstone_key").alias("key"))
    name = _texts(rows, folder)
    cut = _known(rows, spark.table(name), folder).mapInArrow(_cut(), _CUT)
    cut = written(cut if keep_text else cut.drop("spans", "kept"))
    spark.sql(f"DROP TABLE {name}")
    remove_folder(spark, folder)
    return rows.select("doc_id", "key").join(cut, "key").drop("key")


def cleaned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with all their columns, the text without its repeats. Odd bytes of cut characters go too.

    The folder with the texts goes when the application ends: the result reads it.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = _keyed(docs, text_col)
    parts = rows.select(F.col("siltstone_text").alias("text"), F.col("siltstone_key").alias("key"))
    texts = spark.table(_texts(parts, folder))
    cut = _known(parts, texts, folder).mapInArrow(_cut(as_text=True), _CUT)
    kept = cut.select(F.col("key").alias("siltstone_key"), F.col("kept").cast("string").alias(text_col))
    others = rows.drop("siltstone_text", text_col)
    return others.join(kept, "siltstone_key").select(*docs.columns)
