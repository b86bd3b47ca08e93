"""Helpers the operators share: shared folder, text identity, Arrow batches, the packed exchange."""

from __future__ import annotations

import contextlib
import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Odd multipliers for mixing 64-bit hashes.
MIX = tuple(
    np.uint64(x)
    for x in (
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0xD6E8FEB86659FD93,
        0xFF51AFD7ED558CCD,
        0xC4CEB9FE1A85EC53,
    )
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`, removed when the application ends.

    Only where the setting is missing (a local session in a test) a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        base = tempfile.gettempdir()
    folder = f"{base.rstrip('/')}/siltstone-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, folder: str | None = None, name: str = "part") -> DataFrame:
    """Writes the frame as Parquet into the shared folder and reads it back: cuts the lineage."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(docs: DataFrame, text: str = "text", chars: int = 12_000_000) -> int:
    """Number of exchange buckets: one for every `chars` characters, and at least the session's partitions."""
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(partitions(docs.sparkSession), -(-int(total) // chars))


def release() -> None:
    """Gives freed memory back to the system: workers are reused, and the next stage may need it elsewhere."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * MIX[4]
    h = (h ^ (h >> np.uint64(29))) * MIX[5]
    return h ^ (h >> np.uint64(32))


class WordHashes(dict):
    """64-bit hash per word, kept between calls up to `most` words; a full table is emptied."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


# --- packed exchange -------------------------------------------------------------------------------
# One row holds what one batch of documents sends to one bucket: document keys (uint64), per document a
# uint32 of its own and the number of its entries, and the entries (uint64, with an extra number each) in document order.
# Numbers are stored as byte planes, first bytes first: planes that hardly vary then compress in the shuffle. Spark
# shuffles the rows by bucket; a task sorts its bucket in numpy. A bucket's share of the hash space is
# fixed by the caller's count of buckets, which grows with the text.

PACKED = "bucket int, docs binary, info binary, counts binary, entries binary, extra binary"
PACKED_ARROW = pa.schema(
    [("bucket", pa.int32())] + [(n, pa.binary()) for n in ("docs", "info", "counts", "entries", "extra")]
)


def planes(x: np.ndarray) -> bytes:
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack(
    buckets: int,
    where: np.ndarray,
    doc_no: np.ndarray,
    keys: np.ndarray,
    info: np.ndarray,
    entries: np.ndarray,
    extra: np.ndarray | None = None,
) -> Iterator[dict]:
    """Rows of the packed exchange for entries of one batch; `doc_no` points into `keys` and `info`."""
    if not len(entries):
        return
    order = np.argsort(where * np.int64(len(keys)) + doc_no, kind="stable")
    where, doc_no, entries = where[order], doc_no[order], entries[order]
    extra = extra[order] if extra is not None else None
    cuts = np.flatnonzero(np.diff(where)) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(where)], strict=True):
        part = doc_no[lo:hi]
        starts = np.r_[0, np.flatnonzero(np.diff(part)) + 1]
        docs = part[starts]
        yield {
            "bucket": int(where[lo]),
            "docs": planes(keys[docs].astype(np.uint64)),
            "info": planes(info[docs].astype(np.uint32)),
            "counts": planes(np.diff(np.r_[starts, hi - lo]).astype(np.uint32)),
            "entries": planes(np.ascontiguousarray(entries[lo:hi], np.uint64)),
            "extra": planes(np.ascontiguousarray(extra[lo:hi])) if extra is not None else b"",
        }


def packed_batch(rows: list[dict], schema: pa.Schema = PACKED_ARROW) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def unpacked(batches: list[pa.RecordBatch], extra_type: type = np.uint32) -> dict[int, tuple[np.ndarray, ...]]:
    """Per bucket: document key, info, entry and extra of every entry."""
    parts: dict[int, list] = {}
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in PACKED_ARROW.names]
        for bucket, docs, info, counts, entries, extra in zip(*columns, strict=True):
            if bucket is None or entries is None:
                continue
            n = from_planes(counts, np.uint32)
            parts.setdefault(bucket, []).append(
                (
                    np.repeat(from_planes(docs, np.uint64), n),
                    np.repeat(from_planes(info, np.uint32), n),
                    from_planes(entries, np.uint64),
                    from_planes(extra, extra_type),
                )
            )
    return {b: tuple(np.concatenate(x) for x in zip(*p, strict=True)) for b, p in parts.items()}


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], pa.RecordBatch]]:
    """(rows of one bucket, rows that are not packed) from rows sorted by bucket: one bucket is held at a time."""
    release()
    held: list[pa.RecordBatch] = []
    now = None
    empty = None
    for batch in batches:
        kind = batch.column(batch.schema.get_field_index("entries")).is_null()
        others = batch.filter(kind)
        packed = batch.filter(pc.invert(kind))
        empty = others.slice(0, 0)
        if others.num_rows:
            yield [], others
        which = packed.column(0).to_numpy(zero_copy_only=False)
        cuts = np.r_[0, np.flatnonzero(np.diff(which)) + 1, len(which)] if len(which) else []
        for lo, hi in itertools.pairwise(cuts):
            if now is not None and which[lo] != now and held:
                yield held, empty
                held = []
            now = which[lo]
            held.append(packed.slice(lo, hi - lo))
    if held:
        yield held, empty
