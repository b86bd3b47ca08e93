"""N-gram Jaccard self-join of documents: size-aware, heavy-light.

A document's set are its distinct 4-word shingles. Two documents link when 100 * |A & B| >= 85 * |A | B|. Links are
found between distinct sets; documents of one set are one class.

1. Shingle hashes go through one packed exchange by hash; a shingle that stands in one set only is dropped there, the others
   return to their sets with the number of sets they stand in.
2. Each set orders its shingles from rare to frequent and posts the ones in its prefix: linked sets share a posting.
3. The boundary between small and large sets is the one of least cost, from the counts of subsets and of postings.
   Small sets enumerate their subsets of the size that a link needs: sharing one is a link, no check is needed, and every
   set of a group links to the group's smallest one.
4. Large sets scan the inverted lists. First rounds compare each set with one centre per list and merge what
   links, so a list of near copies costs its length, not its square. Then every pair of a list whose sets are not yet
   connected is compared, after bounds on size, place and difference. No candidate is dropped otherwise.

Sets and shingles are known by 64-bit hashes; overlaps are counted on those.

Edge cases: a null or empty text, or one of white space, has an empty set and is its own component; fewer than 4 words are
one shingle; repeated rows are one class; a null doc_id can be a member, but never names a component unless all
its ids are null; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, PACKED, PACKED_ARROW, WordHashes, buckets_for, by_bucket, mixed, pack, release, remove_folder, shared_folder, unpacked, utf8, written
from .components import components

SHINGLE = 4
PERCENT = 85
SMALL_MOST = 40  # sizes for which subsets are considered; the boundary lies at or below
ROUNDS = 3
_CHUNK = 400_000


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """Least overlap that links sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def shingles(text: bytes, hashes: WordHashes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a UTF-8 text; A-Z lower-cased."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    if len(h) < width:
        total = np.full(1, len(h), np.uint64) * MIX[5] + sum((h[k : k + 1] * MIX[k] for k in range(len(h))), np.zeros(1, np.uint64))
        return mixed(total)
    last = len(h) - width + 1
    total = h[:last] * MIX[0]
    for k in range(1, width):
        total += h[k : k + last] * MIX[k % 4] + np.uint64(k // 4)
    return np.unique(mixed(total))


_DOC = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64())])
_SENT = pa.schema([*PACKED_ARROW, *_DOC])
_SENT_SQL = f"{PACKED}, doc_id long, key long, n long"


def _send(buckets: int, width: int):
    """Document rows, and the packed shingles of every set the task has not sent yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        release()
        hashes, sent, turn = WordHashes(), set(), 0
        keys, sizes, parts, rows = [], [], [], []

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            n = np.array(sizes, np.int64)
            where = (tokens % np.uint64(buckets)).astype(np.int64)
            packed = pack(buckets, where, np.repeat(np.arange(len(n)), n), np.array(keys, np.uint64), n, tokens)
            batch = pa.RecordBatch.from_pylist([*rows, *packed], schema=_SENT)
            keys.clear(), sizes.clear(), parts.clear(), rows.clear()
            return batch

        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch, "text"), strict=True):
                own = shingles(text or b"", hashes, width)
                key = xxhash.xxh3_64_intdigest(own.tobytes()) if len(own) else None
                turn += 1
                signed = None if key is None else key - (1 << 64) if key >= 1 << 63 else key
                rows.append({"bucket": turn % buckets, "doc_id": doc_id, "key": signed, "n": len(own)})
                if key is None or key in sent:
                    continue
                if len(sent) < 300_000:
                    sent.add(key)
                keys.append(key), sizes.append(len(own)), parts.append(own)
                held += len(own)
                if held >= _CHUNK:
                    yield flush()
                    held = 0
        yield flush()

    return run


def _shared(buckets: int):
    """Of one bucket of shingles: those in two sets or more, back to their sets with the number of sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, docs in by_bucket(batches):
            if docs.num_rows:
                yield docs
            if not held:
                continue
            for entries in unpacked(held).values():
                held.clear()
                slot, parts = entries[2] >> np.uint64(61), []
                for part in range(8):  # a shingle has all its entries in one part; the parts bound what is held at once
                    keys, n, tokens = (x[slot == part] for x in entries[:3])
                    order = np.lexsort((keys, tokens))
                    keys, n, tokens = keys[order], n[order], tokens[order]
                    fresh = np.r_[True, (np.diff(tokens) != 0) | (np.diff(keys) != 0)][: len(tokens)]
                    keys, n, tokens = keys[fresh], n[fresh], tokens[fresh]
                    starts = np.flatnonzero(np.r_[True, np.diff(tokens) != 0][: len(tokens)])
                    df = np.diff(np.r_[starts, len(tokens)])
                    df = np.repeat(df, df)
                    parts.append([x[df > 1] for x in (keys, n, tokens, df)])
                keys, n, tokens, df = (np.concatenate(x) for x in zip(*parts, strict=True))
                if not len(keys):
                    continue
                own, first, number = np.unique(keys, return_index=True, return_inverse=True)
                where = (own % np.uint64(buckets)).astype(np.int64)[number]
                rows = pack(buckets, where, number, own, n[first], tokens, np.minimum(df, 0xFFFFFFFF).astype(np.uint32))
                yield pa.RecordBatch.from_pylist(list(rows), schema=_SENT)

    return run


# Parity of a set's shared shingles in 256 hash classes, as four numbers: where two sets differ in parity, they differ.
_PARITY = ("p0", "p1", "p2", "p3")
_LONGS = ("doc_id", "key", "n", "token", "place", "own", *_PARITY)
_POSTED = ", ".join(f"{c} long" for c in _LONGS) + ", tokens binary"
_POSTED_ARROW = pa.schema([*((c, pa.int64()) for c in _LONGS), ("tokens", pa.binary())])


def _posted(size: int, **columns: pa.Array) -> pa.RecordBatch:
    none = pa.nulls(size, pa.int64())
    return pa.RecordBatch.from_arrays([*(columns.get(c, none) for c in _LONGS), columns.get("tokens", pa.nulls(size, pa.binary()))], schema=_POSTED_ARROW)


def parities(number: np.ndarray, sets: int, tokens: np.ndarray) -> np.ndarray:
    """(4, sets) parity words of the sets that entries belong to by number."""
    place = (mixed(tokens + MIX[0]) >> np.uint64(56)).astype(np.int64)
    odd = np.bincount(number * 256 + place, minlength=256 * sets).reshape(sets, 256).astype(np.uint8) & 1
    return np.packbits(odd, axis=1, bitorder="little").view(np.int64).T.copy()


def _post(percent: int):
    """Of one bucket of sets: the postings of each set's prefix, and the shared shingles of sets that have some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, docs in by_bucket(batches):
            if docs.num_rows:
                yield _posted(docs.num_rows, **{c: docs.column(docs.schema.get_field_index(c)) for c in _DOC.names})
            if not held:
                continue
            for keys, n, tokens, df in unpacked(held).values():
                order = np.lexsort((tokens, df, keys))
                keys, n, tokens = keys[order], n[order].astype(np.int64), tokens[order]
                starts = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
                sizes = np.diff(np.r_[starts, len(keys)])
                number = np.repeat(np.arange(len(starts)), sizes)
                own = n - sizes[number]  # shingles of this set alone come first
                place = own + np.arange(len(keys)) - starts[number]
                posted = place < n - (-(-percent * n // 100)) + 1
                some = np.flatnonzero(posted[starts])
                for at in range(0, len(some), 500):
                    cut = some[at : at + 500]
                    chosen = np.isin(number, cut)
                    which = np.searchsorted(cut, number[chosen])
                    parity = parities(which, len(cut), tokens[chosen])
                    heads, kept = starts[cut], posted[chosen]
                    which, rows = which[kept], np.flatnonzero(chosen)[kept]
                    marks = {c: pa.array(parity[k][which]) for k, c in enumerate(_PARITY)}
                    yield _posted(len(rows), key=pa.array(keys[rows].view(np.int64)), n=pa.array(n[rows]), token=pa.array(tokens[rows].view(np.int64)), place=pa.array(place[rows]), own=pa.array(own[rows]), **marks)
                    blobs = [np.sort(tokens[lo : lo + sizes[k]]).tobytes() for lo, k in zip(heads, cut, strict=True)]
                    yield _posted(len(cut), key=pa.array(keys[heads].view(np.int64)), n=pa.array(n[heads]), tokens=pa.array(blobs, pa.binary()))

    return run


def subset_sizes(n: int, percent: int = PERCENT) -> list[int]:
    """Overlaps that a link of a set of n shingles may need, over all sizes of the other set."""
    return sorted({needed(n, m, percent) for m in range(-(-percent * n // 100), 100 * n // percent + 1) if needed(n, m, percent) <= min(n, m)})


def boundary(sets: DataFrame, postings: DataFrame, percent: int = PERCENT) -> int:
    """Greatest size that counts as small: subsets of the small and postings scanned for the large cost least together."""
    small = sets.filter(F.col("n") <= SMALL_MOST).groupBy("n", (F.octet_length("tokens") / 8).cast("int").alias("s")).count().collect()
    lists = postings.groupBy("token").agg(F.count("*").alias("length"))
    large = postings.filter(F.col("n") <= SMALL_MOST).join(lists, "token").groupBy("n").agg(F.sum("length").alias("length")).collect()
    subsets, scans = [0.0] * (SMALL_MOST + 1), [0.0] * (SMALL_MOST + 1)
    for n, s, count in small:
        subsets[n] += count * sum(math.comb(s, c) for c in subset_sizes(n, percent) if c <= s)
    for n, length in large:
        scans[n] += length
    return min(range(SMALL_MOST + 1), key=lambda x: (sum(subsets[: x + 1]) + sum(scans[x + 1 :]), x))


def _subsets(percent: int):
    """Sums of two mixes over every subset of a needed size; a unique shingle is in no shared subset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n", "size", "a", "b"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for key, n, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                tokens = np.frombuffer(blob, np.uint64)
                marks = np.stack([mixed(tokens * MIX[1]), mixed(tokens * MIX[3] + np.uint64(1))])
                whole = marks.sum(axis=1)
                for c in subset_sizes(n, percent):
                    left_out = len(tokens) - c
                    if left_out < 0:
                        continue
                    combos = np.array(list(itertools.combinations(range(len(tokens)), left_out)), dtype=np.int64).reshape(math.comb(len(tokens), left_out), left_out)
                    sums = whole[:, None] - marks[:, combos].sum(axis=2)
                    for column, value in zip(out, (np.full(len(combos), key), np.full(len(combos), n), np.full(len(combos), c), sums[0].view(np.int64), sums[1].view(np.int64)), strict=True):
                        column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=names)

    return run


def small_links(sets: DataFrame, most: int, percent: int = PERCENT) -> DataFrame:
    """(a, b) links among sets of at most `most` shingles: each to the smallest set it shares a subset with."""
    small = sets.filter(F.col("n") <= most).select("key", "n", "tokens")
    found = small.mapInArrow(_subsets(percent), "key long, n long, size long, a long, b long")
    least = found.groupBy("size", "a", "b").agg(F.min(F.struct("n", "key")).alias("least"), F.count("*").alias("members")).filter("members > 1")
    linked = found.join(least, ["size", "a", "b"]).filter((F.col("key") != F.col("least.key")) & ((100 + percent) * F.col("size") >= percent * (F.col("n") + F.col("least.n"))))
    return linked.select(F.col("least.key").alias("a"), F.col("key").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) pairs that link, by the overlap of their shared shingles."""
    own = sets.select("key", "n", "tokens")
    both = pairs.join(own.toDF("a", "n_a", "tokens_a"), "a").join(own.toDF("b", "n_b", "tokens_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for ka, kb, na, nb, ta, tb in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                x, y = np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64)
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * common >= percent * (na + nb - common):
                    a.append(ka), b.append(kb)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return both.select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b").mapInArrow(run, "a long, b long")


_SHOWN = ("key", "n", "place", "own", *_PARITY)


def _may_link(x: str, y: str, most: int, percent: int):
    """Bounds two postings of one shingle must meet: sizes, places, least difference, and not both small."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = F.col(f"{x}.own") + F.col(f"{y}.own")
    for c in _PARITY:
        differ = differ + F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")))
    left = F.least(n - F.col(f"{x}.place"), m - F.col(f"{y}.place"))
    return ((100 + percent) * left >= percent * (n + m)) & (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.greatest(n, m) > most) & ((100 + percent) * differ <= (100 - percent) * (n + m))


def large_links(postings: DataFrame, sets: DataFrame, links: DataFrame, most: int, percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """(a, b) links that, with the given ones, connect every pair of sets that link and are not both small."""
    spark = postings.sparkSession
    folder = shared_folder(spark)
    tested, turn = None, 0
    while turn <= rounds:
        labels = components(links)
        labelled = postings.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
        # Only lists with sets that are not connected yet; each with its greatest component.
        counts = labelled.groupBy("token", "label").agg(F.count("*").alias("members"), F.min(F.struct(F.xxhash64("key", F.lit(turn)), *_SHOWN)).alias("centre"))
        lists = counts.groupBy("token").agg(F.count("*").alias("labels"), F.max_by(F.struct("label", "centre"), F.struct("members", "label")).alias("main")).filter("labels > 1").select("token", "main.*")
        open_lists = labelled.join(lists.select("token", F.col("label").alias("main")), "token")
        open_lists = written(open_lists, folder, "open")
        minor = open_lists.filter("label <> main")
        if turn < rounds:
            centre = lists.select("token", *(F.col(f"centre.{c}").alias(c) for c in _SHOWN))
            near = minor.alias("x").join(centre.alias("y"), F.col("x.token") == F.col("y.token")).filter(_may_link("x", "y", most, percent))
            votes = near.groupBy(F.col("x.key").alias("key"), F.col("y.key").alias("centre")).agg(F.count("*").alias("votes"))
            best = votes.groupBy("key").agg(F.max_by("centre", F.struct("votes", "centre")).alias("centre"))
            pairs = best.select(F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b")).distinct()
        else:
            x, y = minor.alias("x"), open_lists.alias("y")
            apart = (F.col("x.token") == F.col("y.token")) & (F.col("x.label") != F.col("y.label"))
            once = (F.col("y.label") == F.col("y.main")) | (F.col("x.key") < F.col("y.key"))
            pairs = x.join(y, apart & once & _may_link("x", "y", most, percent)).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, folder, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = written(verified(pairs, sets, percent), folder, "links")
        links = links.union(found)
        # Without a link from the centres further rounds are spared: the exact pass is next.
        turn = rounds if turn < rounds and found.isEmpty() else turn + 1
    links = written(links.distinct())
    remove_folder(spark, folder)
    return links


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, class_key (null for an empty set) and component_id of every document."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = buckets_for(picked)
    sent = picked.mapInArrow(_send(buckets, width), _SENT_SQL)
    back = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_shared(buckets), _SENT_SQL)
    posted = back.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_post(percent), _POSTED)
    posted = written(posted, folder, "posted")
    members = posted.filter("token IS NULL AND tokens IS NULL").select("doc_id", "key", "n")
    postings = posted.filter("token IS NOT NULL").select("token", *_SHOWN)
    sets = posted.filter("tokens IS NOT NULL").select("key", "n", "tokens")

    most = boundary(sets, postings, percent)
    links = written(small_links(sets, most, percent), folder, "small")
    links = large_links(postings, sets, links, most, percent)
    labels = components(links).withColumnRenamed("node", "key")
    classes = members.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    classes = classes.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "label").select("key", "component_id")
    out = members.join(named, "key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("key").alias("class_key"), F.coalesce("component_id", "doc_id").alias("component_id"))
