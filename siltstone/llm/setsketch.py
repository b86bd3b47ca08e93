"""Near duplicates by SetSketch registers: banded, estimated jointly by likelihood, verified on the full sets.

A document's set are its distinct 5-word shingles. Two documents link when 100 * |A & B| >= 85 * |A | B|; documents of one
component of links are one group. Documents of one set are one class.

1. One pass makes each set's sketch: every shingle is a Poisson process of points, each on one of `REGISTERS` registers; a
   register keeps the least point as its truncated place on a scale of powers of `BASE` (exponentially spaced minima). The
   registers of a union are the greater ones of both (`merged`), and equal registers are likelier the more two sets share.
   Points beyond a set's greatest register are never made, so a set of n costs about n + m log m of them.
2. Bands of registers are hashed; classes that share a band are candidates. The number of registers a band is the greatest for
   which a pair at the threshold shares no band with a probability below `MISS`.
3. Rounds compare each class with one centre per band and merge what links, so a group of near copies costs its size, not its
   square. Then every pair of a band whose classes are not connected yet is compared, after exact bounds on sizes and on the
   least difference (of each set the parity of its shingles in 512 hash classes is kept: where parities differ, sets
   differ). No candidate is dropped otherwise, and no list is capped.
4. Of a candidate pair the similarity is estimated from the counts of greater, smaller and equal registers and the exact set
   sizes; a pair stays unless the threshold is less likely than the estimate by a log-likelihood beyond `DOUBT`.
5. Pairs that stay are verified on the full sets, made again from the whole texts; centres with many members are dealt over
   several tasks.

Classes are known by 128-bit hashes of their sets; shingles within two compared sets by 64-bit hashes.

Edge cases: a null or empty text, or one of white space, has an empty set and is its own component; fewer than 5 words are one
shingle; repeated rows are one class; a null doc_id can be a member, but never names a component unless all its ids are null;
texts of any length are whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MIX, WordHashes, mixed, release, remove_folder, shared_folder, utf8, written
from .components import components

WIDTH = 5
PERCENT = 85
REGISTERS = 200
BASE = 1.02
RATE = 20.0  # points a register gets in a unit of the scale; registers of one shingle are then hardly ever below 0
LAST = 4094  # greatest register; a set of 2**80 shingles stays below
MISS = 1e-9
DOUBT = 32.0  # half the square of 8 standard deviations
ROUNDS = 2
MEMBERS_A_TASK = 400  # members of one centre that are verified together

_SETS, _TOKENS = 1_500, 1_500_000  # sets and shingles sketched at once
_POINTS = 400_000


def shingles(text: bytes, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a UTF-8 text; A-Z lower-cased. Each place has its own multiplier."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    size = min(width, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total * MIX[0] + h[k : k + len(total)])
    return np.unique(total)


def registers(tokens: np.ndarray, sizes: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """(sets, m) registers of sets whose shingle hashes stand one set after the other."""
    sets = len(sizes)
    least = np.full(sets * m, np.inf)
    owner = np.repeat(np.arange(sets), sizes)
    at = np.zeros(len(tokens))
    turn = 0
    while len(tokens):
        several = int(min(256, max(1, _POINTS // len(tokens))))
        for lo in range(0, len(tokens), _POINTS):
            part = slice(lo, min(lo + _POINTS, len(tokens)))
            steps = np.arange(turn + 1, turn + several + 1, dtype=np.uint64) * MIX[2]
            draw = mixed(tokens[part, None] + steps[None, :])
            gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * RATE)
            place = at[part, None] + np.cumsum(gap, axis=1)
            where = ((mixed(draw ^ MIX[1]) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            np.minimum.at(least, (owner[part, None] * m + where.astype(np.int64)).ravel(), place.ravel())
            at[part] = place[:, -1]
        turn += several
        live = np.flatnonzero(np.bincount(owner, minlength=sets))
        greatest = np.zeros(sets)
        greatest[live] = least.reshape(sets, m)[live].max(axis=1)
        stays = at < greatest[owner]
        tokens, owner, at = tokens[stays], owner[stays], at[stays]
    return np.clip(np.floor(1.0 - np.log(least) / math.log(BASE)), 0, LAST).astype("<u2").reshape(sets, m)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def similarity(greater: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood Jaccard of sets of n and m shingles from counts of registers, and how much likelier it is than the threshold.

    With u = n / (n + m), v = m / (n + m) a register of the first is greater with probability p(u - v J), smaller with
    p(v - u J), p(x) = -log_b(1 - x (b - 1) / b).
    """
    u, v = n / (n + m), m / (n + m)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = (-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE) for x in (u - v * j, v - u * j))
        parts = ((greater, up), (smaller, down), (equal, 1 - up - down))
        return sum(np.where(k > 0, k * np.log(np.maximum(p, 1e-300)), 0.0) for k, p in parts)

    most = np.minimum(u / v, v / u)
    lo, hi = np.zeros_like(u), most.copy()
    for _ in range(50):  # the likelihood is concave in J
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        better = likelihood(a) < likelihood(b)
        lo, hi = np.where(better, a, lo), np.where(better, hi, b)
    best = (lo + hi) / 2
    held = np.maximum(best, np.minimum(percent / 100, most))
    return best, likelihood(best) - likelihood(held)


def band_rows(percent: int = PERCENT, m: int = REGISTERS) -> int:
    """Registers a band."""
    share = percent / 100
    return max([r for r in range(1, 30) if (1 - share**r) ** (m // r) <= MISS], default=1)


_PARITY = tuple(f"p{k}" for k in range(8))  # parity of a set's shingles in 512 hash classes
_LONGS = ("doc_id", "n", *_PARITY)
_ROW_ARROW = pa.schema([*((c, pa.int64()) for c in _LONGS), ("digest", pa.binary()), ("key", pa.binary()), ("sketch", pa.binary())])
_ROW = ", ".join(f"{c} long" for c in _LONGS) + ", digest binary, key binary, sketch binary"


def parities(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(words, sets): for each hash class whether a set has an odd number of shingles in it."""
    classes = 64 * len(_PARITY)
    place = ((mixed(tokens + MIX[3]) >> np.uint64(32)) * np.uint64(classes)) >> np.uint64(32)
    odd = np.bincount(np.repeat(np.arange(len(sizes)), sizes) * classes + place.astype(np.int64), minlength=classes * len(sizes)) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(sizes), classes), axis=1, bitorder="little").view(np.int64).T.copy()


def _key(tokens: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(tokens.tobytes())


def _sketch(width: int, m: int):
    """A row per document, and one with the sketch of every set the task has not met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hashes, met = WordHashes(), set()
        sets: list[np.ndarray] = []
        keys: list[bytes] = []

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in sets], np.int64)
            tokens = np.concatenate(sets)
            found = registers(tokens, sizes, m)
            columns = [pa.nulls(len(sets), pa.int64()), pa.array(sizes), *map(pa.array, parities(tokens, sizes)), pa.nulls(len(sets), pa.binary())]
            batch = pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())], schema=_ROW_ARROW)
            sets.clear(), keys.clear()
            return batch

        held = 0
        for batch in batches:
            numbers, own_keys = [], []
            for text in utf8(batch, "text"):
                own = shingles(text or b"", hashes, width)
                key = _key(own) if len(own) else None
                numbers.append(len(own))
                own_keys.append(key)
                if key is None or key in met:
                    continue
                if len(met) < 300_000:
                    met.add(key)
                sets.append(own)
                keys.append(key)
                held += len(own)
                if held >= _TOKENS or len(sets) >= _SETS:
                    yield flush()
                    held = 0
            none = pa.nulls(len(numbers), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, pa.int64()), *(none for _ in _PARITY), batch.column(2), pa.array(own_keys, pa.binary()), pa.nulls(len(numbers), pa.binary())], schema=_ROW_ARROW)
        if sets:
            yield flush()

    return run


def sketches(docs: DataFrame, width: int = WIDTH, m: int = REGISTERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents (doc_id, n, digest, key) and, with a sketch, of sets (key, n, sketch, parities); a set may come from several tasks."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))
    return picked.mapInArrow(_sketch(width, m), _ROW)


# --- candidates ------------------------------------------------------------------------------------

_SHOWN = ("key", "n", *_PARITY)


def postings(classes: DataFrame, rows: int, m: int = REGISTERS) -> DataFrame:
    """band, key, n, parities of every class in a band that it shares with another."""
    bands = F.expr(f"explode(transform(sequence(0, {m // rows - 1}), i -> xxhash64(i, substring(sketch, {2 * rows} * i + 1, {2 * rows}))))")
    dealt = classes.select(bands.alias("band"), "key")
    several = dealt.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1").select("band")
    return dealt.join(several, "band").join(classes.select(*_SHOWN), "key")


def _may_link(x: str, y: str, percent: int) -> Column:
    """Exact bounds on a link: sizes, and the least number of shingles that stand in one set only."""
    n, k = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = F.lit(0)
    for c in _PARITY:
        differ = differ + F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")))
    return (100 * F.least(n, k) >= percent * F.greatest(n, k)) & ((100 + percent) * differ <= (100 - percent) * (n + k))


def likely(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) pairs whose registers do not speak against a link."""
    own = classes.select("key", "n", "sketch")
    both = pairs.join(own.toDF("a", "n_a", "x"), "a").join(own.toDF("b", "n_b", "y"), "b").select("a", "b", "n_a", "n_b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.stack([np.frombuffer(v, "<u2") for v in batch.column(k).to_pylist()]) for k in (4, 5))
            n, m = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in (2, 3))
            estimate, doubt = similarity((x > y).sum(axis=1), (x < y).sum(axis=1), (x == y).sum(axis=1), n, m, percent)
            stays = pa.array((estimate >= percent / 100) | (doubt <= DOUBT))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(stays)

    return both.mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The (a, b) pairs that link, by the overlap of their full sets."""
    dealt = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_A_TASK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    members = pairs.join(dealt, "a").select("a", "b", part).join(texts.toDF("b", "text"), "b").select("a", "part", "b", "text")
    centres = dealt.join(texts.toDF("a", "text"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("binary").alias("b"), "text")
    rows = centres.unionByName(members).repartition("a", "part").sortWithinPartitions("a", "part", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hashes = WordHashes()
        centre = np.empty(0, np.uint64)
        for batch in batches:
            found: list[tuple] = []
            for a, b, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), utf8(batch, "text"), strict=True):
                own = shingles(text, hashes, width)
                if b is None:  # comes first
                    centre = own
                    continue
                at = np.searchsorted(centre, own)
                common = int((centre[np.minimum(at, len(centre) - 1)] == own).sum())
                if 100 * common >= percent * (len(centre) + len(own) - common):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def links(classes: DataFrame, posted: DataFrame, texts: DataFrame, folder: str, width: int, percent: int, rounds: int = ROUNDS) -> DataFrame:
    """(a, b) links that connect every pair of classes that link."""
    spark = classes.sparkSession
    found = spark.createDataFrame([], "a binary, b binary")
    tested = None
    for turn in range(rounds + 1):
        labelled = posted
        if turn:
            labels = components(found)
            labelled = posted.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
        else:
            labelled = posted.withColumn("label", F.col("key"))
        # Bands with classes that are not connected yet; each with a centre from its greatest component.
        counts = labelled.groupBy("band", "label").agg(F.count("*").alias("members"), F.min(F.struct(F.xxhash64("key", F.lit(turn)), *_SHOWN)).alias("centre"))
        lists = counts.groupBy("band").agg(F.count("*").alias("labels"), F.max_by(F.struct("label", "centre"), F.struct("members", "label")).alias("main")).filter("labels > 1")
        lists = lists.select("band", F.col("main.label").alias("main"), *(F.col(f"main.centre.{c}").alias(f"centre_{c}") for c in _SHOWN))
        open_ = written(labelled.join(lists, "band"), folder, "open")
        minor = open_.filter("label <> main")
        if turn < rounds:
            x = minor.select(*_SHOWN, F.struct(*(F.col(f"centre_{c}").alias(c) for c in _SHOWN)).alias("y"), F.struct(*_SHOWN).alias("x"))
            votes = x.filter(_may_link("x", "y", percent)).groupBy("key", F.col("y.key").alias("centre")).agg(F.count("*").alias("votes"))
            best = votes.groupBy("key").agg(F.max_by("centre", F.struct("votes", "centre")).alias("centre"))
            pairs = best.select(F.col("centre").alias("a"), F.col("key").alias("b"))
        else:
            x, y = minor.alias("x"), open_.alias("y")
            apart = (F.col("x.band") == F.col("y.band")) & (F.col("x.label") != F.col("y.label"))
            once = (F.col("y.label") == F.col("y.main")) | (F.col("x.key") < F.col("y.key"))
            pairs = x.join(y, apart & once & _may_link("x", "y", percent)).select(F.col("y.key").alias("a"), F.col("x.key").alias("b"))
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            both_ways = tested.union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = pairs.join(both_ways, ["a", "b"], "left_anti")
        pairs = written(pairs, folder, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        stay = written(likely(pairs, classes, percent), folder, "likely")
        found = found.union(written(verified(stay, texts, width, percent), folder, "links"))
    return found


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, m: int = REGISTERS, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, class_key (null for an empty set), component_id and kept of every document."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    found = written(sketches(docs, width, m, id_col, text_col), folder, "sketches")
    members = found.filter("sketch IS NULL").select("doc_id", "n", "digest", "key")
    sets = found.filter("sketch IS NOT NULL").select(*_SHOWN, "sketch")
    classes = written(sets.groupBy("key").agg(*(F.min(c).alias(c) for c in ("n", *_PARITY, "sketch"))), folder, "classes")
    posted = written(postings(classes, band_rows(percent, m), m), folder, "posted")

    # One text of every class that has candidates; a text is known by its digest.
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    active = posted.select("key").distinct()
    one = members.join(active, "key", "left_semi").groupBy("key").agg(F.min("digest").alias("digest"))
    whole = docs.select(F.unhex(F.md5(text.cast("binary"))).alias("digest"), text.alias("text")).join(one, "digest")
    texts = written(whole.groupBy("key").agg(F.first("text").alias("text")), folder, "texts")

    labels = components(links(classes, posted, texts, folder, width, percent, rounds)).withColumnRenamed("node", "key")
    named = members.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    named = named.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    result = members.join(named.join(least, "label").select("key", "component_id"), "key", "left")
    component = F.coalesce("component_id", "doc_id")
    out = written(result.select("doc_id", F.col("n").alias("n_shingles"), F.col("key").alias("class_key"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")))
    remove_folder(spark, folder)
    return out
