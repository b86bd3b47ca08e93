"""How far the sources of a language stray from each other and from the language, by exact integer divergences.

A term is a run of letters A-Z (lower-cased) and of characters beyond ASCII. A language keeps the terms that stand in at least
`LEAST_DOCS` of its documents. With count c of a term in a group (a source of a language, or the language), the sum N of the
group's counts over the V kept terms, p = 1 + floor(10**9 * (c + 1) / (N + V)); two groups diverge at a term by
floor((p - q)**2 / q).

1. One pass counts terms per (language, source) on each task before anything is shuffled.
2. Three-dimensional cube: sources fall into blocks by hash, terms into blocks by hash. A cell (source block, source block,
   term block) receives the slices of its two source blocks over its terms, each slice copied once per partner block, and adds
   up the divergences of its ordered pairs. Block sizes are fixed, so a cell is bounded however many sources or terms there are.
3. Cells carry present terms only. Partial sums are reduced along the term axis; a term that no source of a cell's blocks has
   diverges by the same amount each time and enters as a count.

Counts are scaled in decimals and divergences are whole numbers of 64 bits: nothing is rounded.

Edge cases: null text, lang or source is the empty string, which is a language or a source like others; a group without
terms has count 0 everywhere; a language without kept terms gives pairs of value 0 and no term rows; equal values rank by the
item's UTF-8 bytes; repeated rows count as documents of their own, whatever their doc_id; texts of any length are whole; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, remove_folder, shared_folder, utf8, written

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200  # the report's length of the term part
SOURCES_A_BLOCK = 32
TERMS_A_BLOCK = 40_000

# Per byte: letters lower-cased, bytes of characters beyond ASCII kept, all else a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SLICE = 1_000  # documents that are split at once
_HELD = 300_000  # distinct counts a task holds before it sends them
_COUNTS = "lang string, source string, term string, n long, docs long"
_KEYS = ("lang", "source", "term")
_COUNTS_ARROW = pa.schema([*((c, pa.string()) for c in _KEYS), ("n", pa.int64()), ("docs", pa.int64())])


def _slice_counts(langs: list[str], sources: list[str], texts: list[bytes]) -> pa.Table:
    """Occurrences and documents per (lang, source, term); a row with a null term for every group met."""
    lists = pc.ascii_split_whitespace(pa.array([t.translate(_FOLD) for t in texts], pa.large_string()))
    terms = lists.flatten().dictionary_encode()
    size = max(1, len(terms.dictionary))
    doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    pairs, times = np.unique(doc * size + terms.indices.to_numpy().astype(np.int64), return_counts=True)
    groups: dict[tuple, int] = {}
    group_of = np.array([groups.setdefault(x, len(groups)) for x in zip(langs, sources, strict=True)], np.int64)
    keys, number = np.unique(group_of[pairs // size] * size + pairs % size, return_inverse=True)
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, number, times)
    found = terms.dictionary.take(pa.array(keys % size)).cast(pa.string())
    some = pc.not_equal(found, "")
    lang, source = (pa.array([g[k] for g in groups], pa.string()) for k in (0, 1))
    which = pa.array(keys // size)
    counted = pa.table([lang.take(which), source.take(which), found, pa.array(n), pa.array(np.bincount(number, minlength=len(keys)).astype(np.int64))], schema=_COUNTS_ARROW).filter(some)
    met = pa.table([lang, source, pa.nulls(len(lang), pa.string()), *(pa.array(np.zeros(len(lang), np.int64)) for _ in "nd")], schema=_COUNTS_ARROW)
    return pa.concat_tables([counted, met])


def _merged(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(list(_KEYS)).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table([*(found.column(c) for c in _KEYS), found.column("n_sum"), found.column("docs_sum")], schema=_COUNTS_ARROW)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's documents, added up before they leave it."""
    release()
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            part = batch.slice(at, _SLICE)
            held.append(_slice_counts(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part, "text")))
            rows += held[-1].num_rows
            if rows > 2 * _HELD:
                held = [_merged(held)]
                rows = held[0].num_rows
                if rows > _HELD:
                    yield from held[0].to_batches(50_000)
                    held, rows = [], 0
    if held:
        yield from _merged(held).to_batches(50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs; the group itself has a row with a null term."""
    picked = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = picked.mapInArrow(_count, _COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a count; decimals, as a count times 10**9 may pass 64 bits."""
    wide = "decimal(20,0)"
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(1)).cast(wide)
    whole = F.call_function("div", scaled, F.nullif(total + terms, F.lit(0)).cast(wide))
    return F.coalesce(whole + F.lit(1), F.lit(1)).cast("long")


def _cell(table: pa.Table) -> pa.Table:
    """One cell: divergence sums of the ordered pairs between its two source blocks, over its terms."""
    column = {name: table.column(name).combine_chunks() for name in table.column_names}
    head = np.asarray(column["term"].is_null())
    names = column["source"].filter(pa.array(head)).to_pylist()
    place = {name: k for k, name in enumerate(names)}
    block = column["block"].filter(pa.array(head)).to_numpy(zero_copy_only=False)
    absent = column["p"].filter(pa.array(head)).to_numpy(zero_copy_only=False)
    kept = column["terms"][0].as_py()
    body = pa.array(~head)
    coded = column["source"].filter(body).dictionary_encode()
    source = np.array([place[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int64)
    term = column["term"].filter(body).dictionary_encode()
    p = np.repeat(absent[:, None], len(term.dictionary), axis=1)
    p[source, term.indices.to_numpy()] = column["p"].filter(body).to_numpy(zero_copy_only=False)
    one_block = column["a"][0].as_py() == column["b"][0].as_py()
    out: list[list] = [[], [], [], [], []]
    for k, name in enumerate(names):
        others = np.flatnonzero(np.arange(len(names)) != k) if one_block else np.flatnonzero(block != block[k])
        apart = p[k] - p[others]
        sums = (apart * apart // p[others]).sum(axis=1)
        idle = absent[k] - absent[others]
        out[0] += [name] * len(others)
        out[1] += [names[j] for j in others]
        out[2] += sums.tolist()
        out[3] += (idle * idle // absent[others]).tolist()
        out[4] += [len(term.dictionary)] * len(others)
    size = len(out[0])
    return pa.table(
        {
            "lang": pa.array([column["lang"][0].as_py()] * size, pa.string()),
            "source": pa.array(out[0], pa.string()),
            "item": pa.array(out[1], pa.string()),
            "value": pa.array(out[2], pa.int64()),
            "absent": pa.array(out[3], pa.int64()),
            "seen": pa.array(out[4], pa.int64()),
            "terms": pa.array([kept] * size, pa.int64()),
        }
    )


_CELL = "lang string, source string, item string, value long, absent long, seen long, terms long"


def pair_divergences(entries: DataFrame, groups: DataFrame, sources_a_block: int = SOURCES_A_BLOCK, terms_a_block: int = TERMS_A_BLOCK) -> DataFrame:
    """lang, source, item, value of every ordered pair of a language's sources.

    entries: lang, source, term, p of the kept terms a source has; groups: lang, source, p (of an absent term), terms (V).
    """
    sizes = groups.groupBy("lang").agg(
        F.ceil(F.count("*") / sources_a_block).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.max("terms") / terms_a_block), F.lit(1)).cast("int").alias("slices"),
        F.max("terms").alias("terms"),
    )
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")
    heads = groups.drop("terms").join(sizes, "lang").select("lang", "source", F.lit(None).cast("string").alias("term"), "p", "terms", block, "blocks", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    slice_ = F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice")
    body = entries.join(sizes, "lang").select("lang", "source", "term", "p", "terms", block, "blocks", slice_)
    copied = heads.unionByName(body).withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = copied.select("lang", F.least("block", "partner").alias("a"), F.greatest("block", "partner").alias("b"), "slice", "source", "block", "term", "p", "terms")
    found = cells.groupBy("lang", "a", "b", "slice").applyInArrow(_cell, _CELL)
    reduced = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.max("absent").alias("absent"), F.sum("seen").alias("seen"), F.max("terms").alias("terms"))
    return reduced.select("lang", "source", "item", (F.col("value") + (F.col("terms") - F.col("seen")) * F.col("absent")).alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, sources_a_block: int = SOURCES_A_BLOCK, terms_a_block: int = TERMS_A_BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` against every other source, part `term` the terms a source overuses."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    counts = written(term_counts(docs), folder, "counts")
    kept = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang")).filter(F.col("docs") >= least_docs).drop("docs")
    entries = written(counts.filter("term IS NOT NULL").select("lang", "source", "term", "n").join(kept, ["lang", "term"]), folder, "entries")
    totals = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left").join(totals, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = written(groups, folder, "groups")

    shares = entries.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("in_lang"), F.col("lang_total"), F.col("terms")).alias("q")
    )
    shares = written(shares, folder, "shares")
    idle = groups.select("lang", "source", share(F.lit(0), F.col("total"), F.col("terms")).alias("p"), "terms")
    pairs = pair_divergences(shares.select("lang", "source", "term", "p"), idle, sources_a_block, terms_a_block)
    strayed = shares.filter("n > 0 AND p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = [
        pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair")),
        strayed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).withColumn("part", F.lit("term")),
    ]
    columns = ("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
    out = written(ranked[0].select(*columns).union(ranked[1].select(*columns)))
    remove_folder(spark, folder)
    return out
