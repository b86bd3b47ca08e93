"""Winnowing: documents' words inside passages of a benchmark, by fingerprints that survive any shared span.

Both sides hash their 5-word grams and keep the least hash of every 6 consecutive grams. Two texts that share
10 words share those 6 grams, so they keep a common fingerprint: no window of 10 words is missed. Documents with
a common fingerprint are read again; there every gram that is a benchmark fingerprint is compared word by word
and extended to both sides, which drops chance hits and yields exact spans. An item of fewer than 10 words is a
single window, for which the guarantee does not hold; such items are looked up by grams of their own length.

Words are compared after lower-casing A-Z alone. Fingerprints use full lower-casing, which is faster and merges
more words: it can add candidates, never lose one.

Spans are found per distinct text, so copies are worked out once. Only DataFrame functions.

Edge cases: a null or empty text has no words and no hits; a null doc_id is kept; repeated rows give repeated
result rows; a null item_id counts for hits, but is not listed; an empty benchmark hits nothing; further columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_folder, written

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 10
GRAM = 5
SIDE = SPAN - GRAM


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased and nothing else changed."""
    plain = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(plain, NOT_WORD), lambda w: w != "")


def folded_words(text: Column) -> Column:
    """As many words, lower-cased in full. A-Z are letters to the pattern only after lower-casing, so it comes first."""
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def _starts(words: str, width: int) -> Column:
    """0, 1, ... for each gram of the width; empty where there is none."""
    n = F.size(words)
    return F.when(n >= width, F.sequence(F.lit(0), n - width)).otherwise(F.array().cast("array<int>"))


def gram_hashes(words: str, width: int) -> Column:
    return F.transform(_starts(words, width), lambda i: F.xxhash64(F.slice(words, i + 1, width)))


def winnowed(grams: str, window: int) -> Column:
    """Distinct least hashes of every `window` consecutive grams."""
    return F.array_distinct(F.transform(_starts(grams, window), lambda i: F.array_min(F.slice(grams, i + 1, window))))


def _around(rows: DataFrame, keep: list[str], width: int) -> DataFrame:
    """One row per gram: its hash, place, words, and up to SIDE words before (nearest first) and after."""
    context = F.transform(
        _starts("words", width),
        lambda i: F.struct(
            F.xxhash64(F.slice("folded", i + 1, width)).alias("fp"),
            i.alias("at"),
            F.slice("words", i + 1, width).alias("gram"),
            F.reverse(F.slice("words", F.greatest(i - SIDE, F.lit(0)) + 1, F.least(i, F.lit(SIDE)))).alias("before"),
            F.slice("words", i + width + 1, SIDE).alias("after"),
        ),
    )
    return rows.select(*keep, F.inline(context))


def _same(a: Column, b: Column) -> Column:
    """Length of the common beginning of two lists of up to SIDE words."""
    length = F.lit(SIDE)
    for k in reversed(range(SIDE)):
        length = F.when(F.coalesce(F.get(a, F.lit(k)) == F.get(b, F.lit(k)), F.lit(False)), length).otherwise(F.lit(k))
    return length


def _spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """key, item_id, start, stop of matches around grams that both sides have."""
    a, b = docs.alias("a"), items.alias("b")
    pairs = a.join(b, (F.col("a.fp") == F.col("b.fp")) & (F.col("a.gram") == F.col("b.gram")))
    left, right = _same(F.col("a.before"), F.col("b.before")), _same(F.col("a.after"), F.col("b.after"))
    found = pairs.select("a.key", "b.item_id", "a.at", left.alias("left"), right.alias("right"))
    found = found.filter(F.col("left") + F.col("right") >= SIDE)
    return found.select("key", "item_id", (F.col("at") - F.col("left")).alias("start"), (F.col("at") + GRAM + F.col("right")).alias("stop"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with doc_id, key and n_words; spans with key, item_id, start and stop in words).

    `key` is the digest of the text; spans of one document may overlap.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
    items = items.select("item_id", words_of(F.col("text")).alias("words"), folded_words(F.col("text")).alias("folded"))
    items = items.filter(F.size("words") > 0)
    long_items = items.filter(F.size("words") >= SPAN)
    short = items.filter(F.size("words") < SPAN).withColumn("width", F.size("words"))
    widths = sorted(r[0] for r in short.select("width").distinct().collect())  # at most nine

    seen = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    seen = seen.select("doc_id", F.md5(F.col("text").cast("binary")).alias("key"), folded_words(F.col("text")).alias("folded"))
    seen = seen.select("doc_id", "key", "folded", gram_hashes("folded", GRAM).alias("grams"))
    marks = winnowed("grams", SIDE + 1)
    for width in widths:
        marks = F.concat(marks, F.array_distinct(F.col("grams") if width == GRAM else gram_hashes("folded", width)))
    seen = seen.select("doc_id", "key", F.size("folded").cast("long").alias("n_words"), marks.alias("marks"))
    seen = written(seen, folder, "marks")

    item_marks = long_items.select(F.explode(winnowed_of("folded")).alias("fp"))
    for width in widths:
        item_marks = item_marks.union(short.filter(F.col("width") == width).select(F.xxhash64("folded").alias("fp")))
    hit = seen.select("key", F.explode("marks").alias("fp")).join(item_marks.distinct(), "fp", "left_semi")
    hit = written(hit.select("key").distinct(), folder, "hit")

    again = docs.select(text.alias("text")).withColumn("key", F.md5(F.col("text").cast("binary")))
    again = again.join(hit, "key", "left_semi").dropDuplicates(["key"])
    again = again.select("key", words_of(F.col("text")).alias("words"), folded_words(F.col("text")).alias("folded"))
    again = written(again, folder, "texts")

    # Only grams that are fingerprints of the benchmark: each window of an item holds one.
    chosen = long_items.select("item_id", "words", "folded", winnowed_of("folded").alias("marks"))
    chosen = _around(chosen, ["item_id", "marks"], GRAM).filter(F.array_contains("marks", F.col("fp"))).drop("marks", "at").distinct()
    spans = _spans(_around(again, ["key"], GRAM), chosen)
    for width in widths:
        whole = short.filter(F.col("width") == width).select("item_id", F.xxhash64("folded").alias("fp"), F.col("words").alias("gram"))
        found = _around(again, ["key"], width).drop("before", "after").join(whole, ["fp", "gram"])
        spans = spans.union(found.select("key", "item_id", F.col("at").alias("start"), (F.col("at") + width).alias("stop")))
    return seen.drop("marks"), written(spans.distinct(), folder, "spans")


def winnowed_of(words: str) -> Column:
    """Fingerprints straight from words (for the small side)."""
    grams = gram_hashes(words, GRAM)
    starts = F.when(F.size(words) >= SPAN, F.sequence(F.lit(0), F.size(words) - SPAN)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(grams, i + 1, SIDE + 1))))


def covered(spans: DataFrame) -> DataFrame:
    """key, n_hit: words inside the union of a text's spans."""
    before = Window.partitionBy("key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    runs = spans.select("key", "start", "stop").distinct().withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(0)))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reached"))
    return runs.groupBy("key").agg(F.sum(fresh).cast("long").alias("n_hit"))


def items_of(spans: DataFrame) -> DataFrame:
    """key, items: the ids, as strings and sorted, of the items with a window in the text."""
    return spans.groupBy("key").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))


def report(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items."""
    seen, spans = contamination(docs, benchmark, **names)
    found = covered(spans).join(items_of(spans), "key")
    joined = seen.join(found, "key", "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
