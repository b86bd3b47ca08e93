"""Rule bitmask ledger: each rule is evaluated once per document; policies and ablations read the bits.

`measure` takes the measurements, `ledger` sets one bit per failed rule, `stored_ledger` writes both to the shared folder and
reads them back, `apply_policy` masks the bits, `decided` does so for every policy version, and `ablation` counts documents by bit pattern and derives from that small table what each rule decides alone.
Only DataFrame functions; nothing is shuffled but the ablation's counts, which combine on the map side.

Edge cases: a null or empty text has no words and all measurements 0, so it fails `few_words`; repeated
rows give repeated ledger rows; a null doc_id is kept; an empty table gives an empty ledger; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
NOT_WORD = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
GRAM = 8

# Rules in the order of their bits. A rule is never renumbered; new ones are added at the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 5 * word_chars",
    "capitals": "100 * n_capitals > 50 * word_chars",
    "stutter": "100 * n_stutter > 20 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 60 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
}
# Versioned policies: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "2025-1": ("few_words", "repeated_windows", "symbols", "capitals", "stutter"),
    "2025-2": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_stutter")


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in POLICIES[policy])


def _count(text: Column, characters: str) -> Column:
    """Occurrences of ASCII characters: the bytes that go when they are replaced by nothing."""
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return (F.octet_length(text) - F.octet_length(rest)).cast("long")


def _covered(positions: Column, width: int) -> Column:
    """Words covered by windows of a width at sorted start positions."""
    gaps = F.transform(positions, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(positions, i + 1) - p, F.lit(width))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements of every document; words are runs of anything but ASCII white space."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.filter(F.split("text", NOT_WORD), lambda w: w != "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    n = F.size("words")
    grams = F.when(n >= GRAM, F.transform(F.sequence(F.lit(1), n - (GRAM - 1)), lambda i: F.xxhash64(F.slice("words", i, GRAM))))
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        (F.char_length("text") - _count(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).alias("n_symbols"),
        lines.alias("lines"),
        F.char_length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.when(n > 1, F.size(F.filter(F.sequence(F.lit(1), n - 1), lambda i: F.get("words", i) == F.get("words", i - 1)))).otherwise(0).cast("long").alias("n_stutter"),
        F.coalesce(grams, F.array().cast("array<bigint>")).alias("grams"),
    )
    # Most documents repeat no window; only the others sort theirs.
    ordered = F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    rows = rows.withColumn("ordered", ordered)

    def twice(x: Column, i: Column) -> Column:
        equal = [F.coalesce(F.get("ordered", i + d).getField("g") == x.getField("g"), F.lit(False)) for d in (-1, 1)]
        return equal[0] | equal[1]

    found = F.transform(F.filter("ordered", twice), lambda x: x.getField("i"))
    rows = rows.withColumn("found", F.sort_array(found))
    n_lines = F.size("lines")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (n_lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("found"), GRAM), F.lit(0).cast("long")).alias("n_repeat_words"),
        n_lines.cast("long").alias("n_lines"),
        "n_capitals",
        "n_stutter",
    )


def ledger(measured: DataFrame) -> DataFrame:
    """Adds `bits`: bit k is set where rule k of RULES fails the document."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("bits", total.cast("long"))


def stored_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger as a written table: rules are evaluated by this write alone, however many policies read it."""
    return written(ledger(measure(docs, id_col, text_col)), name="ledger")


def failed(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy))) != 0


def apply_policy(entries: DataFrame, policy: str, alias: str = "kept") -> DataFrame:
    return entries.withColumn(alias, ~failed(F.col("bits"), policy))


def kept_name(policy: str) -> str:
    return f"kept_{policy.replace('-', '_')}"


def decided(entries: DataFrame) -> DataFrame:
    """Adds one column kept_<policy> per policy version."""
    return entries.withColumns({kept_name(p): ~failed(F.col("bits"), p) for p in POLICIES})


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents it fails, and documents that only it fails, which are kept without it."""
    counts = entries.groupBy(F.col("bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count("*").alias("n"))
    names = list(RULES)
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]))
    each = counts.select("bits", "n", F.inline(rules))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits").isin(0) | (F.col("bits") == F.col("bit")), F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
