"""The operators over the test tables, each with production parameters and its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, conversations, decontaminate, divergence, language_model, licenses, ngram_join, packing, rules, setsketch, suffix_dedup, toxicity, warc
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """Place of the public vocabulary file; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path()).drop("ids")


def warc_query(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"), keep_block=False)
    response = F.col("response")
    revisit = response.record_type == "revisit"
    return found.select(
        warc.page_told(F.col("metadata.block")).alias("page_id"),
        response.http_length.alias("payload_bytes"),
        F.when(revisit, response.digest).otherwise(response.block_sha1).alias("payload_digest"),
        response.record_type.alias("record_type"),
        F.when(revisit, warc.page_of(response.refers_to)).alias("refers_to"),
        F.col("request.target_uri").alias("target_uri"),
    )


def rules_query(spark: SparkSession, folder: str) -> DataFrame:
    """`kept` is the verdict of policy 2025-1; each policy's own stands beside it."""
    entries = rules.decided(rules.stored_ledger(table(spark, folder, "documents")))
    base = rules.failed(F.col("bits"), "base").alias("base_failed")
    verdicts = [F.col("kept_2025_1").alias("kept"), *map(rules.kept_name, rules.POLICIES)]
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base, *verdicts, "bits")


def decontaminate_query(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def classifier_query(spark: SparkSession, folder: str) -> DataFrame:
    found = classifier.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def ngram_join_query(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents")).drop("class_key")


def suffix_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"), keep_text=False)


def language_model_query(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").filter("quality = 1")
    return language_model.cross_entropy_difference(table(spark, folder, "documents"), good)


def tree_path() -> Column:
    """Documents laid out as a source tree: source, language, and up to two levels that follow from the id."""
    digest = F.md5(F.col("doc_id").cast("string").cast("binary"))
    depth = F.instr(F.lit("0123456789abcdef"), F.substring(digest, 3, 1)) % 3
    levels = F.when(depth == 0, F.lit("")).when(depth == 1, F.concat(F.substring(digest, 1, 1), F.lit("/"))).otherwise(F.concat(F.substring(digest, 1, 1), F.lit("/"), F.substring(digest, 2, 1), F.lit("/")))
    return F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), levels, F.col("doc_id").cast("string"), F.lit(".txt"))


def licenses_query(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents").withColumn("path", tree_path()))


def setsketch_query(spark: SparkSession, folder: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, folder, "documents")).drop("class_key")


def divergence_query(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def conversations_query(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, folder, "conversations")))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard": ngram_join_query,
        "op2_license_scan": licenses_query,
        "op3_toxicity": toxicity_query,
        "op4_lm_scoring": language_model_query,
        "op5_quality_rules": rules_query,
        "op6_suffix_dedup": suffix_dedup_query,
        "op7_packing": packing_query,
        "op8_warc": warc_query,
        "op9_decontamination": decontaminate_query,
        "op10_quality_classifier": classifier_query,
        "op11_conversation_repair": conversations_query,
        "op12_setsketch_dedup": setsketch_query,
        "op13_source_divergence": divergence_query,
    }


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, translate(coalesce(url, ''), chr(10) || chr(13), '') AS target_uri FROM pages),
d AS (SELECT page_id, target_uri, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
h AS (SELECT payload_digest, max(page_id) AS holder FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to, target_uri
FROM d LEFT JOIN h ON d.payload_digest = h.payload_digest AND payload_bytes >= 1000
"""


LICENSES_SQL = (
    r"""
WITH t(template, licence, text) AS (VALUES """
    + ", ".join(f"({k}, '{licence}', '{text}')" for k, (licence, text) in enumerate(licenses.TEMPLATES))
    + r"""),
tw AS (SELECT template, licence, term, count(*) AS tf
       FROM (SELECT template, licence, unnest([x FOR x IN string_split_regex(lower(text), '[^a-z0-9]+') IF x <> '']) AS term FROM t)
       GROUP BY ALL),
v AS (SELECT DISTINCT term FROM tw),
f AS (SELECT doc_id, coalesce(text, '') AS text, md5(doc_id::VARCHAR) AS h, strpos('0123456789abcdef', substr(md5(doc_id::VARCHAR), 3, 1)) % 3 AS depth,
             source || '/' || lang AS top FROM documents),
d AS (SELECT doc_id, text, CASE depth WHEN 0 THEN top WHEN 1 THEN top || '/' || substr(h, 1, 1)
                                      ELSE top || '/' || substr(h, 1, 1) || '/' || substr(h, 2, 1) END AS dir FROM f),
units AS (SELECT doc_id, 0 AS line, text AS content FROM d
          UNION ALL SELECT doc_id, i AS line, string_split(text, chr(10))[i] FROM d, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)),
uw AS (SELECT doc_id, line, [x FOR x IN string_split_regex(lower(content), '[^a-z0-9]+') IF x <> ''] AS words FROM units),
ut AS (SELECT doc_id, line, term, count(*) AS tf FROM (SELECT doc_id, line, unnest(words) AS term FROM uw) GROUP BY ALL),
total AS (SELECT count(*) AS n FROM d),
idf AS (SELECT term, ln((1.0 + total.n) / (1 + count(doc_id))) + 1 AS idf
        FROM (SELECT term FROM v UNION SELECT term FROM ut) CROSS JOIN total LEFT JOIN (SELECT term, doc_id FROM ut WHERE line = 0) USING (term) GROUP BY term, total.n),
tl AS (SELECT template, sqrt(sum((tf * idf) ** 2)) AS length FROM tw JOIN idf USING (term) GROUP BY template),
ul AS (SELECT doc_id, line, sqrt(sum((tf * idf) ** 2)) AS length FROM ut JOIN idf USING (term) GROUP BY doc_id, line),
dot AS (SELECT doc_id, line, template, licence, sum(ut.tf * idf * tw.tf * idf) AS dot
        FROM ut JOIN idf USING (term) JOIN tw USING (term) GROUP BY ALL),
c AS (SELECT doc_id, line, licence, round(max(dot / ul.length / tl.length), 6) AS cosine
      FROM dot JOIN ul USING (doc_id, line) JOIN tl USING (template) GROUP BY ALL),
whole AS (SELECT doc_id, licence, cosine FROM c WHERE line = 0 AND cosine >= 0.25
          QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence) = 1),
header AS (SELECT doc_id, licence, cosine FROM c WHERE line > 0 AND cosine >= 0.6
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, line, licence) = 1),
speaker AS (SELECT dir, licence, cosine FROM whole JOIN d USING (doc_id)
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, licence) = 1),
above AS (SELECT d.doc_id, s.licence, s.cosine, len(string_split(d.dir, '/')) - len(string_split(s.dir, '/')) AS distance
          FROM d JOIN speaker s ON d.dir = s.dir OR starts_with(d.dir, s.dir || '/')
          QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY distance) = 1)
SELECT d.doc_id, d.dir || '/' || d.doc_id || '.txt' AS path, coalesce(whole.licence, header.licence, above.licence) AS licence,
       CASE WHEN whole.doc_id IS NOT NULL THEN 'file' WHEN header.doc_id IS NOT NULL THEN 'header'
            WHEN above.doc_id IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       coalesce(whole.cosine, header.cosine, above.cosine) AS cosine,
       CASE WHEN whole.doc_id IS NULL AND header.doc_id IS NULL THEN above.distance END::BIGINT AS distance
FROM d LEFT JOIN whole ON whole.doc_id = d.doc_id LEFT JOIN header ON header.doc_id = d.doc_id LEFT JOIN above ON above.doc_id = d.doc_id
"""
)

RULES_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                  [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram FROM d, unnest(range(1, len(words) - 6)) AS u(i)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 8)) AS v(p) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals, len(lines)::BIGINT AS n_lines,
             len([i FOR i IN range(2, len(words) + 1) IF words[i] = words[i - 1]])::BIGINT AS n_stutter
      FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id),
f AS (SELECT *, n_words < 20 AS f0, 100 * n_repeat_words > 30 * n_words AS f1, 100 * n_symbols > 5 * word_chars AS f2,
             100 * n_capitals > 50 * word_chars AS f3, 100 * n_stutter > 20 * n_words AS f4, 100 * n_dup_lines > 60 * n_lines AS f5,
             word_chars < 2 * n_words AS f6, word_chars > 25 * n_words AS f7 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 OR f1 AS base_failed,
       NOT (f0 OR f1 OR f2 OR f3 OR f4) AS kept, NOT (f0 OR f1) AS kept_base, NOT (f0 OR f1 OR f2 OR f3 OR f4) AS kept_2025_1,
       NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7) AS kept_2025_2,
       (f0::BIGINT + 2 * f1::BIGINT + 4 * f2::BIGINT + 8 * f3::BIGINT + 16 * f4::BIGINT + 32 * f5::BIGINT + 64 * f6::BIGINT
        + 128 * f7::BIGINT)::BIGINT AS bits FROM f
"""

DECONTAMINATE_SQL = r"""
WITH fold AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
w AS (SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS win
      FROM b, unnest(range(1, greatest(len(words) - 8, 2))) AS u(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM w),
g AS (SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS win FROM fold, sizes, unnest(range(1, len(words) - n + 2)) AS u(i)),
hit AS (SELECT doc_id, item_id, i, g.n FROM g JOIN w ON w.n = g.n AND w.win = g.win),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS v(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT fold.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM fold LEFT JOIN places ON places.doc_id = fold.doc_id LEFT JOIN items ON items.doc_id = fold.doc_id
"""


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
whole AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
sums AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (sums.total + whole.v) AS p,
             1 + (1000000000::HUGEINT * (kept.n + 1)) // (whole.total + whole.v) AS q
      FROM g JOIN kept USING (lang) JOIN whole USING (lang) JOIN sums USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                     FROM p x JOIN p y USING (lang, term) GROUP BY ALL) f ON f.lang = a.lang AND f.source = a.source AND f.other = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def near_duplicates_sql(width: int, percent: int, more: str = "") -> str:
    """All pairs of documents that share a shingle; components by transitive closure."""
    return rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS id, doc_id,
                            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT id, array_to_string(words[i:i + {width - 1}], ' ') AS shingle FROM w, unnest(range(1, greatest(len(words) - {width - 2}, 2))) AS u(i) WHERE len(words) > 0),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
sized AS (SELECT s.*, n.n FROM s JOIN n USING (id)),
links AS (SELECT x.id AS a, y.id AS b FROM sized x JOIN sized y ON x.shingle = y.shingle AND x.id <> y.id AND 100 * x.n >= {percent} * y.n AND 100 * y.n >= {percent} * x.n
          GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a, min(doc_id) AS first FROM reach JOIN w ON w.id = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(doc_id, first), doc_id) AS component_id{more}
FROM w LEFT JOIN n USING (id) LEFT JOIN least ON least.a = w.id
"""


def _plus(cell: str, cost: str, letters: str, where: str = "") -> str:
    """A cell is its cost in 12 digits and its audit, so that the least string is the least cell; null where impossible."""
    sent = f"lpad((substr({cell}, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({cell}, 13) || '{letters}'"
    return f"CASE WHEN {where} THEN {sent} END" if where else sent


_INSERTED = ", ".join(
    (
        "s0 AS t0",
        "s1 AS t1",
        f"least(s2, {_plus('s0', '5', 'I')}, {_plus('s1', '5', 'I')}, {_plus('s3', '5', 'I')}) AS t2",
        f"least(s3, {_plus('s2', '5', 'I')}, {_plus('s0', '10', 'II')}, {_plus('s1', '10', 'II')}) AS t3",
    )
)
_EDITED = ", ".join(
    f"least({_plus(f't{k}', '2', 'D')}{edits}) AS s{k}"
    for k, edits in enumerate(
        (
            "",
            f", {_plus('t0', 'stay', 'K', 'may AND initial = $$s$$')}",
            "".join(f", {_plus(t, 'stay', 'K', 'may AND initial = $$u$$')}, {_plus(t, '1 + stay', 'R', 'may')}" for t in ("t0", "t1", "t3")),
            f", {_plus('t2', 'stay', 'K', 'may AND initial = $$a$$')}, {_plus('t2', '1 + stay', 'R', 'may')}",
        )
    )
)

# The walk goes row by row. A letter's place without insertions is its row's; its place among what stays gives its role.
CONVERSATIONS_SQL = rf"""
WITH RECURSIVE bits AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
              FROM (SELECT range AS i FROM range(256))),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hits AS (SELECT named.*, xor(list_reduce([4294967295::BIGINT] || [ord(x)::BIGINT FOR x IN string_split(name, '')],
                lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 20 AS hit FROM named, bits),
rows AS (SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
                CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
         FROM hits, unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(i)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
                  CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE '-' END AS initial,
                  right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final FROM rows),
faults AS (SELECT *, CASE WHEN final = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed),
steps AS (SELECT conv_id, i, initial, fault NOT IN ('blank', 'duplicate') AS may, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS stay FROM faults),
walk AS (SELECT conv_id, 0::BIGINT AS i, '000000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM (SELECT DISTINCT conv_id FROM conversations)
         UNION ALL
         SELECT conv_id, i, {_EDITED} FROM (SELECT w.conv_id, x.i, x.initial, x.may, x.stay, {_INSERTED} FROM walk w JOIN steps x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.i = w.i + 1)),
ends AS (SELECT conv_id, least(t0, t3) AS best FROM (SELECT conv_id, i, {_INSERTED} FROM walk) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
cheapest AS (SELECT conv_id, substr(best, 1, 12)::BIGINT AS cost, substr(best, 13) AS audit FROM ends),
letters AS (SELECT conv_id, p, substr(audit, p, 1) AS letter FROM cheapest, unnest(range(1, length(audit) + 1)) AS u(p)),
edits AS (SELECT conv_id, p, letter, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM letters),
stays AS (SELECT e.conv_id, p, letter, f.role, f.text, f.initial, row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS k
          FROM edits e LEFT JOIN faults f ON letter <> 'I' AND f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i WHERE letter <> 'D'),
given AS (SELECT *, (k - CASE WHEN first_value(initial) OVER (PARTITION BY conv_id ORDER BY k) = 's' AND first_value(letter) OVER (PARTITION BY conv_id ORDER BY k) = 'K' THEN 1 ELSE 0 END) % 2 AS odd FROM stays),
repaired AS (SELECT conv_id, string_agg(CASE letter WHEN 'K' THEN role ELSE CASE odd WHEN 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS whole
             FROM given GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM cheapest c LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard": near_duplicates_sql(ngram_join.SHINGLE, ngram_join.PERCENT),
        "op2_license_scan": LICENSES_SQL,
        "op5_quality_rules": RULES_SQL,
        "op8_warc": WARC_SQL,
        "op9_decontamination": DECONTAMINATE_SQL,
        "op11_conversation_repair": CONVERSATIONS_SQL,
        "op12_setsketch_dedup": near_duplicates_sql(setsketch.WIDTH, setsketch.PERCENT, ", coalesce(least(doc_id, first), doc_id) = doc_id AS kept"),
        "op13_source_divergence": DIVERGENCE_SQL,
    }
