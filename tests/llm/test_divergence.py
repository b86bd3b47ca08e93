from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from siltstone.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=200):
    """Every pair and term by the definition, in plain integers."""
    rows = [(lang or "", source or "", (text or "").translate(LOWER)) for _, text, lang, source in rows]
    docs, of_lang, of_group = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)
        docs[lang].update(set(terms))
        of_lang[lang].update(terms)
        of_group[lang, source].update(terms)
    out = []
    for lang, source in sorted(of_group):
        kept = [t for t, n in docs[lang].items() if n >= 3]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p, q = shares(of_group[lang, source]), shares(of_lang[lang])
        found = []
        for other in sorted(x for y, x in of_group if y == lang and x != source):
            r = shares(of_group[lang, other])
            found.append(("pair", other, sum((p[t] - r[t]) ** 2 // r[t] for t in kept)))
        terms = [("term", t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if of_group[lang, source][t] and p[t] > q[t]]
        for part, most in ((found, None), (terms, top)):
            ordered = sorted(part, key=lambda x: (-x[2], x[1].encode()))
            out += [(lang, source, *x, k) for k, x in enumerate(ordered[:most], 1)]
    return sorted(out)


def corpus():
    rng = random.Random(3)
    words = ["Ab", "aB", "zoo", "été", "naïve", "x", "ÀB", "日本", "don't", "a1b", "under_score", "Q", "r", "s"]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "fr", None, ""]), rng.choice(["s0", "s0", "s1", "ß", None, "S1", "s10"])) for k in range(120)]
    rows += [(None, None, "en", "silent"), (5, "", "xx", "only"), (6, "rare words here", "yy", "a"), (6, "rare words here", "yy", "b"), (7, "1 2 3 \n\t", "yy", "c")]
    rows += [(8, "same same", "tie", s) for s in ("a", "b", "c")] * 2
    rows.append((9, " ".join(rng.choices(words, k=60_000)), "en", "long"))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


@pytest.mark.parametrize(("sources", "terms"), [(32, 40_000), (2, 3), (1, 1)])
def test_equals_the_definition(frame, sources, terms):
    """Also with so small blocks that every axis of the cube is cut."""
    rows = corpus()
    assert result(divergence.audit(frame(rows, SCHEMA), sources_a_block=sources, terms_a_block=terms)) == brute(rows)


def test_terms_end_at_the_top(frame):
    rows = [(k, " ".join(f"{a}{b}" * (1 + (k + ord(b)) % 3) for a in "abc" for b in "defgh"), "en", f"s{k % 2}") for k in range(8)]
    assert result(divergence.audit(frame(rows, SCHEMA), top=4)) == brute(rows, top=4)


def test_counts_beyond_64_bits_once_scaled(spark):
    df = spark.createDataFrame([(2**60, 2**61, 5), (0, 0, 0)], "n long, total long, terms long")
    found = df.select(divergence.share(df.n, df.total, df.terms)).collect()
    assert [r[0] for r in found] == [1 + 10**9 * (2**60 + 1) // (2**61 + 5), 1]


def test_empty_table(frame):
    assert divergence.audit(frame([], SCHEMA)).count() == 0
