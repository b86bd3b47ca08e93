"""The scan against TF-IDF cosines from their definition: document frequencies of all terms, real term counts."""

from __future__ import annotations

import math
from collections import Counter

import pytest

from siltstone.llm import licenses

MIT = "Released under the MIT License."
COMMON = "the code of the matter and the rest of it "
ROWS = [(k, f"d{k}/code.py", COMMON * 3 + f"word{k}") for k in range(30)]
# Words outside the templates that are in many documents, or that repeat, weigh little or much.
ROWS += [
    (100, "a/LICENSE", MIT + " " + "code matter rest it " * 3),
    (101, "a/one.py", "plain"),
    (102, "b/LICENSE", MIT + " " + " ".join(f"seldom{k}" for k in range(12))),
    (103, "c/LICENSE", MIT + " again" * 12),
    (104, "d/x.py", MIT + " code matter rest\n" + "seldom " * 40),
    (105, "e/x.py", None),
]


def brute(rows):
    n = len(rows)
    df = Counter(t for _, _, text in rows for t in set(licenses.terms_of(text or "")))

    def vector(text):
        return {t: k * licenses.idf_of(n, df[t]) for t, k in Counter(licenses.terms_of(text)).items()}

    def length(v):
        return math.sqrt(sum(w * w for w in v.values()))

    sides = [(licence, vector(text)) for licence, text in licenses.TEMPLATES]

    def best(text):
        own = vector(text)
        found = [(sum(w * side.get(t, 0.0) for t, w in own.items()) / length(own) / length(side), licence) for licence, side in sides] if own else []
        return min(((-round(c, 6), licence) for c, licence in found), default=(0.0, None))

    out = {}
    for doc_id, _, text in rows:
        cosine, licence = best(text or "")
        if -cosine >= licenses.FILE_LEAST:
            out[doc_id] = (licence, "file", -cosine)
            continue
        cosine, _, licence = min((*best(x)[:1], k, best(x)[1]) for k, x in enumerate((text or "").split("\n")))
        if -cosine >= licenses.LINE_LEAST:
            out[doc_id] = (licence, "header", -cosine)
    return out


def test_cosines_by_their_definition(spark):
    made = spark.createDataFrame(ROWS, "doc_id long, path string, text string").repartition(3)
    found = {r.doc_id: r for r in licenses.scan(made).collect()}
    got = {k: (r.licence, r.origin, r.cosine) for k, r in found.items() if r.origin in ("file", "header")}
    want = brute(ROWS)
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert [got[k][2] for k in sorted(got)] == pytest.approx([want[k][2] for k in sorted(want)], abs=2e-6)
    # Words that every document has do not hide a licence file, so its directory has a licence to inherit.
    assert found[100].origin == "file" and found[101].origin == "inherited" and found[101].licence == "MIT"
    assert found[103].origin != "file"  # one word twelve times is not twelve words once
