from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.llm import licenses

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."
ROWS = [
    (1, "a/LICENSE", MIT),
    (2, "a/one.py", "plain words with no notice whatever"),
    (3, "a/b/two.py", None),
    (4, "a/b/c/three.py", ""),
    (5, "a/b/c/four.py", f"# {GPL}\nthe code of the matter " + "word " * 2000),
    (6, "a/x/COPYING", GPL),
    (7, "a/x/y/five.py", "more words"),
    (8, "z/six.py", "the words of this and that, version one"),
    (9, None, "no path at all"),
    (10, None, f"{MIT}\n" + "long " * 200),
    (11, "top.txt", "stands at the top"),
    (None, "a/one.py", "no id"),
    (2, "a/one.py", "plain words with no notice whatever"),
    (12, "a/x/LICENSE", MIT + " and then some other words follow here"),
    (13, "z/long.py", "filler " * 30_000 + "\n" + MIT),
    (14, "q/r/s.py", "under the license of nobody"),
]


@pytest.fixture
def files(spark):
    made = spark.createDataFrame(ROWS, "doc_id long, path string, text string")
    return made.withColumns({c: F.lit("clash") for c in ("dir", "key", "licence", "cosine", "words", "term", "line")}).repartition(3)


def brute(rows):
    """Cosines of every line and whole text, without any filter; nearest directory by walking up."""
    df = Counter(t for _, _, text in rows for t in set(licenses.terms_of(text or "")))

    def vector(text):
        return {t: n * licenses.idf_of(len(rows), df[t]) for t, n in Counter(licenses.terms_of(text)).items()}

    def length(v):
        return math.sqrt(sum(w * w for w in v.values()))

    sides = [(licence, vector(template)) for licence, template in licenses.TEMPLATES]

    def best(text):
        unit = vector(text)
        found = []
        for licence, side in sides:
            dot = sum(w * side.get(t, 0.0) for t, w in unit.items())
            if dot:
                found.append((-round(dot / length(unit) / length(side), 6), licence))
        return min(found, default=(0.0, None))

    own, speakers = {}, {}
    for k, (_, path, text) in enumerate(rows):
        cosine, licence = best(text or "")
        if -cosine >= licenses.FILE_LEAST:
            own[k] = (licence, "file", -cosine)
            if path is not None:
                at = path.rpartition("/")[0]
                speakers[at] = min(speakers.get(at, (0.0, "")), (cosine, licence))
            continue
        cosine, line, licence = min((*best(x)[:1], n, best(x)[1]) for n, x in enumerate((text or "").split("\n")))
        if -cosine >= licenses.LINE_LEAST:
            own[k] = (licence, "header", -cosine)
    out = []
    for k, (doc_id, path, _) in enumerate(rows):
        result = (*own[k], None) if k in own else (None, "none", None, None)
        if k not in own and path is not None:
            at, up = path.rpartition("/")[0], 0
            while True:
                if at in speakers:
                    result = (speakers[at][1], "inherited", -speakers[at][0], up)
                    break
                if not at:
                    break
                at, up = at.rpartition("/")[0], up + 1
        out.append((doc_id, path, *result))
    return sorted(out, key=repr)


def test_equals_unfiltered_cosines(files):
    got = sorted((tuple(r[c] for c in ("doc_id", "path", "licence", "origin", "cosine", "distance")) for r in licenses.scan(files).collect()), key=repr)
    want = brute(ROWS)
    assert [g[:4] + g[5:] for g in got] == [w[:4] + w[5:] for w in want]
    assert [g[4] or 0 for g in got] == pytest.approx([w[4] or 0 for w in want], abs=2e-6)
    found = {g[0]: g for g in got if g[0] is not None}
    assert found[4][2:4] == ("MIT", "inherited") and found[4][5] == 2
    assert found[7][2:4] == ("GPL-3.0", "inherited") and found[7][5] == 1
    assert found[5][2:4] == ("GPL-3.0", "header")
    assert found[13][2:4] == ("MIT", "header")
    assert found[8][3] == "none" and found[9][3] == "none"


def test_empty_table(files):
    assert licenses.scan(files.limit(0)).count() == 0


def test_light_terms_cannot_reach_the_threshold():
    idf = {t: 1.0 for _, text in licenses.TEMPLATES for t in licenses.terms_of(text)} | {"license": 9.0, "licensed": 8.0}
    heavy = set(licenses.heavy_terms(idf, licenses.TEMPLATES, 0.6))
    for _, text in licenses.TEMPLATES:
        own = Counter(licenses.terms_of(text))
        light = {t: n * idf[t] for t, n in own.items() if t not in heavy}
        whole = math.sqrt(sum((n * idf[t]) ** 2 for t, n in own.items()))
        assert math.sqrt(sum(w * w for w in light.values())) < 0.6 * whole
