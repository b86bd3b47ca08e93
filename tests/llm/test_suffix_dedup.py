from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from siltstone.llm import suffix_dedup


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k : k + 200] for _, b in texts for k in range(len(b) - 199))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if counts[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def test_equals_all_windows(docs, rows):
    assert result(suffix_dedup.remove_repeats(docs)) == brute(rows)


def test_segments_do_not_change_the_result(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1 << 9)
    assert result(suffix_dedup.remove_repeats(docs)) == brute(rows)


def test_part_of_a_longer_repeat(frame):
    """A text that shares only the middle of what two others share."""
    rng = np.random.default_rng(3)
    long = "".join(chr(97 + x) for x in rng.integers(0, 26, 900))
    made = [(1, "p" * 50 + long + "q" * 30), (2, "r" * 70 + long), (3, "s" * 20 + long[333:612] + "t" * 90), (4, long[100:310]), (5, long[100:299])]
    assert result(suffix_dedup.remove_repeats(frame(made))) == brute(made)


def test_cleaned_keeps_columns_and_valid_text(docs, rows):
    out = suffix_dedup.cleaned(docs)
    assert out.columns == docs.columns
    kept = {r.doc_id: r.text for r in out.filter("doc_id IS NOT NULL").collect()}
    assert kept[400] == dict(rows)[400]
    assert kept[303] == ""  # all of it stands in 304 too
    assert out.count() == len(rows)


def test_empty_table(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.cleaned(no_docs).count() == 0


@pytest.mark.parametrize("width", [1, 3, 8])
def test_sliding_least(width):
    x = np.random.default_rng(1).integers(0, 1000, 50).astype(np.uint64)
    assert suffix_dedup.sliding_least(x, width).tolist() == [min(x[k : k + width]) for k in range(50 - width + 1)]
