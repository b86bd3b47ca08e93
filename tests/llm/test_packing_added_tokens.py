"""Added tokens in texts: the ids of the tokenizers library as it is loaded, without any switch."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from siltstone.llm import packing
from siltstone.llm.queries import tokenizer_path

END = "<|endoftext|>"


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_ids_equal_the_library_as_loaded(reference):
    rng, parts = random.Random(2), ["a", " ", "  ", "b1", "\n", "é", "中", "'ll", ".", "<|", "|>", END, END]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(3000)] + [f"a {END} b", END, END + END]
    own = packing.TokenIds(tokenizer_path(), added_tokens=True)
    for text, found in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.ids(text), "<u2").tolist() == found.ids


def test_packed_documents_hold_added_tokens(spark, reference):
    rows = [(1, f"a {END} b"), (2, END), (3, "plain")]
    pieces = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect()
    for doc_id, text in rows:
        want = np.array([*reference.encode(text, add_special_tokens=False).ids, packing.SEPARATOR])
        (piece,) = (p for p in pieces if p.doc_id == doc_id)
        assert np.frombuffer(piece.ids, "<u2").tolist() == want.tolist()
        assert (piece.doc_tokens, piece.ids_crc32) == (len(want), zlib.crc32(want.astype("<u4").tobytes()))
    assert 50256 in np.frombuffer(next(p for p in pieces if p.doc_id == 2).ids, "<u2")
