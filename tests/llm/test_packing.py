from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import packing
from siltstone.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path())
    found.encode_special_tokens = True
    return found


def test_ids_equal_the_tokenizers_library(reference, rows):
    rng, letters = random.Random(1), "ab A1 .'!\n\t é 中​  <|endoftext|>sd\x1c\x85🙂"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["", "  ", "a<|endoftext|>b", "a" * 3000, " x", "x ", "we'll it's"] + [t for _, t in rows if t]
    own = packing.TokenIds(tokenizer_path())
    for text, found in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.ids(text), "<u2").tolist() == found.ids


def test_pieces_tile_documents_and_sequences(docs, rows, reference):
    pieces = packing.pack_documents(docs, tokenizer_path()).collect()
    want = sorted([(i, [*reference.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows], key=repr)
    # Documents in stream order: by sequence and offset.
    pieces.sort(key=lambda p: (p.sequence_id, p.offset))
    got, at = [], 0
    for p in pieces:
        assert (p.sequence_id, p.offset) == divmod(at, 1024)
        assert 1 <= p.length <= 1024 - p.offset
        ids = np.frombuffer(p.ids, "<u2")
        assert len(ids) == p.length
        assert zlib.crc32(ids.astype("<u4").tobytes()) == p.ids_crc32
        if p.start == 0:
            got.append((p.doc_id, [], p.doc_tokens))
        assert len(got[-1][1]) == p.start
        got[-1][1].extend(ids.tolist())
        at += p.length
    assert all(len(ids) == n for _, ids, n in got)
    assert sorted([(i, ids) for i, ids, _ in got], key=repr) == want


def test_sequences_pad_only_the_last(docs):
    found = packing.sequences(packing.pack_documents(docs, tokenizer_path())).orderBy("sequence_id").collect()
    assert all(r.length == 1024 and r.padding == 0 for r in found[:-1])
    last = found[-1]
    assert last.padding == (0 if last.length & (last.length - 1) == 0 else 1024 - last.length)


def test_empty_table(no_docs):
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0


def test_null_text_is_the_separator(spark):
    made = spark.createDataFrame([(1, None)], "doc_id long, text string").withColumn("ids", F.lit(1))
    row = packing.pack_documents(made, tokenizer_path()).first()
    assert (row.start, row.length, row.doc_tokens, row.ids_crc32) == (0, 1, 1, zlib.crc32(bytes(4)))
