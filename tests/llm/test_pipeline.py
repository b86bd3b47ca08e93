from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm.common import shared_folder, written
from siltstone.llm.queries import oracle_sql, queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, docs, labels, items):
    folder = shared_folder(spark)
    spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in docs], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def corpus(seed=11):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioulmnrstdv") for _ in range(rng.randrange(3, 8))) for _ in range(4000)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    docs = [(k, text(60)) for k in range(400)]
    labels = []
    for k in range(0, 300):
        toxic = k % 10 == 3
        if toxic:
            docs[k] = (k, f"{docs[k][1]} grumbolt {text(5)} snivvern")
        labels.append((k, 1, int(toxic)))
    item, passage = text(30), text(70)
    docs += [(1000, docs[1][1]), (1001, docs[2][1] + " more"), (1002, f"{text(20)} {item} {text(20)}")]
    docs += [(1100 + k, f"{text(30)} {passage} {text(30)}") for k in range(4)]
    docs += [(2000, None), (2001, "")]
    return docs, labels, [(1, item)], passage


@pytest.fixture(scope="module")
def stages(spark):
    docs, labels, items, passage = corpus()
    folder = tables(spark, docs, labels, items)
    out, now = [], spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, folder))
        out.append(now)
    return docs, passage, out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_each_stage_acts_on_the_one_before(stages):
    docs, passage, out = stages
    every = {i for i, _ in docs}
    toxic = {k for k in range(300) if k % 10 == 3}
    assert ids(out[0]) == every - toxic
    assert ids(out[1]) == ids(out[0]) - {1000, 1001}
    texts = {r.doc_id: r for r in out[2].collect()}
    assert set(texts) == ids(out[1])
    original = dict(docs)
    for k in range(1100, 1104):
        assert passage not in texts[k].text and len(texts[k].text) >= len(original[k]) - len(passage) - 4
    assert all(texts[k].text == original[k] for k in range(400) if k in texts)
    assert all(r.n_chars == len(r.text) for r in texts.values())
    assert ids(out[3]) == ids(out[2]) - {1002}
    assert ids(out[4]) == ids(out[3])
    assert all(df.columns == ["doc_id", "text", "lang", "source", "n_chars"] for df in out[:4])


def test_run_gives_the_last_stage(spark, stages):
    docs, labels, items, _ = corpus()
    found = corpus_pipeline.run(spark, tables(spark, docs, labels, items))
    assert found.count() == stages[2][4].count()


def test_empty_and_odd_tables(spark):
    none = tables(spark, [], [], [])
    now = spark.read.parquet(f"{none}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, none))
        assert now.count() == 0
    odd = tables(spark, [(None, "a b c d e f"), (None, "a b c d e f"), (7, "x y z w v u"), (7, "x y z w v u"), (7, None), (None, None)], [(None, None, None)], [(None, None)])
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{odd}/documents.parquet"), odd)
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, "a b c d e f"), (7, ""), (7, "x y z w v u")]


def test_near_duplicates_by_five_words(spark):
    """One changed word of 50: 41 of 51 shingles of five words are shared (0.804), 43 of 51 of four (0.843)."""
    words = [f"w{k}" for k in range(50)]
    near, far = [*words], [*words]
    near[25] = "other"
    far[20], far[30] = "one", "two"
    docs = spark.createDataFrame([(3, " ".join(words)), (5, " ".join(near)), (9, " ".join(far))], "doc_id long, text string")
    assert ids(corpus_pipeline.drop_near_duplicates(spark, docs, "")) == {3, 9}


def test_clashing_names(spark):
    docs, labels, items, passage = corpus()
    folder = tables(spark, docs, labels, items)
    clashing = ("gone_id", "hit_key", "row_number", "count", "component_id", "key", "score", "kept", "spans", "n_words")
    plain = now = spark.read.parquet(f"{folder}/documents.parquet").unionByName(spark.createDataFrame([(1000, "a b c d e f", "en", "s", 1)], COLUMNS))
    now = now.select("*", *(F.lit(f"own {c}").alias(c) for c in clashing))
    for _, stage in corpus_pipeline.STAGES[:4]:
        plain, now = written(stage(spark, plain, folder)), written(stage(spark, now, folder))
        assert now.columns == [*plain.columns, *clashing]
        assert now.count() == now.filter(" AND ".join(f"`{c}` = 'own {c}'" for c in clashing)).count()
        assert sorted(map(repr, now.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_all_operators_are_registered():
    names = list(queries())
    assert sorted(int(n.split("_")[0][2:]) for n in names) == list(range(1, 14))
    assert set(oracle_sql()) <= set(names)
