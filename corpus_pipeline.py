"""A training corpus from `documents`: five stages, each the whole work of one operator of `siltstone.llm`.

A stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs. All but the last
return the columns of documents.

1. toxicity: documents that score 0.5 or more go.
2. n-gram Jaccard join: of each component of near duplicates (five-word shingles, a similarity of 0.8 or more) the document with the
   least id stays.
3. suffix dedup: bytes of strings of 200 that stand more than once leave the texts.
4. decontamination: documents with a window of 10 words of a benchmark item go.
5. packing: what is left becomes pieces of sequences of 1024 tokens.

Edge cases: null and empty texts score as texts without words, are nobody's near duplicate, lose no bytes and hold no window, so they
stay until packing, where each is the one end token; rows without id or with a shared one are told apart by a row number in stage 2,
where of equal texts one stays; very long texts are worked on whole; an empty table gives an empty result; further columns are
handed through to packing, whatever their names (but those that begin with siltstone_).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import decontaminate, ngram_join, packing, suffix_dedup, toxicity
from siltstone.llm.common import shared_folder, table, written
from siltstone.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_rows(docs, toxicity.train_model(docs, table(spark, sf_dir, "labels")))


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share an id, or have none, are told apart by a number of their own."""
    columns, name = docs.columns, "doc_id"
    odd = docs.groupBy("doc_id").count().filter(F.col("doc_id").isNull() | (F.col("count") > 1)).limit(1).count()
    if odd:
        name = free_name(docs, "row_number")
        docs = written(docs.withColumn(name, F.monotonically_increasing_id()))
    found = ngram_join.near_duplicates(docs, width=5, percent=80, id_col=name)
    gone_id = free_name(docs, "gone_id")
    gone = written(found.filter("doc_id <> component_id").select(F.col("doc_id").alias(gone_id)))
    return docs.join(gone, F.col(name) == F.col(gone_id), "left_anti").select(*columns)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cleaned(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    seen, spans = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit_key = free_name(docs, "hit_key")
    hit = spans.select(F.col("key").alias(hit_key)).distinct()
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return docs.join(hit, key == F.col(hit_key), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_strings),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Neither the learned scores, nor byte strings of every document, nor token ids can be had from SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents."""
    folder, docs = shared_folder(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return docs
