"""What the two learned scorers share: the fold, and the bounded labelled sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids whose labels are never read; a null id counts as held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample_labels(labels: DataFrame, label: str, bound: int = SAMPLE, id_col: str = "doc_id") -> DataFrame:
    """doc_id and label of at most `bound` labelled ids of the training fold, chosen by a hash of the id.

    An id with several labels counts with the greatest. The bound makes the frame small enough to broadcast.
    """
    rows = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    rows = rows.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def training_texts(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text and label of the sampled documents; copies of a text count once, with the greatest label."""
    ids = F.broadcast(sample.withColumnRenamed("doc_id", "sampled_id"))
    rows = docs.select(F.col(id_col).cast("long").alias("row_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.join(ids, F.col("row_id") == F.col("sampled_id"))
    return rows.groupBy("text").agg(F.max("label").alias("label"))
