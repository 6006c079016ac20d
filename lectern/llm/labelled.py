"""Bounded samples of labelled documents, and the split into learning and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo five; a null id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_chars: int) -> DataFrame:
    """doc_id, text and label of at most ``per_class`` learning rows of either label, by a hash of the id.

    Texts over ``most_chars`` characters are not learned from, so the sample's size is bounded. An id
    with several labels has its largest; of several documents with one id the first text by order counts.
    """
    learn = labels.select("doc_id", F.col(f"`{label}`").cast("int").alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = (
        docs.select("doc_id", F.length("text").alias("n")).where("n IS NOT NULL").groupBy("doc_id").agg(F.max("n").alias("n")).where(F.col("n") <= most_chars)
        .join(learn.groupBy("doc_id").agg(F.max("label").alias("label")), "doc_id").select("doc_id", "label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("label = 1").orderBy(*order).limit(per_class).unionByName(known.where("label = 0").orderBy(*order).limit(per_class))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most 2 * per_class ids
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
