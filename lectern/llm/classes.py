"""Distinct shingle sets as the nodes of a link graph, the buckets they meet in, and the names of components.

Rows with equal sets (same size and 128-bit digest) are one class from the start, so each text is judged by itself,
whether its doc_id is null or has other texts too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lectern.session import cut_lineage

DIGEST = ["h1", "h2", "n_shingles"]
# Buckets above this size are tried with their most central member first, others with the smallest id.
SMALL_BUCKET = 8


def classes(signed: DataFrame) -> DataFrame:
    """One row per set that isn't empty: its digest, least doc_id, one of its rows (doc_id, text_key) and its id.

    A class is called by its smallest doc_id; a class without one, or whose id has another set, gets a number above the ids.
    """
    known = signed.where("n_shingles > 0").groupBy(*DIGEST).agg(F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row"))
    owners = known.where("least IS NOT NULL").groupBy("least").agg(F.min(F.struct(*DIGEST)).alias("owner"))
    own = F.col("owner").eqNullSafe(F.struct(*DIGEST))
    spare = F.lit(2**62) + F.pmod(F.xxhash64(*DIGEST), F.lit(2**61))
    return known.join(owners, "least", "left").select(
        *DIGEST, "least", F.col("row.doc_id").alias("doc_id"), F.col("row.text_key").alias("text_key"), F.when(own, F.col("least")).otherwise(spare).alias("id"))


def shared_buckets(filed: DataFrame) -> DataFrame:
    """key, id, least (smallest id), size of the keys in ``filed`` (id, key) that several ids have.

    ``filed`` is shuffled once; its buckets are counted where their rows are.
    """
    filed = filed.repartition("key")
    buckets = filed.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("size")).where("least <> most").select("key", "least", "size")
    return filed.join(buckets, "key").select("key", "id", "least", "size").distinct()


def stars(entries: DataFrame) -> DataFrame:
    """a, b: each id with the head that it shares most keys with; the smaller head on a tie.

    The head of a large bucket is its most central member, the one whose buckets are largest in sum: of a
    group of copies that is the text copied or one close to it, so that most copies are linked with it at once.
    """
    large = entries.where(F.col("size") > SMALL_BUCKET)
    weights = large.groupBy("id").agg(F.sum("size").alias("weight"))
    centres = large.join(weights, "id").groupBy("key").agg(F.max(F.struct(F.col("weight"), (-F.col("id")).alias("id"))).alias("x")).select("key", (-F.col("x.id")).alias("centre"))
    headed = entries.join(centres, "key", "left").withColumn("head", F.coalesce("centre", "least"))
    votes = headed.where("id <> head").groupBy("id", "head").agg(F.count("*").alias("n"))
    return votes.groupBy("id").agg(F.max(F.struct(F.col("n"), (-F.col("head")).alias("head"))).alias("best")).select(F.col("id").alias("a"), (-F.col("best.head")).alias("b"))


def unsettled(entries: DataFrame, components: DataFrame) -> DataFrame:
    """key, id, component, size of the members of buckets with several components."""
    marked = entries.select("key", "id").join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))
    buckets = marked.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
    return marked.join(buckets.where("lo <> hi").select("key", "size"), "key").select("key", "id", "component", "size")


def labelled(signed: DataFrame, known: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, text_key, digest, component_id and kept of each row, from the components ``found`` (id, component) of classes.

    A component is named by its smallest doc_id; it has no name (null) if all are null. Of several sets of one name the
    class that bears it is kept. Rows without words are components of their own.
    """
    joined = known.select(*DIGEST, "least", "id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    # Unnamed sets come last, so a component is named if any of its documents is.
    names = joined.groupBy("component").agg(F.min(F.struct(F.col("least").isNull().alias("unnamed"), "least", "id")).alias("head"))
    named = joined.join(names, "component").select(*DIGEST, F.col("head.least").alias("component_id"), (F.col("id") == F.col("head.id")).alias("first"))
    linked = signed.select("doc_id", "text_key", *DIGEST).join(named, DIGEST, "left")
    words = F.col("n_shingles") > 0
    kept = F.when(words, F.col("first") & F.col("doc_id").eqNullSafe(F.col("component_id"))).otherwise(True)
    return linked.select(
        "doc_id", "text_key", "h1", "h2", F.col("n_shingles").cast("bigint").alias("n_shingles"),
        F.when(words, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), kept.alias("kept"))
