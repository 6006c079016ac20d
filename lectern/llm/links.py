"""Connected components of a table of links, and checks of links on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.shingles import as_long, portions, shingles
from lectern.session import cut_lineage

# Up to so many ids (16 bytes each) are sent to all tasks; beyond that the tables are shuffled.
BROADCAST_IDS = 1_000_000
# Places for the bits of a set, for each of its shingles.
PLACES = 8


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of all ids in ``links`` (a, b).

    Each round hangs the neighbours of a node on the smallest of them, first the larger ones and then the
    smaller ones, until every link leads to the smallest id; that takes about log(n) rounds. The smallest
    neighbour is found by an aggregate that is combined before its shuffle, so nodes with many links are
    no bottleneck, and a node's links are never gathered.
    """
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e")).select("e.*")
        edges = cut_lineage(small.where("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    star = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return star.unionByName(star.select(F.col("component").alias("id"), "component").distinct())


def _small(ids: DataFrame) -> DataFrame:
    """``ids``, marked for broadcast if there are few; their number is checked first."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return F.broadcast(ids) if few else ids


def text_key() -> Column:
    """With doc_id, what tells rows apart that have no id or share one; null counts as empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def with_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with text_key) that are in ``rows`` (doc_id, text_key, id; distinct; null counts as a value), with their id."""
    small = _small(rows.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "id"))
    return docs.join(small, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).drop("_id", "_key")


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id and text are not in ``rows`` (doc_id, text_key; distinct; null counts as a value)."""
    small = _small(rows.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")))
    return docs.join(small, F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key")), "left_anti")


def place_bits(values: np.ndarray) -> bytes:
    """A bit for each place that shingles of a set fall on; the number of places is a power of two, ``PLACES`` to a shingle or more."""
    places = 1 << max(3, (PLACES * len(values) - 1).bit_length())
    bits = np.zeros(places, dtype=np.uint8)
    bits[(values & np.uint64(places - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def most_shared(n_a: int, a: bytes, n_b: int, b: bytes) -> int:
    """The most shingles that two sets share by their sizes and ``place_bits``: one for each place of both, and those that either has beside another on one place."""
    one, two = (np.frombuffer(x, dtype=np.uint8) for x in (a, b))
    size = min(len(one), len(two))
    # Places are low bits, so those of a smaller number of places are all that agree in its bits.
    one, two = (np.bitwise_or.reduce(x.reshape(-1, size), axis=0) for x in (one, two))
    places = [int(np.bitwise_count(x).sum(dtype=np.int64)) for x in (one & two, one, two)]
    return places[0] + min(n_a - places[1], n_b - places[2])


def shingle_sets(docs: DataFrame, bits: bool = False) -> DataFrame:
    """id, shingles (distinct, as longs) of (doc_id, text); one row per id. With ``bits`` also n and the ``place_bits``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for piece in portions([len(t or "") for t in texts]):
                sets = [shingles(t) for t in texts[piece]]
                more = {"n": [len(s) for s in sets], "bits": [place_bits(s) for s in sets]} if bits else {}
                yield pd.DataFrame({"id": batch["doc_id"].values[piece], "shingles": [as_long(s) for s in sets], **more})

    return docs.select("doc_id", "text").dropDuplicates(["doc_id"]).mapInPandas(run, "id long, shingles array<long>" + ", n int, bits binary" * bits)


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that ``most_shared`` leaves possible, by n and bits of ``sets``; no link is lost."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch[["n_a", "bits_a", "n_b", "bits_b"]].itertuples(index=False)
            kept = [(100 + percent) * most_shared(*r) >= percent * (r.n_a + r.n_b) for r in rows]
            yield batch.loc[np.array(kept, dtype=bool), ["a", "b"]]

    sides = [sets.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInPandas(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose sets have 100 * intersection >= percent * union."""
    left, right = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb")).alias("shared")
    met = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), shared)
    return met.where(f"100 * shared >= {percent} * (na + nb - shared)").select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, rows: DataFrame, percent: int, bits: bool = False) -> DataFrame:
    """``confirmed``, with the sets of only those ids that are in ``pairs`` (a, b).

    ``texts`` has doc_id, text_key and text, ``rows`` the doc_id and text_key of each id. Rows that repeat a document are left out
    before their sets are made. With ``bits``, for pairs of which few are links, whole sets are sent only for ``possible`` ones.
    """
    ids = _ends(pairs)
    found = with_rows(texts, rows.join(ids, "id", "left_semi").select("doc_id", "text_key", "id"))
    sets = cut_lineage(shingle_sets(found.select(F.col("id").alias("doc_id"), "text"), bits))
    if bits:
        pairs = cut_lineage(possible(pairs, sets, percent))
        sets = sets.select("id", "shingles").join(_small(_ends(pairs)), "id", "left_semi")
    return confirmed(pairs, sets, percent)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def bit_planes(symbols: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` low bits of each row's symbols, bit by bit, 64 symbols to a long: words x bits longs a row."""
    rows, count = symbols.shape
    planes = np.stack([(symbols >> b) & 1 for b in range(bits)], axis=1).astype(np.uint8)
    packed = np.packbits(planes.reshape(rows, bits, count // 64, 64), axis=3, bitorder="little")
    return packed.view(np.uint64)[..., 0].transpose(0, 2, 1).reshape(rows, -1).view(np.int64)
