"""N-gram Jaccard join by R-trees of count vectors.

Links are pairs of documents with 100 intersection >= percent union of their sets of five-word shingles. A set's point
counts its shingles by ``GROUPS`` groups of their hashes. Two sets share at most the sum over the groups of the smaller of
their counts, and a set and a node of the tree at most the sum of the smaller of its count and the largest below
the node, so a pair of nodes whose sum is less than a link needs is not followed (``buckets``). Pairs of points that
survive are verified on whole sets; groups of large sets are alike whatever is in them, so in the search of trees a bit for each of many
more groups (``links.possible``) is compared first.

One tree of all points would prune nothing high up: texts that have nothing in common also have about the same counts in a group, and
the box of a few hundred of them holds everything. So there is a tree for each rare shingle. Shingles are
ordered, the frequent ones last, and a set of n is a point in the trees of its first n - ceil(percent n / 100) + 1; two sets
whose first so many differ can't be linked, in whatever order, so no link is lost. Which shingles are frequent is counted over
all documents, portion by portion; it decides how large trees get, not what is found.

Sets that are equal are one class. Each class is held against the centre of its trees first, point by point and then set by set, and
trees whose points are of one component by then are settled. The other trees are searched for pairs of different components.

Defined results: null and empty texts have the empty set and are linked with nothing; a text of fewer than five words has
one shingle of all; rows that repeat a document have the same component, and each text of an id that has several is
judged by itself; a component without any doc_id has no name (null); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lectern.llm.buckets import Kernel, near_pairs, pairs_across
from lectern.llm.classes import classes, labelled, shared_buckets, stars, unsettled
from lectern.llm.links import components, text_key, verified, with_rows
from lectern.llm.shingles import as_long, portions, shingles
from lectern.session import cut_lineage

PERCENT = 80
GROUPS = 256
# Frequent shingles known to all tasks, at most; those of the largest counts. Fewer only make trees larger.
MOST_FREQUENT = 500_000
LEAST_FREQUENT = 64
_PORTION = 8_000_000
_SEEN = 3
_COUNT_MAX = np.iinfo(np.uint8).max
# Trees of so many points at most are paired by size before their points are sent along.
FEW = 64


def first_ones(count: int, percent: int) -> int:
    """Of ``count`` shingles in order, how many of the first ones any linked set has one of."""
    return count - -(-percent * count // 100) + 1 if count else 0


def _seen_often(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shingles that several texts of a portion have, with how many."""
    held, size = [], 0

    def counted() -> pd.DataFrame:
        values, times = np.unique(np.concatenate(held), return_counts=True)
        often = times >= _SEEN
        return pd.DataFrame({"shingle": as_long(values[often]), "n": times[often]})

    for batch in batches:
        for text in batch["text"]:
            held.append(shingles(text))
            size += len(text or "")
            if size > _PORTION:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def frequent(docs: DataFrame, most: int = MOST_FREQUENT, least: int = LEAST_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles, sorted, and their places by count; at most ``most``."""
    found = docs.select("text").mapInPandas(_seen_often, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = found.orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    values, counts = (rows.column(c).to_numpy().astype(np.int64) for c in ("shingle", "n"))
    order = np.argsort(values.view(np.uint64))
    return values[order].view(np.uint64), counts[order]


def ordered(found: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sorted shingles with the frequent ones last, the most frequent at the end."""
    values, counts = often
    if not len(values) or not len(found):
        return found
    at = np.minimum(np.searchsorted(values, found), len(values) - 1)
    return found[np.argsort(np.where(values[at] == found, counts[at], 0), kind="stable")]


def _signed(often: tuple[np.ndarray, np.ndarray], percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for piece in portions([len(t or "") for t in texts]):
                rows = []
                for text in texts[piece]:
                    found = shingles(text)
                    digest = as_long(np.array([found.sum(dtype=np.uint64), (found * found).sum(dtype=np.uint64)], dtype=np.uint64)).tolist()
                    rows.append((len(found), *digest, as_long(ordered(found, often)[: first_ones(len(found), percent)]), point(found)))
                names = ("n_shingles", "h1", "h2", "keys", "point")
                yield pd.DataFrame({"doc_id": batch["doc_id"].values[piece], "text_key": batch["text_key"].values[piece], **{name: [r[i] for r in rows] for i, name in enumerate(names)}})

    return run


def point(found: np.ndarray) -> bytes:
    """How many shingles are in each group, up to what 8 bits hold, then the number beyond that."""
    counts = np.bincount((found % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
    held = np.minimum(counts, _COUNT_MAX)
    return held.astype(np.uint8).tobytes() + np.int64((counts - held).sum()).tobytes()


class CountVectors(Kernel):
    """Points and the trees they are in."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent

    def load(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Counts held, numbers beyond them, and trees of each member."""
        if not data:
            return np.empty((0, GROUPS), dtype=np.uint8), np.empty(0, dtype=np.int64), []
        counts = np.stack([np.frombuffer(d, dtype=np.uint8, count=GROUPS) for d in data])
        rest = [np.frombuffer(d[GROUPS:], dtype=np.int64) for d in data]
        return counts, np.array([r[0] for r in rest]), [r[1:] for r in rest]

    def most_shared(self, x: tuple, i: np.ndarray, y: tuple, j: np.ndarray) -> np.ndarray:
        """The sum of the smaller counts: the most that the sets of members ``i`` of x and ``j`` of y share."""
        return np.minimum(x[0][i], y[0][j]).sum(axis=1, dtype=np.int64) + np.minimum(x[1][i], y[1][j])

    def near(self, key: np.ndarray | None, n: np.ndarray, x: tuple, i: np.ndarray, y: tuple, j: np.ndarray) -> np.ndarray:
        close = (100 + self.percent) * self.most_shared(x, i, y, j) >= self.percent * n
        for at in np.flatnonzero(close).tolist() if key is not None else ():
            # The first tree that both are in takes the pair.
            one, two = x[2][i[at]], y[2][j[at]]
            place = np.searchsorted(two, one)
            place[place == len(two)] = 0
            close[at] = one[two[place] == one][0] == key[at]
        return close

    def top(self, loaded: tuple) -> np.ndarray:
        return np.concatenate([loaded[0].max(axis=0).astype(np.int64), [loaded[1].max()]]).astype(np.int32)


def _payload(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A member's data: its point, then the trees of more than a few that it is in."""
    for batch in batches:
        data = [point + np.sort(np.asarray([] if trees is None else trees, dtype=np.int64)).tobytes() for point, trees in zip(batch["data"], batch["trees"])]
        yield pd.DataFrame({"id": batch["id"], "n": batch["n"], "data": data})


def linked(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``docs`` (doc_id, text)."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    texts = docs.select("doc_id", text_key().alias("text_key"), "text")
    signed = cut_lineage(texts.mapInPandas(_signed(frequent(docs), percent), "doc_id long, text_key long, n_shingles int, h1 long, h2 long, keys array<long>, point binary"))
    known = cut_lineage(classes(signed))
    rows_of = known.select("doc_id", "text_key", "id")
    filed = with_rows(signed.select("doc_id", "text_key", "keys"), rows_of).select("id", F.explode("keys").alias("key"))
    entries = cut_lineage(shared_buckets(filed))
    met = rows_of.join(entries.select("id").distinct(), "id", "left_semi").select("doc_id", "text_key", "id")
    points = with_rows(signed.select("doc_id", "text_key", F.col("n_shingles").alias("n"), F.col("point").alias("data")), met)
    points = cut_lineage(points.select("id", "n", "data").dropDuplicates(["id"]))
    kernel = CountVectors(percent)
    links = cut_lineage(verified(cut_lineage(near_pairs(stars(entries), points, kernel)), texts, rows_of, percent))
    rows = cut_lineage(unsettled(entries, components(links)))
    trees = rows.where(F.col("size") > FEW).groupBy("id").agg(F.collect_list("key").alias("trees"))  # no more than the set's first shingles
    left = points.join(rows.select("id").distinct(), "id", "left_semi").join(trees, "id", "left")
    payload = cut_lineage(left.mapInPandas(_payload, "id long, n int, data binary"))
    pairs = cut_lineage(pairs_across(rows, payload, kernel, FEW).distinct())
    found = components(links.unionByName(verified(pairs, texts, rows_of, percent, bits=True)))
    return labelled(signed, known, found).select("doc_id", "n_shingles", "component_id")
