"""Random forests for every group at once, grown level by level from histograms.

A group's samples never come together. Features become codes by the group's own quantiles; a group is dealt to chunks of a
bounded number of rows. For each level every chunk adds up, for all trees and open nodes, the labels by code of the
features the node may split on; the sums of a tree's chunks meet and give its splits. Bootstrap numbers and the features
of a node follow from hashes, so any executor that repeats a chunk gets the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lectern.operators.models import SEED
from lectern.session import cut_lineage

TREES, DEPTH, BINS = 100, 5, 32
CHUNK = 20_000
# Histograms of so many chunks are summed before those sums are, and so many trees go in one row.
_TOGETHER = 64
_BLOCK = 10
# P(at most k draws), k = 0, 1, ..., of a sample with replacement from many rows: Poisson with mean one.
_AT_MOST = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(12)])
_SPLIT = "tree int, level int, feature array<int>, cut array<int>, left_n array<double>, left_yes array<double>, right_n array<double>, right_yes array<double>"


def draws(names: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree's sample holds the rows of these 64-bit names."""
    z = names.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (tree + 1) + seed) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z = z ^ (z >> np.uint64(31))
    return np.searchsorted(_AT_MOST, (z >> np.uint64(11)).astype(float) / 2**53, side="right")


def allowed(group: str, tree: int, level: int, width: int, features: int, most: int, seed: int) -> np.ndarray:
    """The features (sorted) that each of the ``width`` nodes of a level may split on."""
    out = np.empty((width, most), dtype=np.int64)
    for node in range(width):
        digest = hashlib.md5(f"{seed}|{group}|{tree}|{level}|{node}".encode()).digest()
        out[node] = np.sort(np.random.default_rng(int.from_bytes(digest[:8], "big")).permutation(features)[:most])
    return out


def codes(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The number of edges of its feature that each entry (rows x features) is above."""
    return np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(x.shape[1])], axis=1).astype(np.uint8)


def _by_tree(splits: Sequence) -> dict[int, list]:
    """The splits of each tree from the root down."""
    found: dict[int, list] = {}
    for s in sorted(splits, key=lambda s: (s["tree"], s["level"])):
        found.setdefault(s["tree"], []).append((np.asarray(s["feature"]), np.asarray(s["cut"]), s))
    return found


def _descend(code: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The node on the next level of each row that is in an open node (-1: none)."""
    out = np.full(len(node), -1)
    at = np.flatnonzero(node >= 0)
    at = at[feature[node[at]] >= 0]
    out[at] = 2 * node[at] + (code[at, feature[node[at]]] > cut[node[at]])
    return out


def _level_sums(level: int, trees: int, features: int, most: int, bins: int, seed: int):
    """Of one chunk the rows and right answers by (node, allowed feature, code) for each tree."""
    width = 2**level

    def run(rows: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(forest):
            return pd.DataFrame({"group": [], "block": [], "part": [], "sums": []})
        group, part = rows["group"].iloc[0], int(rows["chunk"].iloc[0]) // _TOGETHER
        code = np.stack(rows["codes"].to_numpy())
        names, label = rows["name"].to_numpy(), rows["label"].to_numpy(dtype=float)
        grown, size = _by_tree(forest["splits"].iloc[0]), width * most * bins

        def one(tree: int) -> np.ndarray:
            node = np.zeros(len(rows), dtype=np.int64)
            for feature, cut, _ in grown.get(tree, []):
                node = _descend(code, node, feature, cut)
            weight = draws(names, tree, seed)
            at = np.flatnonzero((node >= 0) & (weight > 0))
            if not len(at):
                return np.zeros((2, size))
            mine = allowed(str(group), tree, level, width, features, most, seed)[node[at]]
            cell = ((node[at][:, None] * most + np.arange(most)) * bins + code[at[:, None], mine]).ravel()
            times = np.repeat(weight[at].astype(float), most)
            return np.stack([np.bincount(cell, weights=times, minlength=size), np.bincount(cell, weights=times * np.repeat(label[at], most), minlength=size)])

        blocks = [range(first, min(first + _BLOCK, trees)) for first in range(0, trees, _BLOCK)]
        return pd.DataFrame([(group, k, part, np.stack([one(tree) for tree in block]).tobytes()) for k, block in enumerate(blocks)], columns=["group", "block", "part", "sums"])

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(rows["sums"].iloc[0]) // 8)
    for sums in rows["sums"]:
        total += np.frombuffer(sums)
    return rows.iloc[:1].assign(sums=[total.tobytes()])


def best_splits(sums: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, ...]:
    """feature, cut, and rows and right answers on either side, of each node: the cut with the least Gini impurity after it, the first
    on a tie; feature -1 where no cut lowers it. ``sums`` is (2, nodes, allowed features, codes)."""
    n, yes = np.cumsum(sums, axis=3)
    whole_n, whole_yes = n[:, :1, -1:], yes[:, :1, -1:]
    rest_n, rest_yes = whole_n - n, whole_yes - yes
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (yes**2 + (n - yes) ** 2) / n + (rest_yes**2 + (rest_n - rest_yes) ** 2) / rest_n
        before = ((whole_yes**2 + (whole_n - whole_yes) ** 2) / whole_n)[:, 0, 0]
    score = np.where((n > 0) & (rest_n > 0), score, -1.0).reshape(len(mine), -1)
    best = score.argmax(axis=1)
    node = np.arange(len(mine))
    column, cut = np.divmod(best, sums.shape[3])
    good = score[node, best] > np.where(whole_n[:, 0, 0] > 0, before, np.inf) + 1e-9
    sides = [np.where(good, v[node, column, cut], 0.0) for v in (n, yes, rest_n, rest_yes)]
    return np.where(good, mine[node, column], -1), np.where(good, cut, 0), *sides


def _splits(level: int, features: int, most: int, bins: int, seed: int):
    width = 2**level

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(_added(rows)["sums"].iloc[0]).reshape(-1, 2, width, most, bins)
        group, first, out = rows["group"].iloc[0], int(rows["block"].iloc[0]) * _BLOCK, []
        for tree, sums in enumerate(total, first):
            feature, cut, *sides = best_splits(sums, allowed(str(group), tree, level, width, features, most, seed))
            out.append((group, tree, level, feature.tolist(), cut.tolist(), *[v.tolist() for v in sides]))
        return pd.DataFrame(out, columns=["group", "tree", "level", "feature", "cut", "left_n", "left_yes", "right_n", "right_yes"])

    return run


def _below(x: Column, cuts: Column, most: int) -> Column:
    """How many of the at most ``most`` sorted cuts are below x, by halving; like ``codes`` for one entry."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(x > F.try_element_at(cuts, at + s), at + s).otherwise(at))


def _coded(samples: DataFrame, edges: DataFrame, group: str, bins: int) -> DataFrame:
    """``samples`` with ``__codes`` in place of features, of the groups that have ``edges``.

    Codes are made where the rows are: a byte (two beyond 128 bins) for each feature is then shuffled and not eight.
    """
    code = lambda x, cuts: _below(x, cuts, bins - 1).cast("tinyint" if bins <= 128 else "smallint")
    known = samples.join(edges.select(group, F.col("edges").alias("__edges")), group)
    return known.withColumn("__codes", F.zip_with("features", "__edges", code)).drop("features", "__edges")


def _chunked(samples: DataFrame, sizes: DataFrame, group: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    """``samples`` with __name and __chunk, and (group, __chunk) of the chunks that may occur."""
    chunks = sizes.select(group, F.ceil(F.col("num_samples") / chunk).cast("int").alias("__chunks"))
    named = samples.join(chunks, group).withColumn("__name", F.xxhash64(*samples.columns))
    rows = named.withColumn("__chunk", F.pmod(F.xxhash64("__name"), F.col("__chunks")).cast("int")).drop("__chunks")
    return rows, chunks.select(group, F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)).alias("__chunk"))


def fit_forest_per_group(
    samples: DataFrame, group: str = "exercise", label: str = "correct", trees: int = TREES, depth: int = DEPTH, bins: int = BINS, most: int | None = None,
    min_samples: int = 1, seed: int = SEED, chunk: int = CHUNK,
) -> DataFrame:
    """A random forest of ``label`` (0, 1) on ``features`` for every group: (group, num_samples, yes, edges, splits).

    ``splits`` holds for each tree and level the feature, cut and both sides' sums of the level's nodes; a row goes right where its
    code, the number of ``edges`` (at most ``bins`` - 1 quantiles of the group) it is above, is larger than the cut. A node may split on ``most`` of the features, by
    default the square root of their number. Trees have ``depth`` levels of splits. Rows that agree in all columns are drawn
    together. Groups of fewer than ``min_samples`` rows get no forest.
    """
    kind = dict(samples.dtypes)[group]
    sizes = samples.groupBy(group).agg(F.count(F.lit(1)).alias("num_samples"), F.sum(F.col(label).cast("double")).alias("yes"), F.max(F.size("features")).alias("d"))
    sizes = cut_lineage(sizes.where(F.col("num_samples") >= min_samples))
    d = sizes.agg(F.max("d")).first()[0]
    none = F.array().cast(f"array<struct<{_SPLIT.replace(' ', ':').replace(',:', ',')}>>")
    if d is None:
        return sizes.select(group, "num_samples", "yes", F.array().cast("array<array<double>>").alias("edges"), none.alias("splits"))
    most = most or max(1, round(d**0.5))
    shares = [i / bins for i in range(1, bins)]
    cuts = F.array(*[F.percentile_approx(F.col("features")[j], shares, F.lit(1000)) for j in range(d)])
    edges = cut_lineage(samples.join(sizes.select(group), group, "left_semi").groupBy(group).agg(cuts.alias("edges")))
    rows, chunks = _chunked(samples, sizes, group, chunk)
    chunks = cut_lineage(chunks.select(F.col(group).alias("group"), F.col("__chunk").alias("chunk")))
    where = ["group", "chunk"]
    coded = cut_lineage(_coded(rows, edges, group, bins).select(
        F.col(group).alias("group"), F.col("__chunk").alias("chunk"), F.col("__name").alias("name"), F.col(label).cast("double").alias("label"), F.col("__codes").alias("codes")))
    many = sizes.agg(F.max("num_samples")).first()[0] > chunk * _TOGETHER  # else a tree's chunks are few
    grown = None
    for level in range(depth):
        if grown is None:
            forest = chunks.withColumn("splits", none)
        else:
            forest = chunks.join(grown.groupBy("group").agg(F.collect_list(F.struct(*[c for c in grown.columns if c != "group"])).alias("splits")), "group")
        sums = coded.groupBy(*where).cogroup(forest.groupBy(*where)).applyInPandas(
            _level_sums(level, trees, d, most, bins, seed), f"group {kind}, block int, part int, sums binary")
        added = sums.groupBy("group", "block", "part").applyInPandas(_added, sums.schema) if many else sums
        found = cut_lineage(added.groupBy("group", "block").applyInPandas(_splits(level, d, most, bins, seed), f"group {kind}, {_SPLIT}"))
        grown = found if grown is None else grown.unionByName(found)
    splits = grown.groupBy("group").agg(F.collect_list(F.struct(*[c for c in grown.columns if c != "group"])).alias("splits"))
    return sizes.select(group, "num_samples", "yes").join(edges, group).join(splits.withColumnRenamed("group", group), group, "left").withColumn("splits", F.coalesce("splits", none))


def _chances(columns: list[str]):
    def run(rows: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(forest):
            return pd.DataFrame({c: [] for c in [*columns, "p"]})
        one, code = forest.iloc[0], np.stack(rows["__codes"].to_numpy())
        grown = _by_tree(one["splits"])
        total = np.zeros(len(rows))
        for levels in grown.values():
            p, node = np.full(len(rows), one["yes"] / one["num_samples"]), np.zeros(len(rows), dtype=np.int64)
            for feature, cut, s in levels:
                below = _descend(code, node, feature, cut)
                at = np.flatnonzero(below >= 0)
                right, parent = below[at] % 2 == 1, node[at]
                yes, n = (np.where(right, np.asarray(s[f"right_{c}"])[parent], np.asarray(s[f"left_{c}"])[parent]) for c in ("yes", "n"))
                p[at] = yes / n
                node = below
            total += p
        return rows[columns].assign(p=total / len(grown) if grown else one["yes"] / one["num_samples"])

    return run


def predict_forest_per_group(samples: DataFrame, forests: DataFrame, group: str = "exercise", chunk: int = CHUNK, keep: Sequence[str] | None = None) -> DataFrame:
    """``samples`` of the groups that have a forest with ``p``, the mean over the trees of the chance of a right answer in the row's last node.

    ``keep`` names the columns that come with p (all of them by default); only they and a code for each feature are shuffled.
    """
    forests = cut_lineage(forests)
    columns = samples.columns if keep is None else list(keep)
    # Written, so that Spark knows how small they are and doesn't shuffle the samples to meet them.
    edges = cut_lineage(forests.select(group, "edges"))
    bins = (edges.agg(F.max(F.size(F.get("edges", F.lit(0))))).first()[0] or 0) + 1
    sizes = cut_lineage(samples.groupBy(group).agg(F.count(F.lit(1)).alias("num_samples")).join(forests.select(group), group, "left_semi"))
    rows, chunks = _chunked(samples, sizes, group, chunk)
    again = [c for c in columns if c == "features"]  # codes take the place of features
    rows = _coded(rows.withColumns({f"__{c}": F.col(c) for c in again}), edges, group, bins).withColumnsRenamed({f"__{c}": c for c in again})
    dealt = cut_lineage(chunks.join(forests.drop("edges"), group)).groupBy(group, "__chunk")
    schema = ", ".join(f"`{c}` {t}" for c, t in samples.select(*columns).dtypes)
    meant = rows.select(*dict.fromkeys([group, "__chunk", "__codes", *columns]))
    return meant.groupBy(group, "__chunk").cogroup(dealt).applyInPandas(_chances(columns), f"{schema}, p double")
