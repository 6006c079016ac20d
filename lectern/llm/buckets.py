"""Pairs of different components within buckets, compared in blocks with numpy.

Members of tiny buckets are paired by their sizes alone, fewer than ``tiny`` (by default ``TINY``) pairs a member; a pair that many buckets tell of is compared once.
Members of small buckets are compared where the bucket is gathered, pair by pair of all buckets of a batch at once.
A large bucket is sorted by component and size and cut into leaves of ``LEAF`` members; leaves come ``FAN`` to a parent. Pairs
of nodes are followed from the parents to the leaves, and only those in which a link may be: not all of one
component, sizes that allow the similarity, and bounds that do (``top`` of either node). Leaves are packed into one row
each, so no member is copied for another. ``BLOCK`` neighbouring leaves go to one place together, where all pairs of two blocks' leaves are
compared, so a leaf is sent once for each block it meets; a task holds two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lectern.session import cut_lineage

TINY, LEAF, FAN, BLOCK = 16, 256, 16, 4
_AT_ONCE = 16_384
_NODE = "key long, node long, parent long, block long, level int, c_lo long, c_hi long, n_lo int, n_hi int, top array<int>"
_PACKED = "ids array<long>, components array<long>, ns array<int>, data array<binary>"


class Kernel:
    """What a join knows of its members: ``data`` is one binary per member."""

    percent: int

    def load(self, data: list[bytes]) -> Any:
        raise NotImplementedError

    def near(self, key: np.ndarray | None, n: np.ndarray, x: Any, i: np.ndarray, y: Any, j: np.ndarray) -> np.ndarray:
        """Whether the members ``i`` of x and ``j`` of y, with ``n`` shingles together, may be linked and ``key``, if given, is the first bucket to say so."""
        raise NotImplementedError

    def top(self, loaded: Any) -> np.ndarray:
        """Per coordinate the most any member has; empty for no bound."""
        return np.empty(0, dtype=np.int32)


class _Members:
    def __init__(self, kernel: Kernel, ids, components, ns, data):
        self.id, self.component, self.n = (np.asarray(v, dtype=np.int64) for v in (ids, components, ns))
        self.data = kernel.load(list(data))


def _near(kernel: Kernel, key: np.ndarray, x: _Members, i: np.ndarray, y: _Members, j: np.ndarray) -> pd.DataFrame:
    """The pairs (x[i], y[j]) that may be linked."""
    nx, ny = x.n[i], y.n[j]
    to_do = (x.component[i] != y.component[j]) & (x.id[i] != y.id[j]) & (100 * np.minimum(nx, ny) >= kernel.percent * np.maximum(nx, ny))
    key, i, j, nx, ny = key[to_do], i[to_do], j[to_do], nx[to_do], ny[to_do]
    kept = [np.zeros(0, dtype=bool)]
    for at in range(0, len(i), _AT_ONCE):
        part = slice(at, at + _AT_ONCE)
        kept.append(kernel.near(key[part], nx[part] + ny[part], x.data, i[part], y.data, j[part]))
    close = np.concatenate(kept)
    a, b = x.id[i[close]], y.id[j[close]]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _within(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows with the same key, of rows sorted by key."""
    key = rows["key"].to_numpy(dtype=np.int64)
    for step in range(1, len(rows)):
        at = np.flatnonzero(key[step:] == key[:-step])
        if not len(at):
            break
        yield at, at + step


def _whole_buckets(found: Callable[[pd.DataFrame], Iterator[pd.DataFrame]]) -> Callable:
    """``found`` for a partition that is sorted by key, bucket by whole bucket; holds a batch and one bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = int(np.searchsorted(rows["key"].to_numpy(dtype=np.int64), rows["key"].iloc[-1]))
            if last:
                yield from found(rows.iloc[:last])
            held = rows.iloc[last:]
        if held is not None:
            yield from found(held)

    return run


def _small(kernel: Kernel) -> Callable:
    def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key = rows["key"].to_numpy(dtype=np.int64)
        members = _Members(kernel, rows["id"], rows["component"], rows["n"], rows["data"])
        for i, j in _within(rows):
            yield _near(kernel, key[i], members, i, members, j)

    return _whole_buckets(found)


def _tiny(percent: int) -> Callable:
    """Pairs whose components differ and whose sizes allow a link."""

    def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        ids, component, n = (rows[c].to_numpy(dtype=np.int64) for c in ("id", "component", "n"))
        pairs = [np.empty((2, 0), dtype=np.int64)]
        for i, j in _within(rows):
            good = (component[i] != component[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            pairs.append(np.sort(np.stack([ids[i[good]], ids[j[good]]]), axis=0))
        a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
        yield pd.DataFrame({"a": a, "b": b})

    return _whole_buckets(found)


def _compared(kernel: Kernel) -> Callable:
    """Of pairs (a, b) with both sizes and data those that may be linked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _AT_ONCE):
                rows = batch.iloc[at : at + _AT_ONCE]
                x, y = (kernel.load(rows[c].tolist()) for c in ("data_a", "data_b"))
                n, i = (rows["n_a"] + rows["n_b"]).to_numpy(dtype=np.int64), np.arange(len(rows))
                yield rows.loc[kernel.near(None, n, x, i, y, i), ["a", "b"]]

    return run


def near_pairs(pairs: DataFrame, payload: DataFrame, kernel: Kernel) -> DataFrame:
    """The ``pairs`` (a, b) that may be linked by what ``payload`` (id, n, data) knows of both."""
    sides = [payload.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("data").alias(f"data_{s}")) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInPandas(_compared(kernel), "a long, b long")


def _leaves(kernel: Kernel) -> Callable:
    """Leaves and parents of the large buckets of a sorted partition."""

    def leaf(rows: pd.DataFrame) -> dict:
        ids, components = rows["id"].to_numpy(), rows["component"].to_numpy()
        return {
            "key": int(rows["key"].iloc[0]), "node": int(ids[0]), "level": 0, "c_lo": components.min(), "c_hi": components.max(), "n_lo": rows["n"].min(), "n_hi": rows["n"].max(),
            "top": kernel.top(kernel.load(rows["data"].tolist())), "ids": ids, "components": components, "ns": rows["n"].to_numpy(), "data": rows["data"].tolist()}

    def parent(children: list[dict]) -> dict:
        return {
            "key": children[0]["key"], "node": children[0]["node"], "parent": 0, "block": 0, "level": 1, "c_lo": min(c["c_lo"] for c in children), "c_hi": max(c["c_hi"] for c in children),
            "n_lo": min(c["n_lo"] for c in children), "n_hi": max(c["n_hi"] for c in children), "top": np.maximum.reduce([c["top"] for c in children]), "ids": [], "components": [], "ns": [], "data": []}

    def closed(children: list[dict]) -> pd.DataFrame:
        return pd.DataFrame([*({**c, "parent": children[0]["node"], "block": children[i - i % BLOCK]["node"]} for i, c in enumerate(children)), parent(children)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        children: list[dict] = []
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            key = rows["key"].to_numpy()
            start = 0
            while start < len(rows):
                stop = min(start + LEAF, int(np.searchsorted(key, key[start], side="right")))
                if stop == len(rows) and stop - start < LEAF:
                    break  # the leaf may go on in the next batch
                if children and (children[0]["key"] != key[start] or len(children) == FAN):
                    yield closed(children)
                    children = []
                children.append(leaf(rows.iloc[start:stop]))
                start = stop
            held = rows.iloc[start:]
        if held is not None and len(held):
            if children and (children[0]["key"] != held["key"].iloc[0] or len(children) == FAN):
                yield closed(children)
                children = []
            children.append(leaf(held))
        if children:
            yield closed(children)

    return run


def _met(kernel: Kernel) -> Callable:
    """Pairs between each leaf of a group and the leaves it is to meet (``others``), or within it."""

    def run(leaves: pd.DataFrame) -> pd.DataFrame:
        members = {r.node: _Members(kernel, r.ids, r.components, r.ns, r.data) for r in leaves.itertuples(index=False)}
        found = []
        for node, others in zip(leaves["node"], leaves["others"]):
            for other in others:
                x, y = members[node], members[other]
                i, j = np.triu_indices(len(x.id), 1) if x is y else (v.ravel() for v in np.indices((len(x.id), len(y.id))))
                found.append(_near(kernel, np.full(len(i), leaves["key"].iloc[0]), x, i, y, j))
        return pd.concat(found, ignore_index=True)

    return run


def _possible(percent: int) -> Column:
    """Whether a link may be between nodes x and y: 100 intersection >= percent union."""
    mixed = ~((F.col("x.c_lo") == F.col("x.c_hi")) & (F.col("y.c_lo") == F.col("y.c_hi")) & (F.col("x.c_lo") == F.col("y.c_lo")))
    sizes = (100 * F.col("x.n_hi") >= percent * F.col("y.n_lo")) & (100 * F.col("y.n_hi") >= percent * F.col("x.n_lo"))
    overlap = F.aggregate(F.zip_with("x.top", "y.top", lambda a, b: F.least(a, b)), F.lit(0).cast("bigint"), lambda total, x: total + x)
    bound = (F.size("x.top") == 0) | ((100 + percent) * overlap >= percent * (F.col("x.n_lo") + F.col("y.n_lo")))
    return mixed & sizes & bound


def _node_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """key, x, y and blocks (smaller number first) of the leaves between which a link may be, from the parents down."""
    meta = nodes.select("key", "node", "parent", "block", "level", "c_lo", "c_hi", "n_lo", "n_hi", "top")
    parents, leaves = meta.where("level = 1"), meta.where("level = 0")
    above = parents.alias("x").join(parents.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.node") <= F.col("y.node"))).where(_possible(percent))
    above = cut_lineage(above.select("x.key", F.col("x.node").alias("px"), F.col("y.node").alias("py")))
    one = above.alias("p").join(leaves.alias("x"), (F.col("p.key") == F.col("x.key")) & (F.col("p.px") == F.col("x.parent")))
    two = one.join(leaves.alias("y"), (F.col("p.key") == F.col("y.key")) & (F.col("p.py") == F.col("y.parent")))
    once = (F.col("p.px") != F.col("p.py")) | (F.col("x.node") <= F.col("y.node"))
    blocks = [order("x.block", "y.block").alias(name) for order, name in ((F.least, "block_x"), (F.greatest, "block_y"))]
    return two.where(once & _possible(percent)).select("p.key", F.col("x.node").alias("node_x"), F.col("y.node").alias("node_y"), *blocks)


def pairs_across(rows: DataFrame, payload: DataFrame, kernel: Kernel, tiny: int | None = None, sharper: tuple[DataFrame, Kernel] | None = None) -> DataFrame:
    """a, b of the members of one bucket but different components that may be linked; a pair may come twice.

    ``rows`` has key, id, component and the bucket's size; ``payload`` id, n and data. Buckets that aren't tiny, whose pairs may be many,
    are compared by the payload and kernel of ``sharper``, if given.
    """
    pair = "a long, b long"
    tiny = TINY if tiny is None else tiny
    few = rows.where(F.col("size") <= tiny).join(payload.select("id", "n"), "id").select("key", "id", "component", "n")
    paired = few.repartition("key").sortWithinPartitions("key").mapInPandas(_tiny(kernel.percent), pair).distinct()
    compared = near_pairs(cut_lineage(paired), payload, kernel)
    if sharper is not None:
        payload, kernel = sharper
    more = rows.where(F.col("size").between(tiny + 1, LEAF)).join(payload, "id").select("key", "id", "component", "n", "data")
    small = compared.unionByName(more.repartition("key").sortWithinPartitions("key").mapInPandas(_small(kernel), pair))
    large = cut_lineage(rows.where(F.col("size") > max(tiny, LEAF)))
    if large.isEmpty():
        return small
    order = ["key", "component", "n", "id"]
    packed = large.join(payload, "id").select(*order, "data").repartitionByRange(*order).sortWithinPartitions(*order)
    nodes = cut_lineage(packed.mapInPandas(_leaves(kernel), f"{_NODE}, {_PACKED}"))
    pairs = _node_pairs(nodes, kernel.percent)
    group = ["key", "block_x", "block_y"]
    ends = [F.struct(F.col("node_x").alias("node"), F.col("node_y").alias("other")), F.struct(F.col("node_y").alias("node"), F.lit(None).cast("bigint").alias("other"))]
    sides = pairs.select(*group, F.explode(F.array(*ends)).alias("end")).groupBy(*group, F.col("end.node").alias("node")).agg(F.collect_list("end.other").alias("others"))  # a block's leaves at most
    leaves = nodes.where("level = 0").select("key", "node", "ids", "components", "ns", "data")
    met = sides.join(leaves, ["key", "node"]).groupBy(*group)
    return small.unionByName(met.applyInPandas(_met(kernel), pair))
