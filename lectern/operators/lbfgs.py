"""Quasi-Newton fits of a logistic regression for every group at once.

A group's samples never come together: they are laid out once in blocks, a few rows for each batch, that a join with the groups' states
costs little. Each iteration is one scan of the blocks: the tasks add up, per group, the loss and the gradient at several step lengths along its direction, and the sums meet entry by entry. The group then takes the longest step that lowers the loss
enough, learns from the change of its gradient and sets the next direction; that sees one row per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, functions as F

from lectern.session import cut_lineage

# Step lengths tried in one scan, longest first.
STEPS = (2.0, 1.0, 0.5, 0.25, 0.0625, 0.015625, 0.001)
MEMORY = 8
_ENOUGH = 1e-4


def direction(gradient: np.ndarray, moves: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """Minus the gradient times the inverse curvature that the last moves and changes of gradient tell of (oldest first)."""
    q, scales = gradient.copy(), []
    for move, change in zip(moves[::-1], changes[::-1]):
        rho = 1.0 / (move @ change)
        a = rho * (move @ q)
        q = q - a * change
        scales.append((rho, a))
    if len(moves):
        q = q * (moves[-1] @ changes[-1]) / (changes[-1] @ changes[-1])
    else:
        q = q / max(1.0, float(np.abs(gradient).max()))
    for move, change, (rho, a) in zip(moves, changes, scales[::-1]):
        q = q + move * (a - rho * (change @ q))
    return -q


def _blocks(group: str, label: str, weight: str | None):
    """The samples of each batch and group as one row: labels y, weights w and the features x one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(group).dictionary_encode()
            codes = pc.fill_null(keys.indices, -1).to_numpy(zero_copy_only=False)
            places = [pa.array(np.flatnonzero(codes == k)) for k in range(len(keys.dictionary))]
            cells = {"y": label, **({"w": weight} if weight else {})}
            lists = {c: [batch.column(name).take(at).to_numpy(zero_copy_only=False).astype(float) for at in places] for c, name in cells.items()}
            lists["x"] = [batch.column("features").take(at).flatten().to_numpy(zero_copy_only=False).astype(float) for at in places]
            columns = [pa.array(v, pa.list_(pa.float64())) for v in lists.values()]
            yield pa.RecordBatch.from_arrays([keys.dictionary, *columns], names=[group, *lists])

    return run


def _sums(group: str, weight: str | None):
    """Per task and group the loss and its gradient at all step lengths, as one flat row; one block is held at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict = {}
        for batch in batches:
            for key, x, y, w, theta, way in zip(*(batch[c] for c in (group, "x", "y", "w" if weight else "y", "theta", "way"))):
                theta, way, x = np.asarray(theta), np.asarray(way), x.reshape(len(y), -1)
                w = w if weight else np.ones(len(y))
                z = np.clip((x @ theta)[:, None] + (x @ way)[:, None] * np.array((0.0, *STEPS)), -100, 100)
                loss = (w[:, None] * (np.logaddexp(0.0, z) - y[:, None] * z)).sum(axis=0)
                gradient = x.T @ (w[:, None] * (1.0 / (1.0 + np.exp(-z)) - y[:, None]))
                flat = np.concatenate([loss, gradient.T.ravel()])
                total[key] = total[key] + flat if key in total else flat
        if total:
            yield pd.DataFrame({group: list(total), "part": [v.tolist() for v in total.values()]})

    return run


def _advance(group: str, l2: np.ndarray | float, tolerance: float):
    """The state of each group after its scan: place, next direction, remembered moves, and how far it went."""

    def one(theta, way, moves, changes, flat):
        d = len(theta)
        steps = np.array((0.0, *STEPS))
        at = theta + steps[:, None] * way
        loss = flat[: len(steps)] + (0.5 * l2 * at * at).sum(axis=1)
        gradient = flat[len(steps) :].reshape(len(steps), d) + l2 * at
        slope = gradient[0] @ way
        good = np.flatnonzero(loss[1:] <= loss[0] + _ENOUGH * steps[1:] * slope) + 1
        if not np.abs(way).max() > 0:  # the first scan is of the start only
            return theta, direction(gradient[0], moves, changes), moves, changes, None
        if not len(good):
            # Rounding hides any progress, or the remembered curvature is wrong: begin anew from the gradient, once.
            again = direction(gradient[0], moves[:0], changes[:0])
            return theta, again, moves[:0], changes[:0], (None if len(moves) else 0.0)
        best = good[int(np.argmin(loss[good]))]
        move, change = at[best] - theta, gradient[best] - gradient[0]
        if move @ change > 1e-12 * np.sqrt((move @ move) * (change @ change)):
            moves, changes = np.vstack([moves, move])[-MEMORY:], np.vstack([changes, change])[-MEMORY:]
        way = direction(gradient[best], moves, changes)
        return at[best], way, moves, changes, float(max(np.abs(move).max(), np.abs(way).max()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for theta, way, moves, changes, flat in zip(batch["theta"], batch["way"], batch["moves"], batch["changes"], batch["total"]):
                theta = np.asarray(theta, dtype=float)
                past = [np.asarray(v, dtype=float).reshape(-1, len(theta)) for v in (moves, changes)]
                theta, way, moves, changes, far = one(theta, np.asarray(way, dtype=float), *past, np.asarray(flat, dtype=float))
                if far is not None and far < tolerance:
                    way = np.zeros(len(theta))
                out.append((theta.tolist(), way.tolist(), moves.ravel().tolist(), changes.ravel().tolist(), far))
            yield pd.DataFrame({group: batch[group], "scans": batch["scans"] + 1, **{c: [r[i] for r in out] for i, c in enumerate(("theta", "way", "moves", "changes", "move"))}})

    return run


def lbfgs_per_group(
    samples: DataFrame, group: str = "exercise", label: str = "correct", l2: float = 1e-6, max_steps: int = 100, tolerance: float = 1e-6,
    start: DataFrame | None = None, weight: str | None = None,
) -> DataFrame:
    """Logistic regression of ``label`` on ``features`` for every group: (group, theta, num_samples, scans, converged).

    The loss has ``l2`` / 2 times the squared couplings on top. ``start`` (group, theta) holds where to begin, else at zero. A group is left alone
    once neither its last move nor its next one reaches ``tolerance`` in any entry; one with an unknown label stays where it began, whatever tasks its samples are in; ``scans`` counts the scans it took part in.
    """
    kind, vector = dict(samples.dtypes)[group], "array<double>"
    data = samples.select(group, F.col(label).cast("double").alias(label), "features", *([F.col(weight).cast("double").alias(weight)] if weight else []))
    cells = ["y", *(["w"] if weight else []), "x"]
    blocks = data.mapInArrow(_blocks(group, label, weight), ", ".join([f"{group} {kind}", *[f"{c} {vector}" for c in cells]])).persist()
    counts = cut_lineage(blocks.groupBy(group).agg(
        F.sum(F.size("y").cast("bigint")).alias("num_samples"), F.max((F.size("x") / F.size("y")).cast("int")).alias("d")))
    zeros, none = F.array_repeat(F.lit(0.0), F.col("d")), F.array().cast(vector)
    begun = counts if start is None else counts.join(start.select(group, F.col("theta").alias("given")), group, "left")
    theta = zeros if start is None else F.coalesce("given", zeros)
    state = cut_lineage(begun.select(
        group, F.lit(0).alias("scans"), theta.alias("theta"), zeros.alias("way"), none.alias("moves"), none.alias("changes"), F.lit(None).cast("double").alias("move")))
    resting = F.coalesce(F.col("move") < tolerance, F.lit(False))
    # A sample without a label leaves its group no direction; Arrow may turn NaN into null.
    done = resting | F.exists("way", lambda x: x.isNull() | F.isnan(x))
    for _ in range(max_steps + 1):
        moving = state.where(~done)
        parts = blocks.join(moving.select(group, "theta", "way"), group).mapInPandas(_sums(group, weight), f"{group} {kind}, part {vector}")
        # A task has one row for each of its groups already, so the sums of a group meet in one shuffle.
        cells = parts.repartition(group).select(group, F.posexplode("part").alias("i", "v")).groupBy(group, "i").agg(F.sum(F.coalesce("v", F.lit(float("nan")))).alias("v"))
        total = cells.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda c: c["v"]).alias("total"))
        stepped = moving.drop("move").join(total, group).mapInPandas(
            _advance(group, l2, tolerance), f"{group} {kind}, scans int, theta {vector}, way {vector}, moves {vector}, changes {vector}, move double")
        left = Observation()
        state = cut_lineage(state.where(done).unionByName(stepped).observe(left, F.count_if(~done).alias("n")))
        if not left.get["n"]:
            break
    blocks.unpersist()
    return counts.drop("d").join(state.select(group, "theta", "scans", resting.alias("converged")), group)
