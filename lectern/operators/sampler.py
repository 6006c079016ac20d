"""Abilities by Metropolis chains, and the item-response fit that samples them.

A user's chains see the user's answers only, one per exercise, so chains of different users run side by side and a
batch of users moves as arrays. Every draw follows from an md5 of seed, user, chain and step: a rerun on any
executor walks the same way, and SQL can walk it too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lectern.operators.lbfgs import lbfgs_per_group
from lectern.operators.models import SEED, by_user, first_responses
from lectern.session import cut_lineage

_ANSWERS_AT_ONCE = 200_000


def uniforms(names: Sequence[str], step: int, count: int) -> np.ndarray:
    """``count`` numbers in (0, 1) for each name: 32 bits each of md5(name|step|k) for k = 0, 1, ..."""
    digests = -(-count // 4)
    raw = b"".join(hashlib.md5(f"{name}|{step}|{k}".encode()).digest() for name in names for k in range(digests))
    return ((np.frombuffer(raw, dtype=">u4").astype(float) + 0.5) / 2**32).reshape(len(names), 4 * digests)[:, :count]


def normals(pairs: np.ndarray) -> np.ndarray:
    """Two normal draws from every two uniform ones."""
    size, turn = np.sqrt(-2.0 * np.log(pairs[:, 0::2])), 2 * np.pi * pairs[:, 1::2]
    return np.stack([size * np.cos(turn), size * np.sin(turn)], axis=2).reshape(len(pairs), -1)


def _chance(theta: np.ndarray, couplings: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Log density of abilities (walker x dims) given answers (walker x answers x (dims + 1), sign 0 for padding)."""
    z = np.einsum("wd,wrd->wr", theta, couplings[:, :, :-1]) + couplings[:, :, -1]
    return -0.5 * (theta * theta).sum(axis=1) - np.where(sign != 0, np.logaddexp(0.0, -sign * z), 0.0).sum(axis=1)


def _walk(items: dict, dims: int, steps: int, burn_in: int, chains: int, scale: float, seed: str, draws: int):
    """Per user the chains' mean, variance, last places and number of accepted steps, beside the user and the answers."""
    w = np.array(list(items.values()), dtype=float).reshape(len(items), dims + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = batch.column("answers")
            flat, counts = answers.flatten(), answers.value_lengths().to_numpy()
            k = pc.fill_null(pc.index_in(flat.field("exercise"), pa.array(list(items), flat.field("exercise").type)), -1).to_numpy(zero_copy_only=False)
            known = np.flatnonzero(k >= 0)
            owner = np.repeat(np.arange(len(counts)), counts)[known]
            sign = np.where(pc.fill_null(flat.field("correct"), False).to_numpy(zero_copy_only=False)[known], 1.0, -1.0)
            sizes = np.bincount(owner, minlength=len(counts))
            asked = np.flatnonzero(sizes)  # users without an answer to a known exercise have no chain
            ends = np.cumsum(sizes)
            start = 0
            while start < len(asked):
                # So many users that the padded answers of their chains stay few.
                stop, widest = start, 0
                while stop < len(asked) and (stop == start or max(widest, sizes[asked[stop]]) * (stop + 1 - start) * chains <= _ANSWERS_AT_ONCE):
                    widest = max(widest, sizes[asked[stop]])
                    stop += 1
                users = asked[start:stop]
                row = np.repeat(np.arange(len(users)), sizes[users])
                at = np.concatenate([np.arange(ends[u] - sizes[u], ends[u]) for u in users])
                column = np.arange(len(at)) - np.repeat(np.cumsum(sizes[users]) - sizes[users], sizes[users])
                couplings, signs = np.zeros((len(users), widest, dims + 1)), np.zeros((len(users), widest))
                couplings[row, column], signs[row, column] = w[k[known[at]]], sign[at]
                part = batch.take(pa.array(users))
                yield walked(part, couplings, signs)
                start = stop

    def walked(users: pa.RecordBatch, couplings: np.ndarray, sign: np.ndarray) -> pa.RecordBatch:
        count = users.num_rows
        couplings, sign = np.repeat(couplings, chains, axis=0), np.repeat(sign, chains, axis=0)
        names = [f"{seed}|{user}|{chain}" for user in users.column("user").to_pylist() for chain in range(chains)]
        theta = np.repeat(np.array(users.column("start").to_pylist(), dtype=float), chains, axis=0)
        density = _chance(theta, couplings, sign)
        accepted, kept = np.zeros(len(names), dtype=int), np.zeros((2, len(names), dims))
        last = []
        for step in range(steps):
            u = uniforms(names, step, 1 + 2 * -(-dims // 2))
            there = theta + scale * normals(u[:, 1:])[:, :dims]
            other = _chance(there, couplings, sign)
            took = np.log(u[:, 0]) < other - density
            theta, density = np.where(took[:, None], there, theta), np.where(took, other, density)
            accepted += took
            if step >= burn_in:
                kept += np.stack([theta, theta * theta])
            if step >= steps - draws:
                last.append(theta.reshape(count, chains, dims))
        mean, square = kept.reshape(2, count, chains, dims).mean(axis=2) / max(steps - burn_in, 1)
        places = np.concatenate(last, axis=1) if last else np.zeros((count, 0, dims))
        vectors = pa.list_(pa.float64())
        return pa.RecordBatch.from_arrays(
            [users.column("user"), users.column("answers"), pa.array(mean.tolist(), vectors), pa.array((square - mean * mean).tolist(), vectors),
             pa.array(accepted.reshape(count, chains).sum(axis=1)), pa.array(places.tolist(), pa.list_(vectors))],
            names=["user", "answers", "theta", "variance", "accepted", "draws"])

    return run


def _walked(users: DataFrame, items: DataFrame, dims: int, steps: int, burn_in: int, chains: int, scale: float | None, seed: str, draws: int) -> DataFrame:
    """``_walk`` over ``users`` (user, answers, start). The couplings, a few numbers for each exercise, go out with the tasks; users are not moved."""
    known = {r[0]: r[1] for r in items.where("exercise IS NOT NULL").select("exercise", "w_correct").collect()}
    kinds = dict(users.dtypes)
    walk = _walk(known, dims, steps, burn_in, chains, scale or 1.2 / dims**0.5, seed, draws)
    return users.select("user", "answers", "start").mapInArrow(
        walk, f"user {kinds['user']}, answers {kinds['answers']}, theta array<double>, variance array<double>, accepted long, draws array<array<double>>")


def sample_abilities(
    data: DataFrame, items: DataFrame, dims: int = 1, steps: int = 400, burn_in: int = 100, chains: int = 4, scale: float | None = None,
    seed: str = str(SEED), draws: int = 1, start: DataFrame | None = None,
) -> DataFrame:
    """Posterior mean and variance of each user's abilities by Metropolis chains: (user, theta, variance, accepted, draws).

    ``data`` holds first answers (user, exercise, correct), ``items`` the couplings w_correct (dims and a constant) of each exercise; abilities
    are standard normal beforehand. A chain proposes normal steps of ``scale``; its first ``burn_in`` steps don't count. ``draws`` are
    the places of each chain's last steps, ``start`` (user, theta) where chains begin, else at zero. A user's answers
    come together, at most one per exercise.
    """
    zero = F.array_repeat(F.lit(0.0), dims)
    answers = data.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("exercise", "correct"))).alias("answers"))
    if start is None:
        rows = answers.withColumn("start", zero)
    else:
        rows = answers.join(start.select("user", F.col("theta").alias("start")), "user", "left").withColumn("start", F.coalesce("start", zero))
    # Shuffled tables as small as these would end in one task, for all their steps.
    rows = rows.repartition(3 * data.sparkSession.sparkContext.defaultParallelism)
    return _walked(rows, items, dims, steps, burn_in, chains, scale, seed, draws).drop("answers")


def item_response_sampled(
    responses: DataFrame, dims: int = 1, epochs: int = 20, l2: float = 1e-3, steps: int = 40, chains: int = 4, draws: int = 5,
    order: Sequence[str] = ("time_done", "event_id"), seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Item couplings and abilities by expectation maximisation with sampled abilities: (items, abilities).

    Each epoch carries every user's chains on from where they were, and fits the couplings of all exercises to the answers at
    the chains' last places by L-BFGS, from the couplings of the epoch before. Sampling goes on to move couplings a little, so the last half of the
    epochs is averaged; ``spread`` is the standard deviation over them of the couplings that varies most. For any number of abilities.
    """
    data = cut_lineage(first_responses(responses, order).select("user", "exercise", "correct"))
    first = F.array(*[F.lit(0.5**j) for j in range(dims)], F.lit(0.0))  # equal axes could not part
    items = cut_lineage(data.select("exercise").distinct().select("exercise", first.alias("w_correct")))
    # Users without a name are sampled at the end, but have no say in the couplings.
    users, late = by_user(data, "correct").withColumn("start", F.array_repeat(F.lit(0.0), dims)), []
    for epoch in range(epochs):
        sampled = cut_lineage(_walked(users, items, dims, steps, 0, chains, None, f"{seed}|{epoch}", draws))
        users = sampled.select("user", "answers", F.element_at("draws", -1).alias("start"))
        places = sampled.select(F.explode("answers").alias("answer"), "draws").select("answer.*", F.explode("draws").alias("place"))
        rows = places.select("exercise", "correct", F.concat("place", F.array(F.lit(1.0))).alias("features"))
        fitted = lbfgs_per_group(rows, l2=2 * l2 * chains * draws, max_steps=20, tolerance=1e-3, start=items.select("exercise", F.col("w_correct").alias("theta")))
        items = cut_lineage(fitted.select("exercise", F.col("theta").alias("w_correct")))
        if epoch >= epochs // 2:
            late.append(items)
    whole = late[0]
    for more in late[1:]:
        whole = whole.unionByName(more)
    couplings = whole.groupBy("exercise").agg(
        F.array(*[F.avg(F.col("w_correct")[j]) for j in range(dims + 1)]).alias("w_correct"),
        F.greatest(F.lit(0.0), *[F.stddev_pop(F.col("w_correct")[j]) for j in range(dims + 1)]).alias("spread"))
    sign = [F.when(couplings.agg(F.avg(F.col("w_correct")[j])).scalar() < 0, -1.0).otherwise(1.0) for j in range(dims)] + [F.lit(1.0)]
    items = cut_lineage(couplings.select("exercise", F.array(*[F.col("w_correct")[j] * sign[j] for j in range(dims + 1)]).alias("w_correct"), "spread"))
    return items, sample_abilities(data, items, dims, seed=str(seed))
