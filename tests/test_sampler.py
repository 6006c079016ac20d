"""Metropolis chains and quasi-Newton fits against grids, Newton steps and a plain walk."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import lbfgs, models, sampler
from test_models import newton, simulated

COUPLED = "exercise string, w_correct array<double>, w_time array<double>, sigma double"


def _samples(spark, seed=7):
    rng = np.random.default_rng(seed)
    data, local = [], {}
    for group, n, theta in (("hot", 600, [0.3, 1.2, -0.7]), ("b", 150, [-1.0, 0.1, 2.0]), ("few", 10, [0.0, 0.0, 0.0]), ("one label", 20, [50.0, 0.0, 0.0])):
        x = np.column_stack([np.ones(n), rng.normal(size=(n, 2)) * [1.0, 30.0 if group == "b" else 1.0]])
        y = (rng.random(n) < 1 / (1 + np.exp(-x @ theta))).astype(int)
        local[group] = (x, y)
        data += [(group, int(b), a.tolist()) for a, b in zip(x, y)]
    return local, spark.createDataFrame(data, "exercise string, correct int, features array<double>").repartition(5)


def test_quasi_newton_equals_local_fits(spark):
    local, samples = _samples(spark)
    fits = {r.exercise: r for r in lbfgs.lbfgs_per_group(samples, l2=0.5).collect()}
    assert set(fits) == set(local)
    for group, (x, y) in local.items():
        assert fits[group].converged and fits[group].num_samples == len(y) and fits[group].scans < 40
        assert np.allclose(fits[group].theta, newton(x, y, 0.5), atol=1e-4)


def test_quasi_newton_from_a_given_start(spark):
    local, samples = _samples(spark)
    best = spark.createDataFrame([(g, newton(x, y, 0.5).tolist()) for g, (x, y) in local.items() if g != "few"], "exercise string, theta array<double>")
    fits = {r.exercise: r for r in lbfgs.lbfgs_per_group(samples, l2=0.5, start=best, tolerance=1e-4).collect()}
    assert all(fits[g].scans <= 3 and fits[g].converged for g in ("hot", "b"))
    assert np.allclose(fits["few"].theta, newton(*local["few"], 0.5), atol=1e-3)
    assert not any(r.converged for r in lbfgs.lbfgs_per_group(samples, l2=0.5, max_steps=1).collect())


def test_weights_stand_for_repeated_rows(spark):
    _, samples = _samples(spark)
    weighed = samples.where("exercise = 'b'").withColumn("w", F.pmod(F.xxhash64("features"), F.lit(3)))
    repeated = weighed.withColumn("again", F.explode(F.sequence(F.lit(0), F.col("w")))).where("again > 0")
    one, two = lbfgs.lbfgs_per_group(weighed, l2=0.5, weight="w").first(), lbfgs.lbfgs_per_group(repeated, l2=0.5).first()
    assert np.allclose(one.theta, two.theta, atol=1e-4)
    assert lbfgs.lbfgs_per_group(weighed.limit(0)).count() == 0


def _items(spark, dims):
    rng = np.random.default_rng(dims)
    return spark.createDataFrame([(f"e{k}", (rng.normal(size=dims + 1) * 0.8).tolist(), [0.0] * (dims + 1), 1.0) for k in range(12)], COUPLED)


def _answers(spark, users=25):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(f"u{u}", f"e{k}", bool(rng.random() < 0.6)) for u in range(users) for k in range(12) if rng.random() < 0.2 + 0.03 * u], "user string, exercise string, correct boolean")


@pytest.mark.parametrize("dims", [1, 2])
def test_means_agree_with_the_grid(spark, dims):
    data, items = _answers(spark), _items(spark, dims)
    grid = {r.user: r.theta for r in models.estimate_abilities(data, items, dims, points={1: 41, 2: 13}[dims]).collect()}
    chains = {r.user: r for r in sampler.sample_abilities(data, items, dims, steps=2500, burn_in=300).collect()}
    assert set(grid) == set(chains)
    for user, row in chains.items():
        assert np.abs(np.array(row.theta) - grid[user]).max() < 0.12, user
        assert 0.2 < row.accepted / (4 * 2500) < 0.9 and all(0.05 < v < 1.5 for v in row.variance)


def test_five_abilities(spark):
    rows = sampler.sample_abilities(_answers(spark), _items(spark, 5), dims=5, steps=60, burn_in=10, draws=3).collect()
    assert rows and all(len(r.theta) == 5 and np.isfinite(r.theta).all() and len(r.draws) == 12 and r.accepted > 0 for r in rows)


def test_a_chain_step_by_step(spark, monkeypatch):
    """The walk of one chain as a loop over its steps, however users are put together."""
    data, items = _answers(spark, 6), _items(spark, 1)
    w = {r.exercise: r.w_correct for r in items.collect()}
    for at_once in (200_000, 5):
        monkeypatch.setattr(sampler, "_ANSWERS_AT_ONCE", at_once)
        for row in sampler.sample_abilities(data, items, steps=30, burn_in=10, chains=1, draws=2).collect():
            answers = [(w[r.exercise], r.correct) for r in data.where(F.col("user") == row.user).collect()]
            density = lambda t: -t * t / 2 - sum(math.log1p(math.exp(-(a * t + b) if c else a * t + b)) for (a, b), c in answers)
            theta, places, accepted = 0.0, [], 0
            for step in range(30):
                h = hashlib.md5(f"7|{row.user}|0|{step}|0".encode()).hexdigest()
                u = [(int(h[8 * k : 8 * k + 8], 16) + 0.5) / 2**32 for k in range(4)]
                there = theta + 1.2 * math.sqrt(-2 * math.log(u[1])) * math.cos(2 * math.pi * u[2])
                if math.log(u[0]) < density(there) - density(theta):
                    theta, accepted = there, accepted + 1
                places.append(theta)
            assert row.accepted == accepted and row.theta[0] == pytest.approx(np.mean(places[10:]))
            assert [d[0] for d in row.draws] == pytest.approx(places[-2:])


def test_sampled_fit_recovers_order(spark):
    ability, responses = simulated(spark)
    items, abilities = sampler.item_response_sampled(responses, epochs=8, steps=20)
    w = {r.exercise: r.w_correct for r in items.collect()}
    assert w["easy"][1] > w["mid"][1] > w["hard"][1]
    assert min(w[e][0] for e in ("easy", "mid", "hard")) > w["flat"][0]
    theta = {r.user: r.theta[0] for r in abilities.collect()}
    assert np.corrcoef(ability, [theta[f"u{u}"] for u in range(len(ability))])[0, 1] > 0.5


def test_slope_vanishes_at_a_fit(spark):
    _, responses = simulated(spark, users=60)
    items, _ = models.item_response_fit(responses, epochs=60, l2=0.5, points=9)
    data = models.first_responses(responses, ("time_done", "event_id"))
    for row in models.item_response_slope(data, items, l2=0.5, points=9).collect():
        assert max(map(abs, row.slope)) < 0.002


def test_answers_speak_for_abilities(spark):
    """Posterior moments of one answer against a fine sum."""
    items = _items(spark, 1)
    w = {r.exercise: r.w_correct for r in items.collect()}
    axis = np.linspace(-8, 8, 4001)
    for r in models.response_abilities(items, points=81).collect():
        post = np.exp(-axis**2 / 2) / (1 + np.exp((-1 if r.correct else 1) * (w[r.exercise][0] * axis + w[r.exercise][1])))
        post /= post.sum()
        assert r.ability == pytest.approx((post * axis).sum(), abs=1e-3) and r.difficulty == w[r.exercise][1]
        assert r.variance == pytest.approx((post * axis**2).sum() - (post * axis).sum() ** 2, abs=2e-3)


def test_samples_are_made_once_for_all_scans(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    rows = [(f"g{i % 3}", bool(rng.random() < 1 / (1 + np.exp(-a))), [float(a), 1.0]) for i, (a, _) in enumerate(x)]
    samples = spark.createDataFrame(rows, "exercise string, correct boolean, features array<double>").mapInPandas(
        count, "exercise string, correct boolean, features array<double>")
    fits = lbfgs.lbfgs_per_group(samples, l2=0.5).collect()
    assert len(fits) == 3 and all(r.scans > 2 and r.num_samples == 100 for r in fits)
    assert made.value == 300


def test_chains_are_dealt_over_tasks(spark):
    sampled = sampler.sample_abilities(_answers(spark), _items(spark, 1), steps=20, burn_in=5)
    assert sampled.select(F.spark_partition_id()).distinct().count() > 1


def test_unknown_labels_keep_a_group_at_its_start(spark):
    rows = [(g, None if g == "hole" and k == 5 else k % 3 > 0, [float(k % 7) - 3, 1.0]) for g in ("hole", "whole") for k in range(60)]
    samples = spark.createDataFrame(rows, "exercise string, correct boolean, features array<double>").repartition(12)
    start = spark.createDataFrame([("hole", [1.0, 0.0]), ("whole", [1.0, 0.0])], "exercise string, theta array<double>")
    fits = {r.exercise: r for r in lbfgs.lbfgs_per_group(samples, l2=0.5, start=start).collect()}
    assert fits["hole"].theta == [1.0, 0.0] and not fits["hole"].converged and fits["hole"].num_samples == 60
    assert fits["whole"].converged and fits["whole"].theta != [1.0, 0.0]
