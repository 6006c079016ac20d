"""Forests per group against trees grown node by node from a group's own rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import forest
from lectern.session import cut_lineage


def _samples(spark, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for group, n in (("hot", 900), ("b", 120), ("one label", 30), ("single", 1)):
        x = np.column_stack([np.ones(n), rng.normal(size=n), rng.integers(0, 3, n).astype(float), rng.normal(size=n), rng.random(n)])
        y = np.ones(n, dtype=int) if group in ("one label", "single") else (x[:, 1] * (x[:, 2] - 1) + 0.5 * rng.normal(size=n) > 0).astype(int)
        rows += [(group, int(a), v.tolist()) for a, v in zip(y, x)]
    return spark.createDataFrame(rows, "exercise string, correct int, features array<double>").repartition(4)


def _tree(group, code, y, w, tree, depth, most, bins, seed, path=(0, 0)):
    """Chances of the rows that reach the node, as a function of codes."""
    level, node = path
    n, yes = w.sum(), (w * y).sum()
    leaf = ("leaf", yes / n if n else None)
    if level == depth or not n:
        return leaf
    mine = forest.allowed(group, tree, level, 2**level, code.shape[1], most, seed)[node]
    best = (yes**2 + (n - yes) ** 2) / n + 1e-9, None, None
    for j in mine:
        for cut in range(bins):
            left = code[:, j] <= cut
            ln, rn = w[left].sum(), w[~left].sum()
            if ln and rn:
                ly, ry = (w * y)[left].sum(), (w * y)[~left].sum()
                score = (ly**2 + (ln - ly) ** 2) / ln + (ry**2 + (rn - ry) ** 2) / rn
                if score > best[0] + (1e-9 if best[1] is not None else 0):
                    best = score, j, cut
    if best[1] is None:
        return leaf
    left = code[:, best[1]] <= best[2]
    below = [_tree(group, code[m], y[m], w[m], tree, depth, most, bins, seed, (level + 1, 2 * node + side)) for side, m in ((0, left), (1, ~left))]
    return "split", best[1], best[2], below


def _chance(tree, code):
    while tree[0] == "split":
        tree = tree[3][int(code[tree[1]] > tree[2])]
    return tree[1]


@pytest.mark.parametrize("chunk", [20_000, 40])
def test_forests_equal_trees_grown_alone(spark, chunk):
    samples = _samples(spark)
    options = dict(trees=6, depth=3, bins=8, most=2, seed=5)
    fits = forest.fit_forest_per_group(samples, chunk=chunk, **options)
    scored = forest.predict_forest_per_group(samples, fits, chunk=chunk).withColumn("name", F.xxhash64("exercise", "correct", "features")).collect()
    assert len(scored) == samples.count()
    for fit in fits.collect():
        rows = [r for r in scored if r.exercise == fit.exercise]
        assert fit.num_samples == len(rows) and fit.yes == sum(r.correct for r in rows)
        code = forest.codes(np.array([r.features for r in rows]), np.array(fit.edges))
        y, names = np.array([r.correct for r in rows], dtype=float), np.array([r.name for r in rows])
        trees = [_tree(fit.exercise, code, y, forest.draws(names, t, 5).astype(float), t, 3, 2, 8, 5) for t in range(6)]
        # A tree whose sample is empty says what the group does; one that is a leaf says so too.
        whole = y.mean()
        expected = [np.mean([_chance(t, c) if t[0] == "split" else whole for t in trees]) for c in code]
        found = [r.p for r in rows]
        if len(rows) > 1:
            assert np.allclose(found, expected, atol=1e-9), fit.exercise


def test_forest_learns_and_small_groups_have_none(spark):
    samples = _samples(spark)
    fits = forest.fit_forest_per_group(samples, trees=30, min_samples=100)
    scored = {r.exercise: r for r in forest.predict_forest_per_group(samples, fits).groupBy("exercise").agg(
        F.avg(((F.col("p") > 0.5).cast("int") == F.col("correct")).cast("int")).alias("right"), F.min("p").alias("low"), F.max("p").alias("high")).collect()}
    assert set(scored) == {"hot", "b"} and scored["hot"].right > 0.75
    assert 0 <= scored["hot"].low and scored["hot"].high <= 1


def test_no_samples(spark):
    none = _samples(spark).limit(0)
    fits = forest.fit_forest_per_group(none)
    assert fits.count() == 0 and forest.predict_forest_per_group(none, fits).count() == 0


def test_draws_are_like_a_bootstrap():
    names = np.random.default_rng(0).integers(-(2**62), 2**62, 20_000)
    counts = np.stack([forest.draws(names, t, 1) for t in range(5)])
    assert np.abs(counts.mean(axis=1) - 1).max() < 0.03 and np.abs((counts == 0).mean(axis=1) - np.exp(-1)).max() < 0.02
    assert abs(np.corrcoef(counts)[0, 1]) < 0.03


def test_codes_by_halving_equal_codes(spark):
    edges = [[-1.0, 0.0, 0.0, 2.5, float("inf")], [float("nan")] * 5, [float("-inf"), 1.0, 1.0, 1.0, float("nan")]]
    points = [-2.0, -1.0, -0.0, 0.0, 1e-300, 1.0, 2.5, 3.0, float("inf"), float("-inf"), float("nan")]
    x = np.array([[p] * 3 for p in points])
    samples = spark.createDataFrame([("g", i, v.tolist()) for i, v in enumerate(x)], "g string, i int, features array<double>")
    fits = spark.createDataFrame([("g", edges)], "g string, edges array<array<double>>")
    for bins in (6, 9, 200):
        found = {r.i: r["__codes"] for r in forest._coded(samples, fits, "g", bins).collect()}
        assert [found[i] for i in range(len(x))] == forest.codes(x, np.array(edges)).astype(int).tolist()


def test_features_are_not_shuffled(spark):
    samples = cut_lineage(_samples(spark))
    fits = forest.fit_forest_per_group(samples, trees=3, depth=2)
    shuffled = lambda df: [n for n in _exchanged(df) if n == "features"]
    lean = forest.predict_forest_per_group(samples, fits, keep=["exercise", "correct"])
    assert lean.columns == ["exercise", "correct", "p"] and not shuffled(lean)
    whole = forest.predict_forest_per_group(samples, fits)
    assert whole.columns == [*samples.columns, "p"] and whole.schema["features"].dataType == samples.schema["features"].dataType
    key = lambda df: sorted((r.exercise, r.correct, r.p) for r in df.collect())
    assert key(lean) == key(whole)
    assert sorted(map(repr, whole.select("features").collect())) == sorted(map(repr, samples.select("features").collect()))


def _exchanged(df):
    """Names of the columns that the plan of ``df`` shuffles."""
    names, executed = [], df._jdf.queryExecution().executedPlan()
    nodes = [executed.initialPlan() if "Adaptive" in executed.getClass().getSimpleName() else executed]
    while nodes:
        node = nodes.pop()
        below = node.children()
        nodes += [below.apply(i) for i in range(below.size())]
        if "ShuffleExchange" in node.getClass().getSimpleName():
            out = node.output()
            names += [out.apply(i).name() for i in range(out.size())]
    return names
