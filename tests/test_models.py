"""Statistics and model fits against numpy and plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import models, stats

ATTEMPT = "user string, exercise string, time_done double, event_id bigint, problem_number bigint, correct boolean, problem_type string"


def attempts(spark, seed=1, users=6, exercises=3, n=300, numbers=None):
    rng = random.Random(seed)
    data, done = [], {}
    for i in range(n):
        user = "hot" if rng.random() < 0.5 else f"u{rng.randrange(users)}"
        exercise = f"e{rng.randrange(exercises)}"
        done[user, exercise] = done.get((user, exercise), 0) + 1
        number = done[user, exercise] if numbers is None else numbers(rng, done[user, exercise])
        data.append((user, exercise, i * 20000.0, i, number, rng.random() < 0.7, f"t{rng.randrange(2)}"))
    return data, spark.createDataFrame(data, ATTEMPT)


@pytest.mark.parametrize("values,expected", [([4.0], 4.0), ([1.0, 3.0], 2.0), (list(range(11)), 5.0), ([0.0, 0.0, 0.0, 100.0], 0.0)])
def test_trimmed_mean_small_groups(spark, values, expected):
    df = spark.createDataFrame([("k", float(v)) for v in values] + [("k", float("nan")), ("k", float("inf")), ("k", None)], "k string, v double")
    assert stats.trimmed_mean(df, "v", ["k"]).first().avg == pytest.approx(expected)


def test_trimmed_mean_narrow_band(spark):
    df = spark.createDataFrame([("one", 1.0), ("two", 1.0), ("two", 2.0)], "k string, v double")
    got = {r.k: r.avg for r in stats.trimmed_mean(df, "v", ["k"], 0.500005, 0.9).collect()}
    assert got == {"one": None, "two": 2.0}


@pytest.mark.parametrize("seed", [1, 2])
def test_features_equal_a_replay(spark, seed):
    data, df = attempts(spark, seed)
    got = {r.event_id: r for r in stats.accuracy_predict(stats.accuracy_features(df)).collect()}
    kept = {}
    for user, exercise, _, ident, _, correct, _ in data:
        h = kept.setdefault((user, exercise), [])[-20:]
        r = got[ident]
        e3 = e10 = 0.9
        for x in h:
            e3, e10 = 0.333 * x + 0.667 * e3, 0.1 * x + 0.9 * e10
        streak = next((i for i, x in enumerate(reversed(h)) if not x), len(h))
        assert (r.streak, r.total_done) == (streak, len(h))
        assert (r.ewma_3, r.ewma_10) == (pytest.approx(e3), pytest.approx(e10))
        assert r.log_missed == pytest.approx(math.log(len(h) - sum(h) + 1))
        if not h:
            assert r.p == 0.8 and r.pct_correct == 0.8
        kept[user, exercise].append(int(correct))


def test_struggling(spark):
    data = [("u", "e", float(i), i, i + 1, False, "t") for i in range(12)]
    out = stats.accuracy_predict(stats.accuracy_features(spark.createDataFrame(data, ATTEMPT)), exponent=1.7, min_attempts=5).orderBy("event_id").collect()
    for r in out:
        assert r.struggling == (r.total_done >= 5 and r.p < 0.94 and r.total_done ** 1.7 * (0.94 - r.p) > 20)
    assert out[-1].struggling and not out[3].struggling


@pytest.mark.parametrize("seed", range(4))
def test_in_order_attempts_equal_a_replay(spark, seed):
    data, df = attempts(spark, seed, n=200, numbers=lambda rng, n: max(1, n + rng.choice([0, 0, 0, -1, 1, -2])))
    expected, at = set(), {}
    for user, exercise, _, ident, number, _, _ in data:
        if number == at.get((user, exercise), 0) + 1:
            at[user, exercise] = number
            expected.add(ident)
    assert {r.event_id for r in stats.in_order_attempts(df).collect()} == expected


def test_auc_equals_polyfit_and_curve_bounds(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(400), 4)
    label = rng.random(400) < p
    df = spark.createDataFrame([("m", "e", bool(a), float(b)) for a, b in zip(label, p)], "model string, exercise string, label boolean, p double")
    curve = stats.roc_curve(df).orderBy("threshold").collect()
    assert len(curve) == 103 and curve[0].tpr == 1.0 and curve[-1].tnr == 1.0
    grid = np.round(np.arange(-1, 102) / 100, 2)
    tpr = np.array([(label & (p >= t)).sum() / label.sum() for t in grid])
    fpr = np.array([1 - (~label & (p < t)).sum() / (~label).sum() for t in grid])
    assert np.allclose([r.tpr for r in curve], tpr) and np.allclose([1 - r.tnr for r in curve], fpr)
    fit = np.polyfit(fpr, tpr, 2)
    quality = stats.auc_logloss(df).first()
    assert quality.auc == pytest.approx(np.polyval(np.polyint(fit), 1), abs=1e-7)
    assert quality.avg_logl == pytest.approx(np.mean(np.log(np.where(label, p, 1 - p).clip(1e-300))), abs=1e-9)


def test_log_likelihood_floor(spark):
    df = spark.createDataFrame([(True, 0.0), (False, 1.0), (True, 1.0)], "label boolean, p double")
    assert [r[0] for r in df.select(stats.log_likelihood()).collect()] == [-100.0, -100.0, 0.0]


def test_best_threshold_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    p = np.round(rng.random(150), 4)
    label = rng.random(150) < p
    df = spark.createDataFrame([("e", bool(a), float(b)) for a, b in zip(label, p)], "exercise string, label boolean, p double")
    for beta in (0.5, 2.0):
        best = (-1.0, None)
        for t in range(101):
            over = p > t / 100
            tp, fp, fn = (label & over).sum(), (~label & over).sum(), (label & ~over).sum()
            f = (1 + beta ** 2) * tp / ((1 + beta ** 2) * tp + beta ** 2 * fn + fp) if tp + fn + fp else -1
            best = max(best, (f, -t))
        row = stats.best_threshold(df, [beta]).first()
        assert row.max_score == pytest.approx(best[0]) and row.threshold == pytest.approx(-best[1] / 100)


def newton(x, y, l2):
    theta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ theta))
        theta = theta + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(theta)), x.T @ (y - p) - l2 * theta)
    return theta


def test_fit_per_group_equals_local_fits(spark):
    rng = np.random.default_rng(7)
    data, local = [], {}
    for group, n in (("hot", 600), ("b", 150), ("few", 10)):
        x = np.column_stack([np.ones(n), rng.normal(size=(n, 2))])
        y = (rng.random(n) < 1 / (1 + np.exp(-x @ [0.3, 1.2, -0.7]))).astype(int)
        local[group] = (x, y)
        data += [(group, int(b), a.tolist()) for a, b in zip(x, y)]
    samples = spark.createDataFrame(data, "exercise string, correct int, features array<double>").repartition(5)
    fits = {r.exercise: r for r in models.fit_per_group(samples, min_samples=100, l2=0.5).collect()}
    assert fits["few"].theta is None and fits["few"].num_samples == 10
    for group in ("hot", "b"):
        assert np.allclose(fits[group].theta, newton(*local[group], 0.5), atol=1e-6)
    scored = models.predict_per_group(samples, models.fit_per_group(samples, min_samples=100, l2=0.5))
    assert scored.count() == 750
    # the fitted model is calibrated where the penalty does not bear on it
    assert abs(scored.agg(F.avg("p") - F.avg("correct")).first()[0]) < 0.01


def test_random_components_are_unit_and_stable(spark):
    keys = spark.createDataFrame([("e1", "t", True), ("e1", "t", False), ("e2", "t", True)], "exercise string, problem_type string, correct boolean")
    one, two = (sorted(tuple(r) for r in models.random_components(keys, 20).collect()) for _ in range(2))
    assert one == two and len({r[3] for r in one}) == 3
    for r in one:
        assert sum(v * v for v in r[3:]) == pytest.approx(1.0)


def test_feature_samples_sum_first_attempts(spark):
    data, df = attempts(spark, 11, n=120)
    parts = {tuple(r)[:3]: np.array(tuple(r)[3:]) for r in models.random_components(df, 4).collect()}
    out = models.feature_samples(df, dim=4, numbers=(1, 1000))
    got = sorted((r.attempt_number, r.exercise, r.n_prev_ex, tuple(np.round(r.random, 9))) for r in out.collect())
    expected, state = [], {}
    for user, exercise, _, _, number, correct, kind in data:
        seen, total, n = state.setdefault(user, [set(), np.zeros(4), 0])
        seen.add(exercise)
        expected.append((n, exercise, len(seen), tuple(np.round(total, 9) + 0.0)))
        if number == 1:
            total = total + parts[exercise, kind, correct]
        state[user] = [seen, total, n + 1]
    assert len(got) == 120
    for a, b in zip(got, sorted(expected)):
        assert a[:3] == b[:3] and np.allclose(a[3], b[3], atol=1e-8)


def simulated(spark, users=150, seed=2):
    rng = np.random.default_rng(seed)
    ability = rng.normal(size=users)
    bias = {"easy": 1.5, "mid": 0.0, "hard": -1.5, "flat": 0.2}
    data, i = [], 0
    for u in range(users):
        for exercise, b in bias.items():
            slope = 0.05 if exercise == "flat" else 1.5
            right = rng.random() < 1 / (1 + np.exp(-(slope * ability[u] + b)))
            for again in (right, not right):  # the second answer must not count
                data.append((f"u{u}", exercise, bool(again), int(np.exp(2 - 0.5 * ability[u]) * 10) + 1, float(i), i))
                i += 1
    return ability, spark.createDataFrame(data, "user string, exercise string, correct boolean, time_taken int, time_done double, event_id bigint")


def marginal(spark, data, items, points=None):
    return models.estimate_abilities(data, items, points=points).agg(F.sum("logl")).first()[0]


def test_item_response_recovers_order(spark):
    ability, responses = simulated(spark)
    items, abilities = models.item_response_fit(responses, epochs=5)
    w = {r.exercise: r.w_correct for r in items.collect()}
    assert w["easy"][1] > w["mid"][1] > w["hard"][1]
    assert min(w[e][0] for e in ("easy", "mid", "hard")) > w["flat"][0]
    theta = {r.user: r.theta[0] for r in abilities.collect()}
    assert np.corrcoef(ability, [theta[f"u{u}"] for u in range(len(ability))])[0, 1] > 0.5
    data = models.first_responses(responses, ["time_done", "event_id"])
    shorter, _ = models.item_response_fit(responses, epochs=1)
    assert marginal(spark, data, items) > marginal(spark, data, shorter)


def test_item_response_is_a_stationary_point(spark):
    """The numerical gradient of the penalised log likelihood vanishes at the fit."""
    _, responses = simulated(spark, users=60)
    items, _ = models.item_response_fit(responses, epochs=60, l2=0.5, points=9)
    data = models.first_responses(responses, ["time_done", "event_id"]).cache()
    fitted = {r.exercise: list(r.w_correct) for r in items.collect()}

    def loss(w):
        rows = [(e, v, [0.0, 0.0], 1.0) for e, v in w.items()]
        table = spark.createDataFrame(rows, "exercise string, w_correct array<double>, w_time array<double>, sigma double")
        return marginal(spark, data, table, 9) - 0.5 * sum(x * x for v in w.values() for x in v)

    for exercise, j in (("easy", 0), ("mid", 1)):
        step = 1e-3
        up, down = ({e: [x + (d if (e, i) == (exercise, j) else 0) for i, x in enumerate(v)] for e, v in fitted.items()} for d in (step, -step))
        assert abs(loss(up) - loss(down)) / (2 * step) < 0.05
    data.unpersist()


def test_item_response_in_two_dimensions(spark):
    _, responses = simulated(spark, users=40)
    items, abilities = models.item_response_fit(responses, dims=2, epochs=2, use_time=True)
    assert all(len(r.w_correct) == 3 and r.sigma > 0 for r in items.collect())
    assert all(len(r.theta) == 2 for r in abilities.limit(3).collect())


def test_many_breaks_need_few_rounds(spark, monkeypatch):
    """Each number is met twice, with noise between, so every attempt ends a run."""
    rows = []
    for i in range(1, 1001):
        rows += [("u", "e", 10.0 * i, 3 * i, i, True), ("u", "e", 10.0 * i + 1, 3 * i + 1, i + 5000, True), ("u", "e", 10.0 * i + 2, 3 * i + 2, i, True)]
    steps = []
    plain = stats.cut_lineage
    monkeypatch.setattr(stats, "cut_lineage", lambda df: steps.append(1) or plain(df))
    df = spark.createDataFrame(rows, "user string, exercise string, time_done double, event_id int, problem_number bigint, correct boolean")
    taken = {r.event_id for r in stats.in_order_attempts(df).collect()}
    assert taken == {3 * i for i in range(1, 1001)}
    assert len(steps) < 45


def test_converged_is_said(spark):
    rows = [(f"g{i % 2}", int(i % 3 > 0), [1.0, float(i % 5)]) for i in range(400)]
    df = spark.createDataFrame(rows, "exercise string, correct int, features array<double>")
    assert all(r.converged for r in models.fit_per_group(df, min_samples=10).collect())
    assert not any(r.converged for r in models.fit_per_group(df, min_samples=10, max_steps=1).collect())
    assert all(r.converged is None for r in models.fit_per_group(df, min_samples=1000).collect())


def test_three_abilities(spark):
    nodes, weights = models.quadrature(3, 64)
    assert nodes.shape == (128, 3) and abs(weights.sum() - 1) < 1e-9 and np.abs(weights @ nodes).max() < 1e-9
    rng = np.random.default_rng(1)
    rows = [(f"u{u}", f"e{e}", bool(rng.random() < 0.3 + 0.1 * (u % 4)), 10, float(e), e) for u in range(30) for e in range(6)]
    df = spark.createDataFrame(rows, "user string, exercise string, correct boolean, time_taken int, time_done double, event_id int")
    items, abilities = models.item_response_fit(df, dims=3, epochs=2, points=8)
    assert all(len(r.w_correct) == 4 for r in items.collect())
    assert all(len(r.theta) == 3 and np.isfinite(r.theta).all() for r in abilities.collect()) and abilities.count() == 30


def test_registered_fits_use_the_operators_defaults(spark, monkeypatch):
    from lectern.plans import load_all
    from lectern.plans.registry import QUERIES

    load_all()
    asked, fit = [], models.item_response_fit

    def spy(responses, **options):
        asked.append(set(options))
        return fit(responses, **{**options, "epochs": 1})

    monkeypatch.setattr(models, "item_response_fit", spy)
    for name in ("item_response_fit", "item_response_abilities"):
        assert "converged" in QUERIES[name](spark, "/root/testdata/sf0.001").columns
    assert len(asked) == 2 and not set.union(*asked) & {"epochs", "tolerance"}
    described = []
    vector = models.feature_vector
    monkeypatch.setattr(models, "feature_vector", lambda samples, *rest: described.append(samples) or vector(samples, *rest))
    from lectern.plans import stats
    from lectern.plans.bindings import Inputs

    stats.training(Inputs(spark, "/root/testdata/sf0.001"))
    assert {r["n"] for r in described[0].selectExpr("size(random) AS n").distinct().collect()} == {100}


def test_expected_counts_are_the_sums_over_answers(spark):
    data = spark.createDataFrame(
        [(u, f"e{e}", (u + e) % 3 > 0, None if u == 4 or e == u else 1.0 + (u * e) % 4) for u in range(5) for e in range(3)] + [(None, "e1", True, 1.0), (7, None, True, 1.0)],
        "user int, exercise string, correct boolean, log_time double")
    nodes, weights = models.quadrature(1, 5)
    given = {f"e{e}": {"w_correct": [0.5 + e, 0.1 * e], "w_time": [0.2, 0.3 * e], "sigma": 1.0 + e} for e in range(3)}
    items = spark.createDataFrame([(e, i["w_correct"], i["w_time"], i["sigma"]) for e, i in given.items()], "exercise string, w_correct array<double>, w_time array<double>, sigma double")
    for use_time in (False, True):
        rows = data.where("user IS NOT NULL").join(models._posteriors(data, items, nodes, weights, use_time), "user").where("exercise IS NOT NULL")
        wanted = {r[0]: r[1:] for r in rows.groupBy("exercise").agg(
            F.array(*[F.sum(F.col("post")[i]) for i in range(5)]), F.array(*[F.sum(F.when(F.col("correct"), F.col("post")[i]).otherwise(0.0)) for i in range(5)]),
            F.array(*[F.sum(F.col("post")[i] * F.col("log_time")) for i in range(5)]), F.sum(F.when(F.col("post")[0].isNotNull(), F.col("log_time") * F.col("log_time")))).collect()}
        parts = models.by_user(data, "correct", "log_time").select("answers").mapInArrow(
            models._expected(given, nodes, weights, use_time), "exercise string, n array<double>, r array<double>, s array<double>, q double").collect()
        for exercise, (n, r, s, q) in wanted.items():
            mine = [part for part in parts if part.exercise == exercise]
            for name, value in (("n", n), ("r", r), ("s", s), ("q", q)):
                assert np.allclose(np.sum([part[name] for part in mine], axis=0), value)


def test_the_registered_slope_fits_first(spark, monkeypatch):
    from lectern.plans import load_all
    from lectern.plans.registry import QUERIES

    load_all()
    asked, fit = [], models.item_response_fit
    monkeypatch.setattr(models, "item_response_fit", lambda *args, **named: asked.append(named) or fit(*args, **{**named, "epochs": 1}))
    out = QUERIES["item_response_slope"](spark, "/root/testdata/sf0.001")
    assert asked == [{}] and "flat" in out.columns


def test_feature_samples_scan_without_the_vectors(spark):
    attempts = spark.createDataFrame(
        [(u, f"e{n % 2}", "a", n % 3 > 0, n // 2 + 1, float(n), u * 10 + n, False) for u in range(3) for n in range(6)],
        "user int, exercise string, problem_type string, correct boolean, problem_number int, time_done double, event_id int, randomized boolean")
    samples = models.feature_samples(attempts, dim=2)
    assert samples.count() == 18

    def nodes(plan):
        yield plan
        below = plan.children()
        for i in range(below.size()):
            yield from nodes(below.apply(i))

    scans = [n for n in nodes(samples._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Window"]
    outputs = [[n.output().apply(i).name() for i in range(n.output().size())] for n in scans]
    assert outputs and not any("c0" in names for names in outputs)
