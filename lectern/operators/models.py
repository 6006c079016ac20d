"""Model fits whose sums are made by Spark: logistic regression per group, forests, item response.

A group's samples never come together.  Each iteration is a scan that adds up the few numbers per
group the next step needs; only those go through small numpy solves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.ordered import epoch_hour_chunk, scan_groups
from lectern.operators.stats import FEATURES, accuracy_features, history_validity, score, WEIGHTS
from lectern.session import cut_lineage

MIN_SAMPLES = 2500
NODES, MORE_NODES = {1: 15, 2: 7}, 64
SEED = 7


# -- feature samples ---------------------------------------------------------------------------


def unit_uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts only: 32 bits of their md5."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def random_components(keys: DataFrame, dim: int, seed: int = SEED) -> DataFrame:
    """A fixed unit vector per (exercise, problem_type, correct), normal in every direction.

    Vectors follow from their key and the seed, so every run and every executor has the same ones.
    """
    def normal(i: int) -> Column:
        base = [F.lit(str(seed)), F.col("exercise"), F.col("problem_type"), F.col("correct").cast("string"), F.lit(str(i))]
        return F.sqrt(-2.0 * F.log(unit_uniform(*base, F.lit("r")))) * F.cos(2 * np.pi * unit_uniform(*base, F.lit("a")))

    raw = keys.select("exercise", "problem_type", "correct").distinct().withColumns({f"__z{i}": normal(i) for i in range(dim)})
    length = F.sqrt(sum((F.col(f"__z{i}") * F.col(f"__z{i}") for i in range(dim)), F.lit(0.0)))
    return raw.select("exercise", "problem_type", "correct", *[(F.col(f"__z{i}") / length).alias(f"c{i}") for i in range(dim)])


def feature_samples(
    attempts: DataFrame, chunk: Column | None = None, dim: int = 100, seed: int = SEED, numbers: tuple[int, int | None] = (1, 6), one_in_n: int | None = None,
    order: Sequence[str] = ("time_done", "event_id"), weights: dict[str, float] = WEIGHTS, randomized: bool = False,
) -> DataFrame:
    """Training samples of users with a valid history, described before each attempt: model prediction and
    features, exercises met so far, position, and the sum of the random vectors of their first attempts.

    Sampled are problem numbers in [numbers) (None: no upper end), or one in ``one_in_n`` attempts by hash; ``randomized``
    keeps only cards the scheduler drew at random, while all attempts still count as history.
    """
    chunk = epoch_hour_chunk(order[0]) if chunk is None else chunk
    valid = history_validity(attempts, chunk, order).where("sequential").select("user")
    rows = attempts.join(valid, "user", "left_semi")
    described = cut_lineage(accuracy_features(rows, chunk, order=order).withColumn("prediction", score(weights)))
    keys = ["exercise", "problem_type", "correct"]
    parts = cut_lineage(random_components(described.where("problem_number = 1"), dim, seed))
    with_parts = described.join(parts, keys, "left")
    begins = F.col("total_done") == 0
    first = F.col("problem_number") == 1
    own = lambda i: F.when(first, F.coalesce(f"c{i}", F.lit(0.0))).otherwise(0.0)
    sums = {f"f{i}": own(i) for i in range(dim)}
    placed = scan_groups(with_parts, ["user"], order, chunk, number="position", sums={"n_prev_ex": begins.cast("int"), **sums})
    if one_in_n is not None:
        kept = placed.where(F.pmod(F.xxhash64("user", *order), F.lit(one_in_n)) == 0)
    else:
        kept = placed.where(F.col("problem_number") >= numbers[0])
        if numbers[1] is not None:
            kept = kept.where(F.col("problem_number") < numbers[1])
    if randomized:
        kept = kept.where("randomized")
    # The few vectors are joined anew: brought along, they would double the width of all rows that the scan shuffles.
    kept = kept.drop(*[f"c{i}" for i in range(dim)]).join(parts, keys, "left")
    return kept.select(
        "exercise", F.col("correct").cast("int").alias("correct"), "prediction", "n_prev_ex", "problem_number",
        (F.col("position") - 1).alias("attempt_number"), *FEATURES, F.array(*[F.col(f"f{i}") - own(i) for i in range(dim)]).alias("random"))


def feature_vector(samples: DataFrame, families: Sequence[str], bias: bool = True) -> DataFrame:
    """``features`` made of the named families: baseline, custom, random, mirt."""
    parts = [F.array(F.lit(1.0))] if bias else []
    for family in families:
        parts.append({
            "baseline": lambda: F.array(F.col("prediction").cast("double")),
            "custom": lambda: F.array(*[F.col(c).cast("double") for c in FEATURES]),
            "random": lambda: F.col("random"), "mirt": lambda: F.col("mirt"),
        }[family]())
    clean = lambda v: F.when(v.isNull() | F.isnan(v), 0.0).otherwise(v)
    return samples.withColumn("features", F.transform(F.concat(*parts), clean))


# -- logistic regression -----------------------------------------------------------------------


def _partial_sums(group: str, label: str):
    """Per task and group the gradient and curvature of the log likelihood at theta, as one flat row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for key, rows in batch.groupby(group, sort=False):
                x = np.stack(rows["features"].to_numpy())
                theta = np.asarray(rows["theta"].iloc[0])
                p = 1.0 / (1.0 + np.exp(-np.clip(x @ theta, -100, 100)))
                gradient = x.T @ (rows[label].to_numpy(dtype=float) - p)
                curvature = (x * (p * (1 - p))[:, None]).T @ x
                flat = np.concatenate([gradient, curvature.ravel()])
                sums[key] = sums[key] + flat if key in sums else flat
        if sums:
            yield pd.DataFrame({group: list(sums), "part": [v.tolist() for v in sums.values()]})

    return run


def _newton_steps(group: str, l2: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            thetas, moves = [], []
            for theta, flat in zip(batch["theta"], batch["total"]):
                theta, flat = np.asarray(theta), np.asarray(flat)
                d = len(theta)
                gradient = flat[:d] - l2 * theta
                curvature = flat[d:].reshape(d, d) + l2 * np.eye(d)
                move = np.linalg.lstsq(curvature, gradient, rcond=None)[0]
                size = float(np.abs(move).max())
                move = move * min(1.0, 5.0 / size) if size > 0 else move
                thetas.append((theta + move).tolist())
                moves.append(size)
            yield pd.DataFrame({group: batch[group], "theta": thetas, "move": moves})

    return run


def fit_per_group(
    samples: DataFrame, group: str = "exercise", label: str = "correct", min_samples: int = MIN_SAMPLES, l2: float = 1e-6,
    max_steps: int = 100, tolerance: float = 1e-7,
) -> DataFrame:
    """Logistic regression of ``label`` on ``features`` for every group at once: theta, sample count, and
    ``converged``, whether the last step moved no entry by ``tolerance`` or more.

    Newton's method: each step is one pass over the samples in which every task adds up gradient and
    curvature per group; the sums meet entry by entry, and the solves see one row per group.  Groups
    below ``min_samples`` get no theta.  Group, theta and step tables are as small as the catalogue.
    """
    counts = cut_lineage(samples.groupBy(group).agg(F.count(F.lit(1)).alias("num_samples"), F.max(F.size("features")).alias("d")))
    data = samples.select(group, F.col(label).cast("double").alias(label), "features")
    kind = dict(samples.dtypes)[group]
    theta = cut_lineage(counts.where(F.col("num_samples") >= min_samples).select(group, F.array_repeat(F.lit(0.0), F.col("d")).alias("theta"), F.lit(None).cast("double").alias("move")))
    for _ in range(max_steps):
        rows = data.join(theta.select(group, "theta"), group)
        parts = rows.mapInPandas(_partial_sums(group, label), f"{group} {kind}, part array<double>")
        cells = parts.select(group, F.posexplode("part").alias("i", "v")).groupBy(group, "i").agg(F.sum("v").alias("v"))
        total = cells.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda c: c["v"]).alias("total"))
        stepped = cut_lineage(theta.select(group, "theta").join(total, group).mapInPandas(_newton_steps(group, l2), f"{group} {kind}, theta array<double>, move double"))
        theta = stepped
        largest = stepped.agg(F.max("move")).first()[0]
        if largest is None or largest < tolerance:
            break
    fitted = theta.withColumn("converged", F.coalesce(F.col("move") < tolerance, F.lit(False)))
    return counts.drop("d").join(fitted, group, "left").select(group, "theta", "num_samples", "converged")


def predict_per_group(samples: DataFrame, fits: DataFrame, group: str = "exercise") -> DataFrame:
    """Add ``p``, the fitted probability, for the groups that have a theta."""
    z = F.aggregate(F.zip_with("features", "theta", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    joined = samples.join(fits.where("theta IS NOT NULL").select(group, "theta"), group)
    return joined.withColumn("p", 1.0 / (1.0 + F.exp(-F.greatest(F.least(z, F.lit(100.0)), F.lit(-100.0))))).drop("theta")


def fit_forest(samples: DataFrame, label: str = "correct", trees: int = 100, depth: int = 5, seed: int = SEED) -> DataFrame:
    """Random forest over all samples as one topic, with the probability of a right answer for each."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = samples.withColumns({"__x": array_to_vector(F.col("features")), "__y": F.col(label).cast("double")})
    forest = RandomForestClassifier(featuresCol="__x", labelCol="__y", numTrees=trees, maxDepth=depth, seed=seed, probabilityCol="__p", rawPredictionCol="__r", predictionCol="__d")
    scored = forest.fit(rows).transform(rows)
    return scored.withColumn("p", vector_to_array("__p")[1]).drop("__x", "__y", "__p", "__r", "__d")


# -- item response -----------------------------------------------------------------------------


def quadrature(dims: int, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights of a standard normal ability: an even grid in 1 or 2 dimensions with ``points`` a side, and beyond
    ``points`` draws of a fixed seed with their mirror images, as a grid would grow with the power of the dimensions."""
    if dims > 2:
        drawn = np.random.default_rng(SEED).standard_normal((points, dims))
        nodes = np.concatenate([drawn, -drawn])
        return nodes, np.full(len(nodes), 1.0 / len(nodes))
    axis = np.linspace(-4.0, 4.0, points)
    mass = np.exp(-axis ** 2 / 2)
    if dims == 1:
        nodes, weights = axis[:, None], mass
    else:
        nodes = np.array([(a, b) for a in axis for b in axis])
        weights = np.array([u * v for u in mass for v in mass])
    return nodes, weights / weights.sum()


def _solve_items(nodes: np.ndarray, l2: float, use_time: bool):
    """New couplings of each exercise from its expected counts at the nodes."""
    x = np.hstack([nodes, np.ones((len(nodes), 1))])
    d = x.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"exercise": batch["exercise"], "w_correct": [], "w_time": [], "sigma": [], "move": []}
            for row in batch.itertuples(index=False):
                n, r = np.asarray(row.n), np.asarray(row.r)
                before = w = np.asarray(row.w_correct)
                for _ in range(20):
                    p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
                    gradient = x.T @ (r - n * p) - 2 * l2 * w
                    curvature = (x * (n * p * (1 - p))[:, None]).T @ x + 2 * l2 * np.eye(d)
                    move = np.linalg.solve(curvature, gradient)
                    w = w + np.clip(move, -2, 2)
                    if np.abs(move).max() < 1e-9:
                        break
                out["w_correct"].append(w.tolist())
                out["move"].append(float(np.abs(w - before).max()))
                if use_time:
                    s = np.asarray(row.s)
                    v = np.linalg.solve((x * n[:, None]).T @ x + 2 * l2 * np.eye(d), x.T @ s)
                    rest = row.q - 2 * v @ (x.T @ s) + v @ ((x * n[:, None]).T @ x) @ v
                    out["w_time"].append(v.tolist())
                    out["sigma"].append(float(np.sqrt(max(rest / max(n.sum(), 1e-9), 1e-4))))
                else:
                    out["w_time"].append([0.0] * d)
                    out["sigma"].append(1.0)
            yield pd.DataFrame(out)

    return run


def _posteriors(responses: DataFrame, items: DataFrame, nodes: np.ndarray, weights: np.ndarray, use_time: bool) -> DataFrame:
    """Per user the weight of each node given the answers: sums of log likelihoods, so a user's answers
    are added up on the map side."""
    dims = nodes.shape[1]
    rows = responses.join(items, "exercise")

    def line(w: str, node: np.ndarray) -> Column:
        return sum((F.col(w)[j] * float(node[j]) for j in range(dims)), F.col(w)[dims])

    def log_chance(node: np.ndarray) -> Column:
        z = F.greatest(F.least(line("w_correct", node), F.lit(30.0)), F.lit(-30.0))
        out = -F.log1p(F.exp(F.when(F.col("correct"), -z).otherwise(z)))
        if use_time:
            err = line("w_time", node) - F.col("log_time")
            out = out - err * err / (2 * F.col("sigma") * F.col("sigma")) - F.log("sigma")
        return out

    sums = rows.groupBy("user").agg(*[F.sum(log_chance(node)).alias(f"l{q}") for q, node in enumerate(nodes)])
    logs = sums.select("user", F.array(*[F.col(f"l{q}") + float(np.log(w)) for q, w in enumerate(weights)]).alias("l"))
    peak = logs.withColumn("m", F.array_max("l")).withColumn("e", F.transform("l", lambda v: F.exp(v - F.col("m"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    return peak.withColumn("z", total).select(
        "user", F.transform("e", lambda v: v / F.col("z")).alias("post"), (F.col("m") + F.log("z")).alias("logl"))


def first_responses(responses: DataFrame, order: Sequence[str], max_time: float = 1000.0) -> DataFrame:
    """The first answer of each user to each exercise, with the log of its clamped time."""
    first = responses.groupBy("user", "exercise").agg(F.min_by(F.struct("correct", "time_taken"), F.struct(*order)).alias("r"))
    seconds = F.greatest(F.least(F.col("r.time_taken").cast("double"), F.lit(max_time)), F.lit(1.0))
    return first.select("user", "exercise", F.col("r.correct").alias("correct"), F.log(seconds).alias("log_time"))


def by_user(data: DataFrame, *columns: str) -> DataFrame:
    """One row for each known user with the answers (exercise and ``columns``), at most one per exercise, dealt evenly and written once."""
    rows = data.where("user IS NOT NULL").groupBy("user").agg(F.sort_array(F.collect_list(F.struct("exercise", *columns))).alias("answers"))
    return cut_lineage(rows.repartition(3 * data.sparkSession.sparkContext.defaultParallelism))


def _expected(items: dict, nodes: np.ndarray, weights: np.ndarray, use_time: bool):
    """Per task and exercise the expected answers, right answers and log times at each node, from users' whole answers."""
    x = np.hstack([nodes, np.ones((len(nodes), 1))])
    names = pa.array(list(items), pa.string())
    w, v, sigma = (np.array([item[c] for item in items.values()], dtype=float) for c in ("w_correct", "w_time", "sigma"))
    prior = np.log(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, r, s = (np.zeros((len(names), len(nodes))) for _ in range(3))
        q = np.zeros(len(names))
        for batch in batches:
            answers = batch.column("answers")
            flat, sizes = answers.flatten(), answers.value_lengths().to_numpy()
            k = pc.fill_null(pc.index_in(flat.field("exercise"), names), -1).to_numpy(zero_copy_only=False)
            known = np.flatnonzero(k >= 0)
            k, user = k[known], np.repeat(np.arange(len(sizes)), sizes)[known]
            right = pc.fill_null(flat.field("correct"), False).to_numpy(zero_copy_only=False)[known]
            time = flat.field("log_time").to_numpy(zero_copy_only=False)[known].astype(float)
            z = np.clip(w[k] @ x.T, -30, 30)
            chance = -np.log1p(np.exp(np.where(right[:, None], -z, z)))
            tells = np.ones(len(k), dtype=bool)
            if use_time:
                tells = ~np.isnan(time)  # an answer without a time says nothing
                miss = v[k] @ x.T - time[:, None]
                chance = chance - miss * miss / (2 * sigma[k] * sigma[k])[:, None] - np.log(sigma[k])[:, None]
            logs = np.zeros((len(sizes), len(nodes)))
            np.add.at(logs, user[tells], chance[tells])
            logs += prior
            post = np.exp(logs - logs.max(axis=1, keepdims=True))
            post /= post.sum(axis=1, keepdims=True)
            counted = np.bincount(user[tells], minlength=len(sizes))[user] > 0
            k, share, right, time = k[counted], post[user[counted]], right[counted], time[counted]
            np.add.at(n, k, share)
            np.add.at(r, k[right], share[right])
            timed = ~np.isnan(time)
            np.add.at(s, k[timed], share[timed] * time[timed, None])
            np.add.at(q, k[timed], time[timed] ** 2)
        seen = np.flatnonzero(n.any(axis=1))
        lists = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(seen, pa.int64())), *[pa.array(c[seen].tolist(), lists) for c in (n, r, s)], pa.array(q[seen], pa.float64())],
            names=["exercise", "n", "r", "s", "q"])

    return run


def item_response_fit(
    responses: DataFrame, dims: int = 1, epochs: int = 100, l2: float = 1e-3, use_time: bool = False, points: int | None = None,
    order: Sequence[str] = ("time_done", "event_id"), tolerance: float = 1e-3,
) -> tuple[DataFrame, DataFrame]:
    """Item couplings and user abilities by expectation maximisation over a grid of abilities.

    Each epoch is one scan of the users, each with the own answers: node weights of each user, expected counts per exercise and node added up
    by the tasks, and one small solve per exercise.  Abilities are standard normal; the
    signs are set so that the mean coupling is not negative.  It ends when no coupling moves by ``tolerance`` in
    an epoch, or after ``epochs``.  Returns (items, abilities); ``converged`` says for each item whether its couplings had come to rest.
    """
    nodes, weights = quadrature(dims, points or NODES.get(dims, MORE_NODES))
    data = cut_lineage(first_responses(responses, order))
    users = by_user(data, "correct", "log_time")
    spark, known = data.sparkSession, "exercise string, w_correct array<double>, w_time array<double>, sigma double, move double"
    start = [0.5**j for j in range(dims)] + [0.0]  # equal axes could not part
    fitted = [(r[0], start, [0.0] * (dims + 1), 1.0, None) for r in data.select("exercise").distinct().where("exercise IS NOT NULL").collect()]
    for _ in range(epochs):
        # The couplings, a few numbers for each exercise, go out with the tasks; the answers stay where they are.
        items = {r[0]: {"w_correct": r[1], "w_time": r[2], "sigma": r[3]} for r in fitted}
        if not items:
            break
        parts = users.select("answers").mapInArrow(_expected(items, nodes, weights, use_time), "exercise string, n array<double>, r array<double>, s array<double>, q double")
        added = lambda c: F.array(*[F.sum(F.col(c)[i]) for i in range(len(nodes))]).alias(c)
        counts = parts.groupBy("exercise").agg(added("n"), added("r"), added("s"), F.sum("q").alias("q"))
        before = F.create_map(*[F.lit(x) for name, item in items.items() for x in (name, list(map(float, item["w_correct"])))])
        solved = counts.withColumn("w_correct", before[F.col("exercise")]).mapInPandas(_solve_items(nodes, l2, use_time), known)
        fitted = [tuple(r) for r in solved.collect()]
        if not fitted or max(r[4] for r in fitted) < tolerance:
            break
    items = spark.createDataFrame(fitted, known)
    mean = [items.agg(F.avg(F.col("w_correct")[j])).scalar() for j in range(dims)]
    sign = [F.when(mean[j] < 0, -1.0).otherwise(1.0) for j in range(dims)] + [F.lit(1.0)]
    flip = lambda w: F.array(*[F.col(w)[j] * sign[j] for j in range(dims + 1)]).alias(w)
    items = cut_lineage(items.select("exercise", flip("w_correct"), flip("w_time"), "sigma", F.coalesce(F.col("move") < tolerance, F.lit(False)).alias("converged")))
    return items, estimate_abilities(data, items, dims, use_time, points)


def estimate_abilities(data: DataFrame, items: DataFrame, dims: int = 1, use_time: bool = False, points: int | None = None) -> DataFrame:
    """Posterior mean ability of each user, and the log likelihood of the answers."""
    nodes, weights = quadrature(dims, points or NODES.get(dims, MORE_NODES))
    post = _posteriors(data, items, nodes, weights, use_time)
    mean = [sum((F.col("post")[i] * float(node[j]) for i, node in enumerate(nodes)), F.lit(0.0)) for j in range(dims)]
    return post.select("user", F.array(*mean).alias("theta"), "logl")


def response_abilities(items: DataFrame, dims: int = 1, points: int | None = None) -> DataFrame:
    """What one answer says: (exercise, correct, ability, variance, difficulty) for a right and a wrong answer to each item.

    Ability and variance are those of the posterior over the grid, taken over all dimensions alike; the difficulty is the
    item's constant coupling.  Their precision, 1 / variance, weighs abilities in sums over answers.
    """
    nodes, weights = quadrature(dims, points or NODES.get(dims, MORE_NODES))
    rows = items.select("exercise", F.col("w_correct"), F.explode(F.array(F.lit(True), F.lit(False))).alias("correct"))
    sign = F.when(F.col("correct"), 1.0).otherwise(-1.0)

    def chance(node: np.ndarray) -> Column:
        return 1.0 / (1.0 + F.exp(-sign * sum((F.col("w_correct")[j] * float(node[j]) for j in range(dims)), F.col("w_correct")[dims])))

    post = rows.withColumn("post", F.array(*[chance(node) * float(w) for node, w in zip(nodes, weights)]))
    total = lambda values: sum((F.col("post")[q] * float(v) for q, v in enumerate(values)), F.lit(0.0))
    whole = total(np.ones(len(nodes)))
    moments = post.select(
        "exercise", "correct", (total(nodes.mean(axis=1)) / whole).alias("ability"), (total((nodes**2).mean(axis=1)) / whole).alias("square"), F.col("w_correct")[dims].alias("difficulty"))
    return moments.select("exercise", "correct", "ability", (F.col("square") - F.col("ability") * F.col("ability")).alias("variance"), "difficulty")


def item_response_slope(data: DataFrame, items: DataFrame, dims: int = 1, l2: float = 1e-3, points: int | None = None) -> DataFrame:
    """Per exercise the slope of the penalised log likelihood at its couplings, per answer: (exercise, n, slope).

    At a fit's result every entry is near 0, whatever way the fit took.
    """
    nodes, weights = quadrature(dims, points or NODES.get(dims, MORE_NODES))
    rows = data.join(_posteriors(data, items, nodes, weights, False).select("user", "post"), "user").join(items.select("exercise", "w_correct"), "exercise")

    def miss(node: np.ndarray) -> Column:
        z = sum((F.col("w_correct")[j] * float(node[j]) for j in range(dims)), F.col("w_correct")[dims])
        return F.col("correct").cast("double") - 1.0 / (1.0 + F.exp(-z))

    parts = [F.sum(sum((F.col("post")[q] * miss(node) * float([*node, 1.0][j]) for q, node in enumerate(nodes)), F.lit(0.0))) for j in range(dims + 1)]
    sums = rows.groupBy("exercise", "w_correct").agg(F.count(F.lit(1)).alias("n"), F.array(*parts).alias("s"))
    return sums.select("exercise", "n", F.zip_with("s", "w_correct", lambda s, w: (s - 2 * l2 * w) / F.col("n")).alias("slope"))
