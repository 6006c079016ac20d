"""Statistics of answers and scores: trimmed means, accuracy features, predictions and their quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions.columns import count_if
from lectern.functions.ordered import CHUNK, epoch_hour_chunk, scan_groups
from lectern.functions.quantile import exact_quantiles, value_ranks
from lectern.session import cut_lineage

# Fixed values of the accuracy model.
FIRST_PROBLEM = 0.8
EWMA_SEED = 0.9
HISTORY = 20
STRUGGLE = 20.0
WEIGHTS = {
    "intercept": -1.2229719,
    "ewma_3": 0.8393673,
    "ewma_10": 2.1262489,
    "streak": 0.0153545,
    "log_done": 0.4135883,
    "log_missed": -0.5677724,
    "pct_correct": 0.6284309,
}
FEATURES = ("ewma_3", "ewma_10", "streak", "log_done", "log_missed", "pct_correct")
THRESHOLDS = 103  # -0.01, 0.00 ... 1.01
LOG_FLOOR = -100.0


def trimmed_mean(
    df: DataFrame, value: str, keys: Sequence[str], lower: float = 0.1, upper: float = 0.9, width: float | None = None
) -> DataFrame:
    """Mean of the values whose rank percentile lies in [lower, upper]; values that are not finite do not
    count.  One value has percentile .5, two have .49999 and .50001.

    Works on counts of distinct values, so a key's values never meet in one place.
    """
    finite = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & (F.abs(F.col(value).cast("double")) < float("inf")))
    ranks = value_ranks(finite, keys, value, width)
    top = F.col("total") - 1
    low = F.when(top > 1, F.ceil(F.lit(lower) * top - 1e-9)).when(top == 1, F.when(F.lit(lower <= 0.49999), 0).when(F.lit(lower <= 0.50001), 1).otherwise(2)) \
        .otherwise(F.when(F.lit(lower <= 0.5), 0).otherwise(1))
    high = F.when(top > 1, F.floor(F.lit(upper) * top + 1e-9)).when(top == 1, F.when(F.lit(upper >= 0.50001), 1).when(F.lit(upper >= 0.49999), 0).otherwise(-1)) \
        .otherwise(F.when(F.lit(upper >= 0.5), 0).otherwise(-1))
    copies = F.greatest(F.lit(0), F.least(F.col("last") - 1, high) - F.greatest(F.col("last") - F.col("n"), low) + 1)
    sums = ranks.withColumn("c", copies).groupBy(*keys).agg(
        F.sum(F.col(value) * F.col("c")).alias("s"), F.sum("c").alias("n"))
    return sums.select(*keys, (F.col("s") / F.when(F.col("n") > 0, F.col("n"))).alias("avg"))


def answer_history(
    attempts: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column | None = None, correct: str = "correct", size: int = HISTORY
) -> DataFrame:
    """Add ``history``: the up to ``size`` answers before each attempt, oldest first, as 1 and 0.

    Windows run inside (keys, chunk); the last answers of earlier chunks are carried over, of which
    at most ``size`` chunks can matter.
    """
    keys = list(keys)
    chunk = epoch_hour_chunk(order[0]) if chunk is None else chunk
    answer = F.col(correct).cast("int")
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    rows = attempts.withColumn(CHUNK, chunk).withColumns({
        "__own": F.collect_list(answer).over(inside.rowsBetween(-size, -1)),
        "__tail": F.collect_list(answer).over(inside.rowsBetween(-size + 1, 0))})
    tails = rows.groupBy(*keys, CHUNK).agg(F.max_by("__tail", F.struct(*order)).alias("__tail"))
    along = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(-size, -1)
    carried = tails.select(*keys, CHUNK, F.flatten(F.collect_list("__tail").over(along)).alias("__carry"))
    joined = F.concat("__carry", "__own")
    last = F.slice(joined, F.greatest(F.size(joined) - size + 1, F.lit(1)), F.lit(size))
    return rows.drop("__tail").join(carried, [*keys, CHUNK]).select(*[F.col(c) for c in attempts.columns], last.alias("history"))


def history_features(history: Column | str) -> dict[str, Column]:
    """The model's features of an answer history; an empty one has fixed values."""
    h = F.col(history) if isinstance(history, str) else history
    done = F.size(h)
    right = F.aggregate(h, F.lit(0), lambda a, x: a + x)
    last_miss = F.array_position(F.reverse(h), F.lit(0))

    def ewma(weight: float) -> Column:
        return F.aggregate(h, F.lit(EWMA_SEED), lambda a, x: F.lit(weight) * x + F.lit(1 - weight) * a)

    return {
        "ewma_3": ewma(0.333), "ewma_10": ewma(0.1),
        "streak": F.when(last_miss == 0, done).otherwise((last_miss - 1).cast("int")),
        "log_done": F.when(done > 0, F.log(done.cast("double"))).otherwise(F.lit(0.0)),
        "log_missed": F.log((done - right + 1).cast("double")),
        "pct_correct": F.when(done > 0, right / F.when(done > 0, done)).otherwise(F.lit(FIRST_PROBLEM)),
        "total_done": done,
    }


def accuracy_features(
    attempts: DataFrame, chunk: Column | None = None, user: str = "user", exercise: str = "exercise",
    order: Sequence[str] = ("time_done", "event_id"), correct: str = "correct", history: int = HISTORY,
) -> DataFrame:
    """Model features of each attempt from the user's earlier answers at the exercise."""
    rows = answer_history(attempts, [user, exercise], order, chunk, correct, history)
    return rows.withColumns(history_features("history")).drop("history")


def logistic(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def score(weights: dict[str, float], features: dict[str, Column] | None = None) -> Column:
    z = F.lit(float(weights["intercept"]))
    for name in FEATURES:
        z = z + F.lit(float(weights[name])) * (features[name] if features else F.col(name))
    done = features["total_done"] if features else F.col("total_done")
    return F.when(done > 0, logistic(z)).otherwise(F.lit(FIRST_PROBLEM))


def accuracy_predict(
    features: DataFrame, weights: dict[str, float] = WEIGHTS, exponent: float = 1.0, min_accuracy: float = 0.94, min_attempts: int = 5
) -> DataFrame:
    """Probability that the next answer is right, and whether the user is struggling:
    attempts ** exponent * (min_accuracy - p) above the limit."""
    out = features.withColumn("p", score(weights))
    gap = F.lit(min_accuracy) - F.col("p")
    struggling = (F.col("total_done") >= min_attempts) & (gap > 0) & (F.pow("total_done", F.lit(exponent)) * gap > STRUGGLE)
    return out.withColumn("struggling", struggling)


def min_streak(df: DataFrame, threshold: str, weights: dict[str, float] = WEIGHTS, longest: int = HISTORY) -> DataFrame:
    """Add ``streak``: the fewest right answers in a row from the start that reach the threshold.

    The history is full after ``longest`` answers, so a threshold not reached by then never is: NULL.
    """
    reached = F.transform(
        F.sequence(F.lit(1), F.lit(longest)),
        lambda n: score(weights, history_features(F.array_repeat(F.lit(1), n))) >= F.col(threshold))
    return df.withColumn("streak", F.nullif(F.array_position(reached, F.lit(True)), F.lit(0).cast("bigint")))


def history_validity(attempts: DataFrame, chunk: Column | None = None, order: Sequence[str] = ("time_done", "event_id")) -> DataFrame:
    """Per user: whether problem numbers go up by one within each exercise, and begin with 1."""
    chunk = epoch_hour_chunk(order[0]) if chunk is None else chunk
    steps = scan_groups(
        attempts.select("user", "exercise", "problem_number", *order), ["user", "exercise"], order, chunk, lags={"prev": "problem_number"})
    first = F.col("prev").isNull()
    return steps.groupBy("user").agg(
        F.bool_and(first | (F.col("problem_number") == F.col("prev") + 1)).alias("sequential"),
        F.bool_and(~first | (F.col("problem_number") == 1)).alias("complete"))


def score_bin(p: str = "p") -> Column:
    """Number of whole hundredths in a score, safe against the last bit."""
    return F.floor(F.round(F.col(p) * 100, 9)).cast("int")


def roc_curve(scores: DataFrame, keys: Sequence[str] = ("model", "exercise"), label: str = "label", p: str = "p") -> DataFrame:
    """True positive and true negative rates at the thresholds -0.01, 0 ... 1.01 for each key.

    Scores fold to at most 103 bins per key before they meet the thresholds.
    """
    keys = list(keys)
    bins = scores.groupBy(*keys, score_bin(p).alias("bin")).agg(
        count_if(F.col(label)).alias("pos"), count_if(~F.col(label)).alias("neg"))
    at = bins.withColumn("t", F.explode(F.sequence(F.lit(-1), F.lit(THRESHOLDS - 2))))
    above = F.col("bin") >= F.col("t")
    cells = at.groupBy(*keys, "t").agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(~above, F.col("neg")).otherwise(0)).alias("tn"))
    return cells.select(
        *keys, (F.col("t") / 100).alias("threshold"), (F.col("tp") / F.greatest(F.col("positives"), F.lit(1))).alias("tpr"),
        (F.col("tn") / F.greatest(F.col("negatives"), F.lit(1))).alias("tnr"))


def log_likelihood(label: str = "label", p: str = "p") -> Column:
    chance = F.when(F.col(label), F.col(p)).otherwise(1 - F.col(p))
    return F.when(chance > 0, F.greatest(F.log(F.when(chance > 0, chance)), F.lit(LOG_FLOOR))).otherwise(F.lit(LOG_FLOOR))


def quadratic_area(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Area under the least-squares quadratic of tpr over 1 - tnr on [0, 1], from sums of powers."""
    x, y = 1 - F.col("tnr"), F.col("tpr")
    sums = curve.groupBy(*keys).agg(
        *[F.sum(F.pow(x, F.lit(k))).alias(f"s{k}") for k in range(5)], *[F.sum(F.pow(x, F.lit(k)) * y).alias(f"y{k}") for k in range(3)])
    s = [F.col(f"s{k}") for k in range(5)]
    v = [F.col(f"y{k}") for k in range(3)]

    def det(m) -> Column:
        return (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
                + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))

    normal = [[s[i + j] for j in range(3)] for i in range(3)]
    whole = det(normal)
    area = sum(det([[v[i] if j == k else normal[i][j] for j in range(3)] for i in range(3)]) / (k + 1) for k in range(3))
    return sums.select(*keys, F.when(F.abs(whole) > 1e-12, area / F.when(F.abs(whole) > 1e-12, whole)).alias("auc"))


def trapezoid_area(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Area under the ROC points joined by straight lines; a key has 103 points."""
    fpr = 1 - F.col("tnr")
    along = Window.partitionBy(*keys).orderBy("threshold")
    steps = curve.select(*keys, (fpr - F.lead(fpr).over(along)).alias("dx"), ((F.col("tpr") + F.lead("tpr").over(along)) / 2).alias("h"))
    return steps.groupBy(*keys).agg(F.sum(F.col("dx") * F.col("h")).alias("auc_trapezoid"))


def auc_logloss(scores: DataFrame, keys: Sequence[str] = ("model", "exercise"), label: str = "label", p: str = "p", min_samples: int = 1) -> DataFrame:
    """Per key: area under the curve (quadratic and trapezoid), mean log likelihood, samples.

    Keys with fewer than ``min_samples`` of either class are left out.
    """
    keys = list(keys)
    totals = scores.groupBy(*keys).agg(
        F.avg(log_likelihood(label, p)).alias("avg_logl"), F.count(F.lit(1)).alias("n"),
        count_if(F.col(label)).alias("pos"), count_if(~F.col(label)).alias("neg"))
    totals = totals.where((F.col("pos") >= min_samples) & (F.col("neg") >= min_samples)).drop("pos", "neg")
    curve = roc_curve(scores, keys, label, p)
    return totals.join(quadratic_area(curve, keys), keys).join(trapezoid_area(curve, keys), keys)


def model_averages(quality: DataFrame, curve: DataFrame, model: str = "model", group: str = "exercise", at: Sequence[float] = (0.85, 0.95)) -> DataFrame:
    """Per model the plain and sample-weighted means over its groups of area and log likelihood, and the
    weighted rates in percent at the given thresholds."""
    mean = quality.groupBy(model).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"), F.avg("auc").alias("avg_auc"), F.avg("avg_logl").alias("avg_logl"),
        (F.sum(F.col("auc") * F.col("n")) / F.sum("n")).alias("weighted_auc"), (F.sum(F.col("avg_logl") * F.col("n")) / F.sum("n")).alias("weighted_logl"))
    rows = curve.join(quality.select(model, group, "n"), [model, group])

    def rate(column: Column, t: float) -> Column:
        on = F.round("threshold", 2) == F.lit(t)
        return 100 * F.sum(F.when(on, column * F.col("n"))) / F.sum(F.when(on, F.col("n")))

    rates = rows.groupBy(model).agg(*[
        rate(c, t).alias(f"{name}_{round(t * 100)}") for t in at for name, c in (("tpr", F.col("tpr")), ("fpr", 1 - F.col("tnr")))])
    return mean.join(rates, model)


def in_order_attempts(attempts: DataFrame, chunk: Column | None = None, order: Sequence[str] = ("time_done", "event_id")) -> DataFrame:
    """The attempts of each (user, exercise) whose number is the next one due, starting with 1, in time order.

    Runs of consecutive numbers are found first.  The end of a run leads to the earliest later attempt
    that has the next number, and so to that attempt's run.  From each group's first attempt with
    number 1 the chain of such hops is followed with hops of doubling length, so n breaks take about log2(n) rounds.
    """
    group = ["user", "exercise"]
    chunk = epoch_hour_chunk(order[0]) if chunk is None else chunk
    steps = scan_groups(attempts, group, order, chunk, number="__pos", lags={"prev": "problem_number"})
    fresh = F.col("prev").isNull() | (F.col("problem_number") != F.col("prev") + 1)
    runs = cut_lineage(scan_groups(steps.withColumn("__fresh", fresh), group, order, chunk, sums={"run": F.col("__fresh").cast("int")}).drop("prev", "__fresh"))
    number = F.col("problem_number").cast("bigint")
    # Along falling positions the nearest later attempt is the last one met.
    spots = runs.select(*group, number.alias("due"), (-F.col("__pos")).alias("back"), "run", F.lit(True).alias("spot"))
    ends = runs.groupBy(*group, "run").agg(F.max("__pos").alias("end"), F.max(number).alias("until")).select(
        *group, (F.col("until") + 1).alias("due"), (-F.col("end")).alias("back"), "run", F.lit(False).alias("spot"))
    met = scan_groups(
        spots.unionByName(ends), [*group, "due"], ["back"], F.floor(F.col("back") / 100_000), last_known={"next": (F.col("run"), F.col("spot"))})
    hops = cut_lineage(met.where("NOT spot AND next IS NOT NULL").select(*group, "run", "next", "due"))
    starts = runs.where("problem_number = 1").groupBy(*group).agg(F.min_by("run", "__pos").alias("run"))
    reached, hop = cut_lineage(starts), hops.select(*group, "run", "next")
    while True:
        found = cut_lineage(reached.join(hop, [*group, "run"]).select(*group, F.col("next").alias("run")))
        if found.isEmpty():
            break
        reached = cut_lineage(reached.unionByName(found))
        onward = hop.select(*group, F.col("run").alias("next"), F.col("next").alias("far"))
        hop = cut_lineage(hop.join(onward, [*group, "next"]).select(*group, "run", F.col("far").alias("next")))
    entered = starts.withColumn("due", F.lit(1).cast("bigint")).unionByName(
        reached.join(hops, [*group, "run"]).select(*group, F.col("next").alias("run"), "due"))
    return runs.join(entered, [*group, "run"]).where("problem_number >= due").select(*attempts.columns)


def compare_models(
    attempts: DataFrame, models: dict[str, dict[str, float]], chunk: Column | None = None, order: Sequence[str] = ("time_done", "event_id")
) -> DataFrame:
    """Scores (model, exercise, label, p) of each model on the attempts replayed in order.  Features do not
    depend on the model, so they are made once."""
    rows = accuracy_features(in_order_attempts(attempts, chunk, order), chunk, order=order)
    scored = F.array(*[F.struct(F.lit(name).alias("model"), score(weights).alias("p")) for name, weights in models.items()])
    return rows.select("exercise", F.col("correct").alias("label"), F.explode(scored).alias("s")).select("s.model", "exercise", "label", "s.p")


def parameter_overlap(a: DataFrame, b: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Keys two models share, how many hold the same value, and the shares in percent."""
    left = a.select(key, F.col(value).alias("va"), F.lit(True).alias("in_a"))
    right = b.select(key, F.col(value).alias("vb"), F.lit(True).alias("in_b"))
    in_a, in_b = F.col("in_a").isNotNull(), F.col("in_b").isNotNull()
    sizes = left.join(right, key, "full").agg(
        count_if(in_a & in_b).alias("shared"), count_if(in_a & in_b & F.col("va").eqNullSafe(F.col("vb"))).alias("shared_equal"),
        count_if(in_a).alias("keys_a"), count_if(in_b).alias("keys_b"))
    pct = lambda n, of: 100.0 * F.col(n) / F.when(F.col(of) > 0, F.col(of))
    return sizes.select(
        "shared", "shared_equal", pct("shared", "keys_a").alias("pct_of_a"), pct("shared", "keys_b").alias("pct_of_b"),
        pct("shared_equal", "shared").alias("pct_equal"))


def best_threshold(
    scores: DataFrame, betas: Sequence[float], keys: Sequence[str] = ("exercise",), grid: int = 101, label: str = "label", p: str = "p"
) -> DataFrame:
    """Per key and beta the threshold of an even grid on [0, 1] with the largest F score, the smallest on a
    tie.  A score counts as positive above the threshold.  Scores fold to bins of the grid first."""
    keys, steps = list(keys), grid - 1
    above = (F.ceil(F.round(F.col(p) * steps, 9)) - 1).cast("int")  # last grid point below the score
    bins = scores.groupBy(*keys, above.alias("bin")).agg(count_if(F.col(label)).alias("pos"), count_if(~F.col(label)).alias("neg"))
    at = bins.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    over = F.col("t") <= F.col("bin")
    cells = at.groupBy(*keys, "t").agg(
        F.sum(F.when(over, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(over, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~over, F.col("pos")).otherwise(0)).alias("fn"), F.sum(F.col("pos") + F.col("neg")).alias("samples"))
    rows = cells.withColumn("beta", F.explode(F.array(*[F.lit(float(b)) for b in betas])))
    b2 = F.col("beta") * F.col("beta")
    bottom = (1 + b2) * F.col("tp") + b2 * F.col("fn") + F.col("fp")
    scored = rows.withColumn("f", (1 + b2) * F.col("tp") / F.when(bottom > 0, bottom)).where("f IS NOT NULL")
    rank = F.struct(F.col("f"), -F.col("t"))
    return scored.groupBy(*keys, "beta").agg(
        (F.max_by("t", rank) / steps).alias("threshold"), F.max("f").alias("max_score"), F.max("samples").alias("samples"))


def performance_merge(perf: DataFrame, keys: Sequence[str] = ("job", "exercise", "prediction"), min_samples: int = 0) -> DataFrame:
    """Confusion vectors and log likelihoods of several jobs merged per key: rates at each threshold and the
    mean log likelihood.  The vectors have one entry per threshold."""
    keys = list(keys)
    once = perf.dropDuplicates(["job", "exercise", "prediction"])
    totals = once.groupBy(*keys).agg(
        F.sum("positive_samples").alias("pos"), F.sum("negative_samples").alias("neg"), F.sum("total_logl").alias("logl"))
    totals = totals.where((F.col("pos") >= min_samples) & (F.col("neg") >= min_samples))
    cells = once.select(*keys, F.posexplode(F.arrays_zip("true_positive", "true_negative")).alias("i", "c")).groupBy(*keys, "i").agg(
        F.sum("c.true_positive").alias("tp"), F.sum("c.true_negative").alias("tn"))
    vectors = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "tp", "tn"))).alias("v"))
    pos, neg = F.greatest(F.col("pos").cast("double"), F.lit(0.00001)), F.greatest(F.col("neg").cast("double"), F.lit(0.00001))
    return totals.join(vectors, keys).select(
        *keys, F.transform("v", lambda c: c["tp"] / pos).alias("tpr"), F.transform("v", lambda c: 1 - c["tn"] / neg).alias("fpr"),
        (F.col("logl") / F.when(F.col("pos") + F.col("neg") > 0, F.col("pos") + F.col("neg"))).alias("avg_logl"))


def temporal_performance(perf: DataFrame, keys: Sequence[str] = ("job", "prediction"), left: int = 7, right: int = 7) -> DataFrame:
    """Mean log likelihood by number of earlier exercises and its sample-weighted moving average over the
    ``left`` points before to the one before ``right`` after.  One row per number of exercises."""
    cells = perf.groupBy(*keys, "n_prev").agg(F.sum("total_logl").alias("logl"), F.sum("samples").alias("samples"))
    along = Window.partitionBy(*keys).orderBy("n_prev").rowsBetween(-left, right - 1)
    weight = F.sum("samples").over(along)
    return cells.select(
        *keys, "n_prev", "samples", (F.col("logl") / F.when(F.col("samples") > 0, F.col("samples"))).alias("avg_logl"),
        F.when(weight > 0, F.sum("logl").over(along) / F.when(weight > 0, weight)).otherwise(F.lit(0.0)).alias("smooth_logl"))


def quantiles(df: DataFrame, value: str, qs: Sequence[float], keys: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """The values at index floor((n - 1) q) of the sorted column, one row per q."""
    wide = exact_quantiles(df, list(keys), value, {f"q{i}": q for i, q in enumerate(qs)}, width=width, interpolate=False)
    cells = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.col(f"q{i}").alias("value")) for i, q in enumerate(qs)])
    return wide.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*")

