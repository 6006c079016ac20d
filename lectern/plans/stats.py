"""Queries of the statistics and model block."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import forest, models, sampler, stats as ops
from lectern.operators.lbfgs import lbfgs_per_group
from lectern.operators.learning import exercise_difficulty as difficulty
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.learning import attempts, rounded
from lectern.plans.registry import query
from lectern.session import cut_lineage

W = ops.WEIGHTS
ALT = {**W, "intercept": -0.5, "ewma_10": 1.1, "streak": 0.05}
MODELS = {"first": W, "second": ALT}


def _z(w: dict[str, float]) -> str:
    return " + ".join([f"{w['intercept']}::DOUBLE", *[f"{w[f]}::DOUBLE * {f}" for f in ops.FEATURES]])


def _features_sql(source: str) -> str:
    ewma = lambda w: f"list_reduce(list_prepend(0.9::DOUBLE, h), lambda a, x: {w}::DOUBLE * x + (1 - {w}::DOUBLE) * a)"
    return f"""
        WITH w AS (SELECT *, COALESCE(list(correct::INT::DOUBLE) OVER (PARTITION BY "user", exercise ORDER BY time_done, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), []) AS h
                   FROM {source}),
        c AS (SELECT *, len(h) AS total_done, COALESCE(list_sum(h), 0) AS right_ FROM w)
        SELECT * EXCLUDE (h, right_), {ewma(0.333)} AS ewma_3, {ewma(0.1)} AS ewma_10,
               CASE WHEN list_contains(h, 0) THEN list_position(list_reverse(h), 0) - 1 ELSE len(h) END AS streak,
               CASE WHEN total_done > 0 THEN ln(total_done) ELSE 0 END AS log_done, ln(total_done - right_ + 1) AS log_missed,
               CASE WHEN total_done > 0 THEN right_ / total_done ELSE 0.8 END AS pct_correct FROM c"""


SQL_INPUTS.update({
    "b_odd_attempts": """
        SELECT * REPLACE (problem_number + CASE WHEN "user" % 7 = 0 AND event_id % 5 = 0 THEN 1 WHEN "user" % 7 = 1 THEN 1
                                                WHEN "user" % 7 = 2 AND event_id % 3 = 0 AND problem_number > 1 THEN -1 ELSE 0 END AS problem_number)
        FROM b_attempts""",
    "b_features": _features_sql("b_attempts"),
    "b_predictions": f"SELECT *, CASE WHEN total_done > 0 THEN 1 / (1 + exp(-({_z(W)}))) ELSE 0.8 END AS p FROM b_features",
    "b_validity": """
        SELECT "user", bool_and(prev IS NULL OR problem_number = prev + 1) AS sequential, bool_and(prev IS NOT NULL OR problem_number = 1) AS complete
        FROM (SELECT *, lag(problem_number) OVER (PARTITION BY "user", exercise ORDER BY time_done, event_id) AS prev FROM b_odd_attempts) GROUP BY 1""",
    "b_scores_raw": """
        SELECT event_id, "user", 'ex_' || (k % 12) AS exercise, k % 20 AS n_prev, value < 60 AS label, 'job' || (k % 3) AS job, k % 4 = 0 AS first,
               round(0.5 * (50 / (value + 50)) + 0.5 * k / 100.0::DOUBLE, 4) AS p1, round(50 / (value + 50), 4) AS p2 FROM b_events""",
    "b_scores2": """
        SELECT 'prediction' AS model, exercise, label, p1 AS p, job, n_prev, first FROM b_scores_raw
        UNION ALL SELECT 'original_prediction', exercise, label, p2, job, n_prev, first FROM b_scores_raw""",
    "b_roc": """
        WITH t AS (SELECT unnest(generate_series(-1, 101)) AS t), g AS (SELECT DISTINCT model, exercise FROM b_scores2)
        SELECT g.model, g.exercise, t / 100.0::DOUBLE AS threshold,
               COUNT(*) FILTER (WHERE label AND floor(round(p * 100, 9)) >= t) / GREATEST(COUNT(*) FILTER (WHERE label), 1) AS tpr,
               COUNT(*) FILTER (WHERE NOT label AND floor(round(p * 100, 9)) < t) / GREATEST(COUNT(*) FILTER (WHERE NOT label), 1) AS tnr
        FROM g CROSS JOIN t JOIN b_scores2 s ON s.model = g.model AND s.exercise = g.exercise GROUP BY 1, 2, t""",
    "b_quality": """
        WITH m AS (SELECT model, exercise, SUM(1.0::DOUBLE) AS s0, SUM(1 - tnr) AS s1, SUM((1 - tnr) ** 2) AS s2, SUM((1 - tnr) ** 3) AS s3, SUM((1 - tnr) ** 4) AS s4,
                          SUM(tpr) AS y0, SUM((1 - tnr) * tpr) AS y1, SUM((1 - tnr) ** 2 * tpr) AS y2 FROM b_roc GROUP BY 1, 2),
        d AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS w,
                     y0 * (s2 * s4 - s3 * s3) - s1 * (y1 * s4 - s3 * y2) + s2 * (y1 * s3 - s2 * y2) AS a,
                     s0 * (y1 * s4 - s3 * y2) - y0 * (s1 * s4 - s3 * s2) + s2 * (s1 * y2 - y1 * s2) AS b,
                     s0 * (s2 * y2 - y1 * s3) - s1 * (s1 * y2 - y1 * s2) + y0 * (s1 * s3 - s2 * s2) AS c FROM m),
        z AS (SELECT model, exercise, SUM(dx * h) AS auc_trapezoid FROM (
                  SELECT model, exercise, (1 - tnr) - (1 - lead(tnr) OVER w) AS dx, (tpr + lead(tpr) OVER w) / 2 AS h FROM b_roc
                  WINDOW w AS (PARTITION BY model, exercise ORDER BY threshold)) GROUP BY 1, 2),
        l AS (SELECT model, exercise, AVG(GREATEST(ln(CASE WHEN label THEN p ELSE 1 - p END), -100)) AS avg_logl, COUNT(*) AS n FROM b_scores2 GROUP BY 1, 2
              HAVING COUNT(*) FILTER (WHERE label) > 0 AND COUNT(*) FILTER (WHERE NOT label) > 0)
        SELECT model, exercise, avg_logl, n, a / w + b / w / 2 + c / w / 3 AS auc, auc_trapezoid FROM l JOIN d USING (model, exercise) JOIN z USING (model, exercise)""",
    "b_in_order": """
        WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY "user", exercise ORDER BY time_done, event_id) AS rn FROM b_odd_attempts),
        walk AS (SELECT "user", exercise, rn, event_id, CASE WHEN problem_number = 1 THEN 1 ELSE 0 END AS s, problem_number = 1 AS took FROM r WHERE rn = 1
                 UNION ALL SELECT r."user", r.exercise, r.rn, r.event_id, CASE WHEN r.problem_number = w.s + 1 THEN w.s + 1 ELSE w.s END, r.problem_number = w.s + 1
                 FROM walk w JOIN r ON r."user" = w."user" AND r.exercise = w.exercise AND r.rn = w.rn + 1)
        SELECT a.* FROM b_odd_attempts a JOIN (SELECT event_id FROM walk WHERE took) t ON t.event_id = a.event_id""",
    "b_replayed": _features_sql("b_in_order"),
})


@query("trimmed_mean", "ST-1", """
    WITH r AS (SELECT l_returnflag, l_linestatus, l_quantity AS v, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity) - 1 AS i,
                      COUNT(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS n FROM lineitem)
    SELECT l_returnflag, l_linestatus, round(AVG(v), 6) AS avg FROM r WHERE i / (n - 1) >= 0.1::DOUBLE AND i / (n - 1) <= 0.9::DOUBLE GROUP BY 1, 2""")
def trimmed_mean(b: Inputs):
    return rounded(ops.trimmed_mean(b.table("lineitem"), "l_quantity", ["l_returnflag", "l_linestatus"]))


_COLUMNS = ", ".join(f"round({c}, 8) AS {c}" for c in ops.FEATURES if c != "streak")


@query("accuracy_features", "ST-2", f'SELECT event_id, "user", exercise, {_COLUMNS}, streak, total_done FROM b_features')
def accuracy_features(b: Inputs):
    out = ops.accuracy_features(attempts(b))
    return rounded(out.select("event_id", "user", "exercise", *ops.FEATURES, "total_done"), 8)


@query("accuracy_predict", "ST-3", """
    SELECT event_id, round(p, 8) AS p, total_done >= 3 AND p < 0.94 AND pow(total_done, 2.5) * (0.94::DOUBLE - p) > 20 AS struggling FROM b_predictions""")
def accuracy_predict(b: Inputs):
    out = ops.accuracy_predict(ops.accuracy_features(attempts(b)), exponent=2.5, min_attempts=3)
    return rounded(out.select("event_id", "p", "struggling"), 8)


def _streak_sql() -> str:
    parts = []
    for n in range(1, 21):
        e3, e10 = 1 - 0.1 * (1 - 0.333) ** n, 1 - 0.1 * 0.9 ** n
        parts.append(f"({n}, {e3!r}::DOUBLE, {e10!r}::DOUBLE, {n}, ln({n}), 0.0::DOUBLE, 1.0::DOUBLE)")
    return f"""
        WITH s AS (SELECT n, 1 / (1 + exp(-({_z(W)}))) AS p FROM (VALUES {', '.join(parts)}) v(n, ewma_3, ewma_10, streak, log_done, log_missed, pct_correct)),
        t AS (SELECT exercise, round(0.8 + pct_correct / 6, 6) AS threshold FROM b_exercise_difficulty)
        SELECT exercise, threshold, (SELECT MIN(n) FROM s WHERE p >= threshold)::BIGINT AS streak FROM t"""


@query("min_streak", "ST-3", _streak_sql())
def min_streak(b: Inputs):
    wanted = difficulty(attempts(b)).select("exercise", F.round(0.8 + F.col("pct_correct") / 6, 6).alias("threshold"))
    return ops.min_streak(wanted, "threshold")


def odd_attempts(b: Inputs):
    """Attempts of which some users' numbers jump, begin late or go back."""
    user, ident = F.col("user") % 7, F.col("event_id")
    shift = F.when((user == 0) & (ident % 5 == 0), 1).when(user == 1, 1).when((user == 2) & (ident % 3 == 0) & (F.col("problem_number") > 1), -1).otherwise(0)
    return attempts(b).withColumn("problem_number", F.col("problem_number") + shift)


@query("history_validity", "ST-4", "SELECT * FROM b_validity")
def history_validity(b: Inputs):
    return ops.history_validity(odd_attempts(b))


def _uniform_sql(i: int, tag: str) -> str:
    return f"(('0x' || substr(md5('{models.SEED}|' || exercise || '|' || problem_type || '|' || correct::VARCHAR || '|{i}|{tag}'), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE"


_DIM = 3
SQL_INPUTS["b_samples"] = f"""
    WITH v AS (SELECT p.*, task_type AS problem_type FROM b_odd_predictions p WHERE "user" IN (SELECT "user" FROM b_validity WHERE sequential)),
    z AS (SELECT *, {', '.join(f"sqrt(-2.0 * ln({_uniform_sql(i, 'r')})) * cos(2 * pi() * {_uniform_sql(i, 'a')}) AS z{i}" for i in range(_DIM))}
          FROM (SELECT DISTINCT exercise, problem_type, correct FROM v WHERE problem_number = 1 AND problem_type IS NOT NULL)),
    c AS (SELECT exercise, problem_type, correct, {', '.join(f"z{i} / sqrt({' + '.join(f'z{j} * z{j}' for j in range(_DIM))}) AS c{i}" for i in range(_DIM))} FROM z),
    j AS (SELECT v.*, {', '.join(f"CASE WHEN v.problem_number = 1 THEN COALESCE(c{i}, 0) ELSE 0 END AS g{i}" for i in range(_DIM))}
          FROM v LEFT JOIN c ON c.exercise = v.exercise AND c.problem_type = v.problem_type AND c.correct = v.correct)
    SELECT *, row_number() OVER w - 1 AS attempt_number, SUM((total_done = 0)::INT) OVER w AS n_prev_ex, {', '.join(f"SUM(g{i}) OVER w - g{i} AS f{i}" for i in range(_DIM))}
    FROM j WINDOW w AS (PARTITION BY "user" ORDER BY time_done, event_id)"""
SQL_INPUTS["b_odd_features"] = _features_sql("b_odd_attempts")
SQL_INPUTS["b_odd_predictions"] = f"SELECT *, CASE WHEN total_done > 0 THEN 1 / (1 + exp(-({_z(W)}))) ELSE 0.8 END AS prediction FROM b_odd_features"


def samples(b: Inputs, dim: int = _DIM, numbers: tuple[int, int | None] = (1, 6), randomized: bool = False):
    return models.feature_samples(odd_attempts(b).withColumnRenamed("task_type", "problem_type"), dim=dim, numbers=numbers, randomized=randomized)


@query("feature_samples", "ST-5", f"""
    SELECT exercise, correct::BIGINT AS correct, round(prediction, 6) AS prediction, n_prev_ex::BIGINT AS n_prev_ex, problem_number, attempt_number, {_COLUMNS}, streak,
           {', '.join(f'round(f{i}, 6) + 0.0 AS f{i}' for i in range(_DIM))} FROM b_samples WHERE problem_number >= 1 AND problem_number < 6""")
def feature_samples(b: Inputs):
    out = samples(b).select("*", *[F.col("random")[i].alias(f"f{i}") for i in range(_DIM)]).drop("random")
    eight = [c for c in ops.FEATURES if c != "streak"]
    return out.withColumns({**{c: F.round(c, 8) for c in eight}, **{c: F.round(c, 6) + F.lit(0.0) for c in ("prediction", *[f"f{i}" for i in range(_DIM)])}})


@query("feature_samples_randomized", "ST-5", """
    SELECT exercise, problem_number, attempt_number, n_prev_ex::BIGINT AS n_prev_ex, round(prediction, 6) AS prediction FROM b_samples WHERE randomized AND problem_number >= 1""")
def feature_samples_randomized(b: Inputs):
    out = samples(b, dim=1, numbers=(1, None), randomized=True)
    return out.select("exercise", "problem_number", "attempt_number", "n_prev_ex", F.round("prediction", 6).alias("prediction"))


def training(b: Inputs):
    samples = models.feature_samples(odd_attempts(b).withColumnRenamed("task_type", "problem_type"), numbers=(1, None))
    return cut_lineage(models.feature_vector(samples, ["custom", "random"]).drop("random"))  # features hold the same numbers


@query("fit_per_group", "ST-6")
def fit_per_group(b: Inputs):
    fits = models.fit_per_group(training(b), min_samples=100, l2=1.0)
    return fits.select("exercise", "num_samples", "converged", F.posexplode_outer("theta").alias("i", "theta")).withColumn("theta", F.round("theta", 6))


@query("predict_per_group", "ST-6")
def predict_per_group(b: Inputs):
    rows = training(b)
    scored = models.predict_per_group(rows, models.fit_per_group(rows, min_samples=100, l2=1.0))
    return scored.groupBy("exercise").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 6).alias("mean_p"), F.round(F.avg("correct"), 6).alias("mean_correct"))


def flagged(b: Inputs):
    """Answers described by a constant and one flag, so that the fit is the log odds of either cell."""
    return b.events.select(
        F.concat(F.lit("ex_"), F.col("k") % 12).alias("exercise"), (F.col("value") < 60).cast("int").alias("correct"),
        F.array(F.lit(1.0), (F.col("event_id") % 3 == 0).cast("double")).alias("features"))


SQL_INPUTS["b_flagged"] = """
    SELECT 'ex_' || (k % 12) AS exercise, event_id % 3 = 0 AS flag, COUNT(*) AS n, COUNT(*) FILTER (WHERE value < 60) AS r FROM b_events GROUP BY 1, 2"""


@query("fit_log_odds", "ST-6", """
    WITH c AS (SELECT exercise, SUM(n)::BIGINT AS num_samples, MAX(ln(r / (n - r))) FILTER (WHERE NOT flag) AS a, MAX(ln(r / (n - r))) FILTER (WHERE flag) AS b FROM b_flagged GROUP BY 1)
    SELECT exercise, num_samples, true AS converged, i::BIGINT AS i, round(CASE i WHEN 0 THEN a ELSE b - a END, 4) AS theta FROM c CROSS JOIN (VALUES (0), (1)) t(i)""")
def fit_log_odds(b: Inputs):
    fits = models.fit_per_group(flagged(b), min_samples=1, l2=1e-9)
    return fits.select("exercise", "num_samples", "converged", F.posexplode("theta").alias("i", "theta")).withColumn("theta", F.round("theta", 4))


@query("fit_log_odds_quasi_newton", "ST-12", """
    WITH c AS (SELECT exercise, SUM(n)::BIGINT AS num_samples, MAX(ln(r / (n - r))) FILTER (WHERE NOT flag) AS a, MAX(ln(r / (n - r))) FILTER (WHERE flag) AS b FROM b_flagged GROUP BY 1)
    SELECT exercise, num_samples, true AS converged, i::BIGINT AS i, round(CASE i WHEN 0 THEN a ELSE b - a END, 4) AS theta FROM c CROSS JOIN (VALUES (0), (1)) t(i)""")
def fit_log_odds_quasi_newton(b: Inputs):
    fits = lbfgs_per_group(flagged(b), l2=1e-9)
    return fits.select("exercise", "num_samples", "converged", F.posexplode("theta").alias("i", "theta")).withColumn("theta", F.round("theta", 4))


@query("predict_log_odds", "ST-6", "SELECT exercise, flag, n, r::DOUBLE AS expected FROM b_flagged")
def predict_log_odds(b: Inputs):
    rows = flagged(b)
    scored = models.predict_per_group(rows, models.fit_per_group(rows, min_samples=1, l2=1e-9))
    return scored.groupBy("exercise", (F.col("features")[1] == 1).alias("flag")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("p"), 3).alias("expected"))


@query("fit_forest", "ST-6", """
    SELECT exercise, COUNT(*) AS n, round(AVG(correct::INT), 6) AS mean_correct, true AS in_range, true AS near FROM b_samples WHERE problem_number >= 1 GROUP BY 1""")
def fit_forest(b: Inputs):
    scored = models.fit_forest(training(b))
    sums = scored.groupBy("exercise").agg(
        F.count(F.lit(1)).alias("n"), F.avg("correct").alias("c"), F.avg("p").alias("p"), F.min("p").alias("low"), F.max("p").alias("high"))
    return sums.select("exercise", "n", F.round("c", 6).alias("mean_correct"), ((F.col("low") >= 0) & (F.col("high") <= 1)).alias("in_range"),
                       (F.abs(F.col("p") - F.col("c")) < 0.1).alias("near"))


@query("fit_forest_per_group", "ST-6", """
    SELECT exercise, COUNT(*) AS n, round(AVG(correct::INT), 6) AS mean_correct, true AS in_range, true AS near FROM b_samples WHERE problem_number >= 1 GROUP BY 1""")
def fit_forest_per_group(b: Inputs):
    """A forest for each exercise; its chances lie in range and are right on the whole."""
    rows = training(b)
    scored = forest.predict_forest_per_group(rows, forest.fit_forest_per_group(rows), keep=["exercise", "correct"])
    sums = scored.groupBy("exercise").agg(
        F.count(F.lit(1)).alias("n"), F.avg("correct").alias("c"), F.avg("p").alias("p"), F.min("p").alias("low"), F.max("p").alias("high"))
    return sums.select("exercise", "n", F.round("c", 6).alias("mean_correct"), ((F.col("low") >= 0) & (F.col("high") <= 1)).alias("in_range"),
                       (F.abs(F.col("p") - F.col("c")) < 0.1).alias("near"))


def scores(b: Inputs):
    k, value = F.col("k"), F.col("value")
    p1 = F.round(0.5 * (50 / (value + 50)) + 0.5 * k / 100.0, 4)
    pairs = F.array(F.struct(F.lit("prediction").alias("model"), p1.alias("p")), F.struct(F.lit("original_prediction").alias("model"), F.round(50 / (value + 50), 4).alias("p")))
    return b.events.select(
        F.concat(F.lit("ex_"), k % 12).alias("exercise"), (k % 20).alias("n_prev"), (value < 60).alias("label"), F.concat(F.lit("job"), k % 3).alias("job"),
        (k % 4 == 0).alias("first"), F.explode(pairs).alias("s")).select("s.model", "exercise", "label", "s.p", "job", "n_prev", "first")


@query("roc_curve", "ST-7", "SELECT model, exercise, threshold, round(tpr, 8) AS tpr, round(tnr, 8) AS tnr FROM b_roc")
def roc_curve(b: Inputs):
    return rounded(ops.roc_curve(scores(b)), 8)


@query("auc_logloss", "ST-8", """
    SELECT model, exercise, round(avg_logl, 8) AS avg_logl, n, round(auc, 6) AS auc, round(auc_trapezoid, 8) AS auc_trapezoid FROM b_quality""")
def auc_logloss(b: Inputs):
    out = ops.auc_logloss(scores(b))
    return out.withColumns({"avg_logl": F.round("avg_logl", 8), "auc": F.round("auc", 6), "auc_trapezoid": F.round("auc_trapezoid", 8)})


@query("model_averages", "ST-8", """
    WITH r AS (SELECT c.*, q.n, q.auc FROM b_roc c JOIN b_quality q USING (model, exercise))
    SELECT model, groups, n, round(avg_auc, 6) AS avg_auc, round(avg_logl, 6) AS avg_logl, round(weighted_auc, 6) AS weighted_auc, round(weighted_logl, 6) AS weighted_logl,
           round(tpr_85, 6) AS tpr_85, round(fpr_85, 6) AS fpr_85, round(tpr_95, 6) AS tpr_95, round(fpr_95, 6) AS fpr_95
    FROM (SELECT model, COUNT(*) AS groups, SUM(n)::BIGINT AS n, AVG(auc) AS avg_auc, AVG(avg_logl) AS avg_logl, SUM(auc * n) / SUM(n) AS weighted_auc, SUM(avg_logl * n) / SUM(n) AS weighted_logl
          FROM b_quality GROUP BY 1) JOIN (SELECT model,
              100 * SUM(tpr * n) FILTER (WHERE threshold = 0.85) / SUM(n) FILTER (WHERE threshold = 0.85) AS tpr_85, 100 * SUM((1 - tnr) * n) FILTER (WHERE threshold = 0.85) / SUM(n) FILTER (WHERE threshold = 0.85) AS fpr_85,
              100 * SUM(tpr * n) FILTER (WHERE threshold = 0.95) / SUM(n) FILTER (WHERE threshold = 0.95) AS tpr_95, 100 * SUM((1 - tnr) * n) FILTER (WHERE threshold = 0.95) / SUM(n) FILTER (WHERE threshold = 0.95) AS fpr_95
          FROM r GROUP BY 1) USING (model)""")
def model_averages(b: Inputs):
    rows = scores(b)
    return rounded(ops.model_averages(ops.auc_logloss(rows), ops.roc_curve(rows)))


@query("in_order_attempts", "ST-9", 'SELECT event_id, "user", exercise, problem_number FROM b_in_order')
def in_order_attempts(b: Inputs):
    return ops.in_order_attempts(odd_attempts(b)).select("event_id", "user", "exercise", "problem_number")


@query("compare_models", "ST-9", " UNION ALL ".join(f"""
    SELECT '{name}' AS model, exercise, COUNT(*) AS n, round(AVG(GREATEST(ln(CASE WHEN correct THEN p ELSE 1 - p END), -100)), 6) AS avg_logl
    FROM (SELECT *, CASE WHEN total_done > 0 THEN 1 / (1 + exp(-({_z(w)}))) ELSE 0.8 END AS p FROM b_replayed) GROUP BY 2""" for name, w in MODELS.items()))
def compare_models(b: Inputs):
    scored = ops.compare_models(odd_attempts(b), MODELS)
    return rounded(scored.groupBy("model", "exercise").agg(F.count(F.lit(1)).alias("n"), F.avg(ops.log_likelihood()).alias("avg_logl")))


@query("parameter_overlap", "ST-9", """
    WITH a AS (SELECT p_partkey AS key, p_size AS value FROM part WHERE p_size > 10), b AS (SELECT p_partkey AS key, CASE WHEN p_size > 30 THEN 30 ELSE p_size END AS value FROM part WHERE p_size < 45),
    j AS (SELECT a.value AS va, b.value AS vb FROM a JOIN b USING (key))
    SELECT COUNT(*) AS shared, COUNT(*) FILTER (WHERE va = vb) AS shared_equal, round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM a), 6) AS pct_of_a,
           round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM b), 6) AS pct_of_b, round(100.0 * COUNT(*) FILTER (WHERE va = vb) / COUNT(*), 6) AS pct_equal FROM j""")
def parameter_overlap(b: Inputs):
    parts = b.table("part").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("value"))
    return rounded(ops.parameter_overlap(parts.where("value > 10"), parts.where("value < 45").withColumn("value", F.least("value", F.lit(30)))))


@query("best_threshold", "ST-10", """
    WITH s AS (SELECT exercise, label, round(p * 100, 9) AS p FROM b_scores2 WHERE model = 'prediction' AND first),
    c AS (SELECT exercise, t, COUNT(*) FILTER (WHERE label AND p > t) AS tp, COUNT(*) FILTER (WHERE NOT label AND p > t) AS fp, COUNT(*) FILTER (WHERE label AND p <= t) AS fn, COUNT(*) AS samples
          FROM s CROSS JOIN (SELECT unnest(generate_series(0, 100)) AS t) GROUP BY 1, 2),
    f AS (SELECT *, (1 + beta * beta) * tp / ((1 + beta * beta) * tp + beta * beta * fn + fp) AS f FROM c CROSS JOIN (VALUES (0.5::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) b(beta)),
    r AS (SELECT *, row_number() OVER (PARTITION BY exercise, beta ORDER BY f DESC, t) AS r FROM f WHERE f IS NOT NULL AND NOT isnan(f))
    SELECT exercise, beta, t / 100.0::DOUBLE AS threshold, round(f, 8) AS max_score, samples FROM r WHERE r = 1""")
def best_threshold(b: Inputs):
    rows = scores(b).where("model = 'prediction' AND first")
    return ops.best_threshold(rows, [0.5, 1.0, 2.0]).withColumn("max_score", F.round("max_score", 8))


def performance(b: Inputs):
    """Confusion vectors and log likelihood per job, exercise and prediction."""
    rows = scores(b).withColumnRenamed("model", "prediction")
    keys = ["job", "exercise", "prediction"]
    bins = rows.groupBy(*keys, ops.score_bin().alias("bin")).agg(
        F.count(F.when(F.col("label"), 1)).alias("pos"), F.count(F.when(~F.col("label"), 1)).alias("neg"), F.sum(ops.log_likelihood()).alias("l"))
    cells = bins.withColumn("t", F.explode(F.sequence(F.lit(-1), F.lit(101)))).groupBy(*keys, "t").agg(
        F.sum(F.when(F.col("bin") >= F.col("t"), F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("bin") < F.col("t"), F.col("neg")).otherwise(0)).alias("tn"))
    vectors = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("t", "tp", "tn"))).alias("v"))
    totals = bins.groupBy(*keys).agg(F.sum("pos").alias("positive_samples"), F.sum("neg").alias("negative_samples"), F.sum("l").alias("total_logl"))
    return totals.join(vectors, keys).select(
        *keys, "positive_samples", "negative_samples", "total_logl", F.transform("v", lambda c: c["tp"]).alias("true_positive"), F.transform("v", lambda c: c["tn"]).alias("true_negative"))


for _name, _keys in (("performance_merge", ("job", "exercise", "prediction")), ("performance_overall", ("prediction",))):
    _k = ", ".join("model AS prediction" if c == "prediction" else c for c in _keys)
    _g = ", ".join(str(i + 1) for i in range(len(_keys)))
    query(_name, "ST-11", f"""
        WITH s AS (SELECT {_k}, COUNT(*) FILTER (WHERE label) AS pos, COUNT(*) FILTER (WHERE NOT label) AS neg, SUM(GREATEST(ln(CASE WHEN label THEN p ELSE 1 - p END), -100)) AS l FROM b_scores2 GROUP BY {_g}),
        c AS (SELECT {_k}, t, COUNT(*) FILTER (WHERE label AND floor(round(p * 100, 9)) >= t) AS tp, COUNT(*) FILTER (WHERE NOT label AND floor(round(p * 100, 9)) < t) AS tn
              FROM b_scores2 CROSS JOIN (SELECT unnest(generate_series(-1, 101)) AS t) GROUP BY {_g}, t)
        SELECT {', '.join(_keys)}, (t + 1)::BIGINT AS i, round(tp / GREATEST(pos::DOUBLE, 0.00001), 8) AS tpr, round(1 - tn / GREATEST(neg::DOUBLE, 0.00001), 8) + 0.0 AS fpr, round(l / (pos + neg), 6) AS avg_logl
        FROM c JOIN s USING ({', '.join(_keys)})""")(
        lambda b, keys=_keys: ops.performance_merge(performance(b), keys).select(
            *keys, F.posexplode(F.arrays_zip("tpr", "fpr")).alias("i", "c"), F.round("avg_logl", 6).alias("avg_logl")).select(
            *keys, "i", F.round("c.tpr", 8).alias("tpr"), (F.round("c.fpr", 8) + F.lit(0.0)).alias("fpr"), "avg_logl"))


@query("temporal_performance", "ST-11", """
    WITH c AS (SELECT job, model AS prediction, n_prev, SUM(GREATEST(ln(CASE WHEN label THEN p ELSE 1 - p END), -100)) AS l, COUNT(*) AS n FROM b_scores2 GROUP BY 1, 2, 3)
    SELECT job, prediction, n_prev::BIGINT AS n_prev, n AS samples, round(l / n, 6) AS avg_logl, round(SUM(l) OVER w / SUM(n) OVER w, 6) AS smooth_logl
    FROM c WINDOW w AS (PARTITION BY job, prediction ORDER BY n_prev ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)""")
def temporal_performance(b: Inputs):
    rows = scores(b).select("job", F.col("model").alias("prediction"), "n_prev", ops.log_likelihood().alias("l"))
    perf = rows.groupBy("job", "prediction", "n_prev").agg(F.sum("l").alias("total_logl"), F.count(F.lit(1)).alias("samples"))
    return rounded(ops.temporal_performance(perf))


def responses(b: Inputs):
    return attempts(b).select("user", "exercise", "correct", "time_taken", "time_done", "event_id")


@query("item_response_fit", "ST-12")
def item_response_fit(b: Inputs):
    items, _ = models.item_response_fit(responses(b), use_time=True)
    return items.select("exercise", *[F.round(F.col("w_correct")[i], 4).alias(f"correct_{i}") for i in range(2)],
                        *[F.round(F.col("w_time")[i], 4).alias(f"time_{i}") for i in range(2)], F.round("sigma", 4).alias("sigma"), "converged")


@query("item_response_slope", "ST-12", """
    WITH f AS (SELECT "user", exercise, correct, 0.5::DOUBLE + substr(exercise, 4)::INT / 12.0::DOUBLE AS w0, (substr(exercise, 4)::INT - 6) / 6.0::DOUBLE AS w1
               FROM (SELECT *, row_number() OVER (PARTITION BY "user", exercise ORDER BY time_done, event_id) AS rn FROM b_attempts) WHERE rn = 1),
    g AS (SELECT -4 + 8.0::DOUBLE * q / 14 AS a FROM (SELECT unnest(generate_series(0, 14)) AS q)),
    z AS (SELECT f.*, a, w0 * a + w1 AS z FROM f CROSS JOIN g),
    l AS (SELECT "user", a, -a * a / 2 - SUM(ln(1 + exp(CASE WHEN correct THEN -z ELSE z END))) AS l FROM z GROUP BY "user", a),
    m AS (SELECT "user", a, exp(l - MAX(l) OVER (PARTITION BY "user")) AS e FROM l),
    p AS (SELECT "user", a, e / SUM(e) OVER (PARTITION BY "user") AS post FROM m)
    SELECT exercise, COUNT(DISTINCT "user") AS n, round((SUM(post * (correct::INT - 1 / (1 + exp(-z))) * a) - 0.002::DOUBLE * MAX(w0)) / COUNT(DISTINCT "user"), 6) + 0.0 AS slope_0,
           round((SUM(post * (correct::INT - 1 / (1 + exp(-z)))) - 0.002::DOUBLE * MAX(w1)) / COUNT(DISTINCT "user"), 6) + 0.0 AS slope_1, true AS flat
    FROM z JOIN p USING ("user", a) GROUP BY 1""")
def item_response_slope(b: Inputs):
    """The way up from given couplings, and whether there is none left at those of a fit."""
    data, items = answered_items(b)
    fitted, _ = models.item_response_fit(responses(b))
    flat = models.item_response_slope(data, fitted).select("exercise", F.forall("slope", lambda s: F.abs(s) < 0.002).alias("flat"))
    slopes = models.item_response_slope(data, items).join(flat, "exercise", "left")
    return slopes.select("exercise", "n", *[(F.round(F.col("slope")[i], 6) + F.lit(0.0)).alias(f"slope_{i}") for i in range(2)], "flat")


def answered_items(b: Inputs):
    """First answers, and given couplings of their exercises."""
    data = models.first_responses(responses(b), ("time_done", "event_id"))
    number = F.substring("exercise", 4, 9).cast("int")
    items = data.select("exercise").distinct().select(
        "exercise", F.array(0.5 + number / 12, (number - 6) / 6).alias("w_correct"), F.array(F.lit(0.0), F.lit(0.0)).alias("w_time"), F.lit(1.0).alias("sigma"))
    return data, items


@query("item_response_fixed", "ST-12", """
    WITH f AS (SELECT "user", exercise, correct FROM (SELECT *, row_number() OVER (PARTITION BY "user", exercise ORDER BY time_done, event_id) AS rn FROM b_attempts) WHERE rn = 1),
    g AS (SELECT -4 + 8.0::DOUBLE * q / 14 AS a FROM (SELECT unnest(generate_series(0, 14)) AS q)),
    w AS (SELECT a, -a * a / 2 - ln((SELECT SUM(exp(-a * a / 2)) FROM g)) AS p FROM g),
    z AS (SELECT "user", correct, a, p, (0.5::DOUBLE + substr(exercise, 4)::INT / 12.0::DOUBLE) * a + (substr(exercise, 4)::INT - 6) / 6.0::DOUBLE AS z FROM f CROSS JOIN w),
    l AS (SELECT "user", a, p - SUM(ln(1 + exp(CASE WHEN correct THEN -z ELSE z END))) AS l FROM z GROUP BY "user", a, p),
    m AS (SELECT *, MAX(l) OVER (PARTITION BY "user") AS top FROM l)
    SELECT "user", round(SUM(exp(l - top) * a) / SUM(exp(l - top)), 6) AS theta, round(MAX(top) + ln(SUM(exp(l - top))), 6) AS logl FROM m GROUP BY 1""")
def item_response_fixed(b: Inputs):
    """Abilities at given couplings."""
    data, items = answered_items(b)
    return models.estimate_abilities(data, items).select("user", F.round(F.col("theta")[0], 6).alias("theta"), F.round("logl", 6).alias("logl"))


_CHAIN, _BURN_IN = 60, 20


@query("item_response_chain", "ST-12", f"""
    SELECT * FROM (WITH RECURSIVE f AS (SELECT "user", exercise, correct FROM (SELECT *, row_number() OVER (PARTITION BY "user", exercise ORDER BY time_done, event_id) AS rn FROM b_attempts) WHERE rn = 1),
    a AS (SELECT "user", list(struct_pack(s := 0.5::DOUBLE + substr(exercise, 4)::INT / 12.0::DOUBLE, b := (substr(exercise, 4)::INT - 6) / 6.0::DOUBLE, c := CASE WHEN correct THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END)
                 ORDER BY exercise) AS r FROM f GROUP BY 1),
    h AS (SELECT "user", r, step, md5('{models.SEED}|' || "user" || '|0|' || step || '|0') AS m FROM a CROSS JOIN (SELECT unnest(generate_series(0, {_CHAIN - 1})) AS step)),
    u AS (SELECT "user", r, step, (('0x' || m[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u0,
                 1.2::DOUBLE * sqrt(-2.0::DOUBLE * ln((('0x' || m[9:16])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))
                 * cos(2 * pi() * (('0x' || m[17:24])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE) AS move FROM h),
    w AS (SELECT "user", -1 AS step, 0.0::DOUBLE AS theta, -list_sum(list_transform(r, lambda x: ln(1 + exp(x.c * x.b)))) AS density, 0 AS accepted, 0.0::DOUBLE AS total FROM a
          UNION ALL
          SELECT "user", step, CASE WHEN took THEN there ELSE theta END, CASE WHEN took THEN other ELSE density END, accepted + took::INT,
                 total + CASE WHEN step < {_BURN_IN} THEN 0 WHEN took THEN there ELSE theta END
          FROM (SELECT *, ln(u0) < other - density AS took FROM (
              SELECT p.*, -0.5::DOUBLE * there * there - list_sum(list_transform(r, lambda x: ln(1 + exp(x.c * (x.s * there + x.b))))) AS other FROM (
                  SELECT w."user", u.step, w.theta, w.density, w.accepted, w.total, u.r, u.u0, w.theta + u.move AS there FROM w JOIN u ON u."user" = w."user" AND u.step = w.step + 1) p)))
    SELECT "user", accepted::BIGINT AS accepted, round(total / {_CHAIN - _BURN_IN}, 6) + 0.0 AS theta FROM w WHERE step = {_CHAIN - 1})""")
def item_response_chain(b: Inputs):
    """One Metropolis chain a user at the same couplings."""
    data, items = answered_items(b)
    sampled = sampler.sample_abilities(data, items, steps=_CHAIN, burn_in=_BURN_IN, chains=1)
    return sampled.select("user", "accepted", (F.round(F.col("theta")[0], 6) + F.lit(0.0)).alias("theta"))


@query("item_response_sampled", "ST-12")
def item_response_sampled(b: Inputs):
    items, _ = sampler.item_response_sampled(responses(b))
    return items.select("exercise", *[F.round(F.col("w_correct")[i], 4).alias(f"correct_{i}") for i in range(2)], F.round("spread", 4).alias("spread"))


@query("item_response_abilities", "ST-12")
def item_response_abilities(b: Inputs):
    items, abilities = models.item_response_fit(responses(b))
    return abilities.crossJoin(items.agg(F.every("converged").alias("converged"))).select(
        "user", F.round(F.col("theta")[0], 4).alias("theta"), F.round("logl", 4).alias("logl"), "converged")


_QS = (0.0, 0.1, 0.5, 0.9, 1.0)


@query("quantiles", "ST-13", " UNION ALL ".join(f"""
    SELECT l_shipmode, {q}::DOUBLE AS q, MAX(v) FILTER (WHERE i = CAST(floor((n - 1) * {q}::DOUBLE) AS BIGINT)) AS value FROM r GROUP BY 1""" for q in _QS).join(["""
    WITH r AS (SELECT l_returnflag AS l_shipmode, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i,
                      COUNT(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) SELECT l_shipmode AS l_returnflag, q, value FROM (""", ")"]))
def quantiles(b: Inputs):
    return ops.quantiles(b.table("lineitem"), "l_extendedprice", _QS, ["l_returnflag"])
