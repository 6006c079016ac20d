"""Queries of the learning block, on the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import learning as ops, models
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.registry import query

N = 60
MASTERY = ("mastery.scheduled", "mastery.review")

SQL_INPUTS.update({
    "b_attempts": """
        SELECT event_id, "user", problem_type AS topic, exercise, epoch_us(ts) / 1e6 AS time_done, time_taken, problem_number, correct,
               event_id % 4 = 0 AS randomized, 'seg' || (event_id % 3) AS user_segment, dt,
               CASE WHEN "user" % 11 = 3 AND event_id % 2 = 0 THEN 'alt9' ELSE 'alt' || ("user" % 3) END AS alternative,
               CASE WHEN event_id % 4 = 0 THEN 'mastery.scheduled' WHEN event_id % 9 = 1 THEN 'practice' WHEN event_id % 9 <> 2 THEN 'mastery.review' END AS task_type
        FROM b_numbered_log""",
    "b_trial_attempts": """
        SELECT * REPLACE ('topic_' || (substr(exercise, 4)::INT % 3) AS topic, problem_number + CASE WHEN "user" % 7 = 0 THEN 1 ELSE 0 END AS problem_number)
        FROM b_attempts""",
    "b_attempts_any": "SELECT * FROM b_attempts UNION ALL SELECT * REPLACE ('any' AS topic) FROM b_attempts",
    "b_topic_cards": """
        SELECT * FROM (SELECT *, row_number() OVER w AS card, COUNT(*) OVER g AS done, first_value(problem_number) OVER w AS p1,
                              last_value(user_segment) OVER (PARTITION BY "user", topic ORDER BY time_done, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS seg
                       FROM b_attempts_any WINDOW w AS (PARTITION BY "user", topic ORDER BY time_done, event_id), g AS (PARTITION BY "user", topic)) WHERE p1 = 1""",
    "b_retention": """
        SELECT topic, seg AS user_segment, randomized AS is_randomized, 'card_number' AS bucket_type, card AS bucket_value,
               COUNT(*) FILTER (WHERE correct) AS num_correct, COUNT(*) AS num_attempts FROM b_topic_cards GROUP BY 1, 2, 3, 4, 5""",
    "b_deltas": """
        WITH t AS (SELECT *, lag(card) OVER w AS prev, lag(correct) OVER w AS pc FROM b_topic_cards WHERE randomized AND topic <> 'any'
                   WINDOW w AS (PARTITION BY "user", topic ORDER BY card)),
        s AS (SELECT topic, seg, done, (correct::INT - pc::INT) / (card - prev)::DOUBLE AS gain, unnest(generate_series(prev, card - 1)) AS card
              FROM t WHERE prev IS NOT NULL)
        SELECT topic, seg AS user_segment, done AS num_problems_done, card AS card_number, SUM(gain) AS sum_deltas, COUNT(*) AS num_deltas,
               AVG(gain) AS avg_deltas FROM s GROUP BY 1, 2, 3, 4""",
    "b_segment_summary": """
        WITH a AS (SELECT topic, user_segment, COUNT(DISTINCT "user") AS all_users, COUNT(*) AS all_attempts, SUM(time_taken)::BIGINT AS total_time
                   FROM b_attempts_any GROUP BY 1, 2),
        b AS (SELECT topic, user_segment, COUNT(DISTINCT "user") AS random_card_users FROM b_attempts_any WHERE randomized GROUP BY 1, 2),
        c AS (SELECT topic, user_segment, SUM(num_correct)::BIGINT AS first_card_correct_all, SUM(num_attempts)::BIGINT AS first_card_attempts_all
              FROM b_retention WHERE bucket_value = 1 GROUP BY 1, 2),
        d AS (SELECT topic, user_segment, SUM(num_correct)::BIGINT AS first_card_correct_randomized, SUM(num_attempts)::BIGINT AS first_card_attempts_randomized
              FROM b_retention WHERE bucket_value = 1 AND is_randomized GROUP BY 1, 2),
        e AS (SELECT topic, user_segment, SUM(num_correct)::BIGINT AS num_correct_all, SUM(num_attempts)::BIGINT AS num_attempts_all FROM b_retention GROUP BY 1, 2),
        f AS (SELECT topic, user_segment, SUM(num_correct)::BIGINT AS num_correct_randomized, SUM(num_attempts)::BIGINT AS num_attempts_randomized
              FROM b_retention WHERE is_randomized GROUP BY 1, 2),
        g AS (SELECT topic, user_segment, SUM(sum_deltas) AS sum_deltas_randomized, SUM(num_deltas)::BIGINT AS num_deltas_randomized FROM b_deltas GROUP BY 1, 2)
        SELECT * FROM a JOIN b USING (topic, user_segment) JOIN c USING (topic, user_segment) JOIN d USING (topic, user_segment)
        JOIN e USING (topic, user_segment) JOIN f USING (topic, user_segment) JOIN g USING (topic, user_segment)""",
    "b_positions": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY time_done, event_id) AS position, COUNT(*) OVER (PARTITION BY "user") AS done
                       FROM b_attempts) WHERE position <= {N}""",
    "b_tests": """
        SELECT *, lag(position) OVER w AS prev, lag(correct) OVER w AS prev_correct FROM b_positions WHERE randomized
        WINDOW w AS (PARTITION BY "user" ORDER BY position)""",
    "b_spans": """
        SELECT "user", unnest(generate_series(prev, position - 1)) AS position, correct::INT - prev_correct::INT AS delta, position - prev AS dist
        FROM b_tests WHERE prev IS NOT NULL""",
    "b_exercise_difficulty": "SELECT exercise, COUNT(*) AS cards, AVG(correct::INT) AS pct_correct FROM b_attempts WHERE randomized GROUP BY 1",
})


def attempts(b: Inputs):
    ident, k = F.col("event_id"), F.col("user")
    return b.numbered_log.select(
        "event_id", "user", F.col("problem_type").alias("topic"), "exercise",
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("time_done"), "time_taken", "problem_number", "correct",
        (ident % 4 == 0).alias("randomized"), F.concat(F.lit("seg"), ident % 3).alias("user_segment"), "dt",
        F.when((k % 11 == 3) & (ident % 2 == 0), "alt9").otherwise(F.concat(F.lit("alt"), k % 3)).alias("alternative"),
        F.when(ident % 4 == 0, "mastery.scheduled").when(ident % 9 == 1, "practice").when(ident % 9 != 2, "mastery.review").alias("task_type"))


def attempts_any(b: Inputs):
    return attempts(b).withColumn("topic", F.explode(F.array("topic", F.lit("any"))))


def trial_attempts(b: Inputs):
    """Attempts with topics made of whole exercises; some users' first problems are not on record."""
    return attempts(b).withColumns({
        "topic": F.concat(F.lit("topic_"), F.substring("exercise", 4, 9).cast("int") % 3),
        "problem_number": F.col("problem_number") + F.when(F.col("user") % 7 == 0, 1).otherwise(0)})


def rounded(df, digits: int = 6):
    """Fractions rounded, so that the order of floating-point sums does not show."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c, kind in df.dtypes if kind == "double"})


def stack_log(b: Inputs):
    """Stack logs of at most 64 cards, with the card list and the extra data as JSON texts."""
    block = F.floor(F.col("event_id") / 64)
    info = F.when(F.col("event_id") % 4 == 0, F.struct(F.lit("randomized").alias("purpose")))
    old = F.col("event_id") % 8 == 4
    card = F.struct(F.when(old, info).alias("schedulerInfo"), F.when(~old, info).alias("scheduler_info"))
    logged = F.when(F.col("k") % 11 != 0, F.struct(F.col("event_id").cast("string").alias("ProblemLog")))
    stacks = b.events.groupBy("user", block.alias("block"), "dt").agg(
        F.to_json(F.collect_list(F.struct(card.alias("card"), logged.alias("associated_log")))).alias("cards_list"))
    return stacks.select(
        "user", (F.col("block") % 5 != 0).alias("topic_mode"), F.concat(F.lit("topic_"), F.col("block") % 6).alias("topic_id"),
        F.when(F.col("block") % 3 == 0, '{"segment":"fancy"}').otherwise("{}").alias("extra_data"), "cards_list", "dt")


SQL_INPUTS["b_stack_cards"] = """
    SELECT event_id::VARCHAR AS key, "user", 'topic_' || (event_id // 64 % 6) AS topic,
           CASE WHEN event_id % 4 = 0 THEN '{"purpose":"randomized"}' ELSE '{}' END AS scheduler_info,
           CASE WHEN event_id // 64 % 3 = 0 THEN 'fancy' ELSE 'control' END AS user_segment
    FROM b_events WHERE event_id // 64 % 5 <> 0 AND k % 11 <> 0"""


@query("stack_cards", "LE-1", "SELECT * FROM b_stack_cards")
def stack_cards(b: Inputs):
    return ops.stack_cards(stack_log(b))


@query("topic_attempts", "LE-2", """
    WITH j AS (SELECT DISTINCT c."user", c.topic, exercise, round(time_done, 3) AS time_done, time_taken::BIGINT AS time_taken, problem_number, correct, scheduler_info, c.user_segment,
                      scheduler_info LIKE '%randomized%' AS randomized FROM b_stack_cards c JOIN b_attempts a ON c.key = a.event_id::VARCHAR)
    SELECT * FROM j UNION ALL SELECT * REPLACE ('any' AS topic) FROM j""")
def topic_attempts(b: Inputs):
    log = attempts(b).withColumn("key", F.col("event_id").cast("string"))
    return rounded(ops.topic_attempts(log, stack_cards(b)), 3)


@query("topic_retention", "LE-3", "SELECT * FROM b_retention")
def topic_retention(b: Inputs):
    return ops.topic_retention(attempts_any(b))


@query("accuracy_deltas", "LE-4", """
    SELECT topic, user_segment, num_problems_done, card_number, round(sum_deltas, 6) + 0.0 AS sum_deltas, num_deltas, round(avg_deltas, 6) + 0.0 AS avg_deltas FROM b_deltas""")
def accuracy_deltas(b: Inputs):
    return rounded(ops.accuracy_deltas(attempts_any(b)))


def segment_summary(b: Inputs):
    rows = attempts_any(b)
    return ops.topic_segment_summary(rows, ops.topic_retention(rows), ops.accuracy_deltas(rows))


@query("topic_segment_summary", "LE-5", "SELECT * REPLACE (round(sum_deltas_randomized, 6) + 0.0 AS sum_deltas_randomized) FROM b_segment_summary")
def topic_segment_summary(b: Inputs):
    return rounded(segment_summary(b))


@query("learning_curve_view", "LE-6", """
    WITH g AS (SELECT card_number, SUM(sum_deltas) / SUM(num_deltas) AS gain FROM b_deltas WHERE topic = 'view' AND user_segment = 'seg1' GROUP BY 1),
    r AS (SELECT bucket_value AS card_number, SUM(num_attempts) AS a, SUM(num_correct) AS c FROM b_retention WHERE topic = 'view' AND user_segment = 'seg1' GROUP BY 1),
    j AS (SELECT * FROM g FULL JOIN r USING (card_number))
    SELECT card_number, round(gain, 6) + 0.0 AS gain, round(SUM(gain) OVER (ORDER BY card_number), 6) + 0.0 AS cumulative_gain,
           round(a / GREATEST(MAX(a) OVER (), 1), 6) AS retention, round(c / a, 6) AS pct_correct FROM j""")
def learning_curve_view(b: Inputs):
    rows = attempts_any(b)
    return rounded(ops.learning_curve_view(ops.topic_retention(rows), ops.accuracy_deltas(rows), "view", "seg1"))


@query("segment_rates", "LE-6", """
    SELECT topic, user_segment, all_users AS users, round(all_attempts / all_users, 6) AS cards_per_user, round(total_time / 60 / all_users, 6) AS minutes_per_user,
           round(sum_deltas_randomized / random_card_users, 6) + 0.0 AS gain_per_user,
           round(first_card_correct_all / first_card_attempts_all, 6) AS first_card_accuracy_all,
           round(first_card_correct_randomized / first_card_attempts_randomized, 6) AS first_card_accuracy_randomized,
           round(num_correct_all / num_attempts_all, 6) AS all_cards_accuracy,
           round(num_correct_randomized / num_attempts_randomized, 6) AS randomized_cards_accuracy, round(sum_deltas_randomized, 6) + 0.0 AS total_gain
    FROM b_segment_summary""")
def segment_rates(b: Inputs):
    return rounded(ops.segment_rates(segment_summary(b)))


def _experiment_sql(truncate: int, abilities: bool) -> str:
    sums = {"sd": "sum_difficulty", "ab": "sum_abilities", "aw": "sum_abilities_weighted", "ws": "sum_abilities_weights", "ag": "ability_gain"}
    ability = "".join(f", SUM({short}) AS {name}" for short, name in sums.items()) if abilities else ""
    final = "".join(f", round(SUM({name}), 6) + 0.0 AS {name}" for name in sums.values()) if abilities else ""
    return f"""
        WITH g AS (SELECT -4 + 8.0::DOUBLE * q / 14 AS x, exp(-(4 - 8.0::DOUBLE * q / 14) * (4 - 8.0::DOUBLE * q / 14) / 2) AS w FROM (SELECT unnest(generate_series(0, 14)) AS q)),
        e AS (SELECT exercise, (substr(exercise, 4)::INT - 6) / 6.0::DOUBLE AS difficulty, 0.5::DOUBLE + substr(exercise, 4)::INT / 12.0::DOUBLE AS slope
              FROM (SELECT DISTINCT exercise FROM b_trial_attempts)),
        h AS (SELECT exercise, correct, difficulty, x, w / (1 + exp(CASE WHEN correct THEN -1 ELSE 1 END * (slope * x + difficulty))) AS w
              FROM e CROSS JOIN g CROSS JOIN (VALUES (true), (false)) v(correct)),
        o AS (SELECT exercise, correct, difficulty, SUM(w * x) / SUM(w) AS ability, SUM(w * x * x) / SUM(w) - (SUM(w * x) / SUM(w)) ** 2 AS variance FROM h GROUP BY ALL),
        f AS (SELECT *, first_value(problem_number) OVER (PARTITION BY "user", topic, exercise ORDER BY time_done, event_id) AS p1 FROM b_trial_attempts),
        ok AS (SELECT "user", topic FROM f GROUP BY 1, 2 HAVING MAX(p1) = 1),
        okuser AS (SELECT "user" FROM b_trial_attempts GROUP BY 1 HAVING COUNT(DISTINCT alternative) = 1),
        a AS (SELECT f.*, row_number() OVER (PARTITION BY f."user", f.topic ORDER BY time_done, event_id) AS position,
                     COUNT(*) OVER (PARTITION BY f."user", f.topic) AS done FROM f JOIN ok ON ok."user" = f."user" AND ok.topic = f.topic
              WHERE f."user" IN (SELECT "user" FROM okuser)),
        k AS (SELECT * FROM a WHERE done >= 3),
        t AS (SELECT *, row_number() OVER w AS nth, COUNT(*) OVER (PARTITION BY "user", topic) AS tests, lag(position) OVER w AS prev, lag(correct) OVER w AS pc,
                     lag(ability) OVER w AS pa
              FROM (SELECT k.*, difficulty, ability, variance FROM k JOIN o USING (exercise, correct) WHERE randomized)
              WINDOW w AS (PARTITION BY "user", topic ORDER BY position)),
        s AS (SELECT * FROM t WHERE nth <= tests - {truncate}),
        r AS (SELECT alternative, topic, position, 1 AS n, 0 AS tc, 0 AS c, 0 AS tt, 0.0::DOUBLE AS g, 0.0::DOUBLE AS i, 0.0::DOUBLE AS sd, 0.0::DOUBLE AS ab, 0.0::DOUBLE AS aw, 0.0::DOUBLE AS ws, 0.0::DOUBLE AS ag FROM k
              UNION ALL SELECT alternative, topic, position, 0, 1, correct::INT, LEAST(GREATEST(time_taken, 0), 600), 0, 0, difficulty, ability, ability / variance, 1 / variance, 0 FROM s
              UNION ALL SELECT alternative, topic, unnest(generate_series(prev, position - 1)), 0, 0, 0, 0,
                     (correct::INT - pc::INT) / (position - prev)::DOUBLE, 1.0 / (position - prev)::DOUBLE, 0, 0, 0, 0, (ability - pa) / (position - prev)::DOUBLE
              FROM s WHERE prev IS NOT NULL),
        x AS (SELECT alternative, topic, position, SUM(n) AS n, SUM(tc) AS tc, SUM(c) AS c, SUM(tt) AS tt, SUM(g) AS g, SUM(i) AS i{ability} FROM r GROUP BY 1, 2, 3),
        y AS (SELECT * FROM x UNION ALL SELECT * REPLACE ('AGGREGATE' AS topic) FROM x)
        SELECT alternative, topic, position, SUM(n)::BIGINT AS num_all_cards, SUM(tc)::BIGINT AS num_test_cards, SUM(c)::BIGINT AS num_correct,
               SUM(tt)::BIGINT AS time_taken, round(SUM(g), 6) + 0.0 AS raw_gain, round(SUM(i), 6) AS total_increments{final} FROM y GROUP BY 1, 2, 3"""


@query("experiment_learning_curves", "LE-7", _experiment_sql(1, False))
def experiment_learning_curves(b: Inputs):
    return rounded(ops.experiment_learning_curves(trial_attempts(b), min_attempts=3, truncate=1))


@query("experiment_ability_curves", "LE-7", _experiment_sql(0, True))
def experiment_ability_curves(b: Inputs):
    rows = trial_attempts(b)
    number = F.substring("exercise", 4, 9).cast("int")
    items = rows.select("exercise").distinct().select("exercise", F.array(0.5 + number / 12, (number - 6) / 6).alias("w_correct"))
    abilities = models.response_abilities(items)
    return rounded(ops.experiment_learning_curves(rows, min_attempts=3, abilities=abilities))


@query("position_curves", "LE-8", """
    SELECT position, COUNT(*) AS total, COUNT(*) FILTER (WHERE correct) AS correct, round(AVG(correct::INT), 6) AS accuracy
    FROM b_positions WHERE LEAST(done, 60) >= 20 GROUP BY 1""")
def position_curves(b: Inputs):
    return rounded(ops.position_curves(attempts(b), N, 20))


@query("position_curves_by_type", "LE-8", """
    SELECT *, round(total / SUM(total) OVER (PARTITION BY position), 6) AS ratio FROM (
        SELECT position, task_type, COUNT(*) AS total, COUNT(*) FILTER (WHERE correct) AS correct, round(AVG(correct::INT), 6) AS accuracy
        FROM b_positions GROUP BY 1, 2)""")
def position_curves_by_type(b: Inputs):
    return rounded(ops.position_curves(attempts(b), N, by_type=True))


@query("type_ratios", "LE-8", """
    WITH c AS (SELECT position, COUNT(*) FILTER (WHERE task_type = 'mastery.scheduled') AS t, COUNT(*) FILTER (WHERE task_type LIKE 'mastery%') AS m,
                      COUNT(task_type) AS a FROM b_positions GROUP BY 1)
    SELECT position, round(t / NULLIF(m, 0), 6) AS test_to_mastery, round(t / NULLIF(a, 0), 6) AS test_to_all, round(m / NULLIF(a, 0), 6) AS mastery_to_all FROM c""")
def type_ratios(b: Inputs):
    return rounded(ops.type_ratios(attempts(b), N, "mastery.scheduled", MASTERY))


@query("mastery_run_accuracy", "LE-8", """
    WITH r AS (SELECT *, SUM(COALESCE(task_type = 'practice', false)::INT) OVER (PARTITION BY "user" ORDER BY position) AS run FROM b_positions),
    j AS (SELECT *, row_number() OVER (PARTITION BY "user", run ORDER BY position) - CASE WHEN run > 0 THEN 1 ELSE 0 END AS run_position FROM r)
    SELECT run_position, COUNT(*) AS total, COUNT(*) FILTER (WHERE correct) AS correct, round(AVG(correct::INT), 6) AS accuracy
    FROM j WHERE task_type = 'mastery.scheduled' GROUP BY 1""")
def mastery_run_accuracy(b: Inputs):
    return rounded(ops.mastery_run_accuracy(attempts(b), N, "mastery.scheduled", ["practice"]))


@query("efficiency_curves", "LE-9", """
    WITH e AS (SELECT position, COUNT(*) AS engagement FROM b_positions GROUP BY 1),
    s AS (SELECT position, SUM(delta / dist::DOUBLE) AS eff, SUM(1.0 / dist::DOUBLE) AS eff_max, SUM(delta)::BIGINT AS eff_whole, COUNT(*) AS spans FROM b_spans GROUP BY 1),
    j AS (SELECT position, engagement, COALESCE(eff, 0) AS eff, COALESCE(eff_max, 0) AS eff_max, COALESCE(eff_whole, 0) AS eff_whole, COALESCE(spans, 0) AS spans,
                 CASE WHEN eff_max > 0 THEN eff / eff_max ELSE 0 END AS norm FROM e LEFT JOIN s USING (position))
    SELECT position, engagement, round(eff, 6) + 0.0 AS eff, round(eff_max, 6) AS eff_max, eff_whole, spans, round(norm, 6) + 0.0 AS norm,
           round(SUM(norm) OVER w, 6) + 0.0 AS cumulative, round(SUM(engagement * norm) OVER w, 6) + 0.0 AS learning_gain,
           round(SUM(engagement * eff) OVER w, 6) + 0.0 AS learning_gain_raw FROM j WINDOW w AS (ORDER BY position)""")
def efficiency_curves(b: Inputs):
    return rounded(ops.efficiency_curves(attempts(b), N))


@query("delta_by_distance", "LE-9", """
    SELECT (2 * correct::INT + prev_correct::INT)::BIGINT AS outcome, position - prev AS distance, COUNT(*) AS n FROM b_tests WHERE prev IS NOT NULL GROUP BY 1, 2""")
def delta_by_distance(b: Inputs):
    return ops.delta_by_distance(attempts(b), N)


@query("group_gain", "LE-10", """
    WITH u AS (SELECT "user", MAX(alternative) AS alternative, LEAST(MAX(done), 60) AS m, COUNT(*) FILTER (WHERE randomized) AS cards,
                      arg_min(correct::INT, position) FILTER (WHERE randomized) AS f, arg_max(correct::INT, position) FILTER (WHERE randomized) AS l
               FROM b_positions GROUP BY 1),
    x AS (SELECT unnest(['All', alternative]) AS alternative, m // 10 AS bucket, l - f AS d FROM u WHERE cards >= 2)
    SELECT alternative, bucket, round(AVG(d), 6) + 0.0 AS mean_delta, COUNT(*) AS users FROM x GROUP BY 1, 2""")
def group_gain(b: Inputs):
    return rounded(ops.group_gain(attempts(b), N, bucket=10))


@query("group_efficiency", "LE-10", """
    WITH u AS (SELECT "user", MAX(alternative) AS alt, COUNT(*) FILTER (WHERE randomized) AS cards, MAX(position) FILTER (WHERE randomized) AS lastp FROM b_positions GROUP BY 1),
    m AS (SELECT "user", lastp, unnest(['All', alt]) AS alternative FROM u WHERE cards >= 2),
    z AS (SELECT alternative, COUNT(*) AS users, COUNT(*) FILTER (WHERE lastp - 1 > 60 - 20) AS stayed FROM m GROUP BY 1),
    s AS (SELECT alternative, position, SUM(delta / dist::DOUBLE) AS e, COUNT(*) AS n FROM b_spans JOIN m USING ("user") WHERE position <= 40 GROUP BY 1, 2)
    SELECT alternative, position, round(e / n, 6) + 0.0 AS efficiency, round(SUM(e / n) OVER (PARTITION BY alternative ORDER BY position), 6) + 0.0 AS cumulative,
           round(e / users, 6) + 0.0 AS efficiency_raw, round(e / n * stayed / users, 6) + 0.0 AS learning_gain FROM s JOIN z USING (alternative)""")
def group_efficiency(b: Inputs):
    return rounded(ops.group_efficiency(attempts(b), N, tail=20))


@query("cards_by_date", "LE-10", """
    WITH a AS (SELECT dt, exercise, correct FROM b_attempts WHERE randomized),
    f AS (SELECT DISTINCT exercise FROM a WHERE dt = (SELECT MIN(dt) FROM a))
    SELECT dt::VARCHAR AS dt, round(AVG(correct::INT), 6) AS accuracy, COUNT(*) AS n, COUNT(DISTINCT exercise) AS exercises,
           round(AVG(correct::INT) FILTER (WHERE exercise IN (SELECT exercise FROM f)), 6) AS filtered_accuracy,
           COUNT(*) FILTER (WHERE exercise IN (SELECT exercise FROM f)) AS filtered_n,
           COUNT(DISTINCT exercise) FILTER (WHERE exercise IN (SELECT exercise FROM f)) AS filtered_exercises FROM a GROUP BY a.dt""")
def cards_by_date(b: Inputs):
    return rounded(ops.cards_by_date(attempts(b)))


@query("conditional_accuracy", "LE-11", """
    WITH k AS (SELECT * FROM b_attempts WHERE exercise IN (SELECT exercise FROM b_attempts GROUP BY 1 HAVING COUNT(*) >= 80)),
    l AS (SELECT exercise, correct::INT AS c, lag(exercise) OVER w AS pe, lag(correct) OVER w AS pc FROM k WINDOW w AS (PARTITION BY "user" ORDER BY time_done, event_id)),
    g AS (SELECT exercise, AVG(c) AS p FROM l GROUP BY 1),
    n AS (SELECT pe AS exercise, AVG(c) FILTER (WHERE NOT pc) AS w, AVG(c) FILTER (WHERE pc) AS r FROM l WHERE pe IS NOT NULL GROUP BY 1)
    SELECT exercise, round(p, 6) AS p_global, round(w, 6) AS p_given_wrong, round(r, 6) AS p_given_right FROM g LEFT JOIN n USING (exercise)""")
def conditional_accuracy(b: Inputs):
    return rounded(ops.conditional_accuracy(attempts(b), 80))


def assessments(b: Inputs):
    """Assessments of at most 64 responses, with the history as JSON text."""
    response = F.struct(
        F.col("event_id"), F.concat(F.lit("ex_"), F.col("k") % 12).alias("exercise"), (F.col("value") < 60).alias("correct"),
        F.concat(F.lit("t"), "event_id").alias("time_done"), F.floor("value").cast("int").alias("time_taken"),
        F.col("event_type").alias("problem_type"), F.concat(F.lit("x"), F.col("k") % 5).alias("seed"))
    block = F.floor(F.col("event_id") / 64)
    groups = b.events.groupBy("user", block.alias("block")).agg(F.array_sort(F.collect_list(response)).alias("h"))
    return groups.select(
        F.concat_ws("-", "user", "block").alias("key"), F.concat(F.lit("slug"), F.col("block") % 4).alias("slug"),
        F.to_json("h").alias("history"))


SQL_INPUTS["b_responses"] = """
    SELECT "user" || '-' || (event_id // 64) AS key, 'slug' || (event_id // 64 % 4) AS slug, 't' || event_id AS time_done, 'ex_' || (k % 12) AS exercise,
           event_type AS problem_type, 'x' || (k % 5) AS seed, floor(value)::BIGINT AS time_taken,
           row_number() OVER (PARTITION BY "user", event_id // 64, k % 12 ORDER BY event_id) AS problem_number, value < 60 AS correct FROM b_events"""


@query("assessment_responses", "LE-12", "SELECT * EXCLUDE (slug) FROM b_responses")
def assessment_responses(b: Inputs):
    return ops.assessment_responses(assessments(b))


@query("assessment_quality", "LE-12", """
    WITH a AS (SELECT key, slug, COUNT(*) AS n, COUNT(*) FILTER (WHERE correct) AS c FROM b_responses GROUP BY 1, 2)
    SELECT slug, COUNT(*) AS total, COUNT(*) FILTER (WHERE n = 2) AS complete, COUNT(*) FILTER (WHERE c > 1) AS valid FROM a GROUP BY 1""")
def assessment_quality(b: Inputs):
    return ops.assessment_quality(assessments(b), length=2, enough=1)


@query("top_answers", "LE-13", """
    WITH l AS (SELECT event_id, ts, exercise, seed, 'a' || (event_id % 17) AS answer, CASE WHEN dt < DATE '2024-01-12' AND length(seed) = 2 THEN 'old' ELSE 'new' END AS sha1
               FROM b_problem_log WHERE event_id % 13 <> 0 AND seed LIKE 'x%'),
    n AS (SELECT seed, arg_max(sha1, event_id) AS sha1 FROM l GROUP BY 1),
    c AS (SELECT exercise, l.seed, answer AS response, COUNT(*) AS n FROM l JOIN n ON l.seed = n.seed AND l.sha1 = n.sha1 GROUP BY 1, 2, 3)
    SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY exercise, seed ORDER BY n DESC, response) AS r FROM c) WHERE r <= 10""")
def top_answers(b: Inputs):
    ident = F.col("event_id")
    log = b.problem_log.withColumns({
        "attempts": F.when(ident % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("a"), ident % 17), F.lit("b"))),
        "sha1": F.when((F.col("dt") < F.lit("2024-01-12").cast("date")) & (F.length("seed") == 2), "old").otherwise("new"),
        "time_done": F.unix_micros(F.col("ts").cast("timestamp")) / 1e6})
    return ops.top_answers(log)


@query("assessment_defs", "LE-14", "SELECT slug, string_agg(DISTINCT exercise, '|' ORDER BY exercise) AS exercises FROM b_responses GROUP BY 1")
def assessment_defs(b: Inputs):
    return ops.assessment_defs(assessments(b)).withColumn("exercises", F.array_join("exercises", "|"))


@query("exercise_difficulty", "LE-15", "SELECT exercise, cards, round(pct_correct, 6) AS pct_correct FROM b_exercise_difficulty")
def exercise_difficulty(b: Inputs):
    return rounded(ops.exercise_difficulty(attempts(b)))
