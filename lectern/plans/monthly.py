"""Queries of the monthly block."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import monthly as ops
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.coach import pairs
from lectern.plans.registry import query

SQL_INPUTS.update({
    "b_user_videos": "SELECT \"user\", video_key, MAX(dt) AS dt, bool_or(completed) AS completed FROM b_uvs GROUP BY 1, 2",
    "b_user_exercises": """
        SELECT o_custkey AS "user", o_orderpriority || o_orderstatus AS exercise, MIN(CAST(o_orderdate AS DATE)) AS dt, bool_or(o_totalprice > 300000) AS completed
        FROM orders GROUP BY 1, 2""",
    "b_cohort_sizes": "SELECT coach, COUNT(DISTINCT \"user\") AS num_students FROM b_pairs GROUP BY 1",
    "b_max_cohort": 'SELECT "user", MAX(num_students) AS max_cohort_size FROM b_pairs JOIN b_cohort_sizes USING (coach) GROUP BY 1',
})


def user_videos(b: Inputs):
    return b.uvs.groupBy("user", "video_key").agg(F.max("dt").alias("dt"), F.bool_or("completed").alias("completed"))


def user_exercises(b: Inputs):
    return b.table("orders").groupBy(F.col("o_custkey").alias("user"), F.concat("o_orderpriority", "o_orderstatus").alias("exercise")).agg(
        F.min(F.to_date("o_orderdate")).alias("dt"), F.bool_or(F.col("o_totalprice") > 300000).alias("completed"))


@query("monthly_threshold_users", "MO-1", "WITH m AS (" + """
    SELECT "user", month, SUM(v) AS v, SUM(e) AS e FROM (SELECT "user", strftime(dt, '%Y-%m') AS month, 1 AS v, 0 AS e FROM b_user_videos
        UNION ALL SELECT "user", strftime(dt, '%Y-%m'), 0, 1 FROM b_user_exercises) GROUP BY 1, 2)""" + " UNION ALL ".join(
    f" SELECT 'min_vid={v}; min_ex={e}' AS tag, month, COUNT(*) AS value FROM m WHERE v >= {v} AND e >= {e} GROUP BY 2" for v, e in ops.THRESHOLDS))
def monthly_threshold_users(b: Inputs):
    return ops.monthly_threshold_users(user_videos(b), user_exercises(b))


query("monthly_badge_awards", "MO-2", "SELECT badge_name AS tag, strftime(dt, '%Y-%m') AS month, COUNT(DISTINCT \"user\") AS value FROM b_badges GROUP BY 1, 2")(
    lambda b: ops.monthly_badge_awards(b.badges))
query("monthly_accounts", "MO-3", """
    SELECT CASE WHEN registered THEN 'registration(email)' ELSE 'registration(phantom)' END AS tag, strftime(joined, '%Y-%m') AS month, COUNT(*) AS value FROM b_users GROUP BY 1, 2""")(
    lambda b: ops.monthly_accounts(b.users))

for _name, _lo, _hi in (("retention_cohorts", None, None), ("retention_cohorts_large", 10, None), ("retention_cohorts_small", 1, 40)):
    _where = (f" AND m.max_cohort_size >= {_lo}" if _lo else "") + (f" AND (m.max_cohort_size IS NULL OR m.max_cohort_size <= {_hi})" if _hi else "")
    query(_name, "MO-4", f"""
        WITH u AS (SELECT u."user", joined FROM b_users u LEFT JOIN b_max_cohort m ON m."user" = u."user" WHERE registered{_where}),
        d AS (SELECT DISTINCT u."user", u.joined, v.dt FROM u JOIN (SELECT "user", dt FROM b_order_days UNION ALL SELECT "user", joined FROM b_users) v ON v."user" = u."user")
        SELECT strftime(joined, '%Y-%m') AS cohort, strftime(dt, '%Y-%m') AS month, COUNT(DISTINCT "user") AS users, COUNT(*) AS visits FROM d GROUP BY 1, 2""")(
        lambda b, lo=_lo, hi=_hi: ops.retention_cohorts(b.users, b.order_days, ops.max_cohort_size(pairs(b)), lo, hi))

query("registration_types", "MO-5", """
    SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'phantom' WHEN 'FURNITURE' THEN 'facebook' WHEN 'BUILDING' THEN 'google' ELSE 'email' END AS type, COUNT(*) AS n FROM customer GROUP BY 1""")(
    lambda b: ops.registration_types(b.table("customer").select(F.concat(
        F.when(F.col("c_mktsegment") == "MACHINERY", "http://nouserid.x/").when(F.col("c_mktsegment") == "FURNITURE", "http://facebookid.x/nouserid@")
        .when(F.col("c_mktsegment") == "BUILDING", "g").otherwise("a@x.org"), "c_custkey").alias("current_user"))))
query("cohort_sizes", "MO-6", "SELECT * FROM b_cohort_sizes")(lambda b: ops.cohort_sizes(pairs(b)))
query("max_cohort_size", "MO-6", "SELECT * FROM b_max_cohort")(lambda b: ops.max_cohort_size(pairs(b)))
query("count_cohorts", "MO-6", "SELECT COUNT(*) AS cohorts FROM b_cohort_sizes WHERE num_students >= 10")(lambda b: ops.count_cohorts(pairs(b)))

SQL_INPUTS["b_stats_per_user"] = """
    SELECT "user", SUM(a)::BIGINT AS vids_started, SUM(b)::BIGINT AS vids_completed, SUM(c)::BIGINT AS exs_started, SUM(d)::BIGINT AS exs_completed
    FROM (SELECT "user", 1 AS a, completed::INT AS b, 0 AS c, 0 AS d FROM b_user_videos UNION ALL SELECT "user", 0, 0, 1, completed::INT FROM b_user_exercises) GROUP BY 1"""
query("stats_per_user", "MO-7", "SELECT * FROM b_stats_per_user")(lambda b: ops.stats_per_user(user_videos(b), user_exercises(b)))
query("users_over_cutoffs", "MO-7", " UNION ALL ".join(f"""
    SELECT {c}::BIGINT AS cutoff, COUNT(*) FILTER (WHERE vids_started > {c}) AS vids_started, COUNT(*) FILTER (WHERE vids_completed > {c}) AS vids_completed,
           COUNT(*) FILTER (WHERE exs_started > {c}) AS exs_started, COUNT(*) FILTER (WHERE exs_completed > {c}) AS exs_completed FROM b_stats_per_user""" for c in ops.CUTOFFS))(
    lambda b: ops.users_over_cutoffs(user_videos(b), user_exercises(b)))
query("daily_problem_count", "MO-8", """
    SELECT dt::VARCHAR AS dt, exercise, COUNT(*) AS n FROM b_problem_log GROUP BY b_problem_log.dt, exercise UNION ALL SELECT dt::VARCHAR, 'ALL', COUNT(*) FROM b_problem_log GROUP BY dt""")(
    lambda b: ops.daily_problem_count(b.problem_log))
