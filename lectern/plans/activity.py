"""Queries of the activity block."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import activity as ops
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.registry import query

SQL_INPUTS.update({
    "b_view_summary": """
        SELECT "user", video AS video_key, video_title, dt,
               CAST(SUM(CASE WHEN seconds_watched < 0 THEN 0 WHEN seconds_watched > 1800 THEN 1800
                             ELSE seconds_watched END) AS BIGINT) AS num_seconds,
               bool_or(is_video_completed) AS completed FROM b_view_log GROUP BY 1, 2, 3, 4""",
    "b_solve_summary": """
        SELECT "user", exercise, dt,
               CAST(SUM(LEAST(GREATEST(time_taken, 0), 600)) AS BIGINT) AS time_spent,
               COUNT(*) FILTER (WHERE correct) AS num_correct, COUNT(*) FILTER (WHERE NOT correct) AS num_wrong,
               bool_or(earned_proficiency) AS proficient FROM b_problem_log GROUP BY 1, 2, 3""",
    "b_feedback_summary": """
        SELECT author AS "user", target AS video_key, dt, COUNT(*) AS record_cnt,
               COUNT(*) FILTER (WHERE kind = 'question') AS question_cnt,
               COUNT(*) FILTER (WHERE kind = 'answer') AS answer_cnt FROM b_feedback GROUP BY 1, 2, 3""",
    "b_growth_daily": """
        WITH days AS (SELECT "user", dt, bool_or(joined) AS joined FROM b_order_activity
                      WHERE "user" IN (SELECT "user" FROM b_users WHERE registered) GROUP BY 1, 2),
        g AS (SELECT *, lag(dt) OVER w AS prev, lead(dt) OVER w AS nxt FROM days WINDOW w AS (PARTITION BY "user" ORDER BY dt)),
        c AS (SELECT dt, 'joins' AS series FROM g WHERE joined
              UNION ALL SELECT dt, 'reactivations' FROM g WHERE dt - prev > 28
              UNION ALL SELECT dt + 28, 'deactivations' FROM g WHERE COALESCE(nxt, DATE '2001-09-01') - dt > 28)
        SELECT dt, series, COUNT(*) AS value FROM c WHERE dt >= DATE '1995-06-01' AND dt < DATE '2001-09-01' GROUP BY 1, 2""",
})


@query("user_video_summary", "AC-1", """
    SELECT "user", video_key, video_title, num_seconds, completed, dt::VARCHAR AS dt FROM b_view_summary""")
def user_video_summary(b: Inputs):
    return ops.user_video_summary(b.view_log)


@query("user_exercise_summary", "AC-2", """
    SELECT "user", exercise, time_spent, num_correct, num_wrong, proficient, dt::VARCHAR AS dt FROM b_solve_summary""")
def user_exercise_summary(b: Inputs):
    return ops.user_exercise_summary(b.problem_log)


@query("user_feedback_summary", "AC-3", """
    SELECT "user", video_key, record_cnt, question_cnt, answer_cnt, dt::VARCHAR AS dt FROM b_feedback_summary""")
def user_feedback_summary(b: Inputs):
    return ops.user_feedback_summary(b.feedback)


@query("user_daily_activity", "AC-4", """
    WITH facts AS (
        SELECT "user", dt, false AS joined, record_cnt AS a, 0 AS b, 0 AS c, 0 AS d, 0 AS e, 0 AS f, 0 AS g, 0 AS h FROM b_feedback_summary
        UNION ALL SELECT "user", dt, false, 0, 1, completed::INT, num_seconds, 0, 0, 0, 0 FROM b_view_summary
        UNION ALL SELECT "user", dt, false, 0, 0, 0, 0, 1, proficient::INT, num_correct + num_wrong, time_spent FROM b_solve_summary
        UNION ALL SELECT "user", joined, true, 0, 0, 0, 0, 0, 0, 0, 0 FROM b_learners)
    SELECT "user", dt::VARCHAR AS dt, bool_or(joined) AS joined, SUM(a)::BIGINT AS feedback_items, SUM(b)::BIGINT AS videos_started,
           SUM(c)::BIGINT AS videos_completed, SUM(d)::BIGINT AS videos_seconds, SUM(e)::BIGINT AS exercises_started,
           SUM(f)::BIGINT AS exercises_completed, SUM(g)::BIGINT AS exercises_problems_done, SUM(h)::BIGINT AS exercises_seconds
    FROM facts WHERE dt >= DATE '2024-01-01' AND dt < DATE '2024-01-31' GROUP BY "user", dt""")
def user_daily_activity(b: Inputs):
    return ops.user_daily_activity(
        ops.user_feedback_summary(b.feedback), ops.user_video_summary(b.view_log),
        ops.user_exercise_summary(b.problem_log), b.learners, "2024-01-01", "2024-01-31")


@query("company_metrics", "AC-5", """
    WITH d AS (SELECT DISTINCT a."user", a.dt, u.joined FROM (
                   SELECT "user", dt FROM b_order_days UNION ALL SELECT "user", joined FROM b_users) a
               JOIN b_users u ON a."user" = u."user" AND u.registered
               WHERE a.dt >= DATE '1995-01-01' AND a.dt < DATE '2001-08-01'),
    m AS (SELECT "user", strftime(dt, '%Y-%m') AS activity_month, strftime(MAX(joined), '%Y-%m') AS jm,
                 MAX(dt) - MAX(joined) AS age, COUNT(*) AS n FROM d GROUP BY 1, 2)
    SELECT activity_month, COUNT(*) FILTER (WHERE jm = activity_month) AS registrations_this_month,
           COUNT(*) FILTER (WHERE age >= 28) AS long_term_users_active_this_month,
           COUNT(*) FILTER (WHERE n >= 4) AS highly_engaged_users_active_this_month FROM m GROUP BY 1""")
def company_metrics(b: Inputs):
    return ops.company_metrics(b.order_days, b.users, "1995-01-01", "2001-08-01")


@query("user_growth_daily", "AC-6", "SELECT dt::VARCHAR AS dt, series, value FROM b_growth_daily")
def user_growth_daily(b: Inputs):
    return ops.user_growth_daily(b.order_activity, "1995-06-01", "2001-09-01", b.users)


for _name, _days in (("user_growth_weekly", 7), ("user_growth_monthly", 28)):
    query(_name, "AC-7", f"""
        SELECT (DATE '2001-09-01' - CAST(floor((DATE '2001-09-01' - dt) / {_days}) AS INTEGER) * {_days})::VARCHAR AS dt,
               series, SUM(value)::BIGINT AS value FROM b_growth_daily GROUP BY 1, 2""")(
        lambda b, days=_days: ops.user_growth_rollup(user_growth_daily(b), "2001-09-01", days))


@query("daily_video_stats", "AC-8", """
    WITH t AS (SELECT v.*, unnest(CASE WHEN u.registered THEN ['all', 'registered']
                                       WHEN NOT u.registered THEN ['all', 'phantom'] ELSE ['all'] END) AS user_category
               FROM b_uvs v LEFT JOIN b_users u ON v."user" = u."user"),
    per_user AS (SELECT dt, user_category, "user", MAX(completed::INT) AS c, SUM(num_seconds) AS s FROM t GROUP BY 1, 2, 3)
    SELECT dt::VARCHAR AS dt, user_category, title, youtube_id, COUNT(*) AS watched,
           COUNT(*) FILTER (WHERE completed) AS completed, SUM(num_seconds)::BIGINT AS seconds_watched, 'video' AS aggregation
    FROM t JOIN b_videos ON video_key = key GROUP BY dt, user_category, title, youtube_id
    UNION ALL
    SELECT dt::VARCHAR, user_category, 'Total', 'Total', COUNT(*), SUM(c)::BIGINT, SUM(s)::BIGINT, 'total'
    FROM per_user GROUP BY dt, user_category""")
def daily_video_stats(b: Inputs):
    return ops.daily_video_stats(b.uvs, b.videos, b.users)


SQL_INPUTS["b_video_stats"] = """
    WITH w AS (SELECT * FROM b_uvs WHERE dt >= DATE '1996-01-01' AND dt < DATE '1998-01-01'),
    t AS (SELECT 'all' AS user_category, w.* FROM w
          UNION ALL SELECT 'registered', w.* FROM w JOIN b_users u ON w."user" = u."user" AND u.registered
          UNION ALL SELECT 'phantom', w.* FROM w JOIN b_users u ON w."user" = u."user" AND NOT u.registered),
    l AS (SELECT 'video' AS aggregation, key, title, youtube_id FROM b_videos
          UNION ALL SELECT DISTINCT 'top_topic', vid_key, top_category, 'N/M' FROM b_categories
          UNION ALL SELECT DISTINCT 'second_topic', vid_key, COALESCE(second_category, 'NONE'), 'N/M' FROM b_categories),
    p AS (SELECT user_category, "user", COUNT(DISTINCT dt) AS visits, MAX(completed::INT) AS c, SUM(num_seconds) AS s
          FROM t GROUP BY 1, 2)
    SELECT user_category, aggregation, title, youtube_id, COUNT(DISTINCT "user") AS users,
           COUNT(DISTINCT ("user", dt)) AS visits, COUNT(*) FILTER (WHERE completed) AS completed,
           SUM(num_seconds)::BIGINT AS seconds_watched
    FROM t JOIN l ON t.video_key = l.key GROUP BY 1, 2, 3, 4
    UNION ALL
    SELECT user_category, 'total', 'Total', 'Total', COUNT(*), SUM(visits)::BIGINT, SUM(c)::BIGINT, SUM(s)::BIGINT FROM p GROUP BY 1"""


@query("video_stats", "AC-9", "SELECT *, 'year' AS duration, '1996-01-01' AS dt FROM b_video_stats")
def video_stats(b: Inputs):
    return ops.video_stats(b.uvs, b.videos, b.categories, b.users, "year", "1996-01-01", "1998-01-01")


@query("topic_usage", "AC-10", """
    WITH r AS (SELECT v.*, u.registered FROM b_uvs v LEFT JOIN b_users u ON v."user" = u."user"
               WHERE v.dt >= DATE '1995-01-01' AND v.dt < DATE '2000-01-01'),
    x AS (SELECT topic_title AS topic, r.* FROM r JOIN b_video_topic ON vid_key = video_key
          UNION ALL SELECT 'total', r.* FROM r)
    SELECT topic, registered, COUNT(DISTINCT "user") AS users, COUNT(DISTINCT ("user", dt)) AS visits,
           COUNT(*) FILTER (WHERE completed) AS completed, SUM(num_seconds)::BIGINT AS seconds FROM x GROUP BY 1, 2""")
def topic_usage(b: Inputs):
    return ops.topic_usage(b.uvs, b.video_topic, b.users, "1995-01-01", "2000-01-01")


@query("visit_distribution", "AC-11", """
    WITH p AS (SELECT "user", COUNT(DISTINCT dt) AS visits, COUNT(DISTINCT video_key) AS videos,
                      COUNT(*) FILTER (WHERE completed) AS completed, SUM(num_seconds) AS seconds
               FROM b_uvs WHERE dt >= DATE '1995-01-01' AND dt < DATE '2000-01-01' GROUP BY 1)
    SELECT u.registered, visits, COUNT(*) AS num_users, SUM(videos)::BIGINT AS videos,
           SUM(completed)::BIGINT AS completed, SUM(seconds)::BIGINT AS seconds
    FROM p LEFT JOIN b_users u ON p."user" = u."user" GROUP BY 1, 2""")
def visit_distribution(b: Inputs):
    return ops.visit_distribution(b.uvs, b.users, "1995-01-01", "2000-01-01")


SQL_INPUTS["b_exercise_summary"] = """
    SELECT exercise, CASE WHEN try_cast(seed AS INTEGER) IS NULL THEN seed ELSE problem_type END AS sub_exercise_type,
           try_cast(seed AS INTEGER) IS NULL AS is_static, dt, COUNT(*) FILTER (WHERE correct) AS correct_attempts,
           COUNT(*) FILTER (WHERE NOT correct) AS wrong_attempts,
           SUM(LEAST(GREATEST(time_taken, 0), 600))::BIGINT AS time_taken
    FROM b_problem_log WHERE dt >= DATE '2024-01-01' AND dt < DATE '2024-01-31' GROUP BY 1, 2, 3, 4"""


@query("exercise_summary", "AC-12", "SELECT * REPLACE (dt::VARCHAR AS dt) FROM b_exercise_summary")
def exercise_summary(b: Inputs):
    return ops.exercise_summary(b.problem_log, "2024-01-01", "2024-01-31")


SQL_INPUTS["b_exercise_proficiency"] = """
    WITH p AS (SELECT exercise, "user", MIN(dt) AS dt, MAX(earned_proficiency::INT) AS pr FROM b_problem_log GROUP BY 1, 2)
    SELECT exercise, SUM(pr)::BIGINT AS earned_proficiency, COUNT(*) AS total_users
    FROM p WHERE dt >= DATE '2024-07-08' - 180 AND dt < DATE '2024-07-08' GROUP BY 1"""


@query("exercise_proficiency", "AC-13", "SELECT * FROM b_exercise_proficiency")
def exercise_proficiency(b: Inputs):
    return ops.exercise_proficiency(b.problem_log, "2024-07-08")


SQL_INPUTS["b_badge_context_summary"] = """
    WITH g AS (SELECT *, COALESCE(target_context_name, 'None') AS context_name FROM b_badges),
    f AS (SELECT badge_name, context_name, dt, COUNT(*) AS n FROM (
              SELECT badge_name, context_name, "user", MIN(dt) AS dt FROM g GROUP BY 1, 2, 3) GROUP BY 1, 2, 3)
    SELECT g.badge_name, g.context_name, g.dt, COUNT(*) AS total_awarded, SUM(points_earned)::BIGINT AS total_points_earned,
           ANY_VALUE(f.n) AS unique_awarded
    FROM g LEFT JOIN f ON g.badge_name = f.badge_name AND g.context_name = f.context_name AND g.dt = f.dt
    WHERE g.dt >= DATE '1995-01-01' AND g.dt < DATE '2001-01-01' GROUP BY 1, 2, 3"""


@query("badge_summary", "AC-14", """
    WITH f AS (SELECT badge_name, dt, COUNT(*) AS n FROM (
                   SELECT badge_name, "user", MIN(dt) AS dt FROM b_badges GROUP BY 1, 2) GROUP BY 1, 2)
    SELECT g.badge_name, g.dt::VARCHAR AS dt, COUNT(*) AS total_awarded, SUM(points_earned)::BIGINT AS total_points_earned,
           ANY_VALUE(f.n) AS unique_awarded
    FROM b_badges g LEFT JOIN f ON g.badge_name = f.badge_name AND g.dt = f.dt
    WHERE g.dt >= DATE '1995-01-01' AND g.dt < DATE '2001-01-01' GROUP BY g.badge_name, g.dt""")
def badge_summary(b: Inputs):
    return ops.badge_summary(b.badges, "1995-01-01", "2001-01-01")


@query("badge_context_summary", "AC-14", "SELECT * REPLACE (dt::VARCHAR AS dt) FROM b_badge_context_summary")
def badge_context_summary(b: Inputs):
    return ops.badge_summary(b.badges, "1995-01-01", "2001-01-01", by_context=True)


@query("daily_exercise_stats", "AC-15", """
    WITH l AS (SELECT * FROM b_numbered_log WHERE dt = DATE '2024-01-15'),
    t AS (SELECT "user", COUNT(*) AS n, SUM(topic_mode::INT) AS t FROM l GROUP BY 1),
    u AS (SELECT t."user", n, t, i."user" IS NOT NULL AS known, joined, n_coaches, n_done, registered
          FROM t LEFT JOIN b_learners i ON t."user" = i."user"),
    um AS (SELECT "user", 'everything' AS mode, 'user' AS kind FROM u
        UNION ALL SELECT "user", 'unknown', 'user' FROM u WHERE NOT known
        UNION ALL SELECT "user", 'old', 'user' FROM u WHERE joined < DATE '2024-01-15' - 14
        UNION ALL SELECT "user", 'new', 'user' FROM u WHERE joined >= DATE '2024-01-15' - 14
        UNION ALL SELECT "user", 'coached', 'user' FROM u WHERE known AND n_coaches > 0
        UNION ALL SELECT "user", 'uncoached', 'user' FROM u WHERE known AND n_coaches = 0
        UNION ALL SELECT "user", 'heavy', 'user' FROM u WHERE n_done > 10
        UNION ALL SELECT "user", 'light', 'user' FROM u WHERE known AND (n_done IS NULL OR n_done <= 10)
        UNION ALL SELECT "user", 'registered', 'user' FROM u WHERE registered
        UNION ALL SELECT "user", 'phantom', 'user' FROM u WHERE NOT registered
        UNION ALL SELECT "user", 'none', 'topic' FROM u WHERE t = 0
        UNION ALL SELECT "user", 'some', 'topic' FROM u WHERE t > 0
        UNION ALL SELECT "user", 'majority', 'topic' FROM u WHERE t / n > 0.5
        UNION ALL SELECT "user", 'all', 'topic' FROM u WHERE t = n
        UNION ALL SELECT "user", 'true', 'row' FROM u UNION ALL SELECT "user", 'false', 'row' FROM u),
    x AS (SELECT a.mode AS super_mode, s.mode AS sub_mode, l.* FROM l
          JOIN um a ON a."user" = l."user" AND a.kind = 'user' JOIN um s ON s."user" = l."user"
          WHERE s.kind <> 'row' OR s.mode = l.topic_mode::VARCHAR),
    y AS (SELECT super_mode, sub_mode, exercise, "user", COUNT(*) AS problems, SUM(correct::INT) AS correct, SUM(earned_proficiency::INT) AS profs,
                 SUM(CASE WHEN earned_proficiency THEN problem_number ELSE 0 END) AS ppc, SUM((problem_number = 1)::INT) AS fa,
                 SUM(hint_used::INT) AS hp, SUM(LEAST(GREATEST(time_taken, 0), 600)) AS tt FROM x GROUP BY 1, 2, 3, 4),
    z AS (SELECT * FROM y UNION ALL SELECT super_mode, sub_mode, 'ALL', "user", problems, correct, profs, ppc, fa, hp, tt FROM y)
    SELECT super_mode, sub_mode, exercise, COUNT(DISTINCT "user") AS users, COUNT(*) AS user_exercises,
           SUM(problems)::BIGINT AS problems, SUM(correct)::BIGINT AS correct, SUM(profs)::BIGINT AS profs, SUM(ppc)::BIGINT AS prof_prob_count,
           SUM(fa)::BIGINT AS first_attempts, SUM(hp)::BIGINT AS hint_probs, SUM(tt)::BIGINT AS time_taken
    FROM z GROUP BY 1, 2, 3""")
def daily_exercise_stats(b: Inputs):
    return ops.daily_exercise_stats(b.numbered_log, b.learners, "2024-01-15")


@query("normalised_stat", "AC-16", """
    SELECT dt::VARCHAR AS dt, round(SUM(time_taken) / SUM(correct_attempts + wrong_attempts), 8) AS value FROM b_exercise_summary GROUP BY dt""")
def normalised_stat(b: Inputs):
    stats = exercise_summary(b).withColumn("problems", F.col("correct_attempts") + F.col("wrong_attempts"))
    return ops.normalised_stat(stats, "time_taken", "problems").withColumn("value", F.round("value", 8))


@query("net_growth", "AC-17", """
    SELECT dt::VARCHAR AS dt, COALESCE(SUM(value) FILTER (WHERE series = 'joins'), 0)::BIGINT AS joins,
           COALESCE(SUM(value) FILTER (WHERE series = 'deactivations'), 0)::BIGINT AS deactivations,
           COALESCE(SUM(value) FILTER (WHERE series = 'reactivations'), 0)::BIGINT AS reactivations,
           SUM(CASE WHEN series = 'deactivations' THEN -value ELSE value END)::BIGINT AS net FROM b_growth_daily GROUP BY dt""")
def net_growth(b: Inputs):
    return ops.net_growth(user_growth_daily(b))
