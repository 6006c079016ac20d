"""Queries of the dashboard block."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import dashboard as ops
from lectern.operators.activity import CATEGORIES
from lectern.plans import activity
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.learning import rounded
from lectern.plans.registry import ORACLES, query
from lectern.session import cut_lineage

_TWO = "floor({0}::DOUBLE * 100 / NULLIF({1}, 0) + 0.5) / 100"
_CELLS = {}
for _c in CATEGORIES:
    _of = lambda m, c=_c: f"MAX({m}) FILTER (WHERE user_category = '{c}')"
    _CELLS |= {f"watched_{_c}": _of("users"), f"visits_{_c}": _of("visits"), f"completed_{_c}": _of("completed"),
               f"hours_{_c}": _TWO.format(_of("seconds_watched"), 3600), f"visits_per_user_{_c}": _TWO.format(_of("visits"), _of("users"))}
SQL_INPUTS["b_shares"] = "SELECT aggregation, title, " + ", ".join(f"{v} AS {k}" for k, v in _CELLS.items()) + " FROM b_video_stats GROUP BY 1, 2"
SQL_INPUTS["b_daily_video_stats"] = ORACLES["daily_video_stats"]

for _name, _level in (("topic_share_top", "top_topic"), ("topic_share_second", "second_topic")):
    query(_name, "DA-1", f"""
        WITH t AS (SELECT * FROM b_shares WHERE aggregation = 'total')
        SELECT s.title, {', '.join(f's.{c}' for c in _CELLS)}, {', '.join(f'round(CASE WHEN t.{c} <> 0 THEN s.{c} / t.{c} ELSE 0 END, 8) AS {c}_pct' for c in _CELLS)}
        FROM b_shares s CROSS JOIN t WHERE s.aggregation IN ('{_level}', 'total') AND s.title <> 'NONE'""")(
        lambda b, level=_level: rounded(ops.topic_share(cut_lineage(activity.video_stats(b)), "1996-01-01", "year", level), 8))

query("top_videos", "DA-2", """
    SELECT title, youtube_id, users, visits, completed, seconds_watched, floor(seconds_watched::DOUBLE * 100 / 3600 + 0.5) / 100 AS hours
    FROM b_video_stats WHERE aggregation = 'video' AND user_category = 'all' ORDER BY seconds_watched DESC, title, youtube_id LIMIT 200""")(
    lambda b: ops.top_videos(activity.video_stats(b), "1996-01-01", "year"))
query("title_series", "DA-3", """
    SELECT dt, user_category, title, youtube_id, watched, completed, seconds_watched, aggregation FROM b_daily_video_stats WHERE title = 'Total' AND dt >= '1996-01-01' AND dt < '1998-01-01'""")(
    lambda b: ops.title_series(activity.daily_video_stats(b), "", None, "1996-01-01", "1998-01-01"))
query("recent_minutes", "DA-3", """
    SELECT dt, floor(round(floor(seconds_watched::DOUBLE * 100 / 3600 + 0.5) / 100 * 60, 6))::BIGINT AS minutes
    FROM b_daily_video_stats WHERE title = 'Total' AND user_category = 'all' ORDER BY dt DESC LIMIT 28""")(
    lambda b: ops.recent_minutes(activity.daily_video_stats(b)))

_DRILL = """SUM(correct_attempts + wrong_attempts)::BIGINT AS total, round(SUM(correct_attempts) * 100.0 / SUM(correct_attempts + wrong_attempts), 6) AS pct_correct,
    round(SUM(wrong_attempts) * 100.0 / SUM(correct_attempts + wrong_attempts), 6) AS pct_wrong, floor(SUM(time_taken) / SUM(correct_attempts + wrong_attempts) + 0.5)::BIGINT AS avg_time"""
query("exercise_drilldown", "DA-4", f"""
    WITH d AS (SELECT exercise AS name, {_DRILL} FROM b_exercise_summary GROUP BY 1)
    SELECT d.*, round(earned_proficiency * 100.0 / total_users, 6) AS pct_proficient FROM d LEFT JOIN b_exercise_proficiency p ON p.exercise = d.name""")(
    lambda b: rounded(ops.exercise_drilldown(activity.exercise_summary(b), activity.exercise_proficiency(b))))
query("exercise_drilldown_sub_types", "DA-4", f"""
    WITH d AS (SELECT sub_exercise_type AS name, {_DRILL} FROM b_exercise_summary WHERE exercise = 'ex_3' GROUP BY 1)
    SELECT * FROM d WHERE total > (SELECT SUM(total) FROM d) / 100""")(
    lambda b: rounded(ops.exercise_drilldown(activity.exercise_summary(b), exercise="ex_3")))


def _rank(group: str, measure: str) -> str:
    return (f'row_number() OVER (PARTITION BY "{group}" ORDER BY {measure} DESC, badge_name) AS {group}_{measure}_order, '
            f'SUM({measure}) OVER (PARTITION BY "{group}")::BIGINT AS {group}_{measure}_total')


@query("badge_rollups", "DA-5", f"""
    WITH b AS (SELECT badge_name || '/' || context_name AS badge_name, CASE WHEN badge_name < '3' THEN 'early' ELSE 'late' END AS category, context_name AS context,
                      SUM(total_awarded)::BIGINT AS total_awarded, COALESCE(SUM(unique_awarded), 0)::BIGINT AS unique_awarded
               FROM b_badge_context_summary WHERE dt >= DATE '1996-01-01' AND dt < DATE '1999-01-01' GROUP BY ALL)
    SELECT *, {', '.join(_rank(g, m) for g in ('category', 'context') for m in ('total_awarded', 'unique_awarded'))} FROM b""")
def badge_rollups(b: Inputs):
    summary = activity.badge_context_summary(b).withColumn("badge", F.col("badge_name")).withColumn("badge_name", F.concat_ws("/", "badge_name", "context_name"))
    meta = b.badges.select(
        F.concat_ws("/", "badge_name", F.coalesce("target_context_name", F.lit("None"))).alias("badge_name"),
        F.when(F.col("badge_name") < "3", "early").otherwise("late").alias("category"), F.coalesce("target_context_name", F.lit("None")).alias("context")).distinct()
    return ops.badge_rollups(summary, meta, "1996-01-01", "1999-01-01")


query("context_shares", "DA-5", """
    WITH c AS (SELECT context_name, SUM(total_awarded)::BIGINT AS total_awarded, COALESCE(SUM(unique_awarded), 0)::BIGINT AS unique_awarded FROM b_badge_context_summary WHERE badge_name = '2-HIGH' GROUP BY 1)
    SELECT *, round(total_awarded * 100.0 / SUM(total_awarded) OVER (), 6) AS total_percentage, round(unique_awarded * 100.0 / SUM(unique_awarded) OVER (), 6) AS unique_percentage FROM c""")(
    lambda b: rounded(ops.context_shares(activity.badge_context_summary(b), "2-HIGH")))
query("distinct_values", "DA-6", "SELECT DISTINCT title AS value FROM b_videos")(lambda b: ops.distinct_values(b.videos, "title"))

SQL_INPUTS["b_company_metrics"] = ORACLES["company_metrics"]
_SERIES = ("long_term_users_active_this_month", "highly_engaged_users_active_this_month", "registrations_this_month")
query("goal_series", "DA-7", " UNION ALL ".join(
    f"SELECT '{s}' AS series, activity_month AS month, {s} AS value FROM b_company_metrics WHERE activity_month < (SELECT MAX(activity_month) FROM b_company_metrics)" for s in _SERIES))(
    lambda b: ops.goal_series(cut_lineage(activity.company_metrics(b))))
query("value_week_ago", "DA-7", "SELECT COUNT(*)::DOUBLE AS value FROM b_problem_log WHERE dt = DATE '2024-01-15'")(
    lambda b: ops.value_days_ago(b.problem_log.groupBy("dt").agg(F.count(F.lit(1)).alias("n")), "2024-01-22", "n", 1500000))
