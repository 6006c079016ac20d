"""Queries of the engagement block, on the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import activity, engagement as ops
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.registry import query

M1, M2, M3 = "2024-01-01", "2024-01-16", "2024-01-31"
NAMES = {"standard": "STANDARD", "medium": "MEDIUM", "large": "LARGE", "economy": "ECONOMY", "small": "SMALL", "promo": "PROMO"}


def sources(b: Inputs):
    return (activity.user_video_summary(b.view_log), activity.user_exercise_summary(b.problem_log),
            activity.user_feedback_summary(b.feedback))


def _classification_sql(start: str, end: str) -> str:
    parts = []
    tables = {"video": "b_view_summary", "exercise": "b_solve_summary", "feedback": "b_feedback_summary"}
    for name, kinds in ops.VISIT_TYPES.items():
        union = " UNION ALL ".join(f'SELECT "user", dt FROM {tables[k]}' for k in kinds)
        parts.append(f"""SELECT "user", '{name}' AS type, COUNT(DISTINCT dt) AS visits FROM ({union})
            WHERE dt >= DATE '{start}' AND dt < DATE '{end}' GROUP BY 1""")
    return " UNION ALL ".join(parts)


def _dataset_sql(start: str, end: str, tag: str) -> None:
    where = f"WHERE dt >= DATE '{start}' AND dt < DATE '{end}'"
    visits = ", ".join(f"SUM(CASE WHEN type = '{t}' THEN visits ELSE 0 END)::BIGINT AS {t}_visits" for t in ops.VISIT_TYPES)
    pivot = ", ".join(f"SUM(CASE WHEN topic = '{t}' THEN {m} ELSE 0 END)::BIGINT AS {p}_{m}" for p, t in NAMES.items() for m in ops.MEASURES)
    SQL_INPUTS.update({
        f"b_class_{tag}": _classification_sql(start, end),
        f"b_visits_{tag}": f"""
            SELECT c.*, i.user_id, i.user_email, i.joined, i.registered FROM (SELECT "user", {visits} FROM b_class_{tag} GROUP BY 1) c
            LEFT JOIN b_learners i ON c."user" = i."user" """,
        f"b_condensed_{tag}": f"""
            WITH e AS (SELECT "user", SUM(time_spent)::BIGINT AS timespent_exercise, COUNT(*) AS num_exercise, COUNT(*) FILTER (WHERE proficient) AS num_proficient,
                              round(SUM(num_correct) / SUM(num_correct + num_wrong), 8) AS avg_accuracy FROM b_solve_summary {where} GROUP BY 1),
            v AS (SELECT "user", SUM(num_seconds)::BIGINT AS timespent_video, COUNT(*) AS num_videos, COUNT(*) FILTER (WHERE completed) AS num_completed
                  FROM b_view_summary {where} GROUP BY 1),
            f AS (SELECT "user", COUNT(*) AS num_videos_commented, SUM(record_cnt)::BIGINT AS num_comments, SUM(question_cnt)::BIGINT AS num_questions,
                         SUM(answer_cnt)::BIGINT AS num_answers FROM b_feedback_summary {where} GROUP BY 1)
            SELECT * FROM e FULL JOIN v USING ("user") FULL JOIN f USING ("user")""",
        f"b_user_category_{tag}": f"""
            SELECT "user", top_category AS topic, COUNT(DISTINCT video_key) AS videos, COUNT(DISTINCT dt) AS visits, SUM(num_seconds)::BIGINT AS seconds,
                   COUNT(*) FILTER (WHERE completed) AS completed
            FROM b_view_summary JOIN (SELECT DISTINCT vid_key, top_category FROM b_categories) ON vid_key = video_key {where} GROUP BY 1, 2""",
        f"b_pivot_{tag}": f'SELECT "user", {pivot} FROM b_user_category_{tag} GROUP BY 1',
        f"b_dataset_{tag}": f"""
            SELECT * EXCLUDE (registered), CASE WHEN registered THEN 'registered' ELSE 'phantom' END AS type
            FROM b_visits_{tag} LEFT JOIN b_condensed_{tag} USING ("user") LEFT JOIN b_pivot_{tag} USING ("user") WHERE registered IS NOT NULL""",
    })


_dataset_sql(M1, M2, "m1")
_dataset_sql(M2, M3, "m2")


def classification(b: Inputs, start: str = M1, end: str = M2):
    return ops.user_classification(*sources(b), start, end)


def condensed(b: Inputs, start: str = M1, end: str = M2):
    return ops.condensed_activity(*sources(b), start, end).withColumn("avg_accuracy", F.round("avg_accuracy", 8))


def pivoted(b: Inputs, start: str = M1, end: str = M2):
    return ops.user_category_pivot(ops.user_category_usage(sources(b)[0], b.categories, start, end), NAMES)


def dataset(b: Inputs, start: str = M1, end: str = M2):
    visits = ops.user_visits_summary(classification(b, start, end), b.learners)
    return ops.engagement_dataset(visits, condensed(b, start, end), pivoted(b, start, end))


query("user_classification", "EN-1", "SELECT * FROM b_class_m1")(classification)
query("user_visits_summary", "EN-2", "SELECT * REPLACE (joined::VARCHAR AS joined) FROM b_visits_m1")(
    lambda b: ops.user_visits_summary(classification(b), b.learners))
query("condensed_activity", "EN-3", "SELECT * FROM b_condensed_m1")(condensed)

for _level, _label in (("top", "top_category"), ("second", "COALESCE(second_category, 'NONE')")):
    query(f"category_usage_{_level}", "EN-4", f"""
        SELECT {_label} AS topic, COUNT(DISTINCT video_key) AS videos, COUNT(DISTINCT "user") AS users, COUNT(DISTINCT ("user", dt)) AS visits,
               SUM(num_seconds)::BIGINT AS seconds, COUNT(*) FILTER (WHERE completed) AS completed
        FROM b_uvs JOIN b_categories ON vid_key = video_key WHERE dt >= DATE '1996-01-01' AND dt < DATE '2000-01-01' GROUP BY 1""")(
        lambda b, level=_level: ops.category_usage(b.uvs, b.categories, "1996-01-01", "2000-01-01", level))

for _level, _label in (("top", "top_category"), ("second", "COALESCE(second_category, top_category)")):
    query(f"user_category_usage_{_level}", "EN-5", f"""
        SELECT "user", {_label} AS topic, COUNT(DISTINCT video_key) AS videos, COUNT(DISTINCT dt) AS visits,
               SUM(num_seconds)::BIGINT AS seconds, COUNT(*) FILTER (WHERE completed) AS completed
        FROM b_uvs JOIN b_categories ON vid_key = video_key WHERE dt >= DATE '1996-01-01' AND dt < DATE '2000-01-01' GROUP BY 1, 2""")(
        lambda b, level=_level: ops.user_category_usage(b.uvs, b.categories, "1996-01-01", "2000-01-01", level))

query("user_category_pivot", "EN-6", "SELECT * FROM b_pivot_m1")(pivoted)


@query("user_category_map", "EN-7", """
    SELECT "user", '{' || string_agg('"' || lower(topic) || '":["' || videos || '","' || visits || '","' || seconds || '","' || completed || '"]', ','
                                     ORDER BY lower(topic)) || '}' AS category_json FROM b_user_category_m1 GROUP BY 1""")
def user_category_map(b: Inputs):
    return ops.user_category_map(ops.user_category_usage(sources(b)[0], b.categories, M1, M2))


query("engagement_dataset", "EN-8", "SELECT * REPLACE (joined::VARCHAR AS joined) FROM b_dataset_m1")(dataset)

_COLUMNS = (["user", "user_id", "user_email", "joined"] + [f"{t}_visits" for t in ops.VISIT_TYPES]
            + ["timespent_exercise", "num_exercise", "num_proficient", "avg_accuracy", "timespent_video", "num_videos", "num_completed",
               "num_videos_commented", "num_comments", "num_questions", "num_answers"]
            + [f"{p}_{m}" for p in NAMES for m in ops.MEASURES])


@query("month_over_month_pairs", "EN-9", "SELECT " + ", ".join(
    f'{s}."{c}"{"::VARCHAR" if c == "joined" else ""} AS {s}_{c}' for s in ("a", "b") for c in _COLUMNS) + """
    FROM b_dataset_m1 a LEFT JOIN (SELECT * FROM b_dataset_m2 WHERE type = 'registered') b ON a."user" = b."user" WHERE a.type = 'registered'""")
def month_over_month_pairs(b: Inputs):
    return ops.month_over_month_pairs(dataset(b), dataset(b, M2, M3))


@query("segment_view", "EN-10", """
    SELECT date_trunc('week', dt)::DATE::VARCHAR AS week_date, SUM(CASE WHEN event_type = 'click' THEN floor(value) ELSE 0 END)::DOUBLE AS exercise,
           SUM(CASE WHEN event_type = 'view' THEN floor(value) ELSE 0 END)::DOUBLE AS video FROM b_events GROUP BY 1
    UNION ALL SELECT 'YAxis', 0.0, 0.0 UNION ALL SELECT 'Cumulative', 0.0, 0.0""")
def segment_view(b: Inputs):
    seconds = lambda t: F.sum(F.when(F.col("event_type") == t, F.floor("value")).otherwise(0))
    weekly = b.events.groupBy(F.date_trunc("week", "dt").cast("date").cast("string").alias("week_date")).agg(
        F.countDistinct("user").alias("exercise_users"), F.countDistinct("user").alias("video_users"),
        seconds("click").alias("exercise_seconds"), seconds("view").alias("video_seconds"))
    return ops.segment_view(weekly, ["exercise", "video"], "seconds")
