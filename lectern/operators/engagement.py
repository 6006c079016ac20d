"""Engagement data set: how users spend their days, by kind of activity and by category."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lectern.functions.columns import count_if
from lectern.operators.activity import in_range

# Combinations of activity kinds that count active days.
VISIT_TYPES = {
    "total": ("video", "exercise", "feedback"),
    "video": ("video",), "exercise": ("exercise",), "feedback": ("feedback",),
    "video_exercise": ("video", "exercise"), "video_feedback": ("video", "feedback"),
    "exercise_feedback": ("exercise", "feedback"),
}
MEASURES = ("videos", "visits", "seconds", "completed")


def user_classification(video: DataFrame, exercise: DataFrame, feedback: DataFrame, start: str, end: str) -> DataFrame:
    """Active days per user for each combination of kinds: days with any of its kinds.

    Rows fold to one per user and day with a flag per kind before the combinations are formed.
    """
    tagged = [df.where(in_range(start, end)).select("user", "dt", F.lit(True).alias(kind))
              for kind, df in (("video", video), ("exercise", exercise), ("feedback", feedback))]
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    days = rows.groupBy("user", "dt").agg(*[F.coalesce(F.bool_or(k), F.lit(False)).alias(k) for k in ("video", "exercise", "feedback")])
    counts = days.groupBy("user").agg(*[
        count_if(functools.reduce(lambda a, b: a | b, [F.col(k) for k in kinds])).alias(name) for name, kinds in VISIT_TYPES.items()])
    cells = F.array(*[F.struct(F.lit(name).alias("type"), F.col(name).alias("visits")) for name in VISIT_TYPES])
    return counts.select("user", F.explode(cells).alias("c")).select("user", "c.*").where("visits > 0")


def user_visits_summary(classification: DataFrame, users: DataFrame) -> DataFrame:
    """One column of active days per combination, with user information."""
    wide = classification.groupBy("user").agg(*[
        F.coalesce(F.sum(F.when(F.col("type") == t, F.col("visits"))), F.lit(0)).alias(f"{t}_visits") for t in VISIT_TYPES])
    return wide.join(users.select("user", "user_id", "user_email", "joined", "registered"), "user", "left")


def condensed_activity(video: DataFrame, exercise: DataFrame, feedback: DataFrame, start: str, end: str) -> DataFrame:
    """Totals per user and kind of activity; NULL where the user has none of that kind."""
    answers = F.sum(F.col("num_correct") + F.col("num_wrong"))
    parts = [
        exercise.where(in_range(start, end)).groupBy("user").agg(
            F.sum("time_spent").alias("timespent_exercise"), F.count(F.lit(1)).alias("num_exercise"),
            count_if(F.col("proficient")).alias("num_proficient"),
            (F.sum("num_correct").cast("double") / F.when(answers != 0, answers)).alias("avg_accuracy")),
        video.where(in_range(start, end)).groupBy("user").agg(
            F.sum("num_seconds").alias("timespent_video"), F.count(F.lit(1)).alias("num_videos"),
            count_if(F.col("completed")).alias("num_completed")),
        feedback.where(in_range(start, end)).groupBy("user").agg(
            F.count(F.lit(1)).alias("num_videos_commented"), F.sum("record_cnt").alias("num_comments"),
            F.sum("question_cnt").alias("num_questions"), F.sum("answer_cnt").alias("num_answers")),
    ]
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy("user").agg(*[F.max(c).alias(c) for c in rows.columns if c != "user"])


def category_labels(categories: DataFrame, level: str, missing: str = "none") -> DataFrame:
    """(vid_key, topic) at a level; ``missing`` says what stands for no second category:
    'none' the word NONE, 'top' the top category."""
    if level == "top":
        label = F.col("top_category")
    else:
        label = F.coalesce("second_category", F.lit("NONE") if missing == "none" else F.col("top_category"))
    return categories.select(F.col("vid_key").alias("video_key"), label.alias("topic")).distinct()


def _usage(rows: DataFrame, keys: Sequence[str], users: bool) -> DataFrame:
    days = rows.groupBy(*dict.fromkeys([*keys, "user", "dt"])).agg(
        F.sum("num_seconds").alias("seconds"), count_if(F.col("completed")).alias("completed"))
    sums = [F.sum("seconds").alias("seconds"), F.sum("completed").alias("completed")]
    if users:
        per_user = days.groupBy(*keys, "user").agg(F.count(F.lit(1)).alias("visits"), *sums)
        out = per_user.groupBy(*keys).agg(F.count(F.lit(1)).alias("users"), F.sum("visits").alias("visits"), *sums)
    else:
        out = days.groupBy(*keys).agg(F.count(F.lit(1)).alias("visits"), *sums)
    videos = rows.select(*keys, "video_key").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("videos"))
    # Joined by grouping, which keeps usage without a category.
    both = out.unionByName(videos, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in both.columns if c not in keys])


def category_usage(uvs: DataFrame, categories: DataFrame, start: str, end: str, level: str = "top") -> DataFrame:
    """Videos, users, user-days, seconds and completions per category."""
    rows = uvs.where(in_range(start, end)).join(category_labels(categories, level), "video_key")
    return _usage(rows, ["topic"], users=True)


def user_category_usage(uvs: DataFrame, categories: DataFrame, start: str, end: str, level: str = "top") -> DataFrame:
    """The same per user; a missing second category counts as the top one."""
    rows = uvs.where(in_range(start, end)).join(category_labels(categories, level, "top"), "video_key")
    return _usage(rows, ["user", "topic"], users=False)


def user_category_pivot(usage: DataFrame, names: dict[str, str]) -> DataFrame:
    """Four columns per named category; ``names`` maps a column prefix to a category."""
    return usage.groupBy("user").agg(*[
        F.coalesce(F.sum(F.when(F.col("topic") == topic, F.col(m))), F.lit(0)).alias(f"{prefix}_{m}")
        for prefix, topic in names.items() for m in MEASURES])


def user_category_map(usage: DataFrame) -> DataFrame:
    """Per user a JSON object from normalised category to its measures as text.

    The list per user is as long as the catalogue has categories.
    """
    key = F.replace(F.lower("topic"), F.lit(" "), F.lit("_"))
    values = F.array(*[F.col(m).cast("string") for m in MEASURES])
    entries = usage.groupBy("user", key.alias("key")).agg(F.max(values).alias("value"))
    return entries.groupBy("user").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value"))))).alias("category_json"))


def engagement_dataset(visits: DataFrame, condensed: DataFrame, categories: DataFrame) -> DataFrame:
    """Visits, activity totals and category columns of each known user, typed registered or phantom."""
    kind = F.when(F.col("registered"), "registered").when(~F.col("registered"), "phantom")
    return visits.where(F.col("registered").isNotNull()).withColumn("type", kind).drop("registered").join(
        condensed, "user", "left").join(categories, "user", "left")


def month_over_month_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Registered users of the first month beside what they did in the second, columns a_* and b_*."""
    a = first.where("type = 'registered'").drop("type")
    b = second.where("type = 'registered'").drop("type")
    left = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns])
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    return left.join(right, left["a_user"] == right["b_user"], "left")


def segment_view(wide: DataFrame, segment: Sequence[str], metric: str) -> DataFrame:
    """One metric's columns of a segment's groups by week.  Except for 'users' two constant rows follow,
    which the chart reads as axis settings."""
    out = wide.select("week_date", *[F.col(f"{g}_{metric}").cast("double").alias(g) for g in segment])
    if metric == "users":
        return out
    marks = wide.sparkSession.createDataFrame(
        [(name, *[0.0] * len(segment)) for name in ("YAxis", "Cumulative")], out.schema)
    return out.unionByName(marks)
