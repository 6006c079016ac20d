"""Dashboard queries over the summary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions.days import to_date
from lectern.operators.activity import CATEGORIES, in_range


def two_places(part: Column, whole: Column) -> Column:
    """``part / whole`` rounded half up to two places."""
    return F.floor(part.cast("double") * 100 / F.when(whole != 0, whole) + 0.5) / 100


def _shares(rows: DataFrame) -> DataFrame:
    """Measures of each title side by side for the user categories."""
    def of(category: str, measure: str) -> Column:
        return F.max(F.when(F.col("user_category") == category, F.col(measure)))

    cells = []
    for c in CATEGORIES:
        cells += [
            of(c, "users").alias(f"watched_{c}"), of(c, "visits").alias(f"visits_{c}"), of(c, "completed").alias(f"completed_{c}"),
            two_places(of(c, "seconds_watched"), F.lit(3600)).alias(f"hours_{c}"),
            two_places(of(c, "visits"), of(c, "users")).alias(f"visits_per_user_{c}")]
    return rows.groupBy("title").agg(*cells)


def topic_share(video_stats: DataFrame, dt: str, duration: str, level: str = "top_topic") -> DataFrame:
    """Topics of a level and the total, each measure also as a share of the total's; 'NONE' is left out."""
    rows = video_stats.where((F.col("dt") == to_date(dt)) & (F.col("duration") == duration))
    total = _shares(rows.where("aggregation = 'total'")).withColumn("whole", F.lit(True))
    topics = _shares(rows.where(F.col("aggregation") == level)).where("title <> 'NONE'").withColumn("whole", F.lit(False)).unionByName(total)
    names = [c for c in topics.columns if c not in ("title", "whole")]
    everything = Window.partitionBy(F.lit(0))  # one row per topic
    of = lambda c: F.max(F.when(F.col("whole"), F.col(c))).over(everything)
    share = lambda c: F.when(of(c) != 0, F.col(c) / of(c)).otherwise(F.lit(0.0))
    return topics.select("title", *names, *[share(c).alias(f"{c}_pct") for c in names])


def top_videos(video_stats: DataFrame, dt: str, duration: str, k: int = 200, category: str = "all") -> DataFrame:
    """The k videos with the most watching time."""
    rows = video_stats.where(
        (F.col("dt") == to_date(dt)) & (F.col("duration") == duration) & (F.col("aggregation") == "video") & (F.col("user_category") == category))
    best = rows.orderBy(F.col("seconds_watched").desc(), F.col("title").asc(), F.col("youtube_id").asc()).limit(k)
    return best.select("title", "youtube_id", "users", "visits", "completed", "seconds_watched",
                       two_places(F.col("seconds_watched"), F.lit(3600)).alias("hours"))


def title_series(stats: DataFrame, title: str, duration: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of one title (the total when empty) in a date range, by date."""
    rows = stats.where(F.col("title") == (title or "Total"))
    if duration is not None:
        rows = rows.where(F.col("duration") == duration)
    if start is not None:
        rows = rows.where(F.col("dt") >= to_date(start))
    if end is not None:
        rows = rows.where(F.col("dt") < to_date(end))
    return rows.orderBy("dt", "user_category")


def recent_minutes(stats: DataFrame, days: int = 28) -> DataFrame:
    """Minutes watched by all users on the newest ``days`` days, oldest first."""
    rows = stats.where("title = 'Total' AND user_category = 'all'").orderBy(F.col("dt").desc()).limit(days)
    hours = two_places(F.col("seconds_watched"), F.lit(3600))
    return rows.select("dt", F.floor(F.round(hours * 60, 6)).alias("minutes")).orderBy("dt")


def exercise_drilldown(
    summary: DataFrame, proficiency: DataFrame | None = None, exercise: str | None = None, sub_type: str | None = None,
    start: str | None = None, end: str | None = None,
) -> DataFrame:
    """Attempts by exercise, or by sub-type of one: shares right and wrong, mean time, share proficient.

    Sub-types below one percent of the exercise's attempts are not shown.
    """
    rows = summary
    if start is not None and end is not None:
        rows = rows.where(in_range(start, end))
    key = "exercise" if exercise is None else "sub_exercise_type"
    if exercise is not None:
        rows = rows.where(F.col("exercise") == exercise)
        if sub_type is not None:
            rows = rows.where(F.col("sub_exercise_type") == sub_type)
    sums = rows.groupBy(F.col(key).alias("name")).agg(
        F.sum("correct_attempts").alias("c"), F.sum("wrong_attempts").alias("w"), F.sum("time_taken").alias("t"))
    total = F.col("c") + F.col("w")
    sums = sums.withColumn("total", total)
    if exercise is not None and sub_type is None:
        sums = sums.where(F.col("total") > sums.agg(F.sum("total")).scalar() / 100)
    out = sums.select(
        "name", "total", (F.col("c") * 100.0 / F.col("total")).alias("pct_correct"), (F.col("w") * 100.0 / F.col("total")).alias("pct_wrong"),
        F.floor(F.col("t") / F.col("total") + 0.5).alias("avg_time"))
    if proficiency is None or exercise is not None:
        return out
    return out.join(proficiency.select(
        F.col("exercise").alias("name"), (F.col("earned_proficiency") * 100.0 / F.col("total_users")).alias("pct_proficient")), "name", "left")


def badge_rollups(summary: DataFrame, meta: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Awards per badge over the range, with its rank and the sum within its category and its context for
    both measures.  One row per badge from here on."""
    rows = summary if start is None else summary.where(in_range(start, end))
    badges = rows.groupBy("badge_name").agg(
        F.sum("total_awarded").alias("total_awarded"), F.coalesce(F.sum("unique_awarded"), F.lit(0)).alias("unique_awarded"))
    out = badges.join(meta.select("badge_name", "category", "context"), "badge_name")
    cells = []
    for group in ("category", "context"):
        for measure in ("total_awarded", "unique_awarded"):
            order = Window.partitionBy(group).orderBy(F.col(measure).desc(), F.col("badge_name").asc())
            cells.append(F.row_number().over(order).alias(f"{group}_{measure}_order"))
            cells.append(F.sum(measure).over(Window.partitionBy(group)).alias(f"{group}_{measure}_total"))
    return out.select("*", *cells)


def context_shares(summary: DataFrame, badge: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One badge by context, with each context's share of its awards in percent."""
    rows = summary if start is None else summary.where(in_range(start, end))
    cells = rows.where(F.col("badge_name") == badge).groupBy(
        F.when(F.coalesce("context_name", F.lit("")).isin("", "\\N"), "None").otherwise(F.col("context_name")).alias("context_name"),
    ).agg(F.sum("total_awarded").alias("total_awarded"), F.coalesce(F.sum("unique_awarded"), F.lit(0)).alias("unique_awarded"))
    whole = lambda c: F.sum(c).over(Window.partitionBy(F.lit(0)))  # noqa: E731  (one row per context)
    pct = lambda c: F.col(c) * 100.0 / F.when(whole(c) != 0, whole(c))
    return cells.select(
        "context_name", "total_awarded", "unique_awarded", pct("total_awarded").alias("total_percentage"),
        pct("unique_awarded").alias("unique_percentage"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The values a picker offers."""
    return df.select(F.col(col).alias("value")).distinct()


def goal_series(metrics: DataFrame, series: Sequence[str] = (
        "long_term_users_active_this_month", "highly_engaged_users_active_this_month", "registrations_this_month")) -> DataFrame:
    """Monthly metrics as series, without the last month, which is not complete."""
    last = metrics.agg(F.max("activity_month").alias("activity_month"))  # a single row
    months = metrics.join(F.broadcast(last), "activity_month", "left_anti")
    cells = F.array(*[F.struct(F.lit(s).alias("series"), F.col(s).alias("value")) for s in series])
    return months.select(F.col("activity_month").alias("month"), F.explode(cells).alias("c")).select("c.series", "month", "c.value")


def value_days_ago(df: DataFrame, today: str, value: str, default: float, days: int = 7) -> DataFrame:
    """The value of the day ``days`` before ``today``, or the default."""
    rows = df.where(F.col("dt") == F.date_sub(to_date(today), days))
    return rows.agg(F.coalesce(F.max(value).cast("double"), F.lit(float(default))).alias("value"))
