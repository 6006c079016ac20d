"""Activity and content summaries: what users watched, solved, said and earned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions.columns import any_true, bucket_end_anchored, clamp, count_if, explode_present, month_of
from lectern.functions.days import to_date
from lectern.session import cut_lineage, tasks_for

WATCH_CAP = 1800
SOLVE_CAP = 600
ACTIVE_WINDOW = 28

CATEGORIES = ("all", "registered", "phantom")

ACTIVITY_COUNTS = (
    "feedback_items", "videos_started", "videos_completed", "videos_seconds",
    "exercises_started", "exercises_completed", "exercises_problems_done", "exercises_seconds",
)


def in_range(start: str, end: str, dt: str = "dt") -> Column:
    return (F.col(dt) >= to_date(start)) & (F.col(dt) < to_date(end))


def user_video_summary(video_log: DataFrame, day: str | None = None) -> DataFrame:
    """Per user, video and day: clamped seconds and whether the video was finished."""
    log = video_log if day is None else video_log.where(F.col("dt") == to_date(day))
    return log.groupBy("user", F.col("video").alias("video_key"), "video_title", "dt").agg(
        F.sum(clamp("seconds_watched", 0, WATCH_CAP)).alias("num_seconds"),
        any_true(F.col("is_video_completed")).alias("completed"),
    )


def user_exercise_summary(problem_log: DataFrame, day: str | None = None) -> DataFrame:
    """Per user, exercise and day: clamped time, right and wrong answers, proficiency earned."""
    log = problem_log if day is None else problem_log.where(F.col("dt") == to_date(day))
    return log.groupBy("user", "exercise", "dt").agg(
        F.sum(clamp("time_taken", 0, SOLVE_CAP)).alias("time_spent"),
        count_if(F.col("correct")).alias("num_correct"),
        count_if(~F.col("correct")).alias("num_wrong"),
        any_true(F.col("earned_proficiency")).alias("proficient"),
    )


def user_feedback_summary(feedback: DataFrame, day: str | None = None) -> DataFrame:
    """Per user, first target and day of posting: items, questions and answers."""
    items = feedback.select(
        F.col("author").alias("user"),
        F.get("targets", F.lit(0)).alias("video_key"),
        F.get("types", F.lit(0)).alias("kind"),
        F.to_date(F.timestamp_seconds("date")).alias("dt"),
    )
    if day is not None:
        items = items.where(F.col("dt") == to_date(day))
    return items.groupBy("user", "video_key", "dt").agg(
        F.count(F.lit(1)).alias("record_cnt"),
        count_if(F.col("kind") == "question").alias("question_cnt"),
        count_if(F.col("kind") == "answer").alias("answer_cnt"),
    )


def user_daily_activity(
    feedback: DataFrame, videos: DataFrame, exercises: DataFrame, users: DataFrame, start: str, end: str
) -> DataFrame:
    """Per user and day, the sum of four kinds of facts; a registration alone makes a day."""
    parts = [
        feedback.where(in_range(start, end)).select("user", "dt", F.col("record_cnt").alias("feedback_items")),
        videos.where(in_range(start, end)).select(
            "user", "dt", F.lit(1).alias("videos_started"),
            F.col("completed").cast("int").alias("videos_completed"), F.col("num_seconds").alias("videos_seconds")),
        exercises.where(in_range(start, end)).select(
            "user", "dt", F.lit(1).alias("exercises_started"),
            F.col("proficient").cast("int").alias("exercises_completed"),
            (F.col("num_correct") + F.col("num_wrong")).alias("exercises_problems_done"),
            F.col("time_spent").alias("exercises_seconds")),
        users.where(in_range(start, end, "joined")).select(
            "user", F.col("joined").alias("dt"), F.lit(True).alias("joined")),
    ]
    facts = parts[0]
    for part in parts[1:]:
        facts = facts.unionByName(part, allowMissingColumns=True)
    return facts.groupBy("user", "dt").agg(
        any_true(F.col("joined")).alias("joined"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ACTIVITY_COUNTS],
    )


def company_metrics(
    activity: DataFrame, users: DataFrame, start: str, end: str, long_days: int = 28, min_days: int = 4
) -> DataFrame:
    """Per month: registrations, users active long after joining, users active on many days."""
    members = users.where("registered").select("user", "joined")
    days = (
        activity.select("user", "dt").unionByName(members.select("user", F.col("joined").alias("dt")))
        .where(in_range(start, end)).distinct()
    )
    by_month = days.groupBy("user", month_of(F.col("dt")).alias("activity_month")).agg(
        F.max("dt").alias("last_day"), F.count(F.lit(1)).alias("active_days"))
    return by_month.join(members, "user").groupBy("activity_month").agg(
        count_if(month_of(F.col("joined")) == F.col("activity_month")).alias("registrations_this_month"),
        count_if(F.datediff("last_day", "joined") >= long_days).alias("long_term_users_active_this_month"),
        count_if(F.col("active_days") >= min_days).alias("highly_engaged_users_active_this_month"),
    )


def user_growth_daily(
    activity: DataFrame, start: str, end: str, users: DataFrame | None = None, window: int = ACTIVE_WINDOW
) -> DataFrame:
    """Joins, deactivations and reactivations per day.

    A user is deactivated ``window`` days after an active day that no other follows in time, and
    reactivated on the next one.  Days are made distinct first, so a user has at most one row per day.
    """
    days = activity.where("user IS NOT NULL").groupBy("user", "dt").agg(any_true(F.col("joined")).alias("joined"))
    if users is not None:
        days = days.join(users.where("registered").select("user"), "user", "left_semi")
    along = Window.partitionBy("user").orderBy("dt")
    gaps = days.select(
        "dt", "joined", F.lag("dt").over(along).alias("prev"),
        F.coalesce(F.lead("dt").over(along), to_date(end)).alias("next"))
    far = F.datediff("next", "dt") > window
    back = F.datediff("dt", "prev") > window
    changes = explode_present(gaps, [
        F.when(F.col("joined"), F.struct("dt", F.lit("joins").alias("series"))),
        F.when(back, F.struct("dt", F.lit("reactivations").alias("series"))),
        F.when(far, F.struct(F.date_add("dt", window).alias("dt"), F.lit("deactivations").alias("series"))),
    ], "c").select("c.dt", "c.series")
    return changes.where(in_range(start, end)).groupBy("dt", "series").agg(F.count(F.lit(1)).alias("value"))


def user_growth_rollup(daily: DataFrame, end: str, days: int) -> DataFrame:
    """Daily series summed into buckets of 7 or 28 days counted back from ``end``."""
    label = bucket_end_anchored(F.col("dt"), to_date(end), days)
    return daily.groupBy(label.alias("dt"), "series").agg(F.sum("value").alias("value"))


def with_categories(usage: DataFrame, users: DataFrame) -> DataFrame:
    """Tag usage with each user category it counts for; users without a record count for 'all' only."""
    joined = usage.join(users.select("user", "registered"), "user", "left")
    tags = [F.lit("all"), F.when(F.col("registered"), "registered").when(~F.col("registered"), "phantom")]
    return explode_present(joined, tags, "user_category").drop("registered")


def daily_video_stats(uvs: DataFrame, videos: DataFrame, users: DataFrame, day: str | None = None) -> DataFrame:
    """Views, completions and seconds per day and user category, per video and in total.

    The total counts users; a user has completed when they finished at least one video.
    """
    usage = uvs if day is None else uvs.where(F.col("dt") == to_date(day))
    tagged = with_categories(usage.select("user", "video_key", "dt", "num_seconds", "completed"), users)
    per_key = tagged.groupBy("dt", "user_category", "video_key").agg(
        F.count(F.lit(1)).alias("watched"), count_if(F.col("completed")).alias("completed"),
        F.sum("num_seconds").alias("seconds_watched"))
    by_video = (
        per_key.join(videos.select(F.col("key").alias("video_key"), "title", "youtube_id"), "video_key")
        .groupBy("dt", "user_category", "title", "youtube_id")
        .agg(*[F.sum(c).alias(c) for c in ("watched", "completed", "seconds_watched")])
        .withColumn("aggregation", F.lit("video"))
    )
    per_user = tagged.groupBy("dt", "user_category", "user").agg(
        F.max(F.col("completed").cast("int")).alias("completed"), F.sum("num_seconds").alias("seconds"))
    total = per_user.groupBy("dt", "user_category").agg(
        F.count(F.lit(1)).alias("watched"), F.sum("completed").alias("completed"),
        F.sum("seconds").alias("seconds_watched"),
    ).withColumns({"title": F.lit("Total"), "youtube_id": F.lit("Total"), "aggregation": F.lit("total")})
    return by_video.unionByName(total)


def distinct_usage(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Users, user-days, completions and seconds per key, by one chain of partial aggregates.

    Rows fold to (key, user, day), then (key, user), then key: the same as two distinct counts
    without the row expansion Spark uses for several distinct aggregates.
    """
    rows = cut_lineage(rows.select(*keys, "user", "dt", "completed", "num_seconds"))
    tasks = tasks_for(rows)
    per_day = rows.repartition(tasks, *keys, "user", "dt").groupBy(*keys, "user", "dt").agg(
        count_if(F.col("completed")).alias("completed"), F.sum("num_seconds").alias("seconds_watched"))
    per_user = per_day.repartition(tasks, *keys, "user").groupBy(*keys, "user").agg(
        F.count(F.lit(1)).alias("visits"), F.sum("completed").alias("completed"),
        F.sum("seconds_watched").alias("seconds_watched"))
    return per_user.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("users"), *[F.sum(c).alias(c) for c in ("visits", "completed", "seconds_watched")])


def video_stats(
    uvs: DataFrame, videos: DataFrame, categories: DataFrame, users: DataFrame, duration: str, start: str, end: str
) -> DataFrame:
    """Usage by user category at four levels: video, top topic, second topic, total.

    ``start == end`` means that one day.  All levels come from one pass: each usage row is given
    the (level, label) pairs it belongs to.
    """
    one_day = (F.col("dt") == to_date(start)) | ((F.col("dt") > to_date(start)) & (F.col("dt") < to_date(end)))
    usage = uvs.where(one_day).select("user", "video_key", "dt", "num_seconds", "completed")

    def label(level: str, title: Column, code: Column) -> Column:
        return F.struct(F.lit(level).alias("aggregation"), title.alias("title"), code.alias("youtube_id"))

    na = F.lit("N/M")
    tops = categories.select(F.col("vid_key").alias("key"), label("top_topic", F.col("top_category"), na).alias("l"))
    seconds = categories.select(
        F.col("vid_key").alias("key"),
        label("second_topic", F.coalesce("second_category", F.lit("NONE")), na).alias("l"))
    titles = videos.select("key", label("video", F.col("title"), F.col("youtube_id")).alias("l"))
    labels = titles.unionByName(tops.distinct()).unionByName(seconds.distinct()).select(F.col("key").alias("video_key"), "l.*")

    tagged = with_categories(usage, users)
    keys = ["user_category", "aggregation", "title", "youtube_id"]
    by_label = distinct_usage(tagged.join(labels, "video_key"), keys)
    per_user = tagged.groupBy("user_category", "user", "dt").agg(
        F.max(F.col("completed").cast("int")).alias("completed"), F.sum("num_seconds").alias("s"),
    ).groupBy("user_category", "user").agg(
        F.count(F.lit(1)).alias("visits"), F.max("completed").alias("completed"), F.sum("s").alias("s"))
    total = per_user.groupBy("user_category").agg(
        F.count(F.lit(1)).alias("users"), F.sum("visits").alias("visits"),
        F.sum("completed").alias("completed"), F.sum("s").alias("seconds_watched"),
    ).withColumns({"aggregation": F.lit("total"), "title": F.lit("Total"), "youtube_id": F.lit("Total")})
    return by_label.unionByName(total).withColumns({"duration": F.lit(duration), "dt": to_date(start)})


def topic_usage(uvs: DataFrame, video_topic: DataFrame, users: DataFrame, start: str, end: str) -> DataFrame:
    """Usage per topic title and registration state, and a 'total' topic over all videos."""
    usage = uvs.where(in_range(start, end)).select("user", "video_key", "dt", "num_seconds", "completed")
    known = usage.join(users.select("user", "registered"), "user", "left")
    topics = video_topic.select(F.col("vid_key").alias("video_key"), F.col("topic_title").alias("topic"))
    rows = known.join(topics, "video_key").drop("video_key").unionByName(
        known.drop("video_key").withColumn("topic", F.lit("total")))
    return distinct_usage(rows, ["topic", "registered"]).withColumnRenamed("seconds_watched", "seconds")


def visit_distribution(uvs: DataFrame, users: DataFrame, start: str, end: str) -> DataFrame:
    """Histogram of users by registration state and number of active days in the range."""
    usage = uvs.where(in_range(start, end))
    days = usage.groupBy("user", "dt").agg(
        count_if(F.col("completed")).alias("completed"), F.sum("num_seconds").alias("seconds"))
    per_user = days.groupBy("user").agg(
        F.count(F.lit(1)).alias("visits"), F.sum("completed").alias("completed"), F.sum("seconds").alias("seconds"))
    videos = usage.select("user", "video_key").distinct().groupBy("user").agg(F.count(F.lit(1)).alias("videos"))
    return (
        per_user.join(videos, "user").join(users.select("user", "registered"), "user", "left")
        .groupBy("registered", "visits")
        .agg(F.count(F.lit(1)).alias("num_users"), *[F.sum(c).alias(c) for c in ("videos", "completed", "seconds")])
    )


def exercise_summary(problem_log: DataFrame, start: str, end: str, cap: int = SOLVE_CAP) -> DataFrame:
    """Answers and clamped time per exercise, sub-type and day.

    An exercise whose seed is not an integer is static; its seed then names the sub-type.
    """
    static = F.col("seed").try_cast("int").isNull()
    return (
        problem_log.where(in_range(start, end))
        .withColumn("is_static", static)
        .withColumn("sub_exercise_type", F.when(F.col("is_static"), F.col("seed")).otherwise(F.col("problem_type")))
        .groupBy("exercise", "sub_exercise_type", "is_static", "dt")
        .agg(
            count_if(F.col("correct")).alias("correct_attempts"),
            count_if(~F.col("correct")).alias("wrong_attempts"),
            F.sum(clamp("time_taken", 0, cap)).alias("time_taken"),
        )
    )


def exercise_proficiency(problem_log: DataFrame, end: str, days: int = 180) -> DataFrame:
    """Per exercise, users who began it in the last ``days`` days and those of them ever proficient."""
    per_user = problem_log.groupBy("exercise", "user").agg(
        F.min("dt").alias("dt"), F.max(F.col("earned_proficiency").cast("int")).alias("proficient"))
    recent = (F.col("dt") >= F.date_sub(to_date(end), days)) & (F.col("dt") < to_date(end))
    return per_user.where(recent).groupBy("exercise").agg(
        F.coalesce(F.sum("proficient"), F.lit(0)).alias("earned_proficiency"),
        F.count(F.lit(1)).alias("total_users"))


def badge_summary(badges: DataFrame, start: str, end: str, by_context: bool = False) -> DataFrame:
    """Awards and points per badge and day, and the users whose first award of it fell on that day."""
    keys = ["badge_name"]
    if by_context:
        badges = badges.withColumn("context_name", F.coalesce("target_context_name", F.lit("None")))
        keys.append("context_name")
    totals = badges.where(in_range(start, end)).groupBy(*keys, "dt").agg(
        F.count(F.lit(1)).alias("total_awarded"), F.sum("points_earned").alias("total_points_earned"))
    firsts = (
        badges.groupBy(*keys, "user").agg(F.min("dt").alias("dt")).where(in_range(start, end))
        .groupBy(*keys, "dt").agg(F.count(F.lit(1)).alias("unique_awarded")))
    return totals.join(firsts, [*keys, "dt"], "left")


# The modes of the daily exercise report.
TOPIC_MODES = ("true", "false")
USER_TOPIC_MODES = ("none", "some", "majority", "all")
USER_MODES = ("unknown", "old", "new", "coached", "uncoached", "heavy", "light", "registered", "phantom")
EVERYTHING = "everything"

EXERCISE_STATS = (
    "users", "user_exercises", "problems", "correct", "profs", "prof_prob_count", "first_attempts",
    "hint_probs", "time_taken",
)


def _user_modes(day: str) -> Column:
    """Names of the user modes that hold for a row of the (left-joined) user table."""
    known = F.col("known").isNotNull()
    recent = F.col("joined") >= F.date_sub(to_date(day), 14)
    coached = F.coalesce(F.size("coaches") > 0, F.lit(False))
    done = F.col("proficient_exercises")
    done_count = F.size(F.split(done, "\t"))
    readable = done.isNull() | ~F.startswith(done, F.lit("["))
    tests = {
        "unknown": ~known,
        "old": known & ~recent, "new": known & recent,
        "coached": known & coached, "uncoached": known & ~coached,
        "heavy": known & done.isNotNull() & readable & (done_count > 10),
        "light": known & (done.isNull() | (readable & (done_count <= 10))),
        "registered": known & ~F.col("user_id").contains("nouserid"),
        "phantom": known & F.col("user_id").contains("nouserid"),
    }
    return F.array_compact(F.array(*[F.when(test, F.lit(mode)) for mode, test in tests.items()]))


def daily_exercise_stats(problem_log: DataFrame, users: DataFrame, day: str) -> DataFrame:
    """One day's problem statistics per exercise and 'ALL', for every pair of modes.

    Users with the same set of modes are summed before the pairs are formed, so the pairs multiply
    a handful of mode sets instead of every user.
    """
    log = problem_log.where(F.col("dt") == to_date(day))
    base = log.groupBy("user", "exercise", "topic_mode").agg(
        F.count(F.lit(1)).alias("problems"),
        count_if(F.col("correct")).alias("correct"),
        count_if(F.col("earned_proficiency")).alias("profs"),
        F.coalesce(F.sum(F.when(F.col("earned_proficiency"), F.col("problem_number"))), F.lit(0)).alias("prof_prob_count"),
        count_if(F.col("problem_number") == 1).alias("first_attempts"),
        count_if(F.col("hint_used")).alias("hint_probs"),
        F.sum(clamp("time_taken", 0, SOLVE_CAP)).alias("time_taken"),
    )
    counts = ("problems", "correct", "profs", "prof_prob_count", "first_attempts", "hint_probs", "time_taken")
    views = [F.lit("any"), F.col("topic_mode").cast("string")]
    per_exercise = explode_present(base, views, "view").groupBy("user", "view", "exercise").agg(
        *[F.sum(c).alias(c) for c in counts])
    per_name = (
        per_exercise.withColumn("exercise", F.explode(F.array(F.col("exercise"), F.lit("ALL"))))
        .groupBy("user", "view", "exercise")
        .agg(F.lit(1).alias("users"), F.count(F.lit(1)).alias("user_exercises"), *[F.sum(c).alias(c) for c in counts]))

    topics = base.groupBy("user").agg(
        F.sum("problems").alias("n"), F.sum(F.when(F.col("topic_mode"), F.col("problems")).when(
            ~F.col("topic_mode"), 0)).alias("t"))
    topic_modes = F.array_compact(F.array(
        F.when(F.col("t") == 0, "none"), F.when(F.col("t") > 0, "some"),
        F.when(F.col("t") / F.col("n") > 0.5, "majority"), F.when(F.col("t") == F.col("n"), "all")))
    info = users.select(
        "user", "user_id", "joined", "coaches", "proficient_exercises", F.lit(True).alias("known"))
    modes = topics.join(info, "user", "left").select(
        "user", _user_modes(day).alias("user_modes"), topic_modes.alias("topic_modes"))

    by_set = per_name.join(modes, "user").groupBy("view", "exercise", "user_modes", "topic_modes").agg(
        *[F.sum(c).alias(c) for c in EXERCISE_STATS])
    everything = F.array(F.lit(EVERYTHING))
    subs = F.when(F.col("view") == "any", F.concat(everything, "topic_modes", "user_modes")).otherwise(F.array("view"))
    return (
        by_set.withColumn("sub_mode", F.explode(subs))
        .withColumn("super_mode", F.explode(F.concat(everything, F.col("user_modes"))))
        .groupBy("super_mode", "sub_mode", "exercise").agg(*[F.sum(c).alias(c) for c in EXERCISE_STATS]))


def normalised_stat(stats: DataFrame, stat: str, norm: str) -> DataFrame:
    """One statistic divided by another, per day."""
    return stats.groupBy("dt").agg(F.sum(stat).alias("s"), F.sum(norm).alias("n")).select(
        "dt", (F.col("s").cast("double") / F.when(F.col("n") != 0, F.col("n"))).alias("value"))


def net_growth(growth: DataFrame) -> DataFrame:
    """Growth series side by side per date; net = joins - deactivations + reactivations."""
    series = ("joins", "deactivations", "reactivations")
    wide = growth.groupBy("dt").agg(
        *[F.coalesce(F.sum(F.when(F.col("series") == s, F.col("value"))), F.lit(0)).alias(s) for s in series])
    return wide.withColumn("net", F.col("joins") - F.col("deactivations") + F.col("reactivations"))
