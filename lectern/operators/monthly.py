"""Monthly counts, cohorts and ad-hoc tallies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lectern.functions.columns import count_if, month_of

# Fixed values: (distinct videos, distinct exercises) a user must reach within the month.
THRESHOLDS = ((0, 0), (1, 0), (5, 0), (10, 0), (25, 0), (0, 1), (0, 5), (0, 10), (0, 25), (1, 1), (5, 5))
CUTOFFS = (1, 3, 5, 10, 15, 30, 50, 75, 100, 150, 200)


def monthly_threshold_users(videos: DataFrame, exercises: DataFrame, grid: Sequence[tuple[int, int]] = THRESHOLDS) -> DataFrame:
    """Users per month who reach both thresholds of each grid entry; inputs hold one row (user, dt) per item."""
    rows = videos.select("user", "dt", F.lit(1).alias("v"), F.lit(0).alias("e")).unionByName(
        exercises.select("user", "dt", F.lit(0).alias("v"), F.lit(1).alias("e")))
    users = rows.groupBy("user", month_of(F.col("dt")).alias("month")).agg(F.sum("v").alias("v"), F.sum("e").alias("e"))
    cells = users.groupBy("month").agg(*[
        count_if((F.col("v") >= v) & (F.col("e") >= e)).alias(f"c{i}") for i, (v, e) in enumerate(grid)])
    tags = F.array(*[F.struct(F.lit(f"min_vid={v}; min_ex={e}").alias("tag"), F.col(f"c{i}").alias("value")) for i, (v, e) in enumerate(grid)])
    return cells.select("month", F.explode(tags).alias("t")).select("t.tag", "month", "t.value").where("value > 0")


def monthly_badge_awards(badges: DataFrame) -> DataFrame:
    """Distinct users per badge and month."""
    return badges.select(F.col("badge_name").alias("tag"), month_of(F.col("dt")).alias("month"), "user").distinct().groupBy(
        "tag", "month").agg(F.count(F.lit(1)).alias("value"))


def monthly_accounts(users: DataFrame) -> DataFrame:
    """New accounts per month, phantom and with e-mail."""
    kind = F.when(F.col("user_id").contains("nouserid"), "phantom").otherwise("email")
    return users.where("user_id IS NOT NULL").groupBy(
        F.concat(F.lit("registration("), kind, F.lit(")")).alias("tag"), month_of(F.col("joined")).alias("month"),
    ).agg(F.count(F.lit(1)).alias("value"))


def retention_cohorts(
    users: DataFrame, visits: DataFrame, sizes: DataFrame | None = None, min_group: int | None = None, max_group: int | None = None
) -> DataFrame:
    """Registered users and their distinct visit days by month of joining and month of visit.

    The day of joining is a visit.  ``sizes`` (user, max_cohort_size) limits users to classes within the
    bounds; a user without a class passes an upper bound only.
    """
    chosen = users.where("registered").select("user", "joined")
    if min_group is not None or max_group is not None:
        chosen = chosen.join(sizes.select("user", "max_cohort_size"), "user", "left")
        if min_group is not None:
            chosen = chosen.where(F.col("max_cohort_size") >= min_group)
        if max_group is not None:
            chosen = chosen.where(F.col("max_cohort_size").isNull() | (F.col("max_cohort_size") <= max_group))
        chosen = chosen.select("user", "joined")
    days = visits.select("user", "dt").unionByName(chosen.select("user", F.col("joined").alias("dt"))).distinct()
    monthly = days.groupBy("user", month_of(F.col("dt")).alias("month")).agg(F.count(F.lit(1)).alias("visits"))
    return monthly.join(chosen, "user").groupBy(month_of(F.col("joined")).alias("cohort"), "month").agg(
        F.count(F.lit(1)).alias("users"), F.sum("visits").alias("visits"))


def registration_types(users: DataFrame, identity: str = "current_user") -> DataFrame:
    """Users by the kind of account their identity shows; the first mark found decides."""
    who = F.col(identity)
    kind = (F.when(who.contains("facebookid"), "facebook").when(who.contains("nouserid"), "phantom")
            .when(who.contains("@"), "email").otherwise("google"))
    return users.groupBy(kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))


def cohort_sizes(pairs: DataFrame) -> DataFrame:
    """Coaches and the number of their distinct students."""
    return pairs.where("user IS NOT NULL AND cast(user as string) <> ''").select("coach", "user").distinct().groupBy("coach").agg(
        F.count(F.lit(1)).alias("num_students"))


def max_cohort_size(pairs: DataFrame) -> DataFrame:
    """Size of the largest class each user is in."""
    distinct = pairs.where("user IS NOT NULL AND cast(user as string) <> ''").select("coach", "user").distinct()
    return distinct.join(cohort_sizes(pairs), "coach").groupBy("user").agg(F.max("num_students").alias("max_cohort_size"))


def count_cohorts(pairs: DataFrame, min_size: int = 10) -> DataFrame:
    return cohort_sizes(pairs).where(F.col("num_students") >= min_size).agg(F.count(F.lit(1)).alias("cohorts"))


def stats_per_user(videos: DataFrame, exercises: DataFrame) -> DataFrame:
    """Items started and completed per user; inputs hold one row (user, completed) per item."""
    zero = F.lit(0)
    rows = videos.select("user", F.lit(1).alias("vids_started"), F.col("completed").cast("int").alias("vids_completed"),
                         zero.alias("exs_started"), zero.alias("exs_completed")).unionByName(
        exercises.select("user", zero.alias("vids_started"), zero.alias("vids_completed"), F.lit(1).alias("exs_started"),
                         F.col("completed").cast("int").alias("exs_completed")))
    return rows.groupBy("user").agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in rows.columns if c != "user"])


def users_over_cutoffs(videos: DataFrame, exercises: DataFrame, cutoffs: Sequence[int] = CUTOFFS) -> DataFrame:
    """For each cut-off, users with more items started or completed than it."""
    users = stats_per_user(videos, exercises)
    names = [c for c in users.columns if c != "user"]
    counts = users.agg(*[count_if(F.col(n) > c).alias(f"{n}_{c}") for c in cutoffs for n in names])
    rows = F.array(*[F.struct(F.lit(c).alias("cutoff"), *[F.col(f"{n}_{c}").alias(n) for n in names]) for c in cutoffs])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def daily_problem_count(problem_log: DataFrame) -> DataFrame:
    """Problems per day and exercise, and for all exercises."""
    cells = problem_log.groupBy("dt", "exercise").agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumn("exercise", F.explode(F.array("exercise", F.lit("ALL")))).groupBy("dt", "exercise").agg(F.sum("n").alias("n"))
