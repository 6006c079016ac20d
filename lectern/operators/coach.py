"""Coaches, teachers and students: classes, their growth and their activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lectern.functions.columns import any_true, count_if, explode_present, is_registered
from lectern.functions.days import daily_levels, edge, to_date
from lectern.functions.ordered import top_k
from lectern.operators.activity import ACTIVITY_COUNTS, in_range
from lectern.operators.geo import ip_geolocate
from lectern.session import cut_lineage, tasks_for

CLASS_SIZE = 10
WINDOW = 28


def user_coach_mapping(users: DataFrame) -> DataFrame:
    """(user, coach) pairs; a coach is the user itself when it equals the user, e-mail or id."""
    return users.select(
        "user", "user_id", "user_email", *[c for c in ("joined", "identity") if c in users.columns],
        F.explode("coaches").alias("coach"),
    ).withColumn("self_coach", F.coalesce(
        (F.col("coach") == F.col("user").cast("string")) | (F.col("coach") == F.col("user_email"))
        | (F.col("coach") == F.col("user_id")), F.lit(False)))


def coach_summary(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("coach").agg(
        F.count(F.lit(1)).alias("num_students"), any_true(F.col("self_coach")).alias("self_coaching"))


def user_coach_summary(mapping: DataFrame, coaches: DataFrame) -> DataFrame:
    """Per user with another as coach: number of coaches and the largest class."""
    return mapping.where(~F.col("self_coach")).join(coaches, "coach").groupBy("user").agg(
        F.count(F.lit(1)).alias("num_coaches"), F.max("num_students").alias("max_coach_students"))


def userdata_info(users: DataFrame, summary: DataFrame) -> DataFrame:
    """Narrow user table with registration and class flags."""
    largest = F.coalesce("max_coach_students", F.lit(0))
    return users.join(summary, "user", "left").select(
        "user", "user_id", "user_email", "user_nickname", "joined", is_registered(F.col("user_id")).alias("registered"),
        (largest >= 1).alias("is_coached"), (largest >= CLASS_SIZE).alias("is_student"))


def teacher_since(pairs: DataFrame, n: int = CLASS_SIZE) -> DataFrame:
    """Day on which a coach's n-th student other than itself joined."""
    ranked = top_k(
        pairs.where(~F.col("self_coach")).select("coach", "user", "joined_on"), ["coach"],
        [F.col("joined_on").asc(), F.col("user").asc()], n, rank="nth")
    return ranked.where(F.col("nth") == n).select(F.col("coach").alias("teacher"), F.col("joined_on").alias("dt"))


def student_since(pairs: DataFrame, teachers: DataFrame) -> DataFrame:
    """Per (student, teacher): the later of the teacher's first day and the student's joining."""
    return pairs.where(~F.col("self_coach")).join(teachers, pairs["coach"] == teachers["teacher"]).groupBy(
        F.col("user").alias("student"), "teacher").agg(F.greatest(F.min("dt"), F.min("joined_on")).alias("dt"))


def small_coach_since(pairs: DataFrame, n: int = CLASS_SIZE) -> DataFrame:
    """Coaches with fewer than n pairs and their first day."""
    return pairs.groupBy("coach").agg(F.min("joined_on").alias("dt"), F.count(F.lit(1)).alias("n")).where(
        F.col("n") < n).select("coach", "dt")


def small_class_users(pairs: DataFrame, students: DataFrame) -> DataFrame:
    """(user, coach) pairs of the users who have no teacher."""
    return pairs.join(students.select(F.col("student").alias("user")), "user", "left_anti").groupBy("user", "coach").agg(
        F.min("joined_on").alias("dt"))


def cumulative_daily_count(df: DataFrame, end: str, dt: str = "dt") -> DataFrame:
    """Running number of rows per day, from the first day with a row to ``end`` exclusive."""
    edges = df.select(F.lit("count").alias("metric"), F.col(dt).alias("dt"), F.lit(1).alias("d"))
    return daily_levels(edges, ["count"], end)


def active_edges(
    days: DataFrame, keys: Sequence[str], kinds: dict[str, tuple[int, bool]], window: int = WINDOW
) -> DataFrame:
    """When each group begins and ceases to be active, as edges (keys, metric, dt, d).

    ``kinds`` maps a metric to (min_days, late only): the group counts on a day when it had
    ``min_days`` distinct active days among the ``window`` days before.  ``days`` holds distinct
    (keys, dt), and a flag ``late`` that stays set once it is, when a kind asks for it.

    Between one active day and the next the answer changes at most once, and days whose stretches
    touch need no edge between them: a group gives two edges per stretch of activity, where exploding
    each day to its window would give ``window`` rows per day.
    """
    if any(late and k != 1 for k, late in kinds.values()):
        raise ValueError("late kinds count single days")
    along = Window.partitionBy(*keys).orderBy("dt")
    deepest = max(k for k, _ in kinds.values())
    cells = {f"lag{j}": F.lag("dt", j).over(along) for j in range(1, deepest + 1)}
    late = "late" in days.columns
    if late:
        cells["late_before"] = F.lag("late").over(along)
    marked = days.select(*keys, "dt", *(["late"] if late else []), F.lead("dt").over(along).alias("next"), *[c.alias(n) for n, c in cells.items()])
    lag = lambda j: F.col("dt") if j == 0 else F.col(f"lag{j}")
    no = F.lit(False)
    out = []
    for name, (k, late_only) in kinds.items():
        shown = F.col("late") if late_only else F.lit(True)
        before = F.col("lag1").isNotNull() & (F.col("late_before") if late_only else F.lit(True))
        end = F.date_add(lag(k - 1), window)  # last day on which this day's stretch can hold
        opened = shown & F.coalesce(end > F.col("dt"), no)
        running = before & F.coalesce(F.date_add(lag(k), window) >= F.col("dt"), no)
        follows = F.col("next") if k == 1 else lag(k - 2)
        goes_on = F.coalesce((F.col("next") <= end) & (F.date_add(follows, window) > F.col("next")), no)
        last = F.least(end, F.coalesce(F.col("next"), F.lit("9999-01-01").cast("date")))
        out += [F.when(shown & ~before, edge(name, F.col("dt"), 0)), F.when(opened & ~running, edge(name, F.date_add("dt", 1), 1)),
                F.when(opened & ~goes_on, edge(name, F.date_add(last, 1), -1))]
    return explode_present(marked, out, "e").select(*keys, "e.*")


def busy_edges(members: DataFrame, group: str, threshold: int) -> DataFrame:
    """Edges of the groups that have at least ``threshold`` active members, from the members' edges."""
    deltas = members.groupBy(group, "metric", "dt").agg(F.sum("d").alias("d"))
    along = Window.partitionBy(group, "metric").orderBy("dt")
    level = F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0))
    steps = deltas.select(group, "metric", "dt", "d", level.alias("n"), F.lag("dt").over(along).alias("prev"))
    busy, was_busy = F.col("n") >= threshold, F.col("n") - F.col("d") >= threshold
    change = F.when(busy & ~was_busy, 1).when(~busy & was_busy, -1).when(F.col("prev").isNull(), 0)
    return steps.select(group, "metric", "dt", change.alias("d")).where("d IS NOT NULL")


def rolling_active_users(
    activity: DataFrame, end: str, window: int = WINDOW, min_days: int = 1, user: str = "user"
) -> DataFrame:
    """For each day, users active on ``min_days`` distinct days of the ``window`` days before it."""
    days = activity.where(F.col("dt") < to_date(end)).select(user, "dt").distinct()
    return daily_levels(active_edges(days, [user], {"users": (min_days, False)}, window), ["users"], end)


def rolling_active_teachers(
    activity: DataFrame, end: str, threshold: int = CLASS_SIZE, min_days: int = 1, window: int = WINDOW,
    since: str | None = None,
) -> DataFrame:
    """For each day, teachers with ``threshold`` active students in the window before it.

    ``since`` names a column with each pair's first day; the long-term variant keeps only activity
    more than ``window`` days after it.
    """
    rows = activity.where((F.col("dt") < to_date(end)) & F.col("teacher").isNotNull())
    if since is not None:
        rows = rows.where(F.date_add(since, window) < F.col("dt"))
    rows = cut_lineage(rows.select("teacher", "user", "dt"))
    days = rows.repartition(tasks_for(rows), "teacher", "user").distinct()
    members = active_edges(days, ["teacher", "user"], {"teachers": (min_days, False)}, window)
    return daily_levels(busy_edges(members, "teacher", threshold), ["teachers"], end)


def report_page_visits(request_log: DataFrame, start: str, end: str, prefixes: Sequence[str]) -> DataFrame:
    """Distinct visits per day to pages whose path begins with one of the prefixes."""
    path = F.col("url")
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.startswith(path, F.lit(prefix))
    return request_log.where(in_range(start, end) & hit).select("identity", "url", "dt").distinct()


def student_teacher_count(
    pairs: DataFrame, activity: DataFrame, visits: DataFrame, end: str, n: int = CLASS_SIZE
) -> DataFrame:
    """One row per day with 18 counts of teachers, students, coaches and their users.

    Each count is a set of edges; all of them are summed in one aggregate and laid side by side.
    The class tables and the activity within classes feed several counts, so they are written once.
    A day is reported when the four cumulative counts have begun.
    """
    pairs = cut_lineage(pairs)
    teachers = cut_lineage(teacher_since(pairs, n))
    students = cut_lineage(student_since(pairs, teachers))
    coaches = cut_lineage(small_coach_since(pairs, n))
    singles = cut_lineage(small_class_users(pairs, students))
    days = activity.where(F.col("dt") < to_date(end)).select("user", "dt").distinct()

    series = [
        rows.select(F.lit(name).alias("metric"), "dt", F.lit(1).alias("d"))
        for name, rows in (("teacher_count", teachers), ("student_count", students), ("coach_count", coaches),
                           ("coach_user_count", singles))]
    kinds = {"active": (1, False), "highly_engaged": (4, False), "long_term_active": (1, True)}
    classes = (
        (students.select(F.col("student").alias("user"), "teacher", F.col("dt").alias("began")), n, "teachers", "students"),
        (singles.select("user", F.col("coach").alias("teacher"), F.col("dt").alias("began")), 1, "coaches", "coach_users"))
    for members, threshold, group, member in classes:
        pair_days = cut_lineage(members.join(days, "user").where(F.col("dt") >= F.col("began")).withColumn(
            "late", F.date_add("began", WINDOW) < F.col("dt")).drop("began"))
        user_days = cut_lineage(pair_days.groupBy("user", "dt").agg(F.bool_or("late").alias("late")))
        user_days = user_days.repartition(tasks_for(user_days), "user")
        pair_days = pair_days.repartition(tasks_for(pair_days), "teacher", "user")
        series.append(busy_edges(active_edges(pair_days, ["teacher", "user"], kinds), "teacher", threshold).select(
            F.concat("metric", F.lit(f"_{group}")).alias("metric"), "dt", "d"))
        series.append(active_edges(user_days, ["user"], kinds).select(
            F.concat("metric", F.lit(f"_{member}")).alias("metric"), "dt", "d"))
    visitors = visits.where(F.col("dt") < to_date(end)).select("identity", "dt").distinct().join(
        pairs.select("coach", "identity").distinct(), "identity").select("coach", "dt").distinct()
    for name, group in (("visiting_teachers", teachers.select(F.col("teacher").alias("coach"))),
                        ("visiting_coaches", coaches.select("coach"))):
        seen = visitors.join(group, "coach", "left_semi")
        series.append(active_edges(seen, ["coach"], {name: (1, False)}).select("metric", "dt", "d"))

    edges = series[0]
    for more in series[1:]:
        edges = edges.unionByName(more)
    cumulative = ["teacher_count", "student_count", "coach_count", "coach_user_count"]
    names = [*cumulative, *[f"{k}_{g}" for k in kinds for g in ("teachers", "students", "coaches", "coach_users")],
             "visiting_teachers", "visiting_coaches"]
    return daily_levels(edges, names, end).where(" AND ".join(f"{c} IS NOT NULL" for c in cumulative))


def class_size_histogram(pairs: DataFrame) -> DataFrame:
    """Number of coaches per class size."""
    sizes = pairs.where(~F.col("self_coach")).groupBy("coach").agg(F.count(F.lit(1)).alias("student_count"))
    return sizes.groupBy("student_count").agg(F.count(F.lit(1)).alias("class_count"))


def group_mode(df: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent value per group, the smallest on a tie."""
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, [group], [F.col("n").desc(), F.col(value).asc()], 1)


def teacher_country(students: DataFrame, user_ip: DataFrame, ranges: DataFrame, users: DataFrame) -> DataFrame:
    """Where a teacher's class is: the students' most frequent address, located, with the class size."""
    votes = students.join(user_ip.select(F.col("user").alias("student"), "ip"), "student")
    place = ip_geolocate(group_mode(votes, "teacher", "ip").drop("n"), ranges)
    sizes = students.groupBy("teacher").agg(F.count(F.lit(1)).alias("student_count"))
    info = users.select(F.col("user").alias("teacher"), "user_id", "user_email", "user_nickname", "joined")
    return place.join(sizes, "teacher").join(info, "teacher")


def class_pairs(pairs: DataFrame, n: int = CLASS_SIZE) -> DataFrame:
    """(teacher, student) pairs of the classes with at least n students."""
    named = pairs.where(~F.col("self_coach")).select(F.col("coach").alias("teacher"), F.col("user").alias("student")).distinct()
    large = named.groupBy("teacher").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= n).select("teacher")
    return named.join(large, "teacher", "left_semi")


def class_activity(classes: DataFrame, activity: DataFrame, start: str, end: str) -> DataFrame:
    """Activity sums in the range for each student and each teacher of the classes.

    Users are made distinct before the join, and the two roles are two equi-joins joined by a union.
    """
    totals = activity.where(in_range(start, end)).groupBy("user").agg(*[F.sum(c).alias(c) for c in ACTIVITY_COUNTS])
    roles = [totals.join(classes.select(F.col(role).alias("user")).distinct(), "user", "left_semi").withColumn("role", F.lit(role))
             for role in ("student", "teacher")]
    return roles[0].unionByName(roles[1])


def most_active_coaches(
    classes: DataFrame, class_sums: DataFrame, users: DataFrame, hours: Sequence[int] = (1, 5, 10, 15, 20, 25, 30),
    places: DataFrame | None = None,
) -> DataFrame:
    """Per teacher: active students, their sums, how many exceed each number of hours, own activity.

    With ``places`` (see ``teacher_country``) the rows carry the location of the class instead of the e-mail.
    """
    students = class_sums.where(F.col("role") == "student").withColumnRenamed("user", "student")
    measures = [F.count(F.lit(1)).alias("num_students")]
    measures += [F.sum(c).alias(f"sum_student_{c}") for c in ACTIVITY_COUNTS]
    for kind, seconds in (("video", "videos_seconds"), ("exercise", "exercises_seconds")):
        measures += [count_if(F.col(seconds) > h * 3600).alias(f"students_{h}_hour_{kind}_time") for h in hours]
    by_class = classes.join(students, "student").groupBy("teacher").agg(*measures)
    own = class_sums.where(F.col("role") == "teacher").select(
        F.col("user").alias("teacher"), *[F.col(c).alias(f"sum_teacher_{c}") for c in ACTIVITY_COUNTS])
    both = by_class.join(own, "teacher", "full").na.fill(0)
    if places is not None:
        return both.join(places, "teacher")
    return both.join(users.select(F.col("user").alias("teacher"), F.col("user_email").alias("email")), "teacher", "left")


def class_age_stats(classes: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """Mean, spread and number of the students' known ages in years."""
    age = F.datediff(to_date(as_of), "birthdate") / 365.25
    ages = users.where("birthdate IS NOT NULL").select(F.col("user").alias("student"), age.alias("age"))
    return classes.join(ages, "student").groupBy("teacher").agg(
        F.avg("age").alias("avg_age"), F.stddev_pop("age").alias("stddev_age"), F.count(F.lit(1)).alias("n"))


def report_load_counts(events: DataFrame, start: str, end: str, kind: str = "CoachReportLoadEvent") -> DataFrame:
    """Report-load events per user in the range."""
    return events.where(in_range(start, end) & F.col("class").contains(kind)).groupBy("user_key").agg(
        F.count(F.lit(1)).alias("n"))


def coach_headcounts(mapping: DataFrame, declared: DataFrame, n: int = CLASS_SIZE) -> DataFrame:
    """How many users have a coach, how many coaches there are, and the same for classes of n or more.

    ``declared`` lists the coach names of people who call themselves teachers.
    """
    others = mapping.where(~F.col("self_coach"))
    sizes = mapping.groupBy("coach").agg(F.count(F.lit(1)).alias("num_students"))
    large = sizes.where(F.col("num_students") >= n).select("coach")
    sets = {
        "self_identified_teachers": declared.select("coach"),
        "users_with_coach": others.select("user").distinct(),
        "coaches": sizes.select("coach"),
        "coaches_with_class": large,
        "students_of_classes": others.join(large, "coach", "left_semi").select("user").distinct(),
        "teachers_deduped": large.unionByName(declared.select("coach")).distinct(),
    }
    rows = [df.agg(F.count(F.lit(1)).alias("value")).withColumn("metric", F.lit(name)) for name, df in sets.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
