"""Learning measurement: card stacks, retention, accuracy gains and curves by position.

Attempts are ordered per (user, topic) or per user.  Such a group can be of any size (a shared or
automated account), so positions and neighbours come from :func:`scan_groups`, cut by hour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lectern.functions.columns import clamp, count_if, explode_present, explode_range
from lectern.functions.ordered import epoch_hour_chunk, scan_groups, top_k
from lectern.session import cut_lineage

ORDER = ("time_done", "event_id")

CARD = T.ArrayType(T.StructType([
    T.StructField("card", T.StructType([
        T.StructField("schedulerInfo", T.StringType()), T.StructField("scheduler_info", T.StringType())])),
    T.StructField("associated_log", T.StructType([T.StructField("ProblemLog", T.StringType())])),
]))
HISTORY = T.ArrayType(T.StructType([
    T.StructField("exercise", T.StringType()), T.StructField("correct", T.BooleanType()),
    T.StructField("time_done", T.StringType()), T.StructField("time_taken", T.IntegerType()),
    T.StructField("problem_type", T.StringType()), T.StructField("seed", T.StringType())]))


def stack_cards(stack_log: DataFrame) -> DataFrame:
    """One row per logged card of the topic-mode stacks.  The card list and the extra data are JSON
    texts inside the document; the scheduler's entry has had two names."""
    extra = F.from_json("extra_data", T.StructType([T.StructField("segment", T.StringType())]))
    cards = stack_log.where("topic_mode").select(
        "user", F.col("topic_id").alias("topic"), F.coalesce(extra["segment"], F.lit("control")).alias("user_segment"),
        F.explode(F.from_json("cards_list", CARD)).alias("c"))
    return cards.where("c.card IS NOT NULL AND c.associated_log.ProblemLog IS NOT NULL").select(
        F.col("c.associated_log.ProblemLog").alias("key"), "user", "topic",
        F.coalesce("c.card.scheduler_info", "c.card.schedulerInfo", F.lit("{}")).alias("scheduler_info"), "user_segment")


def topic_attempts(problem_log: DataFrame, cards: DataFrame) -> DataFrame:
    """Distinct attempts of the logged cards, each also under the topic 'any'; ``randomized`` marks the
    cards the scheduler drew at random."""
    log = problem_log.select("key", "exercise", "time_done", "time_taken", "problem_number", "correct")
    rows = log.join(cards, "key").drop("key").distinct()
    drawn = F.coalesce(F.get_json_object("scheduler_info", "$.purpose") == "randomized", F.lit(False))
    return rows.withColumns({"topic": F.explode(F.array("topic", F.lit("any"))), "randomized": drawn})


def _topic_positions(attempts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Card numbers of the (user, topic) groups that begin with a first problem; the group's segment is
    that of its last card."""
    cards = attempts.select("user", "topic", *order, "problem_number", "correct", "randomized", "user_segment")
    rows = scan_groups(
        cards, ["user", "topic"], order, epoch_hour_chunk(order[0]), number="card_number",
        group_sums={"done": F.lit(1)}, firsts={"first_problem": "problem_number"}, lasts={"segment": "user_segment"})
    return rows.where("first_problem = 1").withColumn("user_segment", F.col("segment")).drop("segment", "first_problem")


def topic_retention(attempts: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Attempts and right answers per topic, segment, kind of card and card number."""
    return _topic_positions(attempts, order).groupBy(
        "topic", "user_segment", F.col("randomized").alias("is_randomized"), F.lit("card_number").alias("bucket_type"),
        F.col("card_number").alias("bucket_value"),
    ).agg(count_if(F.col("correct")).alias("num_correct"), F.count(F.lit(1)).alias("num_attempts"))


def card_gains(cards: DataFrame, keys: Sequence[str], order: Sequence[str], position: str) -> DataFrame:
    """Consecutive cards of each group with the change from one to the next: prev, dist, delta."""
    pairs = scan_groups(
        cards, keys, order, epoch_hour_chunk(order[0]), lags={"prev": position, "prev_correct": "correct"},
        number="nth", group_sums={"cards": F.lit(1)})
    return pairs.withColumn("delta", F.col("correct").cast("int") - F.col("prev_correct").cast("int")).withColumn(
        "dist", F.col(position) - F.col("prev"))


def accuracy_deltas(attempts: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Accuracy gained per card: the change between consecutive randomized cards is spread evenly over
    the cards between them.  Spans of a user do not overlap, so they hold at most as many cards as the
    user did."""
    cards = cut_lineage(_topic_positions(attempts.where("topic <> 'any'"), order).where("randomized"))
    gains = card_gains(cards, ["user", "topic"], order, "card_number").where("prev IS NOT NULL")
    spans = gains.select(
        "topic", "user_segment", F.col("done").alias("num_problems_done"), (F.col("delta") / F.col("dist")).alias("gain"),
        "prev", F.col("card_number").alias("next"))
    spread = explode_range(spans, "prev", F.col("next") - 1, "card_number")
    return spread.groupBy("topic", "user_segment", "num_problems_done", "card_number").agg(
        F.sum("gain").alias("sum_deltas"), F.count(F.lit(1)).alias("num_deltas"), F.avg("gain").alias("avg_deltas"))


def topic_segment_summary(attempts: DataFrame, retention: DataFrame, deltas: DataFrame) -> DataFrame:
    """Fourteen measures per topic and segment, for those that have every part of them."""
    keys = ["topic", "user_segment"]
    per_user = attempts.groupBy(*keys, "user").agg(
        F.count(F.lit(1)).alias("n"), F.sum("time_taken").alias("t"), F.bool_or("randomized").alias("r"))
    totals = per_user.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("all_users"), F.sum("n").alias("all_attempts"), F.sum("t").alias("total_time"),
        count_if(F.col("r")).alias("random_card_users"))

    def pick(column: str, name: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(column))).alias(name)

    first, random, always = F.col("bucket_value") == 1, F.col("is_randomized"), F.lit(True)
    kept = retention.where("bucket_type = 'card_number'").groupBy(*keys).agg(
        pick("num_correct", "first_card_correct_all", first), pick("num_attempts", "first_card_attempts_all", first),
        pick("num_correct", "first_card_correct_randomized", first & random),
        pick("num_attempts", "first_card_attempts_randomized", first & random),
        pick("num_correct", "num_correct_all", always), pick("num_attempts", "num_attempts_all", always),
        pick("num_correct", "num_correct_randomized", random), pick("num_attempts", "num_attempts_randomized", random))
    gains = deltas.groupBy(*keys).agg(
        F.sum("sum_deltas").alias("sum_deltas_randomized"), F.sum("num_deltas").alias("num_deltas_randomized"))
    complete = "random_card_users > 0 AND first_card_attempts_all IS NOT NULL AND first_card_attempts_randomized IS NOT NULL"
    return totals.join(kept, keys).join(gains, keys).where(complete)


def learning_curve_view(retention: DataFrame, deltas: DataFrame, topic: str, segment: str) -> DataFrame:
    """By card: mean gain, cumulative gain, retention relative to its maximum, share correct."""
    chosen = (F.col("topic") == topic) & (F.col("user_segment") == segment)
    gains = deltas.where(chosen).groupBy("card_number").agg(
        (F.sum("sum_deltas") / F.sum("num_deltas")).alias("gain"))
    kept = retention.where(chosen).groupBy(F.col("bucket_value").alias("card_number")).agg(
        F.sum("num_attempts").alias("a"), F.sum("num_correct").alias("c"))
    # One row per card number from here on; they run as far as the longest log, so the sum goes by chunks.
    rows = scan_groups(
        gains.join(kept, "card_number", "full"), [], ["card_number"], F.floor(F.col("card_number") / 10_000),
        sums={"cumulative_gain": F.col("gain"), "gains": F.col("gain").isNotNull().cast("int")})
    most = kept.agg(F.max("a")).scalar()
    return rows.select(
        "card_number", "gain", F.when(F.col("gains") > 0, F.col("cumulative_gain")).alias("cumulative_gain"),
        (F.col("a") / F.greatest(most, F.lit(1))).alias("retention"),
        (F.col("c") / F.col("a")).alias("pct_correct"))


def segment_rates(summary: DataFrame) -> DataFrame:
    """Per-user and per-card rates of the topic and segment summary."""
    ratio = lambda a, b: (F.col(a) / F.when(F.col(b) != 0, F.col(b)))
    return summary.select(
        "topic", "user_segment", F.col("all_users").alias("users"), ratio("all_attempts", "all_users").alias("cards_per_user"),
        (F.col("total_time") / 60 / F.col("all_users")).alias("minutes_per_user"),
        ratio("sum_deltas_randomized", "random_card_users").alias("gain_per_user"),
        ratio("first_card_correct_all", "first_card_attempts_all").alias("first_card_accuracy_all"),
        ratio("first_card_correct_randomized", "first_card_attempts_randomized").alias("first_card_accuracy_randomized"),
        ratio("num_correct_all", "num_attempts_all").alias("all_cards_accuracy"),
        ratio("num_correct_randomized", "num_attempts_randomized").alias("randomized_cards_accuracy"),
        F.col("sum_deltas_randomized").alias("total_gain"))


def experiment_learning_curves(
    attempts: DataFrame, *, min_attempts: int = 0, truncate: int = 0, difficulty: DataFrame | None = None,
    cutoff: float | None = None, abilities: DataFrame | None = None, order: Sequence[str] = ORDER, time_cap: int = 600,
) -> DataFrame:
    """Curves by alternative, topic (and 'AGGREGATE') and position: cards, test cards, right answers,
    time and the gain spread between consecutive test cards.

    Left out: (user, topic) groups in which some exercise does not begin with its first problem, and
    users seen in more than one alternative.  ``truncate`` drops the last test cards of each group,
    ``cutoff`` the exercises of ``difficulty`` at or above it.  ``abilities`` (exercise, correct, ability, variance,
    difficulty; see ``models.response_abilities``) adds sums over the test cards: of difficulties, of abilities, of abilities weighted by
    their precision (1 / variance) and of these weights, and the ability gain spread like the raw gain.  Cards without an ability are no
    test cards then.
    """
    group = ["user", "topic"]
    begun = attempts.groupBy(*group, "exercise").agg(F.min_by("problem_number", F.struct(*order)).alias("p"))
    partial = begun.where("p <> 1").select(*group).distinct()
    torn = attempts.groupBy("user").agg(F.min("alternative").alias("a"), F.max("alternative").alias("b")).where("a <> b").select("user")
    usable = attempts.join(torn, "user", "left_anti").join(partial, group, "left_anti")
    cards = usable.select(
        *group, *order, "alternative", "exercise", "correct", "randomized", clamp("time_taken", 0, time_cap).alias("time_taken"))
    placed = scan_groups(cards, group, order, epoch_hour_chunk(order[0]), number="position", group_sums={"done": F.lit(1)})
    placed = cut_lineage(placed.where(F.col("done") >= min_attempts))

    tests = placed.where("randomized")
    if cutoff is not None and difficulty is not None:
        easy = difficulty.where(F.col("difficulty") < cutoff).select("exercise")
        tests = tests.join(easy, "exercise", "left_semi")
    if abilities is not None:
        tests = tests.join(abilities.select("exercise", "correct", "ability", "variance", "difficulty"), ["exercise", "correct"])
    else:
        tests = tests.withColumns({"ability": F.lit(0.0), "variance": F.lit(1.0), "difficulty": F.lit(0.0)})
    steps = scan_groups(
        tests, group, order, epoch_hour_chunk(order[0]), number="nth", group_sums={"tests": F.lit(1)},
        lags={"prev": "position", "prev_correct": "correct", "prev_ability": "ability"})
    steps = cut_lineage(steps.where(F.col("nth") <= F.col("tests") - truncate))

    keys = ["alternative", "topic", "position"]
    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    counts = ["num_all_cards", "num_test_cards", "num_correct", "time_taken"]
    by_ability = ["sum_difficulty", "sum_abilities", "sum_abilities_weighted", "sum_abilities_weights", "ability_gain"]
    sums = [*counts, "raw_gain", "total_increments", *by_ability]

    def summands(df: DataFrame, **given: Column) -> DataFrame:
        """Rows of zeros but for the sums ``given``."""
        return df.select(*keys, *[given.get(c, F.lit(0)).cast("bigint" if c in counts else "double").alias(c) for c in sums])

    counted = summands(placed, num_all_cards=F.lit(1))
    answered = summands(
        steps, num_test_cards=F.lit(1), num_correct=F.col("correct"), time_taken=F.col("time_taken"), sum_difficulty=F.col("difficulty"),
        sum_abilities=F.col("ability"), sum_abilities_weighted=F.col("ability") / F.col("variance"), sum_abilities_weights=1.0 / F.col("variance"))
    spans = steps.where("prev IS NOT NULL").withColumnRenamed("position", "next").withColumn("size", 1.0 / (F.col("next") - F.col("prev")))
    size = F.col("size")
    gained = summands(
        explode_range(spans, "prev", F.col("next") - 1, "position"), raw_gain=size * (F.col("correct").cast("int") - F.col("prev_correct").cast("int")),
        total_increments=size, ability_gain=size * (F.col("ability") - F.col("prev_ability")))
    rows = counted.unionByName(answered).unionByName(gained)
    per_topic = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    out = per_topic.withColumn("topic", F.explode(F.array("topic", F.lit("AGGREGATE")))).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums])
    return out if abilities is not None else out.drop(*by_ability)


def positions(attempts: DataFrame, n: int, min_problems: int = 0, order: Sequence[str] = ORDER) -> DataFrame:
    """The first n attempts of each user with at least ``min_problems`` of them, numbered from 1."""
    rows = scan_groups(attempts, ["user"], order, epoch_hour_chunk(order[0]), number="position", group_sums={"done": F.lit(1)})
    return rows.where((F.col("position") <= n) & (F.least("done", F.lit(n)) >= min_problems))


def position_curves(
    attempts: DataFrame, n: int, min_problems: int = 0, by_type: bool = False, order: Sequence[str] = ORDER
) -> DataFrame:
    """Users reaching each position, right answers and accuracy, optionally per task type with the
    type's share of the position."""
    keys = ["position", "task_type"] if by_type else ["position"]
    out = positions(attempts, n, min_problems, order).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), count_if(F.col("correct")).alias("correct")).withColumn(
        "accuracy", F.col("correct") / F.col("total"))
    if not by_type:
        return out
    return out.withColumn("ratio", F.col("total") / F.sum("total").over(Window.partitionBy("position")))


def type_ratios(
    attempts: DataFrame, n: int, test_type: str, mastery_types: Sequence[str], min_problems: int = 0,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Per position the shares of test cards and mastery cards; attempts without a type do not count."""
    typed = positions(attempts, n, min_problems, order).groupBy("position").agg(
        count_if(F.col("task_type") == test_type).alias("t"), count_if(F.col("task_type").isin(*mastery_types)).alias("m"),
        F.count("task_type").alias("a"))
    ratio = lambda a, b: F.col(a) / F.when(F.col(b) != 0, F.col(b))
    return typed.select("position", ratio("t", "m").alias("test_to_mastery"), ratio("t", "a").alias("test_to_all"),
                        ratio("m", "a").alias("mastery_to_all"))


def mastery_run_accuracy(
    attempts: DataFrame, n: int, test_type: str, reset_types: Sequence[str], min_problems: int = 0,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Accuracy of test cards by position within a mastery run; a practice card ends the run."""
    placed = cut_lineage(positions(attempts, n, min_problems, order).withColumn("reset", F.col("task_type").isin(*reset_types)))
    runs = scan_groups(placed, ["user"], order, epoch_hour_chunk(order[0]), last_known={"broke": (F.col("position"), F.col("reset"))})
    tests = runs.where(F.col("task_type") == test_type).withColumn(
        "run_position", F.col("position") - F.coalesce("broke", F.lit(0)))
    return tests.groupBy("run_position").agg(
        F.count(F.lit(1)).alias("total"), count_if(F.col("correct")).alias("correct")).withColumn(
        "accuracy", F.col("correct") / F.col("total"))


def _test_gains(attempts: DataFrame, n: int, min_problems: int, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    placed = cut_lineage(positions(attempts, n, min_problems, order))
    return placed, card_gains(placed.where("randomized"), ["user"], order, "position")


def efficiency_curves(attempts: DataFrame, n: int, min_problems: int = 0, order: Sequence[str] = ORDER) -> DataFrame:
    """Per position: gain between neighbouring test cards spread over the cards between them, the most
    it could be, their ratio, its running sum, and both running sums weighted by engagement."""
    placed, gains = _test_gains(attempts, n, min_problems, order)
    reached = placed.groupBy("position").agg(F.count(F.lit(1)).alias("engagement"))
    spread = gains.where("prev IS NOT NULL").select(
        F.explode(F.sequence("prev", F.col("position") - 1)).alias("position"),
        (F.col("delta") / F.col("dist")).alias("e"), (1.0 / F.col("dist")).alias("m"), "delta")
    sums = spread.groupBy("position").agg(
        F.sum("e").alias("eff"), F.sum("m").alias("eff_max"), F.sum("delta").alias("eff_whole"), F.count(F.lit(1)).alias("spans"))
    # One row per position, at most n.
    along = Window.partitionBy(F.lit(0)).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    filled = reached.join(sums, "position", "left").na.fill(0).withColumn(
        "norm", F.when(F.col("eff_max") > 0, F.col("eff") / F.col("eff_max")).otherwise(F.lit(0.0)))
    return filled.withColumns({
        "cumulative": F.sum("norm").over(along),
        "learning_gain": F.sum(F.col("engagement") * F.col("norm")).over(along),
        "learning_gain_raw": F.sum(F.col("engagement") * F.col("eff")).over(along)})


def delta_by_distance(attempts: DataFrame, n: int, min_problems: int = 0, order: Sequence[str] = ORDER) -> DataFrame:
    """Pairs of neighbouring test cards by (first, second) outcome, as 2 * second + first, and distance."""
    _, gains = _test_gains(attempts, n, min_problems, order)
    outcome = 2 * F.col("correct").cast("int") + F.col("prev_correct").cast("int")
    return gains.where("prev IS NOT NULL").groupBy(outcome.alias("outcome"), F.col("dist").alias("distance")).agg(
        F.count(F.lit(1)).alias("n"))


def group_gain(attempts: DataFrame, n: int, bucket: int = 50, min_problems: int = 0, order: Sequence[str] = ORDER) -> DataFrame:
    """Mean change from a user's first to last test card by number of problems, for all users ('All')
    and per alternative; users need two test cards."""
    placed = positions(attempts, n, min_problems, order)
    rank = F.when(F.col("randomized"), F.col("position"))
    users = placed.groupBy("user").agg(
        F.max("alternative").alias("alternative"), F.least(F.max("done"), F.lit(n)).alias("m"), F.count(rank).alias("cards"),
        F.min_by(F.col("correct").cast("int"), rank).alias("first"), F.max_by(F.col("correct").cast("int"), rank).alias("last"))
    return users.where("cards >= 2").select(
        F.explode(F.array(F.lit("All"), F.col("alternative"))).alias("alternative"),
        F.floor(F.col("m") / bucket).alias("bucket"), (F.col("last") - F.col("first")).alias("delta"),
    ).groupBy("alternative", "bucket").agg(F.avg("delta").alias("mean_delta"), F.count(F.lit(1)).alias("users"))


def group_efficiency(attempts: DataFrame, n: int, tail: int = 50, min_problems: int = 0, order: Sequence[str] = ORDER) -> DataFrame:
    """Efficiency by position for all users and per alternative, among users with two test cards:
    normalised, cumulative, raw per user, and the learning gain of those who stay to the tail."""
    placed, gains = _test_gains(attempts, n, min_problems, order)
    both = F.explode(F.array(F.lit("All"), F.col("alternative"))).alias("alternative")
    members = placed.groupBy("user").agg(
        F.max("alternative").alias("alternative"), F.count(F.when(F.col("randomized"), 1)).alias("cards"),
        F.max(F.when(F.col("randomized"), F.col("position"))).alias("last")).where("cards >= 2")
    sizes = members.select(both, "last").groupBy("alternative").agg(
        F.count(F.lit(1)).alias("users"), count_if(F.col("last") > n - tail + 1).alias("stayed"))
    spread = gains.where("prev IS NOT NULL").join(members.select("user", F.col("alternative").alias("alt")), "user").select(
        F.explode(F.array(F.lit("All"), F.col("alt"))).alias("alternative"), "prev", "position", "delta", "dist").select(
        "alternative", F.explode(F.sequence("prev", F.col("position") - 1)).alias("position"), (F.col("delta") / F.col("dist")).alias("e"))
    sums = spread.where(F.col("position") <= n - tail).groupBy("alternative", "position").agg(
        F.sum("e").alias("e"), F.count(F.lit(1)).alias("m"))
    along = Window.partitionBy("alternative").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    eff = F.col("e") / F.col("m")
    return sums.join(sizes, "alternative").select(
        "alternative", "position", eff.alias("efficiency"), F.sum(eff).over(along).alias("cumulative"),
        (F.col("e") / F.col("users")).alias("efficiency_raw"), (eff * F.col("stayed") / F.col("users")).alias("learning_gain"))


def cards_by_date(attempts: DataFrame) -> DataFrame:
    """Test cards per day: accuracy, number and exercises, for all and for the exercises of the first day."""
    cells = attempts.where("randomized").groupBy("dt", "exercise").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("correct")).alias("c"))
    first = cells.groupBy("exercise").agg(F.min("dt").alias("since"))
    begin = cells.agg(F.min("dt")).scalar()
    flagged = cells.join(first, "exercise").withColumn("old", F.col("since") == begin)
    old = lambda c: F.sum(F.when(F.col("old"), F.col(c)))
    return flagged.groupBy("dt").agg(
        (F.sum("c") / F.sum("n")).alias("accuracy"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("exercises"),
        (old("c") / old("n")).alias("filtered_accuracy"), F.coalesce(old("n"), F.lit(0)).alias("filtered_n"),
        count_if(F.col("old")).alias("filtered_exercises"))


def conditional_accuracy(attempts: DataFrame, min_samples: int, order: Sequence[str] = ORDER) -> DataFrame:
    """Per exercise with enough samples: its accuracy, and that of the next card after it was answered
    wrongly or rightly.  Rarer exercises are removed before neighbours are formed."""
    common = attempts.groupBy("exercise").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_samples).select("exercise")
    kept = attempts.select("user", *order, "exercise", "correct").join(common, "exercise", "left_semi")
    rows = scan_groups(kept, ["user"], order, epoch_hour_chunk(order[0]), lags={"prev": "exercise", "prev_correct": "correct"})
    own = F.struct(F.col("exercise").alias("exercise"), F.lit("g").alias("k"))
    after = F.struct(F.col("prev").alias("exercise"), F.when(F.col("prev_correct"), "r").otherwise("w").alias("k"))
    cells = explode_present(rows, [own, F.when(F.col("prev").isNotNull(), after)], "e").groupBy("e.exercise", "e.k").agg(
        F.avg(F.col("correct").cast("int")).alias("p"))
    return cells.groupBy("exercise").agg(*[
        F.max(F.when(F.col("k") == k, F.col("p"))).alias(name)
        for k, name in (("g", "p_global"), ("w", "p_given_wrong"), ("r", "p_given_right"))])


def assessment_responses(assessments: DataFrame) -> DataFrame:
    """The responses of each assessment in order, numbered within their exercise.

    The history is part of one record, so numbering it needs no shuffle.
    """
    parsed = assessments.select("key", F.from_json("history", HISTORY).alias("h"))
    steps = parsed.select("key", "h", F.posexplode("h").alias("pos", "r"))
    same = F.filter(F.slice("h", F.lit(1), F.col("pos") + 1), lambda x: x["exercise"] == F.col("r.exercise"))
    return steps.select(
        "key", F.col("r.time_done").alias("time_done"), F.col("r.exercise").alias("exercise"),
        F.col("r.problem_type").alias("problem_type"), F.col("r.seed").alias("seed"), F.col("r.time_taken").alias("time_taken"),
        F.size(same).alias("problem_number"), F.col("r.correct").alias("correct"))


def assessment_quality(assessments: DataFrame, length: int = 15, enough: int = 3) -> DataFrame:
    """Per slug: assessments, complete ones, and those with more than ``enough`` right answers."""
    history = F.from_json("history", HISTORY)
    right = F.size(F.filter(history, lambda r: r["correct"]))
    return assessments.groupBy("slug").agg(
        F.count(F.lit(1)).alias("total"), count_if(F.size(history) == length).alias("complete"), count_if(right > enough).alias("valid"))


def top_answers(problem_log: DataFrame, k: int = 10, static_only: bool = True) -> DataFrame:
    """The k most frequent first answers per exercise and seed, from logs of the newest content only.

    Content is identified by its seed for static items (seed begins with x), else by the exercise.
    """
    static = F.startswith("seed", F.lit("x"))
    log = problem_log.where(F.size("attempts") > 0).withColumn("answer", F.get("attempts", F.lit(0))).withColumn(
        "content", F.when(static, F.col("seed")).otherwise(F.col("exercise")))
    if static_only:
        log = log.where(static)
    newest = log.groupBy("content").agg(F.max_by("sha1", F.struct("time_done", "event_id")).alias("sha1"))
    name = F.when(static, F.col("exercise")).otherwise(F.concat("exercise", F.lit(":"), "problem_type"))
    counts = log.join(newest, ["content", "sha1"], "left_semi").groupBy(
        name.alias("exercise"), "seed", F.col("answer").alias("response")).agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, ["exercise", "seed"], [F.col("n").desc(), F.col("response").asc()], k)


def assessment_defs(assessments: DataFrame) -> DataFrame:
    """Each assessment slug with the sorted distinct exercises it is made of."""
    pairs = assessments.select("slug", F.explode(F.from_json("history", HISTORY)["exercise"]).alias("exercise")).distinct()
    return pairs.groupBy("slug").agg(F.array_sort(F.collect_set("exercise")).alias("exercises"))


def exercise_difficulty(attempts: DataFrame) -> DataFrame:
    """Randomized cards per exercise and the share answered rightly."""
    return attempts.where("randomized").groupBy("exercise").agg(
        F.count(F.lit(1)).alias("cards"), F.avg(F.col("correct").cast("int")).alias("pct_correct"))
