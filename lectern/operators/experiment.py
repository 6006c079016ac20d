"""Experiments: assignment, results, significance and timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lectern.functions.columns import md5_mod
from lectern.functions.ordered import top_k

# P levels and the z score each needs.
Z_CUTOFFS = ((0.10, 1.29), (0.05, 1.65), (0.01, 2.33), (0.001, 3.08))
SMALL_SAMPLE = 10


def weight_bands(alternatives: DataFrame) -> DataFrame:
    """The residues [low, high) of each alternative: heavier ones take the upper end, ties go by number
    and name.  A test has a handful of alternatives."""
    down = Window.partitionBy("canonical_name").orderBy(F.desc("weight"), F.desc("number"), F.desc("name"))
    whole = Window.partitionBy("canonical_name")
    taken = F.sum("weight").over(down.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("weight").over(whole)
    return alternatives.select(
        "canonical_name", "hashable_name", F.col("name").alias("alternative"), total.alias("total"),
        (total - taken).alias("low"), (total - taken + F.col("weight")).alias("high"))


def assign_alternative(identities: DataFrame, alternatives: DataFrame) -> DataFrame:
    """The alternative of each identity in each test it takes part in.

    ``participating_tests`` lists 'canonical name (conversion)'; the residue is the md5 of the hashable
    name and the identity modulo the total weight.
    """
    name = lambda t: F.trim(F.regexp_replace(t, r"\([^(]*$", ""))
    parts = identities.select("identity", F.explode(F.transform("participating_tests", name)).alias("canonical_name")).distinct()
    bands = weight_bands(alternatives)
    tests = bands.select("canonical_name", "hashable_name", "total").distinct()
    placed = parts.join(tests, "canonical_name").withColumn(
        "residue", md5_mod(F.concat("hashable_name", F.col("identity").cast("string")), F.col("total")))
    bands = bands.select("canonical_name", "alternative", "low", "high")
    return placed.join(bands, "canonical_name").where("residue >= low AND residue < high").select(
        "identity", "canonical_name", "alternative")


def user_experiment_info(assigned: DataFrame, users: DataFrame) -> DataFrame:
    """Assignments with the users behind the identities."""
    return users.select("user", "user_id", "user_email", "identity").join(assigned, "identity")


def counted_conversions(participations: DataFrame, conversions: DataFrame, alternatives: DataFrame) -> DataFrame:
    """Conversions that count: after taking part, in a live test; the first one only in a binary test."""
    rules = alternatives.select("experiment", "live", "counting").distinct()
    began = participations.groupBy("experiment", "identity").agg(F.min("ts").alias("began"), F.min(F.struct("ts", "alternative")).getField("alternative").alias("alternative"))
    hits = conversions.select("experiment", "identity", "ts").join(began, ["experiment", "identity"]).where("ts >= began").join(
        rules.where("live"), "experiment")
    many = hits.where("counting").select("experiment", "alternative", "ts")
    once = hits.where("NOT counting").groupBy("experiment", "identity").agg(
        F.min("alternative").alias("alternative"), F.min("ts").alias("ts")).select("experiment", "alternative", "ts")
    return many.unionByName(once)


def experiment_results(participations: DataFrame, conversions: DataFrame, alternatives: DataFrame) -> DataFrame:
    """Participants, conversions and rate of every alternative."""
    people = participations.groupBy("experiment", "identity").agg(F.min(F.struct("ts", "alternative")).getField("alternative").alias("alternative")).groupBy(
        "experiment", "alternative").agg(F.count(F.lit(1)).alias("participants"))
    counted = counted_conversions(participations, conversions, alternatives).groupBy("experiment", "alternative").agg(
        F.count(F.lit(1)).alias("conversions"))
    keys = ["experiment", "alternative"]
    return alternatives.select(*keys).join(people, keys, "left").join(counted, keys, "left").na.fill(0).withColumn(
        "conversion_rate", F.when(F.col("participants") > 0, F.col("conversions") / F.col("participants")).otherwise(F.lit(0.0)))


def ab_significance(results: DataFrame) -> DataFrame:
    """z score of the first against the second alternative, by name, with the strictest p level reached.

    Tests with other than two alternatives or without participants on a side get no score, nor do
    tests whose variance is negative because users convert more than once.
    """
    cell = F.struct("conversion_rate", "participants")
    sides = results.groupBy("experiment").agg(
        F.count(F.lit(1)).alias("k"), F.min_by(cell, "alternative").alias("a"), F.max_by(cell, "alternative").alias("b"),
        F.min("participants").alias("fewest"), F.min_by("alternative", F.struct(-F.col("conversion_rate"), F.col("alternative"))).alias("best"))
    spread = sum(
        F.col(f"{s}.conversion_rate") * (1 - F.col(f"{s}.conversion_rate")) / F.when(F.col(f"{s}.participants") > 0, F.col(f"{s}.participants"))
        for s in ("a", "b"))
    gap = F.col("a.conversion_rate") - F.col("b.conversion_rate")
    z = F.when(F.col("k") == 2, F.when(spread == 0, F.lit(0.0)).when(spread > 0, gap / F.sqrt(spread)))
    scored = sides.withColumn("z", z)
    p = F.lit(None).cast("double")
    for level, cutoff in Z_CUTOFFS:
        p = F.when(F.abs("z") > cutoff, F.lit(level)).otherwise(p)
    return scored.withColumn("p", p).select(
        "experiment", "z", "p", F.coalesce(F.col("p") <= 0.05, F.lit(False)).alias("significant"),
        (F.col("fewest") < SMALL_SAMPLE).alias("small_sample"), "best")


def experiment_snapshots(
    participations: DataFrame, conversions: DataFrame, alternatives: DataFrame, end: str, minutes: int = 30
) -> DataFrame:
    """Cumulative participants and conversions of each alternative at the end of every interval, from
    its first participant to ``end``.  Events are summed per interval before anything is ordered."""
    span = minutes * 60
    stop = F.unix_timestamp(F.lit(end).cast("timestamp"))
    first = participations.groupBy("experiment", "identity").agg(F.min("ts").alias("ts"), F.min(F.struct("ts", "alternative")).getField("alternative").alias("alternative"))
    rows = first.select("experiment", "alternative", "ts", F.lit(1).alias("p"), F.lit(0).alias("c")).unionByName(
        counted_conversions(participations, conversions, alternatives).select(
            "experiment", "alternative", "ts", F.lit(0).alias("p"), F.lit(1).alias("c")))
    tick = ((F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / span) + 1) * span).alias("tick")
    ticks = rows.groupBy("experiment", "alternative", tick).agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
    along = Window.partitionBy("experiment", "alternative").orderBy("tick")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    steps = ticks.select(
        "experiment", "alternative", "tick", F.sum("p").over(upto).alias("participants"), F.sum("c").over(upto).alias("conversions"),
        (F.coalesce(F.lead("tick").over(along), stop + span) - span).alias("last")).where((F.col("tick") <= F.col("last")) & (F.col("tick") <= stop))
    ticks = F.explode(F.sequence("tick", F.least("last", stop), F.lit(span).cast("bigint")))
    return steps.withColumn("tick", ticks).select(
        "experiment", "alternative", F.timestamp_seconds("tick").alias("time"), "participants", "conversions")


def experiment_timeline(snapshots: DataFrame, alternatives: DataFrame, limit: int | None = None) -> DataFrame:
    """Conversion rate over time, in percent unless the test counts conversions; all snapshots, or
    the newest ``limit`` of each test."""
    rules = alternatives.select("experiment", "counting").distinct()
    if limit is not None:
        snapshots = top_k(snapshots, ["experiment"], [F.col("time").desc(), F.col("alternative").asc()], limit)
    rate = F.when(F.col("participants") > 0, F.col("conversions") / F.col("participants")).otherwise(F.lit(0.0))
    return snapshots.join(rules, "experiment").select(
        "experiment", "alternative", "time", F.round(rate * F.when(F.col("counting"), 1.0).otherwise(100.0), 3).alias("rate"))
