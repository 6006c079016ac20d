"""Continuous forms: snapshots, experiment counts, the activity feed and activity windows.

Each job reads a stream with a watermark, which bounds its state, and keeps its result in a table in
the shared folder.  Batches are written so that a repeated batch changes nothing: rows are merged by
key into hash buckets, or into calendar days where the key holds a window, or a batch's own folder is overwritten.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.operators.coach import rolling_active_users
from lectern.operators.geo import split_ip_ranges
from lectern.functions.columns import ip_to_long
from lectern.functions.ordered import hour_chunk, scan_groups
from lectern.session import new_folder
from lectern.sources.sinks import merge_buckets, table_exists
from lectern.sources.versions import write_delta

DELAY = "1 day"


def file_stream(spark: SparkSession, path: str, ts: str | None = "ts", max_files: int | None = None) -> DataFrame:
    """A stream of the Parquet files at a path, the event time as a timestamp.

    The stream source takes a folder or a pattern, never a single file; with its last letter in
    brackets any path is a pattern that matches itself, file or folder.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(f"{path[:-1]}[{path[-1]}]")
    return rows.withColumn(ts, F.col(ts).cast("timestamp")) if ts else rows


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> None:
    """Process what is there in micro-batches and stop; the checkpoint lets a later run go on."""
    spark = stream.sparkSession
    query = (stream.writeStream.foreachBatch(handle).outputMode(mode).trigger(availableNow=True)
             .option("checkpointLocation", checkpoint or new_folder(spark, "offsets")).start())
    query.awaitTermination()


def snapshot_upsert_stream(
    stream: DataFrame, store: str, key: str, ts: str, delay: str = DELAY, checkpoint: str | None = None, buckets: int = 16
) -> None:
    """Overlapping fetches merged into a snapshot with the newest row per key.

    Repeats of a (key, time) within the delay are dropped before the merge; the merge itself takes the
    greatest time, and on a tie the row that sorts first, so the order of arrival does not matter.
    """
    fresh = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key, ts])

    def merge(batch: DataFrame, _: int) -> None:
        rest = [c for c in batch.columns if c not in (key, ts)]
        merge_buckets(batch, store, [key], F.struct(F.col(ts), F.struct(*rest)), buckets)

    run_available(fresh, merge, checkpoint=checkpoint)


def snapshot_delta_stream(stream: DataFrame, store: str, key: str, ts: str, delay: str = DELAY, checkpoint: str | None = None) -> None:
    """As ``snapshot_upsert_stream``, merged when read (``versions.read_merged``): a batch writes its own rows and rewrites none."""
    fresh = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key, ts])
    run_available(fresh, lambda batch, number: write_delta(batch, number, store), checkpoint=checkpoint)


def live_experiment_stream(
    stream: DataFrame, store: str, window: str = "30 minutes", delay: str = DELAY, checkpoint: str | None = None
) -> None:
    """Participations and conversions per identity and window.  Input: experiment, alternative, identity,
    kind ('view' or 'convert') and ts.  State lives as long as the watermark lets late rows in.

    Views of a window are one row with their first time.  Conversions keep their times (``at``), as one that comes before the
    person's first view, which may be known only later, does not count and a later one in the same window does.
    """
    keys = ["experiment", "alternative", "identity", "kind"]
    at = F.when(F.col("kind") == "convert", F.col("ts")).otherwise(F.lit(0).cast("timestamp"))
    counts = stream.withWatermark("ts", delay).withColumn("at", at).groupBy(F.window("ts", window).alias("w"), *keys, "at").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"))
    flat = counts.select(F.col("w.start").alias("window_start"), *keys, "at", "n", "first")
    run_available(flat, lambda batch, _: merge_buckets(batch, store, ["window_start", *keys, "at"], F.col("n"), day="window_start"), "update", checkpoint)


def live_experiment_counts(store: DataFrame, rules: DataFrame) -> DataFrame:
    """Per window and alternative: new participants, and conversions at or after the person's first view, in live tests;
    each person counts once in a binary test, in the window of their first such conversion."""
    keys = ["experiment", "alternative"]
    people = store.where("kind = 'view'").groupBy(*keys, "identity").agg(F.min("first").alias("began"), F.min("window_start").alias("window_start"))
    hits = store.where("kind = 'convert'").join(people.select(*keys, "identity", "began"), [*keys, "identity"]).where("at >= began")
    hits = hits.join(rules.where("live").select("experiment", "counting").distinct(), "experiment")
    many = hits.where("counting").groupBy("window_start", *keys).agg(F.sum("n").alias("c"))
    once = hits.where("NOT counting").groupBy(*keys, "identity").agg(F.min("window_start").alias("window_start")).select(
        "window_start", *keys, F.lit(1).cast("bigint").alias("c"))
    joined = people.select("window_start", *keys, F.lit(1).cast("bigint").alias("p"), F.lit(0).cast("bigint").alias("c"))
    rows = joined.unionByName(many.unionByName(once).withColumn("p", F.lit(0).cast("bigint")))
    return rows.groupBy("window_start", *keys).agg(F.sum("p").alias("participants"), F.sum("c").alias("conversions"))


def recent_activity_feed(
    stream: DataFrame, ranges: DataFrame, store: str, n: int, ident: str = "event_id", ts: str = "ts", ip: str = "ip",
    delay: str = DELAY, checkpoint: str | None = None,
) -> DataFrame:
    """The newest ``n`` attempts with their place: repeats and unlocated ones (no place, or 0/0) left out.

    The store holds two slots in turn: a batch reads the other's and overwrites its own, so it can be repeated.
    """
    pieces = split_ip_ranges(ranges.select("lo", "hi", "city", "country", "latitude", "longitude"), bits=16)
    rows = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([ident]).withColumn("__n", ip_to_long(F.col(ip)))
    placed = rows.join(
        pieces, (F.floor(F.col("__n") / 65536) == F.col("first_byte")) & F.col("__n").between(F.col("lo"), F.col("hi"))
    ).drop("__n", "first_byte", "lo", "hi").where("NOT (latitude = 0 AND longitude = 0)")

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = f"{store}/slot={(batch_id - 1) % 2}"
        both = batch
        if batch_id > 0 and table_exists(spark, earlier):
            both = batch.unionByName(spark.read.parquet(earlier).drop("batch"))
        newest = both.orderBy(F.col(ts).desc(), F.col(ident).desc()).limit(n)
        newest.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{store}/slot={batch_id % 2}")

    run_available(placed, keep, checkpoint=checkpoint)
    feed = stream.sparkSession.read.parquet(store)
    newest = feed.agg(F.max("batch").alias("batch"))  # a single row
    return feed.join(F.broadcast(newest), "batch", "left_semi").drop("batch", "slot")


def activity_day_stream(
    stream: DataFrame, store: str, size: str = "1 day", keys: Sequence[str] = ("user",), ts: str = "ts", delay: str = DELAY,
    checkpoint: str | None = None,
) -> None:
    """Events per user and tumbling window, kept current; rows later than the delay are dropped."""
    counts = stream.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"))
    flat = counts.select(F.col("w.start").alias("window_start"), *keys, "events")
    run_available(flat, lambda batch, _: merge_buckets(batch, store, ["window_start", *keys], F.col("events"), day="window_start"), "update", checkpoint)


def activity_windows(store: DataFrame) -> DataFrame:
    """Users and events per window of the maintained table."""
    return store.groupBy("window_start").agg(F.count(F.lit(1)).alias("users"), F.sum("events").alias("events"))


def rolling_windows(store: DataFrame, end: str, window: int = 28, min_days: int = 1) -> DataFrame:
    """Rolling active users from the maintained table of user days: exact where a sliding streaming window
    would hold every event ``window`` times and count users approximately."""
    days = store.select("user", F.to_date("window_start").alias("dt"))
    return rolling_active_users(days, end, window, min_days)


def visit_sessions(
    stream: DataFrame, store: str, gap: str = "30 minutes", user: str = "user", ts: str = "ts", delay: str = DELAY, checkpoint: str | None = None
) -> None:
    """Visits: events of a user less than ``gap`` apart.  A visit is written once the watermark has passed it."""
    visits = stream.withWatermark(ts, delay).groupBy(user, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("events"))
    flat = visits.select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")
    run_available(flat, lambda batch, i: batch.write.mode("overwrite").parquet(f"{store}/batch={i}"), checkpoint=checkpoint)


def visits(events: DataFrame, gap: str = "30 minutes", user: str = "user", ts: str = "ts", ident: str = "event_id") -> DataFrame:
    """All visits of a table of events, closed or still open: what :func:`visit_sessions` would write in the end.

    Visits are runs of events cut by the hour, so a user with very many events is no single task.
    """
    rows = events.select(user, ts, ident)
    steps = scan_groups(rows, [user], [ts, ident], hour_chunk(ts), lags={"__prev": ts})
    fresh = F.col("__prev").isNull() | (F.col(ts) >= F.col("__prev") + F.expr(f"INTERVAL {gap}"))
    numbered = scan_groups(steps.withColumn("__fresh", fresh.cast("int")), [user], [ts, ident], hour_chunk(ts), sums={"__visit": F.col("__fresh")})
    return numbered.groupBy(user, "__visit").agg(
        F.min(ts).alias("session_start"), (F.max(ts) + F.expr(f"INTERVAL {gap}")).alias("session_end"), F.count(F.lit(1)).alias("events")).drop("__visit")
