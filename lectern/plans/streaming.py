"""Queries of the streaming block: each runs its stream over what is there and returns the kept table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.coach import dotted, ranges
from lectern.plans.recommend import trials
from lectern.plans.registry import query
from lectern.session import new_folder
from lectern.sources import versions
from lectern.streaming import jobs


def events(b: Inputs):
    rows = jobs.file_stream(b.spark, f"{b.sf_dir}/events.parquet")
    return rows.select("event_id", "ts", F.col("user_id").alias("user"), "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("snapshot_upsert_stream", "STR-1", """
    SELECT "user", event_id, event_type, round(epoch_us(ts) / 1000000.0, 3) AS at FROM (
        SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY ts DESC) AS r FROM b_events) WHERE r = 1""")
def snapshot_upsert_stream(b: Inputs):
    store = new_folder(b.spark, "snapshot")
    jobs.snapshot_upsert_stream(events(b).select("user", "event_id", "event_type", "ts"), store, "user", "ts")
    return b.spark.read.parquet(store).select("user", "event_id", "event_type", F.round(F.unix_micros("ts") / 1000000.0, 3).alias("at"))


@query("snapshot_delta_stream", "STR-1", """
    SELECT "user", event_id, event_type, round(epoch_us(ts) / 1000000.0, 3) AS at FROM (
        SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY ts DESC) AS r FROM b_events) WHERE r = 1 AND event_type <> 'error'""")
def snapshot_delta_stream(b: Inputs):
    """Merged when read, with a compaction between two runs; users whose newest event is an error count as deleted."""
    store, offsets = new_folder(b.spark, "deltas"), new_folder(b.spark, "offsets")
    rows = events(b).select("user", "event_id", "event_type", "ts", (F.col("event_type") == "error").alias("gone"))
    jobs.snapshot_delta_stream(rows, store, "user", "ts", checkpoint=offsets)
    versions.compact(b.spark, store, ["user"], "ts")
    jobs.snapshot_delta_stream(rows, store, "user", "ts", checkpoint=offsets)
    merged = versions.read_merged(b.spark, store, ["user"], "ts", deleted="gone")
    return merged.select("user", "event_id", "event_type", F.round(F.unix_micros("ts") / 1000000.0, 3).alias("at"))


SQL_INPUTS["b_live"] = """
    WITH p AS (SELECT experiment, alternative, identity, began, floor(epoch(began) / 1800)::BIGINT * 1800 AS w FROM b_participants),
    h AS (SELECT p.experiment, p.alternative, p.identity, floor(epoch(e.ts) / 1800)::BIGINT * 1800 AS w, 1 AS n, r.counting
          FROM b_trial_events e JOIN p ON p.experiment = e.experiment AND p.identity = e.identity AND e.ts >= p.began AND event_type = 'purchase'
          JOIN (SELECT DISTINCT experiment, live, counting FROM b_trials) r ON r.experiment = p.experiment WHERE r.live),
    u AS (SELECT experiment, alternative, w, 1 AS p, 0 AS c FROM p UNION ALL SELECT experiment, alternative, w, 0, n FROM h WHERE counting
          UNION ALL SELECT experiment, alternative, MIN(w), 0, 1 FROM h WHERE NOT counting GROUP BY experiment, alternative, identity)
    SELECT w AS window_start, experiment, alternative, SUM(p)::BIGINT AS participants, SUM(c)::BIGINT AS conversions FROM u GROUP BY 1, 2, 3"""


@query("live_experiment_counts", "STR-2", "SELECT * FROM b_live")
def live_experiment_counts(b: Inputs):
    k, user = F.col("k"), F.col("user")
    rows = events(b).where("event_type IN ('view', 'purchase')").select(
        F.concat(F.lit("exp"), F.when(k % 4 == 3, 0).otherwise(k % 4)).alias("experiment"), F.concat(F.lit("alt"), user % F.when(k % 4 == 2, 3).otherwise(2)).alias("alternative"),
        user.alias("identity"), F.when(F.col("event_type") == "view", "view").otherwise("convert").alias("kind"), "ts")
    store = new_folder(b.spark, "live")
    jobs.live_experiment_stream(rows, store)
    return jobs.live_experiment_counts(b.spark.read.parquet(store), trials(b)).withColumn("window_start", F.unix_timestamp("window_start"))


@query("recent_activity_feed", "STR-3", """
    SELECT event_id, ip, city, country, latitude, longitude FROM b_located WHERE city <> 'null' AND NOT (latitude = 0 AND longitude = 0)
    ORDER BY event_id DESC LIMIT 100""")
def recent_activity_feed(b: Inputs):
    number = 167772160 + (F.col("user") * 3875 * 997 * 41 + (F.col("k") % 3) * 7777777) % 1000000000
    rows = events(b).select("event_id", "ts", dotted(number).alias("ip"))
    return jobs.recent_activity_feed(rows, ranges(b), new_folder(b.spark, "feed"), 100).drop("ts")


def user_days(b: Inputs):
    store = new_folder(b.spark, "days")
    jobs.activity_day_stream(events(b), store)
    return b.spark.read.parquet(store)


query("activity_windows", "STR-4", "SELECT dt::VARCHAR AS window_start, COUNT(DISTINCT \"user\") AS users, COUNT(*) AS events FROM b_events GROUP BY dt")(
    lambda b: jobs.activity_windows(user_days(b)).withColumn("window_start", F.to_date("window_start")))
query("rolling_windows", "STR-4", """
    WITH a AS (SELECT DISTINCT "user", dt FROM b_events),
    t AS (SELECT "user", d, COUNT(*) AS n FROM (SELECT "user", unnest(generate_series(dt + 1, dt + 28, INTERVAL 1 DAY))::DATE AS d FROM a) GROUP BY 1, 2),
    s AS (SELECT unnest(generate_series((SELECT MIN(dt) FROM a), DATE '2024-02-09', INTERVAL 1 DAY))::DATE AS d)
    SELECT s.d::VARCHAR AS dt, COUNT(*) FILTER (WHERE n >= 4) AS users FROM s LEFT JOIN t ON s.d = t.d GROUP BY s.d""")(
    lambda b: jobs.rolling_windows(user_days(b), "2024-02-10", min_days=4))


_VISITS = """
    WITH g AS (SELECT "user", ts, (lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 6 HOURS)::INT AS fresh FROM b_events WINDOW w AS (PARTITION BY "user" ORDER BY ts)),
    s AS (SELECT *, SUM(fresh) OVER (PARTITION BY "user" ORDER BY ts) AS n FROM g),
    v AS (SELECT "user", MIN(ts) AS a, MAX(ts) + INTERVAL 6 HOURS AS z, COUNT(*) AS events FROM s GROUP BY "user", n)
    SELECT "user", floor(epoch(a))::BIGINT AS session_start, floor(epoch(z))::BIGINT AS session_end, events FROM v"""


@query("visit_sessions", "STR-4", _VISITS)
def visit_sessions(b: Inputs):
    rows = b.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return jobs.visits(rows, "6 hours").withColumns({c: F.unix_timestamp(c) for c in ("session_start", "session_end")})


@query("visit_sessions_closed", "STR-4", _VISITS + " WHERE z <= (SELECT MAX(ts) - INTERVAL 1 DAY FROM b_events)")
def visit_sessions_closed(b: Inputs):
    store = new_folder(b.spark, "visits")
    jobs.visit_sessions(events(b), store, "6 hours")
    return b.spark.read.parquet(store).drop("batch").withColumns({c: F.unix_timestamp(c) for c in ("session_start", "session_end")})
