"""Streams over several batches, with overlap, late rows and a restart."""

import datetime as dt
import pathlib

from pyspark.sql import functions as F

from lectern.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def write(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_overlapping_fetches_merge_across_runs(spark, folder, rows):
    src, store, offsets = folder("src"), folder("store"), folder("offsets")
    schema = "key string, v string, ts timestamp"
    write(spark, src, [("a", "1", at(0)), ("b", "1", at(1)), ("a", "2", at(2))], schema)
    run = lambda: jobs.snapshot_upsert_stream(jobs.file_stream(spark, src), store, "key", "ts", checkpoint=offsets)
    run()
    assert rows(spark.read.parquet(store), "key", "v") == [("a", "2"), ("b", "1")]
    write(spark, src, [("a", "2", at(2)), ("c", "1", at(3)), ("b", "older", at(0))], schema)  # the fetch overlaps
    run()
    assert rows(spark.read.parquet(store), "key", "v") == [("a", "2"), ("b", "1"), ("c", "1")]


def test_late_rows_are_dropped(spark, folder, rows):
    src, store, offsets = folder("src"), folder("store"), folder("offsets")
    schema = "user string, ts timestamp"
    run = lambda: jobs.activity_day_stream(jobs.file_stream(spark, src), store, checkpoint=offsets)
    write(spark, src, [("a", at(0)), ("b", at(1))], schema)
    run()
    write(spark, src, [("a", at(100))], schema)  # moves the watermark to hour 76
    run()
    write(spark, src, [("late", at(2)), ("a", at(101)), ("in time", at(90))], schema)
    run()
    out = jobs.activity_windows(spark.read.parquet(store)).withColumn("d", F.to_date("window_start").cast("string"))
    assert rows(out, "d", "users", "events") == [("2024-01-01", 2, 2), ("2024-01-04", 1, 1), ("2024-01-05", 1, 2)]
    rolling = {str(r.dt): r.users for r in jobs.rolling_windows(spark.read.parquet(store), "2024-01-07").collect()}
    assert rolling["2024-01-02"] == 2 and rolling["2024-01-06"] == 3


def test_feed_keeps_the_newest(spark, folder, rows):
    src, store, offsets = folder("src"), folder("store"), folder("offsets")
    schema = "event_id int, ip string, ts timestamp"
    ranges = spark.createDataFrame([(16777216, 16777471, "Town", "Land", 1.0, 2.0), (33554432, 33554687, "Null", "Island", 0.0, 0.0)],
                                   "lo bigint, hi bigint, city string, country string, latitude double, longitude double")
    run = lambda: jobs.recent_activity_feed(jobs.file_stream(spark, src), ranges, store, 3, checkpoint=offsets)
    write(spark, src, [(i, "1.0.0.1", at(i)) for i in range(5)] + [(9, "2.0.0.1", at(9)), (8, "9.9.9.9", at(8))], schema)
    assert rows(run(), "event_id") == [(2,), (3,), (4,)]
    write(spark, src, [(4, "1.0.0.1", at(4)), (10, "1.0.0.2", at(10))], schema)  # one repeat
    assert rows(run(), "event_id") == [(10,), (3,), (4,)]


def test_binary_conversions_count_once_live(spark, folder, rows):
    src, store = folder("src"), folder("store")
    data = [("e", "a", "u", "view", at(0)), ("e", "a", "u", "convert", at(1)), ("e", "a", "u", "convert", at(3)), ("e", "a", "x", "convert", at(1)),
            ("n", "a", "u", "view", at(0)), ("n", "a", "u", "convert", at(1)), ("n", "a", "u", "convert", at(1.2))]
    write(spark, src, data, "experiment string, alternative string, identity string, kind string, ts timestamp")
    jobs.live_experiment_stream(jobs.file_stream(spark, src), store)
    rules = spark.createDataFrame([("e", "a", True, False), ("n", "a", True, True)], "experiment string, alternative string, live boolean, counting boolean")
    out = jobs.live_experiment_counts(spark.read.parquet(store), rules).withColumn("h", F.hour("window_start"))
    assert rows(out, "experiment", "h", "participants", "conversions") == [("e", 0, 1, 0), ("e", 1, 0, 1), ("n", 0, 1, 0), ("n", 1, 0, 2)]


def test_sessions_close_behind_the_watermark(spark, folder, rows):
    src, store = folder("src"), folder("store")
    write(spark, src, [("a", at(0)), ("a", at(0.25)), ("a", at(2)), ("b", at(60))], "user string, ts timestamp")
    jobs.visit_sessions(jobs.file_stream(spark, src), store)
    out = spark.read.parquet(store)
    assert rows(out, "user", "events") == [("a", 1), ("a", 2)]


def test_closed_days_are_left_alone(spark, folder):
    src, store, offsets = folder("src"), folder("store"), folder("offsets")
    run = lambda: jobs.activity_day_stream(jobs.file_stream(spark, src), store, checkpoint=offsets)
    write(spark, src, [("a", at(0)), ("b", at(30))], "user string, ts timestamp")
    run()
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(store).rglob("*.parquet")}
    write(spark, src, [("c", at(31))], "user string, ts timestamp")
    run()
    after = {p: p.stat().st_mtime_ns for p in pathlib.Path(store).rglob("*.parquet")}
    same = {p for p in before if after.get(p) == before[p]}
    assert {p.parent.name for p in same} == {"day=2024-01-01"}
    assert {p.parent.name for p in after} == {"day=2024-01-01", "day=2024-01-02"}


def test_feed_holds_two_slots_only(spark, folder, rows):
    src, store, offsets = folder("src"), folder("store"), folder("offsets")
    ranges = spark.createDataFrame([(16777216, 16777471, "Town", "Land", 1.0, 2.0)], "lo bigint, hi bigint, city string, country string, latitude double, longitude double")
    for i in range(5):
        write(spark, src, [(i, "1.0.0.1", at(i))], "event_id int, ip string, ts timestamp")
        out = jobs.recent_activity_feed(jobs.file_stream(spark, src), ranges, store, 2, checkpoint=offsets)
        assert rows(out, "event_id") == [(k,) for k in range(max(0, i - 1), i + 1)]
    assert {p.name for p in pathlib.Path(store).iterdir()} == {"slot=0", "slot=1"}


def test_all_visits_with_a_busy_user(spark, rows):
    data = [("a", i, at(i / 10)) for i in range(100)] + [("a", 200, at(10.5)), ("b", 1, at(60)), ("b", 2, at(60)), (None, 3, at(1))]
    df = spark.createDataFrame(data, "user string, event_id int, ts timestamp")
    assert rows(jobs.visits(df), "user", "events") == [("a", 1), ("a", 100), ("b", 2)]
    assert jobs.visits(df.limit(0)).count() == 0


def test_conversions_around_the_first_view(spark, folder, rows):
    """Within one window a person converts, first views, then converts twice; another view comes late from an earlier window."""
    src, store, offsets = folder("src"), folder("store"), folder("offsets")
    schema = "experiment string, alternative string, identity string, kind string, ts timestamp"
    minute = lambda m: T0 + dt.timedelta(minutes=m)
    rules = spark.createDataFrame([("binary", "a", True, False), ("count", "a", True, True)], "experiment string, alternative string, live boolean, counting boolean")
    run = lambda: jobs.live_experiment_stream(jobs.file_stream(spark, src), store, checkpoint=offsets)
    counts = lambda: rows(jobs.live_experiment_counts(spark.read.parquet(store), rules).withColumn("m", (F.unix_timestamp("window_start") / 60 - F.lit(T0.replace(tzinfo=dt.timezone.utc).timestamp() / 60)).cast("int")), "experiment", "m", "participants", "conversions")
    kinds = [("convert", 61), ("view", 65), ("convert", 70), ("convert", 80), ("convert", 80)]
    write(spark, src, [(e, "a", "p", kind, minute(m)) for e in ("binary", "count") for kind, m in kinds], schema)
    run()
    assert counts() == [("binary", 60, 1, 1), ("count", 60, 1, 3)]
    write(spark, src, [(e, "a", "p", "view", minute(31)) for e in ("binary", "count")], schema)
    run()
    assert counts() == [("binary", 30, 1, 0), ("binary", 60, 0, 1), ("count", 30, 1, 0), ("count", 60, 0, 4)]
