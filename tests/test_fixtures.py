"""Worked examples and edge cases of the operators."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F, types as T

from lectern.operators import activity, catalog, coach, dashboard, engagement, experiment, geo, learning, logs, metrics, monthly, recommend
from lectern.sources import readers, sinks

D = dt.date


# -- ingestion --------------------------------------------------------------------------------


def test_entity_scan_separators_and_order(spark, folder, rows):
    path = folder("entities")
    data = [("k1\t{\"a\":1}", D(2024, 1, 1)), ("k2\x01{\"a\":2,\"b\":\"x\"}", D(2024, 1, 2)), ("k3\t{broken", D(2024, 1, 3))]
    spark.createDataFrame(data, "value string, dt date").write.partitionBy("dt").option("compression", "gzip").text(path)
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert rows(readers.entity_scan(spark, path, schema), "key", "a", "b") == [("k1", 1, None), ("k2", 2, "x"), ("k3", None, None)]
    newest = readers.entity_scan(spark, path, schema, limit=1).collect()
    assert [r.key for r in newest] == ["k3"]
    assert [r.key for r in readers.entity_scan(spark, path, schema, order="asc", limit=2).collect()] == ["k1", "k2"]


def test_range_scan_prunes_partitions(spark, folder):
    path = folder("dated")
    df = spark.range(10).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("dt"))
    sinks.partition_overwrite(df, path)
    out = readers.date_range_scan(spark.read.parquet(path), "2024-01-03", "2024-01-05")
    assert sorted(r.id for r in out.collect()) == [2, 3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_json_project_null_text(spark, rows):
    df = spark.createDataFrame([('{"a":"3","b":"null"}',), ('{"a":null}',), ("no json",)], "j string")
    assert rows(readers.json_project(df, "j", {"a": "int", "b": "string"})) == [(3, None), (None, None), (None, None)]


def test_snapshot_merge_ties_and_missing_time(spark, rows):
    schema = "key string, v string, backup_timestamp double, dt date"
    prev = spark.createDataFrame([("a", "old", 5.0, D(2024, 1, 1)), ("b", "old", None, D(2024, 1, 1)), ("c", "only", 1.0, D(2024, 1, 1))], schema)
    incr = spark.createDataFrame([
        ("a", "same time", 5.0, D(2024, 1, 2)), ("b", "first", -1.0, D(2024, 1, 2)), ("d", "early", 2.0, D(2024, 1, 2)),
        ("d", "late, same time", 2.0, D(2024, 1, 3)), ("a", "outside", 9.0, D(2024, 1, 1)), ("c", "past end", 9.0, D(2024, 1, 4))], schema)
    out = readers.snapshot_merge(prev, incr, "key", "backup_timestamp", "2024-01-01", "2024-01-03")
    assert rows(out, "key", "v") == [("a", "old"), ("b", "old"), ("c", "only"), ("d", "early")]


def test_key_sample_is_stable(spark):
    df = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("k"))
    once, again = (readers.key_sample(df, "k", buckets=4).count() for _ in range(2))
    assert once == again and 400 < once < 600
    kept = readers.key_sample(df, "k", fraction=0.5).count()
    assert 940 < kept < 1100
    with pytest.raises(ValueError):
        readers.key_sample(df, "k")


def test_report_upsert_replaces_by_key(spark, folder, rows):
    path, types = folder("report"), {"id": "int", "n": "int"}
    first = spark.createDataFrame([("1", "10"), ("2", "\\N"), ("3", "x"), ("4", "40")], "id string, n string")
    assert rows(sinks.publish_report(first, path, types, "upsert", key="id")) == [(3, 1)]
    sinks.publish_report(spark.createDataFrame([("1", "5"), ("9", "90")], "id string, n string"), path, types, "upsert", key="id")
    assert rows(sinks.read_report(spark, path), "id", "n") == [(1, 5), (2, None), (4, 40), (9, 90)]


def test_report_append_and_replace(spark, folder, rows):
    path, types = folder("plain"), {"id": "int"}
    one, two = (spark.createDataFrame([(v,)], "id string") for v in ("1", "2"))
    sinks.publish_report(one, path, types)
    sinks.publish_report(two, path, types)
    assert rows(sinks.read_report(spark, path)) == [(1,), (2,)]
    sinks.publish_report(two, path, types, "replace")
    assert rows(sinks.read_report(spark, path)) == [(2,)]
    with pytest.raises(ValueError):
        sinks.publish_report(two, path, types, "upsert")


def test_csv_export(spark, folder):
    sinks.export_csv(spark.range(3), folder("csv"))
    assert spark.read.option("header", True).csv(folder("csv")).count() == 3


# -- catalogue --------------------------------------------------------------------------------


def test_array_explode_example(spark, rows):
    df = spark.createDataFrame([("def", "ghi", [1, 2, 3]), ("x", "y", []), ("x", "y", None)], "a string, b string, c array<int>")
    assert rows(catalog.array_explode(df, "c", ["a", "b"])) == [("def", "ghi", 1), ("def", "ghi", 2), ("def", "ghi", 3)]


def test_split_explode_missing_field(spark, rows):
    df = spark.createDataFrame([("a.b", "1"), (None, "2"), ("c", None)], "f string, k string")
    assert rows(catalog.split_explode(df, "f", ".", ["k"], required=False)) == [("a", "1"), ("b", "1"), ("c", "")]
    with pytest.raises(Exception, match="f is missing"):
        catalog.split_explode(df, "f", ".", ["k"]).collect()


def test_topic_mapping_drops_unknown_titles(spark):
    topics = spark.createDataFrame(
        [("r", "Root", []), ("m", "Math", ["r"]), ("g", "Geo", ["m", "gone", "r"]), ("x", "Loose", None)], "key string, title string, ancestor_keys array<string>")
    got = {r.topic_key: (r.ancestor_keys, r.ancestor_titles) for r in catalog.topic_mapping(topics).collect()}
    assert got == {"r": ([], ["Root"]), "m": (["r"], ["Root", "Math"]), "g": (["r", "gone", "m"], ["Root", "Math", "Geo"])}


def test_cover_graph_levels_and_cycles(spark, rows):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("a", "a")], "source string, target string")
    out = rows(catalog.cover_graph(edges))
    assert ("a", "c", "descendant", 3) in out and ("a", "c", "covers", 3) in out and ("c", "a", "covered", 1) in out
    assert ("b", "a", "ancestor", 2) in out and len([r for r in out if r[2] == "descendant"]) == 3
    with pytest.raises(ValueError, match="cycle"):
        catalog.cover_graph(spark.createDataFrame([("a", "b"), ("b", "a")], "source string, target string"))


# -- activity ---------------------------------------------------------------------------------


@pytest.mark.parametrize("gap,changes", [(28, 0), (29, 1)])
def test_growth_gap_boundary(spark, rows, gap, changes):
    start = D(2024, 1, 1)
    days = [("u", start, True), ("u", start + dt.timedelta(gap), False), (None, start, True)]
    df = spark.createDataFrame(days, "user string, dt date, joined boolean")
    out = rows(activity.user_growth_daily(df, "2024-01-01", str(start + dt.timedelta(gap + 28))))
    assert len([r for r in out if r[1] == "reactivations"]) == changes
    assert len([r for r in out if r[1] == "deactivations"]) == changes
    assert (start, "joins", 1) in out


@pytest.mark.parametrize("rest,ends", [(28, 0), (29, 1)])
def test_growth_end_of_history(spark, rows, rest, ends):
    start = D(2024, 1, 1)
    df = spark.createDataFrame([("u", start, False)], "user string, dt date, joined boolean")
    out = rows(activity.user_growth_daily(df, "2024-01-01", str(start + dt.timedelta(rest))))
    assert len(out) == ends


def test_clamps_and_non_integer_seed(spark, rows):
    log = spark.createDataFrame(
        [("u", "e", "p", "12", -5, True, False, D(2024, 1, 1)), ("u", "e", "p", "x9", 900, False, True, D(2024, 1, 1)), ("u", "e", "p", "13", 600, False, False, D(2024, 1, 1))],
        "user string, exercise string, problem_type string, seed string, time_taken int, correct boolean, earned_proficiency boolean, dt date")
    assert rows(activity.user_exercise_summary(log), "time_spent", "num_correct", "num_wrong", "proficient") == [(1200, 1, 2, True)]
    out = rows(activity.exercise_summary(log, "2024-01-01", "2024-01-02"), "sub_exercise_type", "is_static", "time_taken")
    assert out == [("p", False, 600), ("x9", True, 600)]


def test_unknown_users_are_a_mode(spark):
    log = spark.createDataFrame(
        [("stranger", "e", None, 3, True, True, True, 10, D(2024, 1, 1))],
        "user string, exercise string, topic_mode boolean, problem_number int, correct boolean, earned_proficiency boolean, hint_used boolean, time_taken int, dt date")
    users = spark.createDataFrame([], "user string, user_id string, joined date, coaches array<string>, proficient_exercises string")
    out = activity.daily_exercise_stats(log, users, "2024-01-01")
    modes = {(r.super_mode, r.sub_mode) for r in out.collect()}
    assert modes == {(a, b) for a in ("everything", "unknown") for b in ("everything", "unknown")}


def test_company_metrics_count_days(spark, rows):
    users = spark.createDataFrame([("a", D(2024, 1, 1), True), ("b", D(2023, 1, 1), True), ("p", D(2024, 1, 1), False)], "user string, joined date, registered boolean")
    days = spark.createDataFrame([("a", D(2024, 1, d)) for d in (1, 2, 3, 29)] + [("b", D(2024, 1, 5)), ("p", D(2024, 1, 9))], "user string, dt date")
    assert rows(activity.company_metrics(days, users, "2024-01-01", "2024-02-01")) == [("2024-01", 1, 2, 1)]


# -- coaches and places -----------------------------------------------------------------------


def test_self_coach(spark, rows):
    users = spark.createDataFrame([("u", "id1", "u@x", ["id1", "c", "u@x", "u"])], "user string, user_id string, user_email string, coaches array<string>")
    got = rows(coach.user_coach_mapping(users), "coach", "self_coach")
    assert got == [("c", False), ("id1", True), ("u", True), ("u@x", True)]


def test_teacher_since_is_the_nth_student(spark, rows):
    pairs = [(f"u{i}", "c", D(2024, 1, 1) + dt.timedelta(i), False) for i in range(12)] + [("c", "c", D(2020, 1, 1), True), ("z", "few", D(2024, 1, 1), False)]
    df = spark.createDataFrame(pairs, "user string, coach string, joined_on date, self_coach boolean")
    teachers = coach.teacher_since(df)
    assert rows(teachers) == [("c", D(2024, 1, 10))]
    since = dict((r[0], r[2]) for r in rows(coach.student_since(df, teachers)))
    assert since["u0"] == D(2024, 1, 10) and since["u11"] == D(2024, 1, 12)
    assert rows(coach.small_coach_since(df)) == [("few", D(2024, 1, 1))]


def test_split_ranges_over_several_first_bytes(spark, rows):
    df = spark.createDataFrame([(16777200, 2 * 16777216 + 5, "X")], "lo bigint, hi bigint, c string")
    assert rows(geo.split_ip_ranges(df)) == [(0, 16777200, 16777215, "X"), (1, 16777216, 33554431, "X"), (2, 33554432, 33554437, "X")]


def test_geolocate_unknown_and_bounds(spark, rows):
    ranges = spark.createDataFrame([(16777216, 16777300, "Town", 1.0)], "lo bigint, hi bigint, city string, latitude double")
    df = spark.createDataFrame([("1.0.0.0",), ("1.0.0.84",), ("1.0.0.85",), ("bad",), (None,)], "ip string")
    assert rows(geo.ip_geolocate(df, ranges)) == [
        ("1.0.0.0", "Town", 1.0), ("1.0.0.84", "Town", 1.0), ("1.0.0.85", "null", None), ("bad", "null", None), (None, "null", None)]


def test_odd_postal_codes(spark, rows):
    blocks = spark.createDataFrame([("1", "10.0.0.0/24"), ("2", "10.0.1.0/31")], "id string, subnet string")
    places = spark.createDataFrame([("1", "US", "CA", "Elsewhere", "", "E3L"), ("2", "US", "CA", "Elsewhere", "", "94001")],
                                   "id string, country string, state string, city string, area_code string, postalcode string")
    none = spark.createDataFrame([], "city string")
    out = geo.region_ip_ranges(blocks, places, none, spark.createDataFrame([], "area_code int"), spark.createDataFrame([(94001,)], "zip int"), "US", "CA")
    assert rows(out) == [(167772416, 167772418)]


# -- learning ---------------------------------------------------------------------------------


def topic_cards(spark, tests, n=42, first_problem=1):
    """One user's n cards in a topic; ``tests`` maps card numbers of test cards to outcomes."""
    data = [("ben", "topic", float(i * 50000), i, first_problem + i - 1, tests.get(i, True), i in tests, f"seg{i % 2}", 5) for i in range(1, n + 1)]
    return spark.createDataFrame(data, "user string, topic string, time_done double, event_id int, problem_number int, correct boolean, randomized boolean, user_segment string, time_taken int")


def test_accuracy_deltas_example(spark):
    out = learning.accuracy_deltas(topic_cards(spark, {3: False, 6: True})).orderBy("card_number").collect()
    assert [(r.user_segment, r.num_problems_done, r.card_number, round(r.avg_deltas, 3)) for r in out] == [
        ("seg0", 42, 3, 0.333), ("seg0", 42, 4, 0.333), ("seg0", 42, 5, 0.333)]


@pytest.mark.parametrize("tests", [{}, {7: True}])
def test_no_deltas_without_two_test_cards(spark, tests):
    assert learning.accuracy_deltas(topic_cards(spark, tests)).count() == 0


def test_groups_that_begin_late_are_skipped(spark):
    assert learning.topic_retention(topic_cards(spark, {3: True, 5: True}, first_problem=2)).count() == 0


def test_any_topic_has_retention_but_no_deltas(spark):
    cards = topic_cards(spark, {3: True, 5: True}).withColumn("topic", F.lit("any"))
    assert learning.topic_retention(cards).count() > 0 and learning.accuracy_deltas(cards).count() == 0


def test_stack_cards_names_and_defaults(spark, rows):
    cards = '[{"card":{"schedulerInfo":{"purpose":"randomized"}},"associated_log":{"ProblemLog":"p1"}},{"card":{"scheduler_info":{}},"associated_log":{"ProblemLog":"p2"}},{"card":{}},{"associated_log":{"ProblemLog":"p3"}}]'
    df = spark.createDataFrame([("u", True, "t", "{}", cards), ("u", False, "t", "{}", cards)], "user string, topic_mode boolean, topic_id string, extra_data string, cards_list string")
    assert rows(learning.stack_cards(df), "key", "scheduler_info", "user_segment") == [("p1", '{"purpose":"randomized"}', "control"), ("p2", "{}", "control")]


def test_top_answers_keep_the_newest_content(spark, rows):
    data = [("e", "x1", "t", ["a"], "old", 1.0, 1), ("e", "x1", "t", ["b", "c"], "new", 2.0, 2), ("e", "x1", "t", ["b"], "new", 3.0, 3), ("e", "x1", "t", [], "new", 4.0, 4), ("e", "7", "t", ["z"], "new", 5.0, 5)]
    df = spark.createDataFrame(data, "exercise string, seed string, problem_type string, attempts array<string>, sha1 string, time_done double, event_id int")
    assert rows(learning.top_answers(df)) == [("e", "x1", "b", 2)]
    assert rows(learning.top_answers(df, static_only=False), "exercise", "seed", "response", "n") == [("e", "x1", "b", 2), ("e:t", "7", "z", 1)]


# -- experiments ------------------------------------------------------------------------------


def test_weighted_assignment_orders_by_weight(spark):
    alternatives = spark.createDataFrame([("t", "t", "a", 1, 0), ("t", "t", "b", 4, 1), ("t", "t", "c", 20, 2)], "canonical_name string, hashable_name string, name string, weight int, number int")
    people = spark.range(200).select(F.concat(F.lit("id"), "id").alias("identity"), F.array(F.lit("t (seen)"), F.lit("t (again)")).alias("participating_tests"))
    counts = {r.alternative: r["count"] for r in experiment.assign_alternative(people, alternatives).groupBy("alternative").count().collect()}
    assert 0 < counts["a"] < counts["b"] < counts["c"] and sum(counts.values()) == 200


def test_tied_weights_go_by_number(spark, rows):
    alternatives = spark.createDataFrame([("t", "t", "a", 2, 10), ("t", "t", "b", 2, 9)], "canonical_name string, hashable_name string, name string, weight int, number int")
    assert rows(experiment.weight_bands(alternatives), "alternative", "low", "high") == [("a", 2, 4), ("b", 0, 2)]


def test_binary_tests_convert_once(spark, rows):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    part = spark.createDataFrame([("e", "u", "a", at(1)), ("n", "u", "a", at(1)), ("dead", "u", "a", at(1))], "experiment string, identity string, alternative string, ts timestamp")
    conv = spark.createDataFrame([(e, "u", at(m)) for e in ("e", "n", "dead") for m in (0, 2, 3)] + [("e", "outsider", at(5))], "experiment string, identity string, ts timestamp")
    rules = spark.createDataFrame([("e", "a", True, False), ("e", "b", True, False), ("n", "a", True, True), ("dead", "a", False, True)], "experiment string, alternative string, live boolean, counting boolean")
    assert rows(experiment.experiment_results(part, conv, rules)) == [
        ("dead", "a", 1, 0, 0.0), ("e", "a", 1, 1, 1.0), ("e", "b", 0, 0, 0.0), ("n", "a", 1, 2, 2.0)]


def test_significance_levels(spark):
    df = spark.createDataFrame([("e", "a", 1000, 100, 0.1), ("e", "b", 1000, 150, 0.15), ("s", "a", 5, 1, 0.2), ("s", "b", 9, 3, 1 / 3)],
                               "experiment string, alternative string, participants bigint, conversions bigint, conversion_rate double")
    got = {r.experiment: r for r in experiment.ab_significance(df).collect()}
    z = -0.05 / math.sqrt(0.1 * 0.9 / 1000 + 0.15 * 0.85 / 1000)
    assert got["e"].z == pytest.approx(z) and got["e"].p == 0.001 and got["e"].best == "b" and not got["e"].small_sample
    assert got["s"].p is None and got["s"].small_sample and not got["s"].significant


# -- recommendation ---------------------------------------------------------------------------


@pytest.mark.parametrize("block", [1, 2, 256])
def test_pairs_and_their_mirror(spark, rows, block):
    done = [("u1", "a", 3.0), ("u1", "b", 1.0), ("u1", "c", 2.0), ("u2", "a", 1.0), ("u3", "a", 1.0), ("u3", "b", 2.0)]
    out = rows(recommend.cooccurrence(spark.createDataFrame(done, "user string, item string, completion_time double"), block))
    assert out == [("a", "b", 1, 1), ("a", "c", 0, 1), ("b", "a", 1, 1), ("b", "c", 1, 0), ("c", "a", 1, 0), ("c", "b", 0, 1)]


def test_lone_items_give_no_pairs(spark):
    done = spark.createDataFrame([("u1", "a", 1.0), ("u2", "b", 1.0)], "user string, item string, completion_time double")
    assert recommend.cooccurrence(done).count() == 0


def test_top_similar_scores(spark):
    schema = "item1 string, item2 string, preceed_cnt int, succeed_cnt int, cnt1 int, cnt2 int"
    one = spark.createDataFrame([("a", "b", 0, 1, 1, 1)], schema)
    assert recommend.top_similar(one, min_count=1).first().score == 1.0
    many = spark.createDataFrame([("a", f"p{i:03}", i, 0, 100, 1) for i in range(1, 101)], schema)
    best = recommend.top_similar(many, min_count=1).orderBy(F.desc("score")).collect()
    assert [r.item2 for r in best] == [f"p{i:03}" for i in range(100, 80, -1)]
    assert best[0].score == pytest.approx(10.0)
    two = spark.createDataFrame([("a", "b", 1, 0, 1, 2), ("b", "a", 0, 1, 2, 1)], schema)
    assert all(r.score == pytest.approx(1 / math.sqrt(2)) for r in recommend.top_similar(two, min_count=1).collect())


def test_early_pruning_changes_nothing(spark, rows):
    data = [(f"u{i % 17}", f"i{(i * i) % 23}", float(i)) for i in range(300)]
    done = spark.createDataFrame(data, "user string, item string, completion_time double").groupBy("user", "item").agg(F.min("completion_time").alias("completion_time"))
    plain = recommend.top_similar(recommend.cooccurrence_counts(recommend.cooccurrence(done), recommend.item_counts(done)), 6, 5)
    assert rows(recommend.recommend(done, 6, 5)) == rows(plain)


def test_pairs_carry_their_counts_and_join_no_more(spark, rows):
    done = spark.createDataFrame([(f"u{u}", f"v{v}", float((u * v) % 3)) for u in range(6) for v in range(u + 3)], "user string, item string, completion_time double")
    counts = recommend.item_counts(done)
    plain = recommend.cooccurrence_counts(recommend.cooccurrence(done), counts)
    carried = recommend.cooccurrence_counts(recommend.cooccurrence(done, block=2, counts=counts), counts)
    columns = ["item1", "item2", "preceed_cnt", "succeed_cnt", "cnt1", "cnt2"]
    assert rows(carried, *columns) == rows(plain, *columns)
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins(carried) < joins(plain)


def test_similarity_matrix_makes_its_scores_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    scores = spark.createDataFrame([("a", "b", 0.5), ("b", "a", 0.5)], "item1 string, item2 string, score double").mapInPandas(counted, "item1 string, item2 string, score double")
    assert recommend.similarity_matrix(scores).count() == 2
    assert made.value == 2


def test_similarity_matrix_indexes(spark):
    scores = spark.createDataFrame([("b", "a", 0.5), ("b", "c", 0.25)], "item1 string, item2 string, score double")
    got = {r.item: (r["index"], r.row) for r in recommend.similarity_matrix(scores).collect()}
    assert got == {"a": (0, None), "b": (1, {0: 0.5, 2: 0.25}), "c": (2, None)}


# -- logs and metrics -------------------------------------------------------------------------


def test_cache_log_examples(spark, folder):
    text = "\n".join([
        '\t1:1.0 memcache: get "orphan" (fail)',
        '10.0.0.1 - - [22/May/2012:10:00:00 -0700] "/first" 200', '\t1:10.5 memcache: get "ns:key" (fail)', "\tnoise",
        '10.0.0.1 - - [22/May/2012:10:00:05 -0700] "/second" 200', '\t1:11.0 memcache: set "ns:key" (904 bytes) (expires 2160000)',
        '\t1:11.5 memcache: get "user_ag5abc" (success)', "not a log line", '\t1:11.6 memcache: delete "ns:key" '])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder("log"))
    lines = logs.read_log_lines(spark, folder("log"))
    got = [(r.url, r.time, r.command, r.key, r.key_prefix, r.success, r.num_bytes, r.expires) for r in logs.cache_log_parse(lines).orderBy("time").collect()]
    assert got == [
        ("/first", 10.5, "get", "ns:key", "ns:key", False, 0, 0), ("/second", 11.0, "set", "ns:key", "ns:key", True, 904, 2160000),
        ("/second", 11.5, "get", "user_ag5abc", "user_ag5...", True, 0, 0), ("/second", 11.6, "delete", "ns:key", "ns:key", True, 0, 0)]
    assert {r.url for r in logs.cache_log_parse(lines, ignore_before="904 bytes").collect()} == {"/second"}
    assert logs.cache_log_parse(lines, ignore_before="never there").count() == 4


def test_evicted_and_unused_keys(spark, rows):
    ops = [("r1", 1.0, "set", "k", True, 10), ("r1", 2.0, "get", "k", False, 0), ("r2", 3.0, "set", "k", True, 20), ("r2", 0.5, "get", "old", True, 0), ("r3", 4.0, "set", "lost", True, 7)]
    df = spark.createDataFrame(ops, "request_id string, time double, command string, key string, success boolean, num_bytes bigint").withColumns({"key_prefix": F.col("key"), "line_id": F.lit("l")})
    assert rows(logs.cache_report(df, "evicted_gets"), "key", "value") == [("k", 1.0)]
    assert rows(logs.cache_report(df, "space")) == [
        ("live_bytes", "k", 21.0), ("live_bytes", "lost", 11.0), ("live_total", "bytes", 32.0), ("live_total", "items", 2.0)]
    assert rows(logs.cache_report(df, "set_never_get")) == [("set_and_get", "k", 1.0), ("set_and_get", "lost", 0.0), ("set_never_get", "k", 1.0), ("set_never_get", "lost", 1.0)]


def test_cache_lines_of_one_time_keep_their_order(spark, folder, rows):
    """Line 9 sets, line 10 looks the key up in vain at the same logged time; the last request does nothing."""
    text = ['10.0.0.1 - - [22/May/2012:10:00:00 -0700] "/first" 200', *["\tnoise"] * 8, '\t1:1.5 memcache: set "k" (7 bytes)', '\t1:1.5 memcache: get "k" (fail)',
            '10.0.0.1 - - [22/May/2012:10:00:05 -0700] "/idle" 200']
    spark.createDataFrame([("\n".join(text),)], "value string").coalesce(1).write.text(folder("log"))
    lines = logs.read_log_lines(spark, folder("log"))
    ops = logs.cache_log_parse(lines)
    assert rows(logs.cache_report(ops, "evicted_gets"), "key", "value") == [("k", 1.0)]
    assert rows(logs.cache_report(ops, "space")) == [("evicted_bytes", "k", 8.0), ("evicted_total", "bytes", 8.0), ("evicted_total", "items", 1.0)]
    assert rows(logs.cache_report(ops, "get_never_set"), "key", "value") == [("from", None), ("to", None)]
    assert rows(logs.cache_idle_requests(lines, ops), "key", "value") == [("requests", 2.0), ("without cache commands", 1.0)]


def test_message_match_window(spark, rows):
    problems = spark.createDataFrame([("u", "e", 3, "log3", 1000.0, D(2024, 1, 1)), ("u", "e", 4, "log4", 5000.0, D(2024, 1, 1))], "id string, exercise string, problem_number int, info string, ts double, dt date")
    messages = spark.createDataFrame([("u", "e", 2, "old", 900.0), ("u", "e", 2, "hello", 1599.0), ("u", "e", 3, "far", 4400.0)], "id string, exercise string, total_done int, text string, ts double")
    assert rows(logs.message_attempt_match(problems, messages), "info", "text") == [("log3", "hello"), ("log4", "")]


def test_event_params(spark, rows):
    df = spark.createDataFrame([("a;x.lesson.text:Hi there;x.n:1;",), ("x.lesson.text_2:no;",), ("x.lesson.text:open end",)], "e string")
    assert rows(logs.event_param_extract(df, "e", "lesson.text"), "value") == [("Hi there",), ("open end",)]


def test_latency_keeps_requests_without_url(spark, rows):
    log = spark.createDataFrame([(D(2024, 1, 1), None, 10, 4, 100), (D(2024, 1, 1), None, 30, 8, 300), (D(2024, 1, 1), "/a", 5, None, 50)],
                                "dt date, url string, ms int, cpu_ms int, bytes int")
    out = logs.url_latency_stats(log, measures=["ms", "cpu_ms"])
    assert rows(out, "url", "count", "avg_response_bytes", "ms_pct50", "cpu_ms_pct50") == [("/a", 1, 50.0, 5.0, None), (None, 2, 200.0, 20.0, 6.0)]


def test_category_usage_keeps_missing_categories(spark, rows):
    uvs = spark.createDataFrame([("u", 1, D(2024, 1, 1), 5, True), ("u", 2, D(2024, 1, 1), 7, False)], "user string, video_key int, dt date, num_seconds int, completed boolean")
    cats = spark.createDataFrame([(1, None, None), (2, "Math", None)], "vid_key int, top_category string, second_category string")
    out = engagement.category_usage(uvs, cats, "2024-01-01", "2024-01-02")
    assert rows(out, "topic", "videos", "users", "visits", "seconds", "completed") == [("Math", 1, 1, 1, 7, 0), (None, 1, 1, 1, 5, 1)]


def test_log_search_needs_a_term(spark):
    with pytest.raises(ValueError, match="broad"):
        logs.log_search(spark.range(1), spark.range(1))


def test_week_bounds(spark):
    start = D(2012, 6, 17)
    df = spark.createDataFrame([(start + dt.timedelta(i),) for i in range(7)], "d date")
    assert {(r.week_start, (r.week_end - r.week_start).days) for r in metrics.week_bounds(df, "d").collect()} == {(start, 7)}


def test_collate_records_example(spark):
    data = [(1972, "USA", "NY", 1000), (1972, "USA", "LA", 500), (1973, "USA", "NY", 2000), (1973, "USA", "Chicago", 400), (1973, "USA", "LA", 600), (1972, "Canada", "Toronto", 6)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "Year int, Country string, City string, Population int, at int")
    out = {(r.Year, r.Country): {c: r[c] for c in ("NY", "LA", "Chicago", "Toronto") if r[c] is not None} for r in metrics.collate_records(df, ["Year", "Country"], "City", "Population", "at").collect()}
    assert out == {(1972, "USA"): {"NY": 1000, "LA": 500}, (1973, "USA"): {"NY": 2000, "LA": 600, "Chicago": 400}, (1972, "Canada"): {"Toronto": 6}}


def test_usage_names_and_numbers(spark, folder, rows):
    lines = ["Date,Name,Unit,Used", '2012-10-15,"Dedicated Memcache (10k ops/s/GB, 1GB unit)",Hour,"31,000.23"', "2012-10-01,Search Document Storage,GB,5", "2012-10-16,Search Document  Storage,GB,7"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(folder("usage"))
    assert rows(metrics.usage_report_load(spark, folder("usage"), "2012-10-10")) == [
        (D(2012, 10, 15), "dedicated_memcache", 31000.23), (D(2012, 10, 16), "search_document_storage", 7.0)]


def test_significant_digits(spark):
    points = spark.createDataFrame([("a", 1, 123456.0), ("a", 2, 0.00123456), ("b", 2, 0.0), ("a", 0, 1.0)], "name string, t int, value double")
    got = {r.t: (r.a, r.b) for r in metrics.series_by_time(points, ["a", "b"], start=0).collect()}
    assert got[1][0] == 123500.0 and got[2][0] == pytest.approx(0.001235) and got[2][1] == 0.0 and set(got) == {1, 2}


def test_counter_hit_rate(spark):
    df = spark.createDataFrame([(0, 100, 50), (90000, 103, 51), (90001, 103, 51)], "t bigint, hits bigint, misses bigint")
    assert [(r.t, r.hit_pct) for r in metrics.counter_hit_rate(df).orderBy("t").collect()] == [(90000, 75.0), (90001, None)]


# -- engagement, monthly, dashboard -----------------------------------------------------------


def test_category_map_example(spark):
    usage = spark.createDataFrame([("u", "Math Algebra", 3, 1, 1606, 1)], "user string, topic string, videos bigint, visits bigint, seconds bigint, completed bigint")
    assert engagement.user_category_map(usage).first().category_json == '{"math_algebra":["3","1","1606","1"]}'


def test_classification_unions_days(spark, rows):
    day = lambda n: D(2024, 1, n)
    frame = lambda *d: spark.createDataFrame([("u", day(n)) for n in d], "user string, dt date")
    got = {t: n for _, t, n in rows(engagement.user_classification(frame(1, 2), frame(2, 3), frame(9), "2024-01-01", "2024-01-05"))}
    assert got == {"total": 3, "video": 2, "exercise": 2, "video_exercise": 3, "video_feedback": 2, "exercise_feedback": 2}


def test_cohort_bounds(spark, rows):
    users = spark.createDataFrame([("a", D(2024, 1, 1), True), ("b", D(2024, 1, 1), True), ("c", D(2024, 1, 1), True)], "user string, joined date, registered boolean")
    visits = spark.createDataFrame([("a", D(2024, 2, 1))], "user string, dt date")
    sizes = spark.createDataFrame([("a", 5), ("b", 50)], "user string, max_cohort_size int")
    assert rows(monthly.retention_cohorts(users, visits, sizes, max_group=10)) == [("2024-01", "2024-01", 2, 2), ("2024-01", "2024-02", 1, 1)]
    assert rows(monthly.retention_cohorts(users, visits, sizes, min_group=10)) == [("2024-01", "2024-01", 1, 1)]


def test_value_days_ago_default(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 5)], "dt date, n int")
    assert dashboard.value_days_ago(df, "2024-01-08", "n", 7).first().value == 5.0
    assert dashboard.value_days_ago(df, "2024-01-09", "n", 7).first().value == 7.0


def test_total_row_equals_sum_of_parts(spark):
    """Seconds over all videos equal the total's, per user category."""
    import __spark_entry__ as entry
    df = entry.queries()["video_stats"](spark, "/root/testdata/sf0.001")
    sums = {(r.user_category, r.aggregation): r.s for r in df.groupBy("user_category", "aggregation").agg(F.sum("seconds_watched").alias("s")).collect()}
    for category in ("all", "registered", "phantom"):
        assert len({sums[category, a] for a in ("video", "top_topic", "second_topic", "total")}) == 1
    assert sums["all", "total"] == sums["registered", "total"] + sums["phantom", "total"]


def test_cover_graph_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}") for i in range(70)], "source string, target string")
    levels = {r["node"]: r["level"] for r in catalog.cover_graph(edges).select("node", "level").distinct().collect()}
    assert levels["n00"] == 71 and levels["n70"] == 1


def test_key_prefixes_are_whole():
    assert len(logs.KEY_PREFIXES) == 14
