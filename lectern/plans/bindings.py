"""The driver's tables as operator inputs, once for Spark and once as SQL.

Each property of :class:`Inputs` has its twin in ``SQL_INPUTS`` under the same name with a ``b_``
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions.ordered import hour_chunk, scan_groups
from lectern.session import cut_lineage

SQL_INPUTS: dict[str, str] = {}


class Inputs:
    """Tables of one data folder and the inputs derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rows(self, columns: str, *values: tuple) -> DataFrame:
        """A small fixed parameter table."""
        return self.spark.createDataFrame(list(values), columns)

    # -- events -------------------------------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id", "ts", F.to_date("ts").alias("dt"), F.col("user_id").alias("user"), "event_type", "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"))

    @cached_property
    def view_log(self) -> DataFrame:
        """Video log of the event stream."""
        return self.events.where("event_type = 'view'").select(
            "user", F.col("k").alias("video"), F.concat(F.lit("Video "), F.col("k")).alias("video_title"),
            F.floor(F.col("value") * 20 - 100).cast("int").alias("seconds_watched"),
            (F.col("value") > 40).alias("is_video_completed"), "dt", "ts", "event_id")

    @cached_property
    def problem_log(self) -> DataFrame:
        """Problem log without positions; every event is an attempt."""
        k = F.col("k")
        return self.events.select(
            "event_id", "ts", "dt", "user", F.concat(F.lit("ex_"), k % 12).alias("exercise"),
            F.col("event_type").alias("problem_type"),
            F.when(k % 3 == 0, F.concat(F.lit("x"), k % 5)).otherwise(k.cast("string")).alias("seed"),
            F.floor(F.col("value") * 8 - 20).cast("int").alias("time_taken"),
            (F.col("value") < 60).alias("correct"),
            ((F.col("event_type") == "purchase") & (F.col("value") < 60)).alias("earned_proficiency"),
            F.when(k % 4 != 0, k % 2 == 0).alias("topic_mode"),
            (F.col("event_type") == "error").alias("hint_used"))

    @cached_property
    def numbered_log(self) -> DataFrame:
        """Problem log with the position of each attempt among the user's attempts at the exercise,
        stored once as such a log would be."""
        return cut_lineage(scan_groups(
            self.problem_log, ["user", "exercise"], ["ts", "event_id"], hour_chunk("ts"), number="problem_number"))

    @cached_property
    def feedback(self) -> DataFrame:
        return self.events.where("event_type = 'error'").select(
            F.col("user").alias("author"), F.array("k").alias("targets"),
            F.array(F.when(F.col("k") % 3 == 0, "question").when(F.col("k") % 3 == 1, "answer").otherwise("comment")).alias("types"),
            (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("date"))

    # -- catalogue and usage --------------------------------------------------------------------

    @cached_property
    def videos(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("key"), F.col("p_name").alias("title"),
            F.concat(F.lit("yt"), F.col("p_partkey")).alias("youtube_id"))

    @cached_property
    def categories(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("vid_key"), F.col("p_type").alias("top_category"),
            F.when(F.col("p_size") > 5, F.col("p_brand")).alias("second_category"))

    @cached_property
    def video_topic(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("vid_key"), F.col("p_brand").alias("topic_title"))

    @cached_property
    def video_log(self) -> DataFrame:
        """Video log of the order lines: the buyer watched the part on the order date."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dt"))
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("user"), F.col("l_partkey").alias("video"),
            F.concat(F.lit("Video "), F.col("l_partkey")).alias("video_title"),
            F.floor(F.col("l_quantity") * 50 - 100).cast("int").alias("seconds_watched"),
            (F.col("l_returnflag") == "R").alias("is_video_completed"), "dt",
            F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"))

    @cached_property
    def uvs(self) -> DataFrame:
        from lectern.operators.activity import user_video_summary
        return user_video_summary(self.video_log)

    # -- people ---------------------------------------------------------------------------------

    @cached_property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        phantom = F.col("c_mktsegment") == "MACHINERY"
        user_id = F.concat(F.when(phantom, F.lit("http://nouserid.example.org/")).otherwise(F.lit("id")), key)
        return self.table("customer").select(
            key.alias("user"), user_id.alias("user_id"),
            F.concat(F.lower("c_name"), F.lit("@example.org")).alias("user_email"),
            F.col("c_name").alias("user_nickname"), F.concat(F.lit("ident"), key).alias("identity"),
            F.date_add(F.lit("1995-01-01").cast("date"), (key * 37 % 2000).cast("int")).alias("joined"),
            (~phantom).alias("registered"))

    @cached_property
    def learners(self) -> DataFrame:
        """Users of the event stream, who joined shortly before or during it."""
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        done = F.array_join(F.transform(F.sequence(F.lit(0), nation), lambda i: F.concat(F.lit("e"), i)), "\t")
        return self.table("customer").select(
            key.alias("user"),
            F.concat(F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("http://nouserid.example.org/"))
                     .otherwise(F.lit("id")), key).alias("user_id"),
            F.date_add(F.lit("2023-12-20").cast("date"), (key % 30).cast("int")).alias("joined"),
            F.when(F.col("c_mktsegment") == "FURNITURE", F.array(F.lit("c1"), F.lit("c2")))
            .when(F.col("c_mktsegment") == "BUILDING", F.array().cast("array<string>")).alias("coaches"),
            F.when(nation > 0, done).alias("proficient_exercises"),
            F.concat(F.lower("c_name"), F.lit("@example.org")).alias("user_email"),
            (F.col("c_mktsegment") != "MACHINERY").alias("registered"))

    @cached_property
    def order_days(self) -> DataFrame:
        """Long activity history: a customer is active on each order date and joins on the first."""
        return self.table("orders").select(F.col("o_custkey").alias("user"), F.to_date("o_orderdate").alias("dt"))

    @cached_property
    def order_activity(self) -> DataFrame:
        first = self.order_days.groupBy("user").agg(F.min("dt").alias("dt"))
        return self.order_days.distinct().join(first.withColumn("j", F.lit(True)), ["user", "dt"], "left").select(
            "user", "dt", F.coalesce("j", F.lit(False)).alias("joined"))

    @cached_property
    def badges(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_custkey").alias("user"), F.col("o_orderpriority").alias("badge_name"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("target_context_name"),
            F.floor(F.col("o_totalprice") / 1000).cast("int").alias("points_earned"), F.to_date("o_orderdate").alias("dt"))


SQL_INPUTS.update({
    "b_events": """
        SELECT event_id, ts, CAST(ts AS DATE) AS dt, user_id AS "user", event_type, value,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events""",
    "b_view_log": """
        SELECT "user", k AS video, 'Video ' || k AS video_title, CAST(floor(value * 20 - 100) AS INTEGER) AS seconds_watched,
               value > 40 AS is_video_completed, dt, ts, event_id FROM b_events WHERE event_type = 'view'""",
    "b_problem_log": """
        SELECT event_id, ts, dt, "user", 'ex_' || (k % 12) AS exercise, event_type AS problem_type,
               CASE WHEN k % 3 = 0 THEN 'x' || (k % 5) ELSE k::VARCHAR END AS seed,
               CAST(floor(value * 8 - 20) AS INTEGER) AS time_taken, value < 60 AS correct,
               (event_type = 'purchase' AND value < 60) AS earned_proficiency,
               CASE WHEN k % 4 <> 0 THEN k % 2 = 0 END AS topic_mode, event_type = 'error' AS hint_used
        FROM b_events""",
    "b_numbered_log": """
        SELECT *, row_number() OVER (PARTITION BY "user", exercise ORDER BY ts, event_id) AS problem_number
        FROM b_problem_log""",
    "b_feedback": """
        SELECT "user" AS author, k AS target, ['question', 'answer', 'comment'][k % 3 + 1] AS kind, dt
        FROM b_events WHERE event_type = 'error'""",
    "b_videos": "SELECT p_partkey AS key, p_name AS title, 'yt' || p_partkey AS youtube_id FROM part",
    "b_categories": """
        SELECT p_partkey AS vid_key, p_type AS top_category,
               CASE WHEN p_size > 5 THEN p_brand END AS second_category FROM part""",
    "b_video_topic": "SELECT p_partkey AS vid_key, p_brand AS topic_title FROM part",
    "b_video_log": """
        SELECT o_custkey AS "user", l_partkey AS video, 'Video ' || l_partkey AS video_title,
               CAST(floor(l_quantity * 50 - 100) AS INTEGER) AS seconds_watched, l_returnflag = 'R' AS is_video_completed,
               CAST(o_orderdate AS DATE) AS dt, l_orderkey AS order_key, l_linenumber AS line
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "b_uvs": """
        SELECT "user", video AS video_key, video_title, dt,
               CAST(SUM(CASE WHEN seconds_watched < 0 THEN 0 WHEN seconds_watched > 1800 THEN 1800
                             ELSE seconds_watched END) AS BIGINT) AS num_seconds,
               bool_or(is_video_completed) AS completed
        FROM b_video_log GROUP BY 1, 2, 3, 4""",
    "b_users": """
        SELECT c_custkey AS "user",
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'http://nouserid.example.org/' ELSE 'id' END || c_custkey AS user_id,
               lower(c_name) || '@example.org' AS user_email, c_name AS user_nickname, 'ident' || c_custkey AS identity,
               DATE '1995-01-01' + CAST(c_custkey * 37 % 2000 AS INTEGER) AS joined,
               c_mktsegment <> 'MACHINERY' AS registered FROM customer""",
    "b_learners": """
        SELECT c_custkey AS "user",
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'http://nouserid.example.org/' ELSE 'id' END || c_custkey AS user_id,
               c_mktsegment <> 'MACHINERY' AS registered, lower(c_name) || '@example.org' AS user_email,
               DATE '2023-12-20' + CAST(c_custkey % 30 AS INTEGER) AS joined,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN 2 ELSE 0 END AS n_coaches,
               CASE WHEN c_nationkey > 0 THEN c_nationkey + 1 END AS n_done FROM customer""",
    "b_order_days": "SELECT o_custkey AS \"user\", CAST(o_orderdate AS DATE) AS dt FROM orders",
    "b_order_activity": """
        SELECT DISTINCT "user", dt, dt = MIN(dt) OVER (PARTITION BY "user") AS joined FROM b_order_days""",
    "b_badges": """
        SELECT o_custkey AS "user", o_orderpriority AS badge_name,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS target_context_name,
               CAST(floor(o_totalprice / 1000) AS INTEGER) AS points_earned, CAST(o_orderdate AS DATE) AS dt FROM orders""",
})
