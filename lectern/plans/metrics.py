"""Queries of the operational metrics block."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.ordered import scan_groups
from lectern.operators import metrics as ops
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.learning import rounded
from lectern.plans.registry import query
from lectern.session import new_folder

SQL_INPUTS.update({
    "b_usage": """
        SELECT CAST(o_orderdate AS DATE) AS dt, 'frontend_' || lower(o_orderstatus) || '_hours' AS key, SUM(o_totalprice::DECIMAL(18, 2))::DOUBLE AS value
        FROM orders GROUP BY 1, 2""",
    "b_hourly": """
        SELECT epoch(ts)::BIGINT // 3600 * 3600 AS t, event_type AS name, MAX(value) AS value FROM (SELECT date_trunc('hour', ts) AS ts, event_type, value FROM b_events) GROUP BY 1, 2""",
    "b_counters": """
        WITH h AS (SELECT epoch(date_trunc('hour', ts))::BIGINT AS t, COUNT(*) FILTER (WHERE event_type = 'click') AS h, COUNT(*) FILTER (WHERE event_type = 'error') AS m FROM b_events GROUP BY 1)
        SELECT t, SUM(h) OVER (ORDER BY t) AS hits, SUM(m) OVER (ORDER BY t) AS misses FROM h""",
})


def daily_usage(b: Inputs):
    return b.table("orders").groupBy(F.to_date("o_orderdate").alias("dt"), "o_orderstatus").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("used"))


@query("usage_report_load", "OP-1", "SELECT dt::VARCHAR AS dt, key, value FROM b_usage WHERE dt >= DATE '1998-01-01'")
def usage_report_load(b: Inputs):
    path = new_folder(b.spark, "usage")
    daily_usage(b).select(
        F.col("dt").cast("string").alias("Date"), F.concat(F.lit("Frontend "), "o_orderstatus", F.lit("  Hours (10k ops/s, GB)")).alias("Name"),
        F.lit("Hour").alias("Unit"), F.format_number("used", 2).alias("Used")).write.option("header", True).csv(path)
    return ops.usage_report_load(b.spark, path, "1998-01-01")


def usage(b: Inputs):
    return daily_usage(b).select(
        "dt", F.concat(F.lit("frontend_"), F.lower("o_orderstatus"), F.lit("_hours")).alias("key"), F.col("used").cast("double").alias("value"))


query("usage_by_week", "OP-2", """
    SELECT date_trunc('week', dt)::DATE::VARCHAR AS dt, round(SUM(value), 2) AS used FROM b_usage WHERE key = 'frontend_f_hours' GROUP BY 1""")(
    lambda b: rounded(ops.usage_by_week(usage(b), "frontend_f_hours"), 2))
query("usage_by_complete_week", "OP-2", """
    SELECT date_trunc('week', dt)::DATE::VARCHAR AS dt, round(SUM(value), 2) AS used FROM b_usage WHERE key = 'frontend_f_hours' GROUP BY 1 HAVING COUNT(DISTINCT dt) = 7""")(
    lambda b: rounded(ops.usage_by_week(usage(b), "frontend_f_hours", complete_only=True), 2))
query("usage_by_day", "OP-2", "SELECT dt::VARCHAR AS dt, value AS used FROM b_usage WHERE key = 'frontend_f_hours'")(
    lambda b: ops.usage_by_week(usage(b), "frontend_f_hours", "day"))

query("week_bounds", "OP-3", """
    SELECT o_orderkey, (d - CAST(dayofweek(d) AS INTEGER))::VARCHAR AS week_start, (d - CAST(dayofweek(d) AS INTEGER) + 7)::VARCHAR AS week_end
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")(
    lambda b: ops.week_bounds(b.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")), "d").drop("d"))

_TYPES = ("view", "click", "signup", "error", "purchase")
_sig = "floor(value * pow(10.0, 3 - floor(log10(abs(value)))) + 0.5) / pow(10.0, 3 - floor(log10(abs(value))))"


@query("series_by_time", "OP-4", "SELECT t, " + ", ".join(f"MAX({_sig}) FILTER (WHERE name = '{n}') AS {n}" for n in _TYPES) + """
    FROM b_hourly WHERE t > epoch(TIMESTAMP '2024-01-10')::BIGINT GROUP BY 1""")
def series_by_time(b: Inputs):
    hour = F.unix_timestamp(F.date_trunc("hour", F.col("ts")).cast("timestamp"))
    points = b.events.groupBy(hour.alias("t"), F.col("event_type").alias("name")).agg(F.max("value").alias("value"))
    return ops.series_by_time(points, _TYPES, start=1704844800)


def counters(b: Inputs):
    hour = F.unix_timestamp(F.date_trunc("hour", F.col("ts")).cast("timestamp"))
    hourly = b.events.groupBy(hour.alias("t")).agg(
        F.count(F.when(F.col("event_type") == "click", 1)).alias("h"), F.count(F.when(F.col("event_type") == "error", 1)).alias("m"))
    return scan_groups(hourly, [], ["t"], F.floor(F.col("t") / 86400), sums={"hits": F.col("h"), "misses": F.col("m")}).select("t", "hits", "misses")


@query("counter_hit_rate", "OP-5", """
    WITH d AS (SELECT t, hits - lag(hits) OVER w AS h, misses - lag(misses) OVER w AS m FROM b_counters WINDOW w AS (ORDER BY t))
    SELECT t, round(h * 100.0 / NULLIF(h + m, 0), 6) AS hit_pct FROM d WHERE h IS NOT NULL""")
def counter_hit_rate(b: Inputs):
    return rounded(ops.counter_hit_rate(counters(b)))


query("weighted_mean", "OP-6", """
    SELECT p_brand, SUM(p_size)::BIGINT AS p_size, round(SUM(p_size * p_retailprice) / SUM(p_size), 6) AS p_retailprice FROM part GROUP BY 1""")(
    lambda b: rounded(ops.weighted_mean(b.table("part"), "p_size", ["p_retailprice"], ["p_brand"])))
query("median_record", "OP-6", """
    SELECT l_returnflag, round(median(l_quantity), 6) AS l_quantity, round(median(l_extendedprice), 6) AS l_extendedprice, round(median(l_tax), 6) AS l_tax
    FROM lineitem GROUP BY 1""")(
    lambda b: rounded(ops.median_record(b.table("lineitem"), ["l_quantity", "l_extendedprice", "l_tax"], ["l_returnflag"])))

_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
query("collate_records", "OP-7", "SELECT c_nationkey::BIGINT AS c_nationkey, " + ", ".join(
    f"arg_max(c_name, c_custkey) FILTER (WHERE c_mktsegment = '{s}') AS \"{s}\"" for s in _SEGMENTS) + " FROM customer GROUP BY 1")(
    lambda b: ops.collate_records(b.table("customer"), ["c_nationkey"], "c_mktsegment", "c_name", "c_custkey", _SEGMENTS))
query("metric_history", "OP-8", "SELECT event_id, event_type, value FROM events ORDER BY ts DESC LIMIT 500")(
    lambda b: ops.metric_history(b.table("events").select("event_id", "event_type", "value", "ts"), "ts", 500).drop("ts"))
