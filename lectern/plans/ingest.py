"""Queries of the ingestion block.  Files they read back are written to the shared folder first."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.registry import query
from lectern.sources import readers, sinks, versions

EVENT_SCHEMA = T.StructType([
    T.StructField("user", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("k", T.IntegerType())])


def event_text(b: Inputs) -> str:
    """The events as gzip ``key<TAB>json`` text in dated folders."""
    path = sinks.new_folder(b.spark, "entities")
    doc = F.to_json(F.struct("user", "event_type", "value", "k"))
    (b.events.select(F.concat(F.col("event_id").cast("string"), F.lit("\t"), doc).alias("value"), "dt")
     .write.partitionBy("dt").option("compression", "gzip").text(path))
    return path


@query("entity_scan", "IN-1", """
    SELECT event_id::VARCHAR AS key, "user", event_type, value, k, dt::VARCHAR AS dt FROM b_events""")
def entity_scan(b: Inputs):
    return readers.entity_scan(b.spark, event_text(b), EVENT_SCHEMA)


@query("entity_scan_newest", "IN-1", """
    SELECT event_id::VARCHAR AS key, "user", event_type, value, k, dt::VARCHAR AS dt
    FROM b_events ORDER BY b_events.dt DESC, event_id::VARCHAR LIMIT 200""")
def entity_scan_newest(b: Inputs):
    return readers.entity_scan(b.spark, event_text(b), EVENT_SCHEMA, order="desc", limit=200)


@query("date_range_scan", "IN-2", """
    SELECT event_id, "user", event_type, dt::VARCHAR AS dt FROM b_events
    WHERE dt >= DATE '2024-01-08' AND dt < DATE '2024-01-22'""")
def date_range_scan(b: Inputs):
    path = sinks.new_folder(b.spark, "dated")
    sinks.partition_overwrite(b.events.select("event_id", "user", "event_type", "dt"), path)
    return readers.date_range_scan(b.spark.read.parquet(path), "2024-01-08", "2024-01-22")


@query("json_project", "IN-3", """SELECT event_id, k::BIGINT AS k, NULL::DOUBLE AS missing FROM b_events""")
def json_project(b: Inputs):
    return readers.json_project(b.table("events").select("event_id", "props"), "props", {"k": "int", "missing": "double"})


def order_entities(b: Inputs):
    return b.table("orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 1000)).cast("double").alias("backup_timestamp"),
        F.to_date("o_orderdate").alias("dt"))


SQL_INPUTS["b_order_entities"] = """
    SELECT o_custkey AS key, o_orderkey AS order_key, o_totalprice AS price,
           CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 1000) END AS backup_timestamp,
           CAST(o_orderdate AS DATE) AS dt FROM orders"""
SQL_INPUTS["b_latest_per_day"] = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, dt ORDER BY order_key) AS rn FROM b_order_entities) WHERE rn = 1"""


@query("snapshot_merge", "IN-4", """
    WITH prev AS (SELECT * FROM b_latest_per_day WHERE dt <= DATE '1998-01-01'),
    snap AS (SELECT *, 0 AS source FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY dt DESC) AS r FROM prev) WHERE r = 1
             UNION ALL SELECT *, 0, 1 FROM b_latest_per_day WHERE dt > DATE '1998-01-01' AND dt <= DATE '2000-06-30')
    SELECT key, order_key, price, backup_timestamp, dt::VARCHAR AS dt FROM (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY COALESCE(backup_timestamp, -1) DESC, source, snap.dt) AS pick FROM snap)
    WHERE pick = 1""")
def snapshot_merge(b: Inputs):
    # One order per customer and day, so that the tie rules decide every case.
    orders = order_entities(b)
    days = readers.newest(orders.withColumn("id", F.struct("key", "dt")), "id", -F.col("order_key")).drop("id")
    prev = readers.newest(days.where("dt <= DATE'1998-01-01'"), "key", F.col("dt"))
    return readers.snapshot_merge(prev, days, "key", "backup_timestamp", "1998-01-01", "2000-06-30")


@query("current_view", "IN-4", """
    SELECT event_id, "user", dt::VARCHAR AS dt FROM b_events WHERE dt = (SELECT MAX(dt) FROM b_events)""")
def current_view(b: Inputs):
    return readers.current_view(b.events.select("event_id", "user", "dt"))


@query("key_sample_md5", "IN-5", """
    WITH h AS (SELECT *, md5(l_orderkey::VARCHAR) AS m FROM lineitem),
    a AS (SELECT *, ('0x' || substr(m, 1, 8))::BIGINT % 100 AS r1 FROM h),
    b AS (SELECT *, (r1 * 4294967296 + ('0x' || substr(m, 9, 8))::BIGINT) % 100 AS r2 FROM a),
    c AS (SELECT *, (r2 * 4294967296 + ('0x' || substr(m, 17, 8))::BIGINT) % 100 AS r3 FROM b),
    d AS (SELECT *, (r3 * 4294967296 + ('0x' || substr(m, 25, 8))::BIGINT) % 100 AS r4 FROM c)
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM d WHERE r4 <= 25""")
def key_sample_md5(b: Inputs):
    return readers.key_sample(b.table("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", fraction=0.25)


@query("key_sample_hash", "IN-5", """
    WITH h AS (SELECT *, md5(l_orderkey::VARCHAR) AS m FROM lineitem)
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM h WHERE ('0x' || substr(m, 25, 8))::BIGINT % 16 = 0""")
def key_sample_hash(b: Inputs):
    return readers.key_sample(b.table("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", buckets=16)


@query("partition_overwrite", "IN-6", """
    SELECT event_type, dt::VARCHAR AS dt, CASE WHEN dt >= DATE '2024-01-20' THEN -COUNT(*) ELSE COUNT(*) END AS n
    FROM b_events GROUP BY event_type, dt""")
def partition_overwrite(b: Inputs):
    path = sinks.new_folder(b.spark, "summary")
    counts = b.events.groupBy("event_type", "dt").agg(F.count(F.lit(1)).alias("n"))
    sinks.partition_overwrite(counts, path)
    late = counts.where("dt >= DATE'2024-01-20'").withColumn("n", -F.col("n"))
    sinks.partition_overwrite(late, path)
    return b.spark.read.parquet(path)


def order_report(b: Inputs):
    """Order rows as text cells; one status has no number in its price cell."""
    return b.table("orders").select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when(F.col("o_orderstatus") == "P", F.lit("\\N")).when(
            F.col("o_orderpriority") == "2-HIGH", F.lit("n/a")).otherwise(F.floor("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderstatus").alias("status"))


REPORT_TYPES = {"order_key": "bigint", "price": "bigint", "status": "string"}


@query("publish_report", "IN-7", """
    SELECT COUNT(*) FILTER (WHERE o_orderstatus = 'P' OR o_orderpriority <> '2-HIGH') AS saved,
           COUNT(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderpriority = '2-HIGH') AS errors FROM orders""")
def publish_report(b: Inputs):
    return sinks.publish_report(order_report(b), sinks.new_folder(b.spark, "report"), REPORT_TYPES, "replace", partition=["status"])


@query("publish_report_upsert", "IN-7", """
    SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN -1
           ELSE CAST(floor(o_totalprice) AS BIGINT) END AS price, o_orderstatus AS status
    FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority <> '2-HIGH'""")
def publish_report_upsert(b: Inputs):
    path = sinks.new_folder(b.spark, "report")
    rows = order_report(b)
    sinks.publish_report(rows, path, REPORT_TYPES, "upsert", key="order_key")
    changed = rows.where("status = 'F' AND price <> 'n/a'").withColumn("price", F.lit("-1"))
    sinks.publish_report(changed, path, REPORT_TYPES, "upsert", key="order_key")
    return sinks.read_report(b.spark, path)


@query("publish_report_partition", "IN-7", """
    SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN -1
           ELSE CAST(floor(o_totalprice) AS BIGINT) END AS price, o_orderstatus AS status
    FROM orders WHERE o_orderstatus IN ('P', 'F') OR o_orderpriority <> '2-HIGH'""")
def publish_report_partition(b: Inputs):
    path = sinks.new_folder(b.spark, "report")
    rows = order_report(b)
    sinks.publish_report(rows, path, REPORT_TYPES, "append", partition=["status"])
    again = rows.where("status = 'F'").withColumn("price", F.lit("-1"))
    sinks.publish_report(again, path, REPORT_TYPES, "replace_partition", partition=["status"])
    return sinks.read_report(b.spark, path)


@query("publish_report_versions", "IN-7", """
    SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS price, o_orderstatus AS status,
           (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '2-HIGH') AS errors
    FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority <> '2-HIGH'""")
def publish_report_versions(b: Inputs):
    """The second version of a report, with the number of its bad rows."""
    path = versions.new_folder(b.spark, "report")
    rows = order_report(b)
    versions.publish_version(rows.where("status = 'F'"), path, REPORT_TYPES)
    saved = versions.publish_version(rows, path, REPORT_TYPES)
    return versions.read_version(b.spark, path).withColumn("errors", saved.select("errors").scalar())


@query("overlap_dedupe", "IN-8", """
    SELECT event_id, "user", event_type, CASE WHEN dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN 2 ELSE 1 END AS fetched
    FROM b_events""")
def overlap_dedupe(b: Inputs):
    rows = b.events.select("event_id", "user", "event_type", "dt")
    first = rows.where("dt <= DATE'2024-01-12'").withColumn("fetched", F.lit(1))
    second = rows.where("dt >= DATE'2024-01-10'").withColumn(
        "fetched", F.when(F.col("dt") <= F.lit("2024-01-12").cast("date"), 2).otherwise(1))
    return readers.overlap_dedupe(first.unionByName(second), "event_id", "fetched").drop("dt")


@query("dimension_refresh", "IN-9", """
    SELECT event_id::VARCHAR AS key, props AS json FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30'""")
def dimension_refresh(b: Inputs):
    path = sinks.new_folder(b.spark, "dimension")
    export = b.table("events").select(
        F.col("event_id").cast("string").alias("key"), F.col("props").alias("json"), F.to_date("ts").alias("dt"))
    for day in ("2024-01-29", "2024-01-30"):
        sinks.dimension_refresh(readers.dimension_day(export, day), path)
    return b.spark.read.parquet(path)
