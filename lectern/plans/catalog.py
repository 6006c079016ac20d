"""Queries of the catalogue block.  Lists are shown joined by '|'."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import catalog as ops
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.registry import query


@query("split_explode", "CA-1", """
    SELECT unnest(string_split(text, chr(10))) AS value, doc_id::VARCHAR AS doc_id, COALESCE(lang, '') AS lang
    FROM documents WHERE text IS NOT NULL""")
def split_explode(b: Inputs):
    return ops.split_explode(b.table("documents"), "text", "\n", ["doc_id", "lang"], required=False)


@query("array_explode", "CA-2", "SELECT vec_id, label::BIGINT AS label, unnest(embedding)::DOUBLE AS value FROM embeddings")
def array_explode(b: Inputs):
    return ops.array_explode(b.table("embeddings"), "embedding", ["vec_id", "label"])


def topic_tree(b: Inputs):
    """Regions, nations and customers as a topic tree under a root that has no record."""
    region = b.table("region").select(
        F.concat(F.lit("r"), "r_regionkey").alias("key"), F.col("r_name").alias("title"), F.array(F.lit("root")).alias("ancestor_keys"))
    nation = b.table("nation").select(
        F.concat(F.lit("n"), "n_nationkey").alias("key"), F.col("n_name").alias("title"),
        F.array(F.concat(F.lit("r"), "n_regionkey"), F.lit("root")).alias("ancestor_keys"))
    customer = b.table("customer").join(b.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("c"), "c_custkey").alias("key"), F.col("c_name").alias("title"),
        F.array(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), F.lit("root")).alias("ancestor_keys"))
    return region.unionByName(nation).unionByName(customer)


SQL_INPUTS["b_topic_mapping"] = """
    SELECT 'r' || r_regionkey AS topic_key, r_name AS topic_title, 'root' AS ancestor_keys, r_name AS ancestor_titles,
           r_name AS t0, NULL AS t1, NULL AS t2 FROM region
    UNION ALL SELECT 'n' || n_nationkey, n_name, 'root|r' || n_regionkey, r_name || '|' || n_name, r_name, n_name, NULL
    FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'c' || c_custkey, c_name, 'root|r' || n_regionkey || '|n' || n_nationkey, r_name || '|' || n_name || '|' || c_name,
           r_name, n_name, c_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query("topic_mapping", "CA-3", "SELECT topic_key, topic_title, ancestor_keys, ancestor_titles FROM b_topic_mapping")
def topic_mapping(b: Inputs):
    return ops.topic_mapping(topic_tree(b)).withColumns({
        c: F.array_join(c, "|") for c in ("ancestor_keys", "ancestor_titles")})


def tagged_orders(b: Inputs):
    """Orders as videos filed under their customer and, if large, the customer's nation."""
    joined = b.table("orders").join(b.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("c"), "c_custkey", F.when(F.col("o_totalprice") > 250000, F.concat(F.lit("\tn"), "c_nationkey"))
                 .otherwise(F.lit("\tgone"))).alias("topic_string_keys"))


SQL_INPUTS["b_tagged_orders"] = """
    SELECT o_orderkey::VARCHAR AS vid_key, o_orderpriority AS vid_title, 'c' || c_custkey AS topic_key
    FROM orders JOIN customer ON o_custkey = c_custkey
    UNION ALL SELECT o_orderkey::VARCHAR, o_orderpriority, 'n' || c_nationkey
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 250000"""


@query("video_topic", "CA-4", """
    SELECT vid_key, vid_title, topic_key, topic_title, lower(topic_title) AS topic_desc FROM b_tagged_orders JOIN b_topic_mapping USING (topic_key)""")
def video_topic(b: Inputs):
    return ops.video_topic(tagged_orders(b), topic_tree(b).withColumn("description", F.lower("title")))


@query("video_topic_category", "CA-4", """
    SELECT DISTINCT vid_key, t1 AS top_category, t1 || '-' || t2 AS second_category FROM b_tagged_orders JOIN b_topic_mapping USING (topic_key)""")
def video_topic_category(b: Inputs):
    return ops.video_topic_category(video_topic(b), ops.topic_mapping(topic_tree(b)))


@query("topic_old_key_map", "CA-5", """
    SELECT lower(replace(p_name, ' ', '-')) AS slug, p_name AS title, p_brand || ' ' || p_name AS standalone_title,
           'old' || p_partkey AS old_key_name FROM part WHERE p_size > 10""")
def topic_old_key_map(b: Inputs):
    return ops.topic_old_key_map(b.table("part").select(
        F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("slug"), F.col("p_name").alias("title"),
        F.concat("p_brand", F.lit(" "), "p_name").alias("standalone_title"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("old"), "p_partkey")).alias("old_key_name")))


def topic_edges(b: Inputs):
    parts = b.table("part").select(F.col("p_brand").alias("parent"), F.col("p_name").alias("child"), F.lit("Exercise").alias("kind"))
    brands = b.table("part").select(F.col("p_type").alias("parent"), F.col("p_brand").alias("child"), F.lit("Topic").alias("kind"))
    return parts.unionByName(brands)


@query("exercise_topic_map", "CA-6", "SELECT DISTINCT p_brand AS topic, p_name AS exercise FROM part")
def exercise_topic_map(b: Inputs):
    return ops.exercise_topic_map(topic_edges(b))


@query("exercises_by_topic", "CA-6", """
    SELECT p_brand AS topic, string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS exercises FROM part GROUP BY 1""")
def exercises_by_topic(b: Inputs):
    return ops.exercises_by_topic(exercise_topic_map(b)).withColumn("exercises", F.array_join("exercises", "|"))


def cover_edges(b: Inputs):
    """Each part covers the part with half its key; large parts also cover the one with a third."""
    key = F.col("p_partkey")
    halves = b.table("part").select(key.alias("source"), F.floor(key / 2).cast("bigint").alias("target")).where("source > 0")
    thirds = b.table("part").where("p_size > 25").select(key.alias("source"), F.floor(key / 3).cast("bigint").alias("target"))
    return halves.unionByName(thirds).where("source > 0")


@query("cover_graph", "CA-7", """
    WITH RECURSIVE e AS (SELECT p_partkey AS s, p_partkey // 2 AS t FROM part WHERE p_partkey > 0
                         UNION SELECT p_partkey, p_partkey // 3 FROM part WHERE p_size > 25 AND p_partkey > 0),
    c AS (SELECT s, t, 1 AS d FROM e UNION SELECT c.s, e.t, c.d + 1 FROM c JOIN e ON c.t = e.s),
    l AS (SELECT s, MAX(d) + 1 AS level FROM c GROUP BY s),
    r AS (SELECT DISTINCT s AS node, t AS related, 'descendant' AS relation FROM c
          UNION ALL SELECT DISTINCT t, s, 'ancestor' FROM c
          UNION ALL SELECT s, t, 'covers' FROM e UNION ALL SELECT t, s, 'covered' FROM e)
    SELECT node, related, relation, COALESCE(level, 1)::BIGINT AS level FROM r LEFT JOIN l ON node = s""")
def cover_graph(b: Inputs):
    return ops.cover_graph(cover_edges(b))
