"""Catalogue and hierarchy: videos, topics, exercises and the covers graph."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lectern.session import cut_lineage, tasks_for, tasks_of


def split_explode(df: DataFrame, field: str, delim: str, carry: Sequence[str], required: bool = True) -> DataFrame:
    """One row per part of a delimited field; a carried NULL becomes ''.

    A missing field is an error when ``required``, otherwise the row is left out.
    """
    text = F.col(field)
    if required:
        text = F.when(text.isNotNull(), text).otherwise(F.raise_error(F.lit(f"{field} is missing")).cast("string"))
    else:
        df = df.where(text.isNotNull())
    parts = F.split(text, "\\Q" + delim + "\\E")
    carried = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in carry]
    return df.select(F.explode(parts).alias("value"), *carried)


def array_explode(df: DataFrame, field: str, carry: Sequence[str]) -> DataFrame:
    """One row per array element; an empty or missing array gives none."""
    return df.select(*carry, F.explode(field).alias("value"))


def topic_mapping(topics: DataFrame) -> DataFrame:
    """Per topic its ancestors from generic to specific: all keys, and the titles of the known ones
    followed by the topic's own.  The lists are as long as the tree is deep."""
    named = topics.where("ancestor_keys IS NOT NULL").select(
        "key", "title", F.reverse("ancestor_keys").alias("ancestor_keys"))
    steps = named.select("key", F.posexplode("ancestor_keys").alias("pos", "ancestor"))
    titles = topics.select(F.col("key").alias("ancestor"), F.col("title").alias("ancestor_title"))
    found = steps.join(titles, "ancestor").groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("pos", "ancestor_title"))).alias("found"))
    known = F.coalesce(F.transform("found", lambda s: s["ancestor_title"]), F.array().cast("array<string>"))
    return named.join(found, "key", "left").select(
        F.col("key").alias("topic_key"), F.col("title").alias("topic_title"), "ancestor_keys",
        F.concat(known, F.array("title")).alias("ancestor_titles"))


def video_topic(videos: DataFrame, topics: DataFrame, delim: str = "\t") -> DataFrame:
    """Video and topic pairs from the videos' delimited topic keys."""
    pairs = split_explode(videos, "topic_string_keys", delim, ["key", "title"], required=False)
    info = topics.select(
        F.col("key").alias("topic_key"), F.col("title").alias("topic_title"), F.col("description").alias("topic_desc"))
    return pairs.select(
        F.col("value").alias("topic_key"), F.col("key").alias("vid_key"), F.col("title").alias("vid_title"),
    ).join(info, "topic_key").select("vid_key", "vid_title", "topic_key", "topic_title", "topic_desc")


def video_topic_category(pairs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Top and second category of each video: levels 1 and 2 of its topics' title paths."""
    top, second = F.get("ancestor_titles", F.lit(1)), F.get("ancestor_titles", F.lit(2))
    return pairs.join(mapping.select("topic_key", "ancestor_titles"), "topic_key", "left").select(
        "vid_key", top.alias("top_category"), F.concat(top, F.lit("-"), second).alias("second_category")).distinct()


def topic_old_key_map(topics: DataFrame) -> DataFrame:
    """Names of the topics that carry a legacy key."""
    return topics.where("old_key_name IS NOT NULL").select("slug", "title", "standalone_title", "old_key_name")


def exercise_topic_map(edges: DataFrame, kind: str = "Exercise") -> DataFrame:
    """(topic, exercise) pairs of the tree edges that lead to an exercise."""
    return edges.where(F.col("kind") == kind).select(
        F.col("parent").alias("topic"), F.col("child").alias("exercise")).distinct()


def exercises_by_topic(pairs: DataFrame) -> DataFrame:
    """Topics with the sorted list of their exercises."""
    return pairs.groupBy("topic").agg(F.array_sort(F.collect_set("exercise")).alias("exercises"))


def _joined(ways: DataFrame, more: DataFrame, tasks: int) -> DataFrame:
    """Pairs that a way and another from its target on lead between; a task has at most the ways to its nodes beyond its share."""
    first, second = ways.repartition(tasks, "target").alias("a"), more.repartition(tasks, "source").alias("b")
    return first.join(second, F.col("a.target") == F.col("b.source")).select("a.source", "b.target")


def _number(ways: DataFrame, more: DataFrame) -> int:
    """Rows of ``_joined``, from the ways to and from each node."""
    first = ways.groupBy(F.col("target").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    second = more.groupBy(F.col("source").alias("node")).agg(F.count(F.lit(1)).alias("m"))
    return first.join(second, "node").agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0


def _distinct(pairs: DataFrame, rows: int) -> DataFrame:
    """The distinct ones of so many pairs as a written table."""
    return cut_lineage(pairs.repartition(tasks_of(rows), "source", "target").distinct())


def _doubled(direct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The transitive closure (source, target) of a DAG and, for nodes with a way on, the length of their longest (node, height).

    Round k holds the pairs that 2^k steps lead between (``leaps``), the pairs that fewer steps do and the longest ways
    of fewer steps. A longer way is a leap and a shorter way, so each round doubles the length and the
    number of rounds is the logarithm of the longest way; a pair is found once from each way's length at most.
    """
    leaps, length = direct, 1
    closure = heights = None
    while True:
        after = leaps.select(F.col("source").alias("node"), F.lit(length).alias("height"))
        near, rows = leaps, leaps.count()
        if closure is not None:
            known = closure.count()
            tasks, rows = tasks_of(max(known, rows)), rows + known + _number(closure, leaps)
            near = near.unionByName(closure).unionByName(_joined(closure, leaps, tasks))
            way = leaps.join(heights.withColumnRenamed("node", "target"), "target").select(F.col("source").alias("node"), (F.col("height") + length).alias("height"))
            after = after.unionByName(way).unionByName(heights)
        closure = _distinct(near, rows)
        heights = cut_lineage(after.groupBy("node").agg(F.max("height").alias("height")))
        if not closure.where("source = target").isEmpty():
            raise ValueError(f"the graph has a cycle: {', '.join(map(str, _one_cycle(closure)))}")
        leaps = _distinct(_joined(leaps, leaps, tasks_for(leaps)), _number(leaps, leaps))
        length *= 2
        if leaps.isEmpty():
            return closure, heights


def _one_cycle(closure: DataFrame, most: int = 20) -> list:
    """Nodes of the strongly connected component of the smallest node on a cycle, the first ``most`` of them."""
    first = closure.where("source = target").agg(F.min("source")).scalar()
    there = closure.where(F.col("source") == first).select(F.col("target").alias("node"))
    back = closure.where(F.col("target") == first).select(F.col("source").alias("node"))
    return [r["node"] for r in there.join(back, "node").distinct().orderBy("node").limit(most).collect()]


def cover_graph(edges: DataFrame) -> DataFrame:
    """Direct and transitive relations of a DAG, with the level of each node.

    The closure grows by doubling, see ``_doubled``.  A way that leads back to its start is a
    cycle, which is an error that names it; an edge from a node to itself is left out.  A node's level is its longest
    downstream path plus one.
    """
    direct = cut_lineage(edges.select("source", "target").where("source <> target").distinct())
    if direct.isEmpty():
        return direct.select(
            F.col("source").alias("node"), F.col("target").alias("related"), F.lit("covers").alias("relation"),
            F.lit(1).alias("level"))
    closure, heights = _doubled(direct)

    def relations(pairs: DataFrame, down: str, up: str) -> DataFrame:
        either = F.array(
            F.struct(F.col("source").alias("node"), F.col("target").alias("related"), F.lit(down).alias("relation")),
            F.struct(F.col("target").alias("node"), F.col("source").alias("related"), F.lit(up).alias("relation")))
        return pairs.select(F.explode(either).alias("r")).select("r.*")

    related = relations(closure, "descendant", "ancestor").unionByName(relations(direct, "covers", "covered"))
    levels = heights.select("node", (F.col("height") + 1).alias("level"))
    # Both directions of all pairs; a node's rows are at most the nodes.
    related = related.repartition(tasks_for(closure, 2) + tasks_for(direct, 2), "node")
    return related.join(levels, "node", "left").select(
        "node", "related", "relation", F.coalesce("level", F.lit(1)).alias("level"))
