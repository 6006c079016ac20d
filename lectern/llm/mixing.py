"""Mixing sources to target weights by systematic sampling.

Each source has a target, in words. A document's expected copies are target / source size, the same
for all documents of a source. Documents of a source are put in order (size, then a hash of the id),
their expected copies are summed along that order, one random offset of the source is added, and a
document is emitted once for each integer that its stretch of the sum crosses. Order by size makes the
words taken follow the target closely. The offset follows from a seed, so reruns agree.

Nothing here sees a whole source at once: places in the order come from counts per (source, size,
hash prefix), and only such small groups are numbered row by row.

Defined results: a null text has size 0; null sources form a source of their own, last in the order;
a source without any word has target 0 and no copies; repeated rows are separate documents; an empty
table gives an empty result. Input columns that clash with an added one are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Target of each source from ``sizes`` (source, source_size), which has one row per source.

    Sources by code point, null last, weigh ``weights`` in turn. A target stops at ``most`` times its
    source's size, and what is over goes to the others by weight: with sources sorted by cap / weight
    those that are full come first, so the level of the rest follows from running sums.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    weighed = sizes.select("source", "source_size", weight.cast("bigint").alias("weight"), turn.alias("turn"))
    fill = Window.orderBy(F.col("source_size") * float(most) / F.col("weight"), "turn")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    levelled = weighed.withColumn("level", left / F.sum("weight").over(after).cast("double"))
    open_level = F.when(F.col("source_size") * float(most) > F.col("level") * F.col("weight"), F.col("level"))
    filled = levelled.withColumn("level", F.first(open_level, ignorenulls=True).over(everything))
    cap = F.col("source_size") * float(most)
    return filled.select(
        "source", "source_size", F.coalesce(F.least(cap, F.col("level") * F.col("weight")), F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED,
        keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with size, source_size, target, copies and taken.

    ``copies`` is how often the document is emitted, ``taken`` its words times that.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept], word_count(F.col("text")).alias("size"), key.alias("_key"),
        F.md5(named.cast("binary")).alias("_order"), named.alias("_name"), F.col("source").alias("_source"))
    bucket = F.substring("_order", 1, 2)

    counts = rows.groupBy("_key", "size", bucket.alias("_bucket")).agg(
        F.count("*").alias("_n"), F.first("_source", ignorenulls=True).alias("_source"))
    by_size = counts.groupBy("_key", "size").agg(F.sum("_n").alias("_n"), F.first("_source", ignorenulls=True).alias("source"))
    sources = by_size.groupBy("_key").agg(
        F.sum(F.col("_n") * F.col("size")).alias("source_size"), F.first("source", ignorenulls=True).alias("source"))
    aims = targets(sources.select("source", "source_size"), weights, most).withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    up_to = Window.partitionBy("_key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_key", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = by_size.select("_key", "size", F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_smaller"))
    starts = (
        counts.select("_key", "size", "_bucket", F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_earlier"))
        .join(sizes, ["_key", "size"]).join(aims.select("_key", "source_size", "target"), "_key")
        .select("_key", "size", "_bucket", (F.col("_smaller") + F.col("_earlier")).alias("_start"), "source_size", "target"))

    place = F.row_number().over(Window.partitionBy("_key", "size", "_bucket").orderBy("_order", "_name")) + F.col("_start")
    offset = (F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("_key")).cast("binary")), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    numbered = (
        rows.withColumn("_bucket", bucket).join(starts, ["_key", "size", "_bucket"])
        .withColumn("_place", place.cast("bigint")).withColumn("_each", each).withColumn("_offset", offset))
    crossed = F.floor(F.col("_place") * F.col("_each") + F.col("_offset")) - F.floor((F.col("_place") - 1) * F.col("_each") + F.col("_offset"))
    return numbered.withColumn("copies", crossed.cast("bigint")).select(
        *[F.col(f"`{c}`") for c in kept], "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document once per copy, with its number ``copy`` from 1."""
    mixed = mix(docs, **options).where("copies > 0")
    kept = [c for c in mixed.columns if c.lower() != "copy"]
    return mixed.select(*[F.col(f"`{c}`") for c in kept], F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))


SQL = """
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         coalesce('=' || source, '') AS k, coalesce(CAST(doc_id AS VARCHAR), '') AS name
  FROM documents),
sources AS (SELECT k, max(source) AS source, sum(size)::BIGINT AS s FROM rows GROUP BY k),
turns AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM sources),
weighed AS (SELECT *, turn % 3 + 1 AS w FROM turns),
levels AS (
  SELECT *, s * 3.0::DOUBLE / w AS fill,
    (sum(s) OVER () - 3 * coalesce(sum(s) OVER (ORDER BY s * 3.0::DOUBLE / w, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / (sum(w) OVER (ORDER BY s * 3.0::DOUBLE / w, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed),
lvl AS (SELECT level FROM levels WHERE s * 3.0::DOUBLE > level * w ORDER BY fill, turn LIMIT 1),
aims AS (
  SELECT k, s, coalesce(least(s * 3.0::DOUBLE, (SELECT level FROM lvl) * w), 0.0::DOUBLE) AS target,
    (CAST('0x' || substr(md5('mix' || k), 1, 8) AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u
  FROM levels),
placed AS (
  SELECT r.doc_id, r.size, a.s, a.target, a.u, CASE WHEN a.s > 0 THEN a.target / a.s::DOUBLE ELSE 0.0::DOUBLE END AS each,
    row_number() OVER (PARTITION BY r.k ORDER BY r.size, md5(r.name), r.name) AS place
  FROM rows r JOIN aims a ON r.k = a.k)
SELECT doc_id, size, s AS source_size, target,
  size * (floor(place * each + u) - floor((place - 1) * each + u))::BIGINT AS taken
FROM placed
"""
