"""Readers: entity text, dated partitions, JSON fields, snapshots and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lectern.functions.columns import md5_mod
from lectern.functions.days import to_date


def entity_scan(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, order: str | None = "desc",
    limit: int | None = None, partition: str = "dt",
) -> DataFrame:
    """Entities of ``key<TAB>json`` text (``\\x01`` also separates), plain or gzip, in dated folders.

    ``limit`` keeps that many, from the newest day on (``order='desc'``) or from the oldest.
    """
    lines = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    cells = F.split("value", "[\t\x01]", 2)
    dated = partition in lines.columns
    rows = lines.select(
        F.get(cells, F.lit(0)).alias("key"), F.from_json(F.get(cells, F.lit(1)), schema).alias("doc"),
        *([F.col(partition).cast("date").alias(partition)] if dated else []))
    fields = [f"doc.{f.name}" for f in schema.fields if f.name != "key"]
    out = rows.select("key", *fields, *([partition] if dated else []))
    if limit is None:
        return out
    if not dated or order is None:
        return out.limit(limit)
    day = F.col(partition).desc() if order == "desc" else F.col(partition).asc()
    return out.orderBy(day, "key").limit(limit)


def date_range_scan(df: DataFrame, start: str, end: str, dt: str = "dt") -> DataFrame:
    """Rows of [start, end); on a table partitioned by ``dt`` only those folders are read."""
    return df.where((F.col(dt) >= F.lit(start).cast("date")) & (F.col(dt) < F.lit(end).cast("date")))


def json_project(df: DataFrame, json_col: str, fields: dict[str, str]) -> DataFrame:
    """Typed fields of a JSON column from one parse; missing, null and the text 'null' become NULL."""
    raw = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    parsed = df.withColumn("__doc", F.from_json(json_col, raw))
    out = [F.nullif(F.col("__doc")[name], F.lit("null")).try_cast(kind).alias(name) for name, kind in fields.items()]
    return parsed.select(*[c for c in df.columns if c != json_col and c not in fields], *out)


def newest(df: DataFrame, key: str | Sequence[str], order: Column) -> DataFrame:
    """The row with the greatest ``order`` per key, folded on the map side first."""
    keys = [key] if isinstance(key, str) else list(key)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), order).alias("__row"))
    return best.select(*[F.col("__row")[c].alias(c) for c in df.columns])


def snapshot_merge(prev: DataFrame, incr: DataFrame, key: str, ts: str, start: str, end: str, dt: str = "dt") -> DataFrame:
    """Previous snapshot and the increments of (start, end] merged to the newest row per key.

    A missing timestamp counts as -1; on a tie the snapshot wins, then the earlier increment.
    """
    fresh = incr.where((F.col(dt) > to_date(start)) & (F.col(dt) <= to_date(end)))
    both = prev.withColumn("__source", F.lit(0)).unionByName(fresh.withColumn("__source", F.lit(1)), allowMissingColumns=True)
    age = F.coalesce(F.datediff(F.col(dt), F.lit("1970-01-01").cast("date")), F.lit(0))
    stamp = F.coalesce(F.col(ts).cast("double"), F.lit(-1.0))
    return newest(both, key, F.struct(stamp, -F.col("__source"), -age)).drop("__source")


def current_view(df: DataFrame, as_of: str | None = None, dt: str = "dt") -> DataFrame:
    """The snapshot of ``as_of``, or the latest one."""
    if as_of is not None:
        return df.where(F.col(dt) == to_date(as_of))
    latest = df.agg(F.max(dt).alias(dt))  # a single row
    return df.join(F.broadcast(latest), dt, "left_semi")


def key_sample(df: DataFrame, key: str, *, buckets: int | None = None, fraction: float | None = None) -> DataFrame:
    """A stable sample by key: one of ``buckets`` hash buckets, or md5 % 100 <= fraction * 100.

    The comparison is inclusive, so a fraction of 0.5 keeps 51 of 100 residues.
    """
    if buckets is not None:
        return df.where(md5_mod(F.col(key).cast("string"), buckets) == 0)
    if fraction is None:
        raise ValueError("give buckets or fraction")
    return df.where(md5_mod(F.col(key).cast("string"), 100) <= fraction * 100)


def overlap_dedupe(df: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per key of fetches that overlap at their edges: the latest fetched."""
    return newest(df, key, F.struct(F.col(ts), F.struct(*[c for c in df.columns if c not in (key, ts)])))


def dimension_day(df: DataFrame, day: str, dt: str = "dt") -> DataFrame:
    """One day's full export of a small dimension."""
    return df.where(F.col(dt) == to_date(day)).drop(dt)
