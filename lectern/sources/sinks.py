"""Writers: dated partitions and the report store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from lectern.functions.columns import count_if
from lectern.session import new_folder
from lectern.sources.readers import newest

NULL_TEXT = "\\N"


def partition_overwrite(df: DataFrame, path: str, by: Sequence[str] = ("dt",)) -> None:
    """Replace exactly the partitions that ``df`` holds.

    Rows are gathered by partition value so that there are few files; adaptive execution splits a
    value with many rows over several tasks and joins small ones.
    """
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))


def dimension_refresh(df: DataFrame, path: str) -> None:
    """Replace a small dimension as a whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def typed_report(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns cast to their declared types, ``bad`` set on rows with a value that cannot be cast."""
    cells = {c: F.nullif(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in types}
    cast = {c: cells[c].try_cast(kind) for c, kind in types.items()}
    bad = F.lit(False)
    for c in types:
        bad = bad | (cells[c].isNotNull() & cast[c].isNull())
    return df.select(*[v.alias(c) for c, v in cast.items()], bad.alias("bad"))


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def merge_buckets(fresh: DataFrame, path: str, keys: Sequence[str], order: Column, buckets: int = 64, day: str | None = None) -> None:
    """Keep the row with the greatest ``order`` per key in a table split into hash buckets of the key.

    Only the buckets that ``fresh`` touches are read and rewritten, through a staged copy.  Merging the
    same rows twice gives the same table.  With ``day``, a time that is one of the keys, the table is split by
    calendar day instead, so days without fresh rows are left alone, however long the history.
    """
    spark = fresh.sparkSession
    place, value = ("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")) if day is None else ("day", F.to_date(day))
    rows = fresh.withColumn(place, value)
    if table_exists(spark, path):
        touched = rows.select(place).distinct()  # at most ``buckets`` rows, or one a calendar day
        rows = spark.read.parquet(path).join(F.broadcast(touched), place, "left_semi").unionByName(rows)
    staged = new_folder(spark, "merge")
    newest(rows, list(keys), order).write.parquet(staged)
    if not spark.read.parquet(staged).isEmpty():
        (spark.read.parquet(staged).hint("rebalance", place).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy(place).parquet(path))


def publish_report(
    df: DataFrame, path: str, types: dict[str, str], mode: str = "append", *, key: str | None = None,
    partition: Sequence[str] = (), buckets: int = 64,
) -> DataFrame:
    """Write a report and return one row (saved, errors).

    append             add rows
    replace            drop what is there
    replace_partition  drop only the partitions that the new rows hold
    upsert             new rows replace those with the same key; the store is split into ``buckets``
                       by key hash and only touched buckets are rewritten
    """
    spark = df.sparkSession
    typed = typed_report(df, types)
    good = typed.where("NOT bad").drop("bad")
    if mode == "append":
        good.write.mode("append").partitionBy(*partition).parquet(path)
    elif mode == "replace":
        good.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition).parquet(path)
    elif mode == "replace_partition":
        if not partition:
            raise ValueError("replace_partition needs partition columns")
        partition_overwrite(good, path, partition)
    elif mode == "upsert":
        if key is None:
            raise ValueError("upsert needs a key")
        # The write counter puts new rows above those in the store, whatever they hold.
        seen = spark.read.parquet(path).agg(F.max("written")).first()[0] if table_exists(spark, path) else 0
        merge_buckets(good.withColumn("written", F.lit((seen or 0) + 1).cast("bigint")), path, [key], F.struct("written", *good.columns), buckets)
    else:
        raise ValueError(f"unknown mode {mode}")
    return typed.agg(count_if(~F.col("bad")).alias("saved"), count_if(F.col("bad")).alias("errors"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a report; bucket and write counter of an upsert store are internal."""
    return spark.read.parquet(path).drop("bucket", "written")


def export_csv(df: DataFrame, path: str) -> None:
    """A headed CSV export, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)
