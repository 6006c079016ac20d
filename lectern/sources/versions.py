"""Tables kept as versions and deltas, so that readers see a whole state or the one before it.

A version is a folder of its own; it counts once a row of the manifest names it. That row is one small file which Spark's committer moves
into place at the end, so a job that fails on the way leaves readers the old version. One writer at a time.

A merged table is a base version and deltas after it: a batch writes its own rows only, readers take the newest row of
each key over both, and compaction makes a new base of what readers see.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lectern.session import new_folder
from lectern.sources.readers import newest
from lectern.sources.sinks import table_exists, typed_report

MANIFEST = "number long, folder string, saved long, errors long, upto long, schema string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The committed versions of the table at ``path``."""
    place = f"{path}/manifest"
    return spark.read.schema(MANIFEST).parquet(place) if table_exists(spark, place) else spark.createDataFrame([], MANIFEST)


def _last(spark: SparkSession, path: str, number: int | None = None):
    known = manifest(spark, path)
    return (known if number is None else known.where(F.col("number") == number)).orderBy(F.desc("number")).first()


def _commit(df: DataFrame, path: str, folder: str, saved: int, errors: int, upto: int | None = None) -> DataFrame:
    """Name ``folder``, which holds the rows of ``df``, as the next version."""
    spark = df.sparkSession
    last = _last(spark, path)
    row = spark.createDataFrame([(last["number"] + 1 if last else 1, folder, saved, errors, upto, df.schema.json())], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return row


def publish_version(df: DataFrame, path: str, types: dict[str, str]) -> DataFrame:
    """Write a report (text cells cast to ``types``) as a new version; one row (number, folder, saved, errors).

    Rows with a bad cell are kept beside the good ones, under bad=true, and counted from the files written, so the report
    is worked out once.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "version")
    typed = typed_report(df, types)
    typed.write.partitionBy("bad").parquet(folder)
    counts = spark.read.schema(typed.schema).parquet(folder).agg(F.count_if(~F.col("bad")), F.count_if("bad")).first()
    return _commit(typed, path, folder, *counts).drop("upto", "schema")


def read_version(spark: SparkSession, path: str, number: int | None = None, bad: bool = False) -> DataFrame:
    """The good (or the bad) rows of a version, by default the newest."""
    last = _last(spark, path, number)
    if last is None:
        raise ValueError(f"no version {'yet' if number is None else number} at {path}")
    rows = spark.read.schema(T.StructType.fromJson(json.loads(last["schema"]))).parquet(last["folder"])
    return rows.where(F.col("bad") == bad).drop("bad")


def write_delta(batch: DataFrame, batch_id: int, path: str) -> None:
    """Add a batch's rows; what is written grows with the batch alone, and a repeated batch replaces its own rows."""
    (batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/deltas"))


def read_merged(spark: SparkSession, path: str, keys: Sequence[str], ts: str, deleted: str | None = None) -> DataFrame:
    """The newest row of each key over the base and the deltas after it; on equal times the one that sorts last.

    A key whose newest row is marked ``deleted`` is left out.
    """
    last = _last(spark, path)
    deltas = spark.read.parquet(f"{path}/deltas")
    rows = deltas.where(F.col("batch") > last["upto"]).drop("batch") if last else deltas.drop("batch")
    if last:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(last["folder"]))
    rest = [c for c in rows.columns if c not in (*keys, ts)]
    merged = newest(rows, list(keys), F.struct(F.col(ts), F.struct(*rest)))
    return merged.where(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else merged


def compact(spark: SparkSession, path: str, keys: Sequence[str], ts: str, deleted: str | None = None) -> DataFrame:
    """Make a new base of the merged rows; later reads leave its deltas alone. Rows that come later with an older time than a deletion bring a key back."""
    upto = spark.read.parquet(f"{path}/deltas").agg(F.max("batch")).first()[0]
    folder = new_folder(spark, "base")
    merged = read_merged(spark, path, keys, ts, deleted)
    merged.write.parquet(folder)
    return _commit(merged, path, folder, spark.read.schema(merged.schema).parquet(folder).count(), 0, upto)
