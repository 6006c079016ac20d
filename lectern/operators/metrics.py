"""Operational metrics: usage reports, time series and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.columns import significant
from lectern.functions.ordered import scan_groups
from lectern.functions.quantile import exact_quantiles


def usage_report_load(spark, path: str, since: str) -> DataFrame:
    """Usage rows (dt, key, value) of headed CSV files with Date, Name, Unit, Used.

    Names lose everything from the first sign that is neither word nor space and become snake case;
    numbers lose their thousands separators.
    """
    rows = spark.read.option("header", True).schema("Date string, Name string, Unit string, Used string").csv(path)
    name = F.lower(F.regexp_replace(F.trim(F.regexp_replace("Name", r"[^\w\s].*", "")), r"\s+", "_"))
    return rows.where(F.col("Date") >= since).select(
        F.to_date("Date").alias("dt"), name.alias("key"), F.replace("Used", F.lit(","), F.lit("")).cast("double").alias("value"))


def usage_by_week(usage: DataFrame, name: str, group: str = "week", complete_only: bool = False) -> DataFrame:
    """Usage of one resource per day, or per week labelled by its Monday; ``complete_only`` keeps weeks
    with all seven days."""
    rows = usage.where(F.col("key") == name)
    if group == "day":
        return rows.select("dt", F.col("value").alias("used"))
    weeks = rows.groupBy(F.date_trunc("week", "dt").cast("date").alias("week")).agg(
        F.sum("value").alias("used"), F.countDistinct("dt").alias("days"))
    if complete_only:
        weeks = weeks.where("days = 7")
    return weeks.select(F.col("week").alias("dt"), "used")


def week_bounds(df: DataFrame, date: str) -> DataFrame:
    """The Sunday on or before a date and the one after it."""
    end = F.next_day(date, "SUN")
    return df.withColumns({"week_start": F.date_sub(end, 7), "week_end": end})


def series_by_time(points: DataFrame, names: Sequence[str], start: float | None = None, digits: int = 4) -> DataFrame:
    """Points (name, t, value) laid side by side per t after ``start``, to ``digits`` significant digits."""
    rows = points if start is None else points.where(F.col("t") > start)
    return rows.groupBy("t").agg(*[
        F.max(F.when(F.col("name") == n, significant(F.col("value").cast("double"), digits))).alias(n) for n in names])


def counter_hit_rate(samples: DataFrame, keys: Sequence[str] = (), chunk: Column | None = None) -> DataFrame:
    """Hit rate in percent between consecutive samples of cumulative hit and miss counters."""
    chunk = F.floor(F.col("t") / 86400) if chunk is None else chunk
    steps = scan_groups(samples, keys, ["t"], chunk, lags={"h0": "hits", "m0": "misses"}).where("h0 IS NOT NULL")
    hits, misses = F.col("hits") - F.col("h0"), F.col("misses") - F.col("m0")
    return steps.select(*keys, "t", (hits * 100.0 / F.when(hits + misses != 0, hits + misses)).alias("hit_pct"))


def weighted_mean(df: DataFrame, weight: str, fields: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Total weight and weighted means of the fields."""
    total = F.sum(weight)
    return df.groupBy(*keys).agg(
        total.alias(weight), *[(F.sum(F.col(weight) * F.col(f)) / F.when(total != 0, total)).alias(f) for f in fields])


def median_record(df: DataFrame, fields: Sequence[str], keys: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """Median of each field per key; an even number of values gives the mean of the middle two."""
    tall = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("v")) for f in fields])).alias("c")).select(*keys, "c.*")
    picked = exact_quantiles(tall, [*keys, "field"], "v", {"median": 0.5}, width=width)
    return picked.groupBy(*keys).agg(*[F.max(F.when(F.col("field") == f, F.col("median"))).alias(f) for f in fields])


def collate_records(df: DataFrame, fixed: Sequence[str], key: str, value: str, order: str, names: Sequence[str] | None = None) -> DataFrame:
    """Records with the same fixed fields as one, a column per varying key; the last value wins.

    ``names`` lists the columns; without it Spark first looks up the distinct keys.
    """
    grouped = df.groupBy(*fixed)
    pivoted = grouped.pivot(key, list(names)) if names is not None else grouped.pivot(key)
    return pivoted.agg(F.max_by(value, order))


def metric_history(df: DataFrame, time: str, limit: int) -> DataFrame:
    """The newest records of a series, newest first; equal times go by the other columns."""
    return df.orderBy(F.col(time).desc(), *[F.col(f"`{c}`") for c in df.columns if c != time]).limit(limit)
