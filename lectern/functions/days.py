"""Day series from edges.  An edge is (metric, dt, d): the metric's level changes by d on day dt.

Edges are summed per day before they are shuffled, so a series costs as many rows as there are
calendar days, whatever the number of intervals and however long they are.  An edge with d = 0
marks a day from which the series is reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def to_date(value: str | Column) -> Column:
    return F.to_date(F.lit(value)) if isinstance(value, str) else value


def edge(metric: str, dt: Column, d: int) -> Column:
    return F.struct(F.lit(metric).alias("metric"), dt.alias("dt"), F.lit(d).alias("d"))


def daily_levels(edges: DataFrame, names: Sequence[str], end: str) -> DataFrame:
    """One row per day, from the first edge to ``end`` exclusive, with the level of each metric.

    A metric is NULL before its first edge.  The window runs over one row per calendar day.
    """
    deltas = edges.groupBy("dt").pivot("metric", list(names)).agg(F.sum("d"))
    along = Window.partitionBy(F.lit(0)).orderBy("dt")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    steps = deltas.select(
        "dt", F.least(F.lead("dt").over(along), to_date(end)).alias("until"),
        *[F.sum(F.col(f"`{n}`")).over(upto).alias(n) for n in names],
    ).withColumn("until", F.coalesce("until", to_date(end))).where("dt < until")
    return steps.withColumn("dt", F.explode(F.sequence("dt", F.date_sub("until", 1)))).drop("until")
