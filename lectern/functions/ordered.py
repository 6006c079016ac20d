"""Ordered-group windows that never hold a whole group in one task.

``Window.partitionBy(key)`` sends every row of a key to one task, so a key that owns a third
of the rows stops the job.  Here a group is cut into *chunks* (a bucket of its order key: a
hour, a range of numbers).  One map-side combined aggregate gives each chunk's totals
and its edge rows, a small window carries them along the chunks of a key, and the row windows
run inside (key, chunk).  Results equal those of the plain window, because chunks follow the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.session import cut_lineage

CHUNK = "__chunk"


def scan_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    *,
    number: str | None = None,
    sums: dict[str, Column] | None = None,
    lags: dict[str, str] | None = None,
    leads: dict[str, str] | None = None,
    last_known: dict[str, tuple[Column, Column]] | None = None,
    group_sums: dict[str, Column] | None = None,
    firsts: dict[str, str] | None = None,
    lasts: dict[str, str] | None = None,
    null_keys: bool = False,
) -> DataFrame:
    """Add ordered columns to ``df``; rows with a NULL key belong to no group and are left out, unless
    ``null_keys`` makes NULL a key like any other.

    ``order`` must be unique inside a group and ``chunk`` must not decrease along it.

    number       1-based position in the group
    sums         running sum up to and including the row
    lags, leads  value of a column on the row before / after
    last_known   ``(value, condition)``: value on the nearest earlier row that meets the condition
    group_sums   sum over the whole group
    firsts, lasts  value of a column on the first / last row of the group
    """
    if null_keys and keys:
        # A struct that holds NULL is not NULL itself, so grouping and joining on it keep such rows.
        wrapped = df.withColumn("__key", F.struct(*keys))
        return scan_groups(
            wrapped, ["__key"], order, chunk, number=number, sums=sums, lags=lags, leads=leads, last_known=last_known,
            group_sums=group_sums, firsts=firsts, lasts=lasts).drop("__key")
    sums, lags, leads = dict(sums or {}), dict(lags or {}), dict(leads or {})
    last_known, group_sums = dict(last_known or {}), dict(group_sums or {})
    firsts, lasts = dict(firsts or {}), dict(lasts or {})
    keys, order = list(keys), list(order)
    rank = F.struct(*order)

    tagged = df.withColumn(CHUNK, chunk)
    for name, value in {**sums, **group_sums}.items():
        tagged = tagged.withColumn(f"__v_{name}", value)
    for name, (value, condition) in last_known.items():
        tagged = tagged.withColumn(f"__k_{name}", F.when(condition, F.struct(value.alias("v"))))

    edge_last = sorted(set(lags.values()) | set(lasts.values()))
    edge_first = sorted(set(leads.values()) | set(firsts.values()))
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.sum(f"__v_{name}").alias(f"__s_{name}") for name in {**sums, **group_sums}]
    if edge_last:
        aggs.append(F.max_by(F.struct(*edge_last), rank).alias("__last"))
    if edge_first:
        aggs.append(F.min_by(F.struct(*edge_first), rank).alias("__first"))
    for name in last_known:
        marked = F.col(f"__k_{name}")
        aggs.append(F.max_by(marked, F.when(marked.isNotNull(), rank)).alias(f"__e_{name}"))
    summary = tagged.groupBy(*keys, CHUNK).agg(*aggs)

    along = Window.partitionBy(*keys).orderBy(CHUNK)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = [F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off")]
    carried += [F.sum(f"__s_{n}").over(earlier).alias(f"__o_{n}") for n in sums]
    carried += [F.sum(f"__s_{n}").over(whole).alias(n) for n in group_sums]
    if lags:
        carried.append(F.lag("__last").over(along).alias("__before"))
    if leads:
        carried.append(F.lead("__first").over(along).alias("__after"))
    carried += [F.last(f"__e_{n}", ignorenulls=True).over(earlier).alias(f"__c_{n}") for n in last_known]
    carried += [F.first(F.col("__first")[c]).over(whole).alias(n) for n, c in firsts.items()]
    carried += [F.last(F.col("__last")[c]).over(whole).alias(n) for n, c in lasts.items()]
    carry = summary.select(*keys, CHUNK, *carried)

    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = []
    if number:
        local.append(F.row_number().over(inside).alias("__rn"))
    local += [F.sum(f"__v_{n}").over(upto).alias(f"__l_{n}") for n in sums]
    local += [F.lag(F.struct(c)).over(inside).alias(f"__p_{n}") for n, c in lags.items()]
    local += [F.lead(F.struct(c)).over(inside).alias(f"__f_{n}") for n, c in leads.items()]
    local += [F.last(f"__k_{n}", ignorenulls=True).over(before).alias(f"__b_{n}") for n in last_known]
    rows = tagged.select("*", *local).join(carry, [*keys, CHUNK], "inner")

    out = [F.col(c) for c in df.columns]
    if number:
        out.append((F.col("__rn") + F.col("__off")).alias(number))
    for n in sums:
        total = F.coalesce(F.col(f"__l_{n}"), F.lit(0)) + F.coalesce(F.col(f"__o_{n}"), F.lit(0))
        out.append(total.alias(n))
    out += [F.when(F.col(f"__p_{n}").isNotNull(), F.col(f"__p_{n}")[c]).otherwise(F.col("__before")[c]).alias(n)
            for n, c in lags.items()]
    out += [F.when(F.col(f"__f_{n}").isNotNull(), F.col(f"__f_{n}")[c]).otherwise(F.col("__after")[c]).alias(n)
            for n, c in leads.items()]
    out += [F.coalesce(F.col(f"__b_{n}"), F.col(f"__c_{n}"))["v"].alias(n) for n in last_known]
    out += [F.col(n) for n in [*group_sums, *firsts, *lasts]]
    return rows.select(*out)


def hour_chunk(ts: str) -> Column:
    """Chunks of one hour for groups ordered by a timestamp: a key that fills a one-day input alone is
    still cut into 24."""
    return F.date_trunc("hour", F.col(ts))


def epoch_hour_chunk(seconds: str) -> Column:
    """Chunks of one hour for groups ordered by epoch seconds."""
    return F.floor(F.col(seconds) / 3600)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows per key; Spark limits each group before the shuffle."""
    name = rank or "__rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def number_all(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``, the place of each row (from 0) in the unique ``order`` of all rows.

    Rows are sorted into ranges whose bounds Spark takes from the data; each range is numbered by itself, and
    the sizes of the ranges before it are added.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    placed = cut_lineage(ranged).withColumns({"__part": F.shiftright("__id", 33), "__row": F.col("__id").bitwiseAND((1 << 33) - 1)})
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per task
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return placed.join(offsets, "__part").withColumn(name, F.col("__off") + F.col("__row")).drop("__id", "__part", "__row", "__off")
