"""Exact rank statistics from value counts, so that no group's values meet in one buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.ordered import scan_groups

# Chunks of the value axis: so many between powers of e, and so many from a group's least to its greatest value.
PER_POWER, PER_GROUP = 512, 4096


def value_chunk(value: Column, low: Column, high: Column) -> Column:
    """A chunk that never falls as ``value`` grows: its sign, its size on a logarithmic scale, and its place
    between ``low`` and ``high``.  The second parts values over many powers of ten, the third those close together."""
    x, size = value.cast("double"), F.abs(value.cast("double"))
    power = F.floor(F.log(F.nullif(size, F.lit(0.0))) * PER_POWER)
    place = F.floor((x - low) / F.nullif(high - low, F.lit(0.0)) * PER_GROUP)
    return F.struct(
        F.signum(x).alias("sign"), F.coalesce(F.when(x < 0, -power).otherwise(power), F.lit(0)).alias("power"),
        F.coalesce(place, F.lit(0)).alias("place"))


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, width: float | None = None) -> DataFrame:
    """One row per (keys, distinct value): n, last (rank of its last copy, 1-based) and total."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    if width is not None:
        chunk = F.floor(F.col(value) / F.lit(float(width)))
    else:
        whole = F.struct(*keys) if keys else F.lit(0)
        ends = counts.groupBy(whole.alias("__of")).agg(
            F.min(F.col(value).cast("double")).alias("__low"), F.max(F.col(value).cast("double")).alias("__high"))
        counts = counts.withColumn("__of", whole).join(ends if keys else F.broadcast(ends), "__of")  # without keys a single row
        chunk = value_chunk(F.col(value), F.col("__low"), F.col("__high"))
    ranks = scan_groups(counts, keys, [value], chunk, sums={"last": F.col("n")}, group_sums={"total": F.col("n")}, null_keys=True)
    return ranks.drop("__of", "__low", "__high")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, qs: dict[str, float], *, width: float | None = None, interpolate: bool = True
) -> DataFrame:
    """Quantiles per key.  ``interpolate`` gives the linear rule, otherwise the value at floor((n-1)q).

    ``width`` is the span of one chunk of the value axis and affects the work split only; without it chunks follow the data.
    """
    ranks = value_ranks(df, keys, value, width)
    aggs = []
    for name, q in qs.items():
        at = (F.col("total") - 1) * F.lit(float(q))
        low, high = F.floor(at + F.lit(1e-9)), F.ceil(at - F.lit(1e-9))
        for tag, pos in (("lo", low), ("hi", high)):
            holds = (pos < F.col("last")) & (pos >= F.col("last") - F.col("n"))
            aggs.append(F.max(F.when(holds, F.col(value))).alias(f"__{tag}_{name}"))
        aggs.append(F.max(at - low).alias(f"__w_{name}"))
    picked = ranks.groupBy(*keys).agg(*aggs)
    out = []
    for name in qs:
        lo, hi = F.col(f"__lo_{name}").cast("double"), F.col(f"__hi_{name}").cast("double")
        weight = F.greatest(F.col(f"__w_{name}"), F.lit(0.0))
        out.append((lo + (hi - lo) * weight if interpolate else lo).alias(name))
    return picked.select(*keys, *out)
