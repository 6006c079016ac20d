"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def clamp(col: Column | str, low: float, high: float) -> Column:
    """``col`` limited to [low, high]; NULL stays NULL."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col)))


def count_if(condition: Column) -> Column:
    """Number of rows for which ``condition`` holds, 0 for an empty group."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))


def any_true(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, NULL when ``whole`` is 0 (no ANSI error)."""
    return part.cast("double") / F.when(whole != 0, whole.cast("double"))


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def bucket_end_anchored(day: Column, end: Column, days: int) -> Column:
    """Label of the ``days``-long bucket holding ``day``: ``end`` less a whole number of buckets."""
    return F.date_sub(end, (F.floor(F.datediff(end, day) / F.lit(days)) * days).cast("int"))


def md5_mod(text: Column, modulus: Column | int) -> Column:
    """The 128-bit md5 of ``text`` modulo ``modulus`` (below 2^31), folded 32 bits at a time."""
    digest = F.md5(text.cast("binary"))
    m = F.lit(modulus).cast("bigint") if isinstance(modulus, int) else modulus.cast("bigint")
    rest = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        part = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        rest = (rest * F.lit(4294967296) + part) % m
    return rest


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text as an integer; NULL when it is not four parts."""
    parts = F.split(ip, r"\.")
    octet = [F.try_element_at(parts, F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    value = octet[0] * 16777216 + octet[1] * 65536 + octet[2] * 256 + octet[3]
    return F.when(F.size(parts) == 4, value)


def significant(col: Column, digits: int) -> Column:
    """``col`` rounded to ``digits`` significant digits."""
    size = F.floor(F.log10(F.abs(col)))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - size)
    return F.when(col == 0, F.lit(0.0)).otherwise(F.floor(col * scale + 0.5) / scale)


def is_registered(user_id: Column) -> Column:
    """Registered unless the id carries the mark of an unregistered visitor."""
    return ~user_id.contains("nouserid")


def explode_present(df: DataFrame, items: list[Column], name: str) -> DataFrame:
    """One row per item that is not NULL.  The filter runs after the generator, inside generated code;
    ``array_compact`` before it would be interpreted for every row."""
    return df.withColumn(name, F.explode(F.array(*items))).where(F.col(name).isNotNull())


def explode_range(df: DataFrame, first: str | Column, last: str | Column, name: str, step: int = 1024) -> DataFrame:
    """A row for each whole number from ``first`` to ``last``, in two steps, so that no row holds the whole range."""
    low, high = F.col(first) if isinstance(first, str) else first, F.col(last) if isinstance(last, str) else last
    ranged = df.withColumns({"__low": low.cast("bigint"), "__high": high.cast("bigint")}).where("__low <= __high")
    blocks = ranged.withColumn("__low", F.explode(F.sequence("__low", "__high", F.lit(step).cast("bigint"))))
    return blocks.withColumn(name, F.explode(F.sequence("__low", F.least(F.col("__low") + (step - 1), F.col("__high"))))).drop("__low", "__high")
