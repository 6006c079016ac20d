"""Geography: IP ranges and the join of addresses to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.columns import ip_to_long
from lectern.functions.ordered import scan_groups
from lectern.session import cut_lineage

PLACE = ("city", "region", "country_code", "country", "latitude", "longitude")


def split_ip_ranges(ranges: DataFrame, lo: str = "lo", hi: str = "hi", bits: int = 8) -> DataFrame:
    """Ranges cut so that each piece has one leading ``bits``-bit prefix, given as ``first_byte``."""
    span = 1 << (32 - bits)
    prefix = lambda c: F.floor(F.col(c) / F.lit(span)).cast("bigint")
    rest = [c for c in ranges.columns if c not in (lo, hi)]
    pieces = ranges.withColumn("first_byte", F.explode(F.sequence(prefix(lo), prefix(hi))))
    start, stop = F.col("first_byte") * span, (F.col("first_byte") + 1) * span - 1
    return pieces.select("first_byte", F.greatest(F.col(lo), start).alias("lo"), F.least(F.col(hi), stop).alias("hi"), *rest)


def flat_ranges(ranges: DataFrame) -> DataFrame:
    """Disjoint ranges with the columns of those given: (at, place), the place from ``at`` on up to the next row's; null for none.

    Ranges may lie in others; the innermost covers, of equal ones the last by the order of their columns.  Ranges that
    cross are an error.  Starts and ends are put in order; a running count of open ranges gives each start its level,
    and what covers after an end is the last start of the level that is left, so nothing is expanded.
    """
    places = [c for c in ranges.columns if c not in ("lo", "hi")]
    kept = cut_lineage(ranges.where("lo <= hi").select("lo", "hi", F.struct(*places).alias("place")).distinct())
    inner = F.struct((-F.col("hi")).alias("hi"), "place")
    starts = kept.select(F.col("lo").alias("at"), F.lit(1).alias("step"), inner.alias("x"), "hi")
    # An end closes the innermost range first.
    ends = kept.select((F.col("hi") + 1).alias("at"), F.lit(-1).alias("step"), F.struct((-F.col("lo")).alias("hi"), "place").alias("x"), "hi")
    order = ["at", "step", "x"]
    prefix = F.floor(F.col("at") / 65536)
    events = cut_lineage(scan_groups(starts.unionByName(ends), [], order, prefix, sums={"open": F.col("step")}))
    opened = F.col("step") == 1
    tagged = events.withColumns({"level": F.col("open"), "asks": ~opened, "around": F.lit(False)})
    outer = events.where(opened & (F.col("open") > 1)).withColumns({"level": F.col("open") - 1, "asks": F.lit(True), "around": F.lit(True)})
    started = scan_groups(
        tagged.unionByName(outer), ["level"], [*order, "around"], prefix,
        last_known={"cover": (F.struct("hi", F.col("x.place").alias("place")), ~F.col("asks"))})
    started = cut_lineage(started)
    if not started.where("around AND cover.hi < hi").isEmpty():
        raise ValueError("ranges cross: one begins in another and ends after it")
    place = F.when(opened, F.col("x.place")).when(F.col("open") > 0, F.col("cover.place"))
    return started.where("NOT around").groupBy("at").agg(F.max_by(F.struct(place.alias("place")), F.struct("step", "x")).alias("s")).select("at", "s.place")


def ip_geolocate(df: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Add the place of each address; text columns are 'null' when it is unknown.  Of ranges that lie in each other
    the innermost counts (see ``flat_ranges``), so an address has one place.

    Distinct addresses are looked up, so a busy address costs one lookup.  They are put in order with the
    starts of the disjoint ranges, in chunks of the first two bytes, and take the last start before them, carried over
    from earlier chunks; no range is expanded and a chunk holds at most 65536 addresses.
    """
    places = [c for c in PLACE if c in ranges.columns]
    flat = flat_ranges(ranges.select("lo", "hi", *places)).select(
        F.lit(None).cast(df.schema[ip].dataType).alias(ip), F.col("at").alias("__n"), F.lit(0).alias("__kind"), "place")
    addresses = df.select(ip).where(F.col(ip).isNotNull()).distinct().withColumn("__n", ip_to_long(F.col(ip))).where("__n IS NOT NULL")
    both = flat.unionByName(addresses.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    merged = scan_groups(both, [], ["__n", "__kind", ip], F.floor(F.col("__n") / 65536), last_known={"__at": (F.col("place"), F.col("__kind") == 0)})
    found = merged.where("__kind = 1 AND __at IS NOT NULL").select(ip, *[F.col(f"__at.{c}").alias(c) for c in places])
    text = {c for c, kind in ranges.dtypes if kind == "string"}
    out: list[Column] = [F.coalesce(c, F.lit("null")).alias(c) if c in text else F.col(c) for c in places]
    return df.join(found, ip, "left").select(*df.columns, *out)


def region_ip_ranges(
    blocks: DataFrame, locations: DataFrame, cities: DataFrame, area_codes: DataFrame, zips: DataFrame,
    country: str, state: str,
) -> DataFrame:
    """CIDR blocks of a state whose city, area code or postal code is listed, as [start, end).

    Odd postal codes are no numbers and match no list.
    """
    near = locations.where((F.col("country") == country) & (F.col("state") == state)).withColumns({
        "area": F.col("area_code").try_cast("int"), "zip": F.col("postalcode").try_cast("int")})
    listed = (
        near.join(cities.select("city"), "city", "left_semi").select("id")
        .unionByName(near.join(area_codes.select(F.col("area_code").alias("area")), "area", "left_semi").select("id"))
        .unionByName(near.join(zips.select("zip"), "zip", "left_semi").select("id"))
        .distinct())
    net = F.split("subnet", "/")
    size = F.pow(F.lit(2.0), 32 - F.get(net, F.lit(1)).cast("int")).cast("bigint")
    return blocks.join(listed, "id", "left_semi").select(
        ip_to_long(F.get(net, F.lit(0))).alias("start"), (ip_to_long(F.get(net, F.lit(0))) + size).alias("end"))
