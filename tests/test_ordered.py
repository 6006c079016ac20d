"""Chunked windows, counts-based quantiles and edges against plain Python."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions.columns import explode_range, ip_to_long, md5_mod
from lectern.functions.ordered import number_all, scan_groups, top_k
from lectern.functions.quantile import exact_quantiles, value_chunk
from lectern.operators.coach import rolling_active_teachers, rolling_active_users

DAY = dt.date(2024, 1, 1)


def hot_rows(seed, n=400):
    """One key owns most of the rows."""
    rng = random.Random(seed)
    times = rng.sample(range(5000), n)
    return [("hot" if rng.random() < 0.7 else rng.choice("abc"), t, rng.randint(-3, 9), rng.random() < 0.3) for t in times]


@pytest.mark.parametrize("seed,width", [(1, 7), (2, 250), (3, 100000)])
def test_scan_groups_equals_a_walk(spark, seed, width):
    data = hot_rows(seed)
    df = spark.createDataFrame(data, "k string, t int, v int, mark boolean")
    out = scan_groups(
        df, ["k"], ["t"], F.floor(F.col("t") / width), number="n", sums={"run": F.col("v")}, lags={"before": "v"}, leads={"after": "v"},
        last_known={"marked": (F.col("t"), F.col("mark"))}, group_sums={"total": F.col("v")}, firsts={"first": "v"}, lasts={"last": "v"})
    got = {(r.k, r.t): (r.n, r.run, r.before, r.after, r.marked, r.total, r.first, r.last) for r in out.collect()}
    expected = {}
    for key in {r[0] for r in data}:
        group = sorted((r for r in data if r[0] == key), key=lambda r: r[1])
        run, marked = 0, None
        for i, (_, t, v, mark) in enumerate(group):
            run += v
            expected[key, t] = (
                i + 1, run, group[i - 1][2] if i else None, group[i + 1][2] if i + 1 < len(group) else None, marked,
                sum(r[2] for r in group), group[0][2], group[-1][2])
            marked = t if mark else marked
    assert got == expected


def test_scan_without_keys_and_empty_input(spark):
    df = spark.createDataFrame([(t, 1) for t in range(50)], "t int, v int")
    out = scan_groups(df, [], ["t"], F.floor(F.col("t") / 8), sums={"run": F.col("v")})
    assert [r.run for r in out.orderBy("t").collect()] == list(range(1, 51))
    assert scan_groups(df.limit(0), [], ["t"], F.floor(F.col("t") / 8), number="n").count() == 0


def test_lag_keeps_nulls_apart_from_missing(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (30, None)], "t int, v int").withColumn("k", F.lit("a"))
    out = scan_groups(df, ["k"], ["t"], F.floor(F.col("t") / 10), lags={"p": "v"}, leads={"n": "v"})
    assert [(r.p, r.n) for r in out.orderBy("t").collect()] == [(None, 5), (None, None), (5, None)]


def test_null_is_a_key_when_asked(spark):
    df = spark.createDataFrame([(None, t, 1) for t in range(5)] + [("a", 9, 1)], "k string, t int, v int")
    chunk = F.floor(F.col("t") / 2)
    assert scan_groups(df, ["k"], ["t"], chunk, number="n").count() == 1
    kept = scan_groups(df, ["k"], ["t"], chunk, number="n", sums={"run": F.col("v")}, lags={"p": "t"}, null_keys=True)
    got = sorted(((r.k, r.t, r.n, r.run, r.p) for r in kept.collect()), key=lambda r: (r[0] or "", r[1]))
    assert got == [(None, t, t + 1, t + 1, t - 1 if t else None) for t in range(5)] + [("a", 9, 1, 1, None)]
    quantiles = {r.k: r.q for r in exact_quantiles(df, ["k"], "t", {"q": 0.5}, width=2.0).collect()}
    assert quantiles == {None: 2.0, "a": 9.0}


def test_hot_group_is_split(spark):
    """The row windows run over (key, chunk), so no task holds the whole key."""
    df = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise("cold").alias("k"), F.col("id").alias("t"))
    plan = scan_groups(df, ["k"], ["t"], F.floor(F.col("t") / 10), number="n")._jdf.queryExecution().optimizedPlan().toString()
    window = plan.split("row_number() windowspecdefinition(")[1].split("specifiedwindowframe")[0]
    assert window.startswith("k#") and "__chunk#" in window


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = top_k(df, ["k"], [F.col("v").desc()], 2)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in out.collect()) == [994, 995, 996, 997, 998, 999]


@pytest.mark.parametrize("n", [1, 2, 5, 40, 101])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(0, 20, n), 1)
    df = spark.createDataFrame([("a", float(v)) for v in values], "k string, v double")
    qs = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q95": 0.95, "q100": 1.0}
    row = exact_quantiles(df, ["k"], "v", qs, width=3.0).first()
    for name, q in qs.items():
        assert row[name] == pytest.approx(float(np.quantile(values, q)))
    low = exact_quantiles(df, ["k"], "v", {"q": 0.3}, width=3.0, interpolate=False).first().q
    assert low == sorted(values)[int((n - 1) * 0.3)]


def brute_active(days, end, window, k):
    first = min(d for _, d in days)
    out, day = {}, first
    while day < end:
        per = {}
        for user, d in set(days):
            if day - dt.timedelta(window) <= d < day:
                per[user] = per.get(user, 0) + 1
        out[day] = sum(1 for c in per.values() if c >= k)
        day += dt.timedelta(1)
    return out


@pytest.mark.parametrize("k", [1, 2, 4])
def test_rolling_users_equal_brute_force(spark, k):
    rng = random.Random(k)
    days = [(rng.choice("abcdef"), DAY + dt.timedelta(rng.randint(0, 120))) for _ in range(90)]
    end = DAY + dt.timedelta(140)
    df = spark.createDataFrame(days, "user string, dt date")
    got = {r.dt: r.users for r in rolling_active_users(df, str(end), min_days=k).collect()}
    assert got == brute_active(days, end, 28, k)


@pytest.mark.parametrize("threshold,k", [(1, 1), (2, 1), (2, 3)])
def test_rolling_teachers_equal_brute_force(spark, threshold, k):
    rng = random.Random(threshold * 10 + k)
    data = [(rng.choice("xyz"), rng.choice("abcdef"), DAY + dt.timedelta(rng.randint(0, 90))) for _ in range(160)]
    end = DAY + dt.timedelta(125)
    df = spark.createDataFrame(data, "teacher string, user string, dt date")
    got = {r.dt: r.teachers for r in rolling_active_teachers(df, str(end), threshold, k).collect()}
    day, expected = min(d for _, _, d in data), {}
    while day < end:
        n = 0
        for teacher in "xyz":
            per = {}
            for _, user, d in {r for r in data if r[0] == teacher}:
                if day - dt.timedelta(28) <= d < day:
                    per[user] = per.get(user, 0) + 1
            n += sum(1 for c in per.values() if c >= k) >= threshold
        expected[day] = n
        day += dt.timedelta(1)
    assert got == expected


def test_md5_modulo_and_ip(spark):
    import hashlib
    df = spark.createDataFrame([(f"id{i}",) for i in range(50)], "s string")
    for m in (2, 7, 100, 1000003):
        for r in df.select("s", md5_mod(F.col("s"), m).alias("r")).collect():
            assert r.r == int(hashlib.md5(r.s.encode()).hexdigest(), 16) % m
    ips = spark.createDataFrame([("1.2.3.4",), ("255.255.255.255",), ("x.2.3.4",), ("1.2.3",), (None,)], "ip string")
    assert [r[0] for r in ips.select(ip_to_long(F.col("ip"))).collect()] == [16909060, 4294967295, None, None, None]


def test_value_chunks_follow_the_data(spark):
    for values in ([i / 5000 for i in range(5000)], [1.7e9 + i for i in range(5000)], [-(2.0 ** (i / 100)) for i in range(2000)]):
        df = spark.createDataFrame([(v,) for v in values], "v double").withColumns({"low": F.lit(min(values)), "high": F.lit(max(values))})
        chunks = df.withColumn("c", value_chunk(F.col("v"), F.col("low"), F.col("high")))
        sizes = [r["count"] for r in chunks.groupBy("c").count().collect()]
        assert len(sizes) > 100 and max(sizes) < len(values) / 20
        by_value = [tuple(r.c) for r in chunks.orderBy("v").collect()]
        assert by_value == sorted(by_value)
    mixed = [-3.0, -1e-300, 0.0, 1e-300, 0.5, 7.0]
    df = spark.createDataFrame([(v,) for v in mixed], "v double")
    row = exact_quantiles(df, [], "v", {"low": 0.0, "mid": 0.4, "high": 1.0}, interpolate=False).first()
    assert (row.low, row.mid, row.high) == (-3.0, 0.0, 7.0)
    same = spark.createDataFrame([("k", 4.0)] * 3 + [(None, 1.0)], "k string, v double")
    assert {r.k: r.q for r in exact_quantiles(same, ["k"], "v", {"q": 0.5}).collect()} == {"k": 4.0, None: 1.0}


def test_number_all(spark):
    items = [(f"item{i:05d}",) for i in range(3000)]
    out = number_all(spark.createDataFrame(items, "item string").repartition(7), ["item"], "n").collect()
    assert {r.n: r.item for r in out} == {i: item for i, (item,) in enumerate(items)}
    assert number_all(spark.createDataFrame([], "item string"), ["item"], "n").count() == 0


def test_explode_range(spark):
    df = spark.createDataFrame([(1, 5000), (7, 7), (9, 8)], "a bigint, b bigint")
    out = explode_range(df, "a", "b", "i", step=100)
    assert out.where("a = 1").agg(F.count("i"), F.min("i"), F.max("i"), F.countDistinct("i")).first()[:] == (5000, 1, 5000, 5000)
    assert [r.i for r in out.where("a > 1").collect()] == [7]
