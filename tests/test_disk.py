"""What is shuffled to make a table goes when the table stands; pairs are made in passes."""

import os
import time

import pytest
from pyspark.sql import functions as F

from lectern import session
from lectern.operators import recommend

SCHEMA = "user string, item string, completion_time double"


def _shuffles(spark):
    """Names of shuffle files on disk."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that came since ``before`` and stay; they are removed in the background."""
    for _ in range(50):
        if not (new := _shuffles(spark) - before):
            break
        time.sleep(0.1)
    return new


def test_tables_leave_no_shuffle_files(spark):
    before = _shuffles(spark)
    told = spark.conf.get(session._CLEANUP)
    table = session.cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")))
    assert not _left(spark, before) and spark.conf.get(session._CLEANUP) == told
    assert {(r.k, r.n) for r in table.collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}


def test_setting_returns_after_failure(spark):
    told = spark.conf.get(session._CLEANUP)
    with pytest.raises(ZeroDivisionError):
        with session.shuffles_removed(spark):
            1 / 0
    assert spark.conf.get(session._CLEANUP) == told


def _done(spark):
    nan = float("nan")
    data = [(f"u{u}", f"v{(u * v) % 23:02}", float(v % 5)) for u in range(12) for v in range(u + 3)]
    odd = [("o", "a", None), ("o", "b", 1.0), ("p", "a", nan), ("p", "b", 1.0), ("q", None, 1.0), (None, "a", 1.0), (None, "b", 1.0), ("r", "c", None), ("r", "d", None)]
    return spark.createDataFrame(data + data[:9] + odd, SCHEMA)


def _expected(done):
    found = {}
    rows = [r for r in done.collect() if r.user is not None and r.item is not None]
    for x in rows:
        for y in rows:
            if x.user == y.user and x.item < y.item:
                pre, suc = found.setdefault((x.item, y.item), [None, None])
                a, b = x.completion_time, y.completion_time
                if a is not None and b is not None:
                    first = b != b or a <= b
                    found[x.item, y.item] = [(pre or 0) + first, (suc or 0) + (not first)]
    return {(*k, *v) for k, v in found.items()} | {(*k[::-1], *v[::-1]) for k, v in found.items()}


@pytest.mark.parametrize("block", [2, 256])
def test_passes_find_the_same_pairs(spark, monkeypatch, block):
    done = _done(spark)
    expected = _expected(done)
    for some in (10**9, 200):
        monkeypatch.setattr(recommend, "PAIRS_A_PASS", some)
        found = [tuple(r) for r in recommend.cooccurrence(done, block).collect()]
        assert len(found) == len(expected) and set(found) == expected
        few = {tuple(r) for r in recommend.cooccurrence(done, block, least=3).collect()}
        assert few == {r for r in expected if r[2] is not None and r[2] + r[3] >= 3} and few


def test_pairs_leave_no_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(recommend, "PAIRS_A_PASS", 200)
    done, before = _done(spark), _shuffles(spark)
    pairs = recommend.cooccurrence(done, counts=recommend.item_counts(done))
    assert len({f.split("_")[1] for f in _left(spark, before)}) <= 1  # the number of pairs: a row a task
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_no_completions(spark):
    assert recommend.recommend(_done(spark).limit(0)).count() == 0
