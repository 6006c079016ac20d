"""Steps that keep several copies of a row are dealt by the number of rows, not by their compressed bytes."""

import datetime as dt
import re

from lectern import session
from lectern.operators import activity, catalog, coach

DAY = dt.date(2024, 1, 1)


def _tasks(df, *columns):
    """Numbers of tasks that a plan deals by the columns with."""
    keys = ", ".join(rf"{c}#\d+L?" for c in columns)
    return [int(n) for n in re.findall(rf"hashpartitioning\({keys}, (\d+)\), REPARTITION_BY_NUM", df._jdf.queryExecution().toString())]


def test_tasks_follow_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    table = spark.range(250)
    assert session.tasks_for(table) == 3 and session.tasks_for(table, 2) == 5 and session.tasks_for(table.limit(0)) == 1


def test_rolling_teachers_deal_pairs(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    rows = [(t, u, DAY + dt.timedelta(d)) for t in range(3) for u in range(20) for d in range(10)]
    days = spark.createDataFrame(rows + rows[:5], "teacher long, user long, dt date")
    out = coach.rolling_active_teachers(days, "2024-02-20", threshold=20)
    assert set(_tasks(out, "teacher", "user")) == {7}
    assert {r.teachers for r in out.where("dt > '2024-01-02' AND dt < '2024-01-20'").collect()} == {3}


def test_usage_deals_user_days(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    rows = [(f"t{u % 2}", u, DAY + dt.timedelta(d), True, 5) for u in range(30) for d in range(20)]
    usage = spark.createDataFrame(rows, "title string, user long, dt date, completed boolean, num_seconds long")
    out = activity.distinct_usage(usage, ["title"])
    assert set(_tasks(out, "title", "user", "dt")) == {6} and set(_tasks(out, "title", "user")) == {6}
    assert sorted(tuple(r) for r in out.collect()) == [("t0", 15, 300, 300, 1500), ("t1", 15, 300, 300, 1500)]


def test_closure_deals_relations(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    out = catalog.cover_graph(spark.createDataFrame([(i, i + 1) for i in range(40)], "source long, target long"))
    assert set(_tasks(out, "node")) == {17 + 1}  # 820 pairs and 40 edges, both ways
    assert out.count() == 2 * (820 + 40) and {r.level for r in out.where("node = 0").select("level").distinct().collect()} == {41}
