"""Closure by doubling and the sweep over nested ranges, against plain Python."""

import random

import pytest

from lectern.operators import catalog, geo


def _closure(edges):
    out = {}
    for s, t in edges:
        out.setdefault(s, set()).add(t)

    def below(node, seen):
        for t in out.get(node, ()):
            if t not in seen:
                seen.add(t)
                below(t, seen)
        return seen

    def level(node):
        return 1 + max((level(t) for t in out.get(node, ())), default=0)

    nodes = {n for e in edges for n in e}
    down = {n: below(n, set()) for n in nodes}
    rows = set()
    for n in nodes:
        for t in down[n]:
            rows |= {(n, t, "descendant", level(n)), (t, n, "ancestor", level(t))}
    for s, t in edges:
        rows |= {(s, t, "covers", level(s)), (t, s, "covered", level(t))}
    return rows


def test_cover_graph_of_random_dags(spark):
    rng = random.Random(8)
    for nodes, count in ((12, 20), (30, 45), (9, 36)):
        edges = {tuple(sorted(rng.sample(range(nodes), 2))) for _ in range(count)}
        frame = spark.createDataFrame([*edges, (3, 3), next(iter(edges))], "source long, target long")
        found = catalog.cover_graph(frame).collect()
        assert len(found) == len(set(found)) and {tuple(r) for r in found} == _closure(edges)


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    """A chain of 1,000 nodes takes eleven rounds: lengths 1, 2, 4, ... 1024."""
    written = []
    cut = catalog.cut_lineage
    monkeypatch.setattr(catalog, "cut_lineage", lambda df: written.append(1) or cut(df))
    edges = spark.createDataFrame([(i, i + 1) for i in range(999)], "source long, target long")
    found = catalog.cover_graph(edges)
    assert len(written) <= 1 + 3 * 11
    assert found.where("relation = 'descendant'").count() == 999 * 1000 // 2
    assert {r["node"]: r["level"] for r in found.select("node", "level").distinct().collect()} == {i: 1000 - i for i in range(1000)}


def test_cycle_is_named(spark):
    edges = [(i, i + 1) for i in range(20)] + [(17, 13), (30, 31)]
    with pytest.raises(ValueError, match="cycle: 13, 14, 15, 16, 17$"):
        catalog.cover_graph(spark.createDataFrame(edges, "source long, target long"))


def _dotted(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def _laminar(rng, lo, hi, depth, out):
    """Random ranges of [lo, hi], nested or disjoint, some of them equal or touching."""
    at = lo
    while at <= hi and depth:
        size = rng.randint(1, max(1, (hi - lo) // 2))
        end = min(hi, at + size - 1)
        out.append((at, end))
        if rng.random() < 0.2:
            out.append((at, end))
        if rng.random() < 0.6:
            _laminar(rng, at, end, depth - 1, out)
        at = end + 1 + (rng.randint(0, 200_000) if rng.random() < 0.6 else 0)


def test_nested_ranges_against_brute_force(spark):
    rng = random.Random(5)
    for lo, hi in ((0, 4294967295), (10 * 2**24, 10 * 2**24 + 300), (2**24 - 5, 2**24 + 200_000)):
        ranges = []
        _laminar(rng, lo, hi, 4, ranges)
        ranges = rng.sample(ranges, min(150, len(ranges)))
        rows = [(a, b, f"c{i:03}") for i, (a, b) in enumerate(ranges)]
        points = {max(0, min(2**32 - 1, p + d)) for a, b, _ in rows for p in (a, b) for d in (-1, 0, 1)} | {rng.randint(lo, hi) for _ in range(100)}
        frame = spark.createDataFrame(rows, "lo long, hi long, city string")
        df = spark.createDataFrame([(k, _dotted(p)) for k, p in enumerate(sorted(points))] + [(-1, None), (-2, "x")], "k long, ip string")
        found = {r["k"]: r["city"] for r in geo.ip_geolocate(df, frame).collect()}
        for k, p in enumerate(sorted(points)):
            covering = [(a, -b, c) for a, b, c in rows if a <= p <= b]
            assert found[k] == (max(covering)[2] if covering else "null"), (p, covering)
        assert found[-1] == found[-2] == "null" and len(found) == len(points) + 2


def test_whole_address_space_is_one_row(spark):
    flat = geo.flat_ranges(spark.createDataFrame([(0, 4294967295, "all")], "lo long, hi long, city string"))
    assert sorted((r["at"], r["place"] and r["place"]["city"]) for r in flat.collect()) == [(0, "all"), (4294967296, None)]


def test_no_range_and_crossing_ranges(spark):
    none = spark.createDataFrame([], "lo long, hi long, city string")
    df = spark.createDataFrame([("1.2.3.4",)], "ip string")
    assert geo.ip_geolocate(df, none).first()["city"] == "null"
    for crossing in ([(0, 10, "a"), (5, 15, "b")], [(0, 100, "a"), (3, 50, "b"), (50, 60, "c"), (70, 80, "d")]):
        with pytest.raises(ValueError, match="cross"):
            geo.ip_geolocate(df, spark.createDataFrame(crossing, "lo long, hi long, city string"))
