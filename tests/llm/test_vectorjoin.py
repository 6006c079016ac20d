"""The count-vector join against brute force, and its bounds against whole sets."""

import random

import numpy as np
import pandas as pd
import pytest

from lectern.llm import buckets, vectorjoin
from lectern.llm.links import confirmed, most_shared, place_bits, possible, shingle_sets
from lectern.llm.shingles import shingles


def _words(rng, n):
    return ["w%d" % rng.randrange(4000) for _ in range(n)]


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def _expected(rows, percent):
    sets = [_set(t) for _, t in rows]
    component = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j in range(i):
                b = sets[j]
                if a and b and component[i] != component[j] and 100 * len(a & b) >= percent * len(a | b):
                    component[i] = component[j] = min(component[i], component[j])
                    changed = True
    out = []
    for i, (doc_id, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if component[j] == component[i]]
        known = [g for g in group if g is not None]
        out.append((doc_id, len(sets[i]), (min(known) if known else None) if sets[i] else doc_id))
    return sorted(out, key=repr)


def _found(spark, rows, percent=80):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in vectorjoin.linked(docs, percent).collect()), key=repr)


def _copies(rng, base, count, most):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = "e%d" % rng.randrange(10**6)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("percent", [80, 60, 100])
def test_against_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = [t for n in (8, 40, 150) for t in _copies(rng, _words(rng, n), 12, 5)]
    passage = _words(rng, 60)
    texts += [" ".join(passage + _words(rng, rng.randint(3, 40))) for _ in range(30)]
    texts += [None, "", " \n", "one", "ONE", "one two three four", "one two three four five", texts[3], texts[3].upper()]
    rows = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    assert _found(spark, rows, percent) == _expected(rows, percent)


def test_large_trees(spark, monkeypatch):
    """Small leaves make trees of two levels; copies far from the text copied aren't linked, but for those alike."""
    monkeypatch.setattr(vectorjoin, "FEW", 2)
    monkeypatch.setattr(buckets, "LEAF", 6)
    monkeypatch.setattr(buckets, "FAN", 3)
    monkeypatch.setattr(vectorjoin, "LEAST_FREQUENT", 4)
    rng = random.Random(9)
    base = _words(rng, 120)
    texts = _copies(rng, base, 140, 14)
    texts += [t + " more" for t in texts[::9]]
    rows = list(enumerate(texts))
    expected = _expected(rows, 80)
    assert 3 < len({r[2] for r in expected}) < 140
    assert _found(spark, rows) == expected


def test_nulls_repeats_and_two_texts_of_an_id(spark):
    rng = random.Random(2)
    a, b, c = (" ".join(_words(rng, 50)) for _ in range(3))
    near = a.split()
    near[3] = "other"
    rows = [(5, a), (5, a), (5, b), (None, a), (None, c), (None, c), (2, " ".join(near)), (None, ""), (9, None), (9, b)]
    assert _found(spark, rows) == _expected(rows, 80)
    assert _found(spark, [(None, "a b c"), (None, "a b c")]) == [(None, 1, None)] * 2


def test_empty_table_and_clashing_columns(spark):
    assert vectorjoin.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a b c", 1, 2, "x"), (2, "a b c", 3, 4, "y")], "doc_id long, text string, id long, key long, text_key string")
    assert sorted(tuple(r) for r in vectorjoin.linked(docs).collect()) == [(1, 1, 1), (2, 1, 1)]


def test_first_ones_hold_any_link():
    rng = random.Random(6)
    often = np.sort(np.array([rng.randrange(500) for _ in range(60)], dtype=np.uint64))
    often = np.unique(often), np.arange(len(np.unique(often)))
    for _ in range(400):
        n = rng.randint(1, 60)
        a = np.unique(np.array([rng.randrange(500) for _ in range(n)], dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.randint(0, max(1, len(a) // 4)) :], np.array([rng.randrange(500) for _ in range(rng.randint(0, 8))], dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if len(b) and 100 * shared >= 80 * (len(a) + len(b) - shared):
            first = [set(vectorjoin.ordered(x, often)[: vectorjoin.first_ones(len(x), 80)].tolist()) for x in (a, b)]
            assert first[0] & first[1]


def test_bits_bound_what_is_shared():
    """No link is ruled out by the bits of two sets, whatever their sizes; unlike sets whose groups are alike are."""
    rng = np.random.default_rng(6)
    for n, m in ((1, 1), (1, 3), (40, 40), (1000, 830), (1030, 1000), (5000, 5000), (5000, 700)):
        for share in (0.0, 0.5, 0.9, 1.0):
            both = round(min(n, m) * share)
            values = rng.integers(0, 2**64, n + m - both, dtype=np.uint64)
            most = most_shared(n, place_bits(values[:n]), m, place_bits(values[n - both :]))
            assert both <= most <= min(n, m)
            assert share > 0.5 or n < 1000 or 180 * most < 80 * (n + m)


def test_possible_keeps_links(spark):
    rng = random.Random(4)
    base = _words(rng, 900)
    texts = _copies(rng, base, 12, 60) + [" ".join(_words(rng, 900)) for _ in range(4)]
    sets = shingle_sets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bits=True)
    pairs = spark.createDataFrame([(a, b) for b in range(16) for a in range(b)], "a long, b long")
    kept, links = ({tuple(r) for r in t.collect()} for t in (possible(pairs, sets, 80), confirmed(pairs, sets, 80)))
    assert links and links <= kept and not any(b >= 12 for _, b in kept)


def test_points_bound_what_is_shared(monkeypatch):
    """Also where a count goes beyond what the point holds."""
    for most in (255, 2):
        monkeypatch.setattr(vectorjoin, "_COUNT_MAX", most)
        kernel, rng, one = vectorjoin.CountVectors(), np.random.default_rng(most), np.zeros(1, dtype=np.int64)
        for _ in range(100):
            a, b = (np.unique(rng.integers(0, 3000, int(rng.integers(1, 2500)), dtype=np.uint64)) for _ in range(2))
            x, y = (kernel.load([vectorjoin.point(v)]) for v in (a, b))
            assert kernel.most_shared(x, one, y, one)[0] >= len(np.intersect1d(a, b))
            assert np.minimum(kernel.top(x), kernel.top(y)).sum() >= len(np.intersect1d(a, b))


def test_leaves_of_a_sorted_partition(monkeypatch):
    """Every member is in one leaf of its key and every leaf under one parent, whatever the batches."""
    monkeypatch.setattr(buckets, "LEAF", 4)
    monkeypatch.setattr(buckets, "FAN", 2)
    kernel = vectorjoin.CountVectors()
    data = [vectorjoin.point(shingles(f"a b c d e {k}")) + np.array([1], dtype=np.int64).tobytes() for k in range(40)]
    rows = pd.DataFrame({"key": [1] * 3 + [2] * 21 + [5] * 16, "id": range(40), "component": range(40), "n": 2, "data": data})
    for cuts in ([0, 40], [0, 1, 2, 9, 10, 23, 24, 40], list(range(41))):
        nodes = pd.concat(buckets._leaves(kernel)(iter([rows.iloc[a:b] for a, b in zip(cuts, cuts[1:])])))
        leaves, parents = nodes[nodes["level"] == 0], nodes[nodes["level"] == 1]
        assert sorted((k, i) for k, ids in zip(leaves["key"], leaves["ids"]) for i in ids) == sorted(zip(rows["key"], rows["id"]))
        assert max(map(len, leaves["ids"])) == 4 and set(zip(leaves["key"], leaves["parent"])) == set(zip(parents["key"], parents["node"]))
        assert len(leaves) == 1 + 6 + 4 and len(parents) == 1 + 3 + 2
