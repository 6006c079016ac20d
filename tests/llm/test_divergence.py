"""The divergence audit against sums over every term, and its tree against sums over every pair of entries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lectern.llm import divergence

ALPHABET = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(128, 0x250)]))


def _terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def _audit(rows, least=3, top=200):
    n, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = _terms(text)
        for t in found:
            n[lang, source, t] += 1
        for t in set(found):
            docs[lang, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), k in docs.items() if x == lang and k >= least]
        sources = sorted(s for x, s in groups if x == lang)
        size = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (n[lang, s, t] + 1) // (size[s] + len(kept)) for t in kept} for s in sources}
        whole = sum(size.values())
        q = {t: 1 + 10**9 * (sum(n[lang, s, t] for s in sources) + 1) // (whole + len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if n[lang, s, t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return out


def _random_rows(seed, rows, sources):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcéXßñ") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    out = []
    for _ in range(rows):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "7", "\n"]) for _ in range(rng.choice([0, 1, 4, 30])))
        out.append((text, rng.choice(["en", "de", None, ""]), rng.choice(sources)))
    return out


def _compared(spark, rows, **options):
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    found = sorted(tuple(r) for r in divergence.audit(docs, **options).collect())
    assert found == sorted(_audit(rows, *options.values()))
    return found


def test_against_all_terms(spark):
    rows = _random_rows(1, 120, ["a", "b", "c", "dé", None, "Z", "e f"])
    rows += [("alone here", "fr", "x"), (None, "fr", "y"), (None, None, None), ("one source", "it", "a")] + [("copied words words", "en", "a")] * 5
    found = _compared(spark, rows)
    assert {r[4] for r in found if r[0] == "fr"} == {0}  # nothing kept, pairs all the same
    assert not [r for r in found if r[0] == "it"]


def test_top_and_ties(spark):
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows = [(" ".join(words), "en", "one")] * 3 + [("other things", "en", "two")] * 3
    found = _compared(spark, rows, least_docs=3, top=7)
    assert [r[3] for r in sorted((r for r in found if r[1] == "one" and r[2] == "term"), key=lambda r: r[5])] == sorted(words)[:7]


def test_empty_table_and_extra_columns(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
    rows = [(t, l, s, "q", 1, 2.0) for t, l, s in _random_rows(3, 40, ["a", "b"])]
    docs = spark.createDataFrame(rows, "text string, lang string, source string, term string, n int, salt double")
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == sorted(_audit([r[:3] for r in rows]))


def test_long_text_and_small_portions(monkeypatch):
    text = "Wort wörter," * 500 + "x"
    for at_once, held in ((10**6, 10**6), (7, 10**6), (7, 0)):
        monkeypatch.setattr(divergence, "_AT_ONCE", at_once)
        monkeypatch.setattr(divergence, "_COUNTED", held)
        found = pd.concat(divergence._counted(iter([pd.DataFrame({"text": [text, "x"], "lang": "de", "source": "s"})])))
        total = {t: (int(g["n"].sum()), int(g["docs"].sum())) for t, g in found.groupby("term")}
        assert total == {"wort": (500, 1), "wörter": (500, 1), "x": (2, 2)} and found["term"].isna().any()


def test_tree_by_pairs_of_entries(monkeypatch):
    """Corrections of the walk, in parts and with small portions, against each row's pairs."""
    rng = random.Random(4)
    rows = Counter()
    for _ in range(200):
        lang = rng.choice("xy")
        row = tuple((s, rng.randint(1, 3)) for s in "abcdef" if rng.random() < 0.5)
        if len(row) > 1:
            rows[lang, row] += rng.randint(1, 3)
    p = lambda s, n: 1 + 1000 * (n + 1) // (ord(s) - 90)
    f = lambda a, b: (a - b) ** 2 // b
    expected = defaultdict(int)
    for (lang, row), times in rows.items():
        for s, n in row:
            for o, m in row:
                if s != o:
                    expected[lang, s, o] += times * (f(p(s, n), p(o, m)) - f(p(s, n), p(o, 0)) - f(p(s, 0), p(o, m)) + f(p(s, 0), p(o, 0)))
    frame = pd.DataFrame([
        {"lang": lang, "sources": [s for s, _ in row], "ns": [n for _, n in row], "ps": [p(s, n) for s, n in row], "zeros": [p(s, 0) for s, _ in row], "times": times}
        for (lang, row), times in sorted(rows.items())])
    for held, cuts in ((10**6, [0, len(frame)]), (5, [0, 31, 32, 90, len(frame)])):
        monkeypatch.setattr(divergence, "_HELD", held)
        total = defaultdict(int)
        for a, b in zip(cuts, cuts[1:]):
            for part in divergence._walk(iter([frame.iloc[a : (a + b) // 2], frame.iloc[(a + b) // 2 : b]])):
                for r in part.itertuples():
                    total[r.lang, r.source, r.item] += int(r.value)
        assert {k: v for k, v in total.items() if v} == {k: v for k, v in expected.items() if v}
    assert not list(divergence._walk(iter([])))


def test_path_counts_nodes_once():
    """Rows that share a path work out its corrections once."""
    path = divergence._Path()
    shares = np.array([[9, 8, 7], [1, 2, 3]], dtype=np.int64)
    for _ in range(4):
        path.insert(["a", "b", "c"], [1, 2, 3], shares, 2)
    path.close(0)
    assert path.held == 6 and [times for _, _, times in path.closed] == [8, 8]


def test_rows_of_a_term_meet_once(spark):
    """All sources of a term are in one partition as counted, so no second shuffle of all terms is needed."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame(_random_rows(5, 60, ["a", "b", "c"]), "text string, lang string, source string")
        places = divergence.counts(docs).withColumn("place", F.spark_partition_id()).groupBy("lang", "term").agg(F.countDistinct("place").alias("n"))
        assert places.count() > 20 and places.where("n > 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
