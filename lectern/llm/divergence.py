"""Source divergence audit: how far the term shares of a language's sources lie apart, by a frequent-pattern tree.

A term is a run of ASCII letters and characters beyond ASCII, with A-Z lower-cased. A language keeps the terms of at least
``LEAST_DOCS`` of its documents, V of them. A source (of a language) gives a kept term with n occurrences the share
p = 1 + floor(10^9 (n + 1) / (N + V)), N being its occurrences of all kept terms; so does the language. The
divergence of a share p from a share q is floor((p - q)^2 / q). Audited are each source against each other source of its language,
summed over all kept terms (part ``pair``), and each source's terms above the language's share (part ``term``, the
200 largest, which is the feature). All is whole-number arithmetic.

Pairs of sources without a common term need no look at terms: with z for the share of a term with no occurrence,

    sum over terms = V f(z, z') + sum over terms of the first (f(p, z') - f(z, z')) + sum over terms of the second (f(z, q) - f(z, z'))
                   + sum over common terms (f(p, q) - f(p, z') - f(z, q) + f(z, z')).

The second and third sums follow from how many terms have which share in one source. For the last, each term is a
row, its sources in order with the counts that aren't zero. Equal rows are one with a multiplicity, and rows that begin alike share
a path of the tree, whose nodes are (source, count) after their ancestors. A node's correction with an ancestor is worked
out once and counted as often as terms pass the node. The tree is never held: rows are sorted, so that a
walk along them has one open path; where the next row leaves it the nodes below are closed. A node cut by
the border of two partitions counts in either with the terms passing there.

Defined results: null text, lang and source are the empty string; each row is a document, also one that repeats another or
has no doc_id; every (lang, source) occurs in part ``pair`` if its language has other sources, with value 0 where no term is kept;
an empty table gives an empty result; other columns play no part. Ties go by the item's UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.session import cut_lineage

# Bytes of terms, A-Z as a-z; all others divide terms.
_BYTES = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
LEAST_DOCS = 3
TOP = 200
_UNIT = 1_000_000_000
# Rows of a hot source or language are dealt to so many keys; the small side is repeated for each.
_SALTS = 16
_HELD = 500_000
# Bytes of texts whose terms are counted together, and of a piece of a longer text.
_COUNTED = 16_000_000
_AT_ONCE = 1_000_000


def _pieces(data: bytes) -> Iterator[bytes]:
    """Translated text in pieces of about ``_AT_ONCE`` bytes that cut no term."""
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + _AT_ONCE)
        yield data[start : stop if stop >= 0 else len(data)]
        start = stop if stop >= 0 else len(data)


def _tally(texts: list[bytes], group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Each term in each group of the translated ``texts``: the term, the group, its occurrences and its texts."""
    split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    found = split.flatten().dictionary_encode()
    # Texts are ordered by group, so sorted pairs of term and text have the texts of a group together.
    order = np.argsort(group, kind="stable")
    rank = np.empty(len(texts), dtype=np.int64)
    rank[order] = np.arange(len(texts))
    pairs = found.indices.to_numpy() * np.int64(len(texts)) + np.repeat(rank, pc.list_value_length(split).to_numpy())
    empty = pc.index(found.dictionary, "").as_py()
    if empty >= 0:
        pairs = pairs[pairs // len(texts) != empty]
    pairs.sort()
    term, text = np.divmod(pairs, len(texts))
    group = group[order][text]
    fresh = np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]
    starts = np.flatnonzero(fresh & np.append(True, (term[1:] != term[:-1]) | (group[1:] != group[:-1]))[: len(pairs)])
    n = np.diff(np.append(starts, len(pairs)))
    docs = np.add.reduceat(fresh.astype(np.int64), starts) if len(starts) else n
    return found.dictionary.take(pa.array(term[starts])), group[starts], n, docs


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences and documents of each term by (lang, source), summed over many rows; a group also has a row without a term."""
    number: dict[tuple[str, str], int] = {}
    texts: list[bytes] = []
    groups: list[int] = []
    held = 0

    def rows(terms: pa.Array, group: np.ndarray, n: np.ndarray, docs: np.ndarray) -> pd.DataFrame:
        names = [pa.array([key[i] for key in number], pa.large_string()).take(pa.array(group)) for i in (0, 1)]
        columns = {"lang": names[0], "source": names[1], "term": terms}
        return pd.DataFrame({c: pd.Series(pd.arrays.ArrowExtensionArray(v)) for c, v in columns.items()} | {"n": n, "docs": docs})

    for batch in batches:
        for text, lang, source in zip(batch["text"], batch["lang"], batch["source"]):
            group = number.setdefault((lang, source), len(number))
            data = (text if isinstance(text, bytes) else text.encode("utf-8")).translate(_BYTES)
            if len(data) > _AT_ONCE:
                # The pieces of a long text are counted in turn and put together, so that it is one document.
                parts = [_tally([piece], np.zeros(1, dtype=np.int64)) for piece in _pieces(data)]
                one = pa.table({"term": pa.chunked_array([p[0] for p in parts]), "n": np.concatenate([p[2] for p in parts])}).group_by("term").aggregate([("n", "sum")])
                yield rows(one["term"].combine_chunks(), np.full(len(one), group), one["n_sum"].to_numpy(), np.ones(len(one), dtype=np.int64))
                continue
            texts.append(data)
            groups.append(group)
            held += len(data)
            if held > _COUNTED:
                yield rows(*_tally(texts, np.array(groups)))
                texts, groups, held = [], [], 0
    if texts:
        yield rows(*_tally(texts, np.array(groups)))
    if number:
        none = np.zeros(len(number), dtype=np.int64)
        yield rows(pa.nulls(len(number), pa.large_string()), np.arange(len(number)), none, none)


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs of ``docs`` (text, lang, source); the row without a term says that the group occurs.

    All rows of a term are in one partition. Tasks have summed their rows before, so a frequent term is no more than a row for each portion of text and source.
    """
    text, *rest = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    found = docs.select(text.cast("binary").alias("text"), *rest).mapInPandas(_counted, "lang string, source string, term string, n long, docs long")
    return found.repartition("term", "lang").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, size: str) -> Column:
    return F.expr(f"CASE WHEN v > 0 THEN 1 + ((cast({_UNIT} as decimal(10,0)) * ({n} + 1)) div ({size} + v)) END")


def _far(p: str, q: str) -> Column:
    """The divergence of shares, at most 10^18."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _salted(many: DataFrame, few: DataFrame, on: list[str], by: Column) -> DataFrame:
    """Inner join of rows, of which a key may have a third, with few: ``few`` is repeated for each salt."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    return many.withColumn("salt", F.pmod(by, F.lit(_SALTS)).cast("int")).join(few.withColumn("salt", salts), [*on, "salt"]).drop("salt")


class _Path:
    """The open path of the tree and the closed nodes of one language, each with its ancestors."""

    def __init__(self):
        self.lang, self.nodes, self.passed = None, [], []
        self.places = np.zeros(0, dtype=np.int64)
        self.shares = np.zeros((2, 0), dtype=np.int64)
        self.number: dict[str, int] = {}
        self.closed: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.held = 0

    def insert(self, sources: list[str], counts: list[int], shares: np.ndarray, times: int) -> None:
        nodes = list(zip(sources, counts))
        common = 0
        for old, new in zip(self.nodes, nodes):
            if old != new:
                break
            common += 1
        self.close(common)
        self.nodes = nodes
        self.passed += [0] * (len(nodes) - common)
        self.passed[-1] += times
        self.places = np.array([self.number.setdefault(s, len(self.number)) for s in sources])
        self.shares = shares

    def close(self, depth: int) -> None:
        """Close the nodes below ``depth``; the terms that passed them passed their parents."""
        for at in range(len(self.nodes) - 1, depth - 1, -1):
            times = self.passed.pop()
            if at:
                self.passed[-1] += times
                self.closed.append((self.places[: at + 1], self.shares[:, : at + 1], times))
                self.held += 2 * at
        del self.nodes[depth:]

    def taken(self) -> pd.DataFrame:
        """The corrections of the closed nodes with each of their ancestors, by (lang, source, item), and none left."""
        lengths = np.array([len(places) for places, _, _ in self.closed])
        last = np.cumsum(lengths) - 1
        place = np.concatenate([places for places, _, _ in self.closed])
        p, z = np.concatenate([shares for _, shares, _ in self.closed], axis=1)
        node = np.repeat(last, lengths)
        times = np.repeat(np.array([t for _, _, t in self.closed], dtype=np.int64), lengths)
        above = node != np.arange(len(node))
        p, z, q, y, times, a, b = p[above], z[above], p[node[above]], z[node[above]], times[above], place[above], place[node[above]]
        far = lambda x, to: (x - to) ** 2 // to
        value = np.concatenate([times * (far(p, q) - far(p, y) - far(z, q) + far(z, y)), times * (far(q, p) - far(q, z) - far(y, p) + far(y, z))])
        size = len(self.number)
        pairs, at = np.unique(np.concatenate([a * size + b, b * size + a]), return_inverse=True)
        total = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(total, at, value)
        names = np.array(list(self.number), dtype=object)
        self.closed, self.held = [], 0
        return pd.DataFrame({"lang": self.lang, "source": names[pairs // size], "item": names[pairs % size], "value": total})


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Corrections of the tree of the sorted rows of a partition; holds one path and closed nodes of about ``_HELD`` corrections."""
    path = _Path()
    for batch in batches:
        for lang, sources, ns, ps, zeros, times in zip(batch["lang"], batch["sources"], batch["ns"], batch["ps"], batch["zeros"], batch["times"]):
            if lang != path.lang:
                path.close(0)
                if path.closed:
                    yield path.taken()
                path = _Path()
                path.lang = lang
            path.insert(list(sources), list(ns), np.array([ps, zeros], dtype=np.int64), int(times))
            if path.held > _HELD:
                yield path.taken()
    path.close(0)
    if path.closed:
        yield path.taken()


def common_terms(cells: DataFrame) -> DataFrame:
    """lang, source, item, value: the corrections of pairs of sources for the terms that both have."""
    entry = F.struct("source", "n", "p", "zero")
    rows = cells.groupBy("lang", "term").agg(F.sort_array(F.collect_list(entry)).alias("path"))  # one entry per source at most
    rows = cut_lineage(rows.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count("*").alias("times")))
    walked = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path").select(
        "lang", F.col("path.source").alias("sources"), F.col("path.n").alias("ns"), F.col("path.p").alias("ps"), F.col("path.zero").alias("zeros"), "times")
    return walked.mapInPandas(_walk, "lang string, source string, item string, value long")


def _own_terms(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """lang, source, item, value: the corrections of pairs for the terms of one of the two."""
    shares = cells.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("terms"))
    others = sources.select("lang", F.col("source").alias("item"), F.col("zero").alias("other"))
    met = _salted(shares, others, ["lang"], F.xxhash64("source", "p")).where("source <> item")
    times = F.col("terms").cast("decimal(20,0)")
    one = F.struct("source", "item", (times * (_far("p", "other") - _far("zero", "other"))).alias("value"))
    two = F.struct(F.col("item").alias("source"), F.col("source").alias("item"), (times * (_far("other", "p") - _far("other", "zero"))).alias("value"))
    return met.select("lang", F.explode(F.array(one, two)).alias("x")).select("lang", "x.source", "x.item", "x.value")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank of ``docs`` (text, lang, source)."""
    of_term = Window.partitionBy("term", "lang")  # one row per source at most
    whole = counts(docs).select("*", F.sum("n").over(of_term).alias("total"), F.sum("docs").over(of_term).alias("in_docs"), F.min("source").over(of_term).alias("least"))
    per = cut_lineage(whole.where((F.col("in_docs") >= least_docs) | F.col("term").isNull()).select("lang", "source", "term", "n", "total", (F.col("source") == F.col("least")).alias("first")))
    kept = per.where("term IS NOT NULL")
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    languages = kept.where("first").groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("whole"))
    known = per.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left").join(languages, "lang", "left")
    sources = known.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("size", "v", "whole")])
    sources = cut_lineage(sources.withColumn("zero", _share("0", "size")))
    cells = _salted(kept, sources, ["lang", "source"], F.xxhash64("term"))
    cells = cut_lineage(cells.select("lang", "source", "term", "n", "zero", _share("n", "size").alias("p"), _share("total", "whole").alias("q")))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), _far("p", "q").alias("value"))
    top_terms = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    others = sources.select("lang", F.col("source").alias("item"), F.col("zero").alias("other"))
    pairs = _salted(sources, others, ["lang"], F.xxhash64("source")).where("source <> item")
    without = pairs.select("lang", "source", "item", F.coalesce(F.col("v").cast("decimal(20,0)") * _far("zero", "other"), F.lit(0)).alias("value"))
    parts = [df.select("lang", "source", "item", F.col("value").cast("decimal(38,0)").alias("value")) for df in (without, _own_terms(cells, sources), common_terms(cells))]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))
    all_pairs = summed.withColumn("rank", F.row_number().over(best))
    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")) for part, df in (("pair", all_pairs), ("term", top_terms))]
    return out[0].unionByName(out[1])


SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT lang, source, r, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*) AS v, sum(total) AS whole FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(size, 0) AS size FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS size FROM c GROUP BY lang, source) USING (lang, source)),
p AS (
  SELECT lang, g.source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (size + v)::HUGEINT AS p, 1 + (1000000000::HUGEINT * (total + 1)) // (whole + v)::HUGEINT AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
t AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM t WHERE part = 'pair' OR rank <= 200
"""
