"""Secret scan: fixed forms, and character Markov models of random strings against ordinary identifiers.

The base forms are assignments to names such as password or token, access key ids, and long hex runs. Their
values are the labelled sample of random strings; long identifier-like tokens outside them are the sample of
ordinary ones, and distinct strings count once, so copies don't weigh. First-order models over the token
alphabet, smoothed by one, give each pair of neighbouring characters a log-likelihood ratio, in whole
millionths so that sums don't depend on their order. A token is a secret when the mean over its pairs is at
least ``threshold``. Texts are scanned once; the models have at most 68 x 67 cells.

Defined results: null texts count as empty; rows that repeat a document are scanned each; an empty table
gives an empty result. Without any base span the random model is the uniform one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.spans import NO_SPANS, apart, digest, listed, with_spans
from lectern.session import cut_lineage

# The base forms.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]++""",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
LEAST_ASSIGNED = 6
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
FIRST = "^"
THRESHOLD = 0.6


def scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of each row with its base spans and the tokens apart from them, written once."""
    texts = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    found = with_spans(texts, "_text", {**BASE, "tokens": TOKEN})
    assigned = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= LEAST_ASSIGNED)
    found = found.withColumn("assign", assigned)
    loose = F.filter("tokens", lambda t: apart(t, F.concat("assign", "access", "hex")))
    return found.withColumn("tokens", loose).withColumn("text_key", F.xxhash64("_text")).drop("_text")


def steps(strings: DataFrame, keep: list[str]) -> DataFrame:
    """One row per pair of neighbouring characters of ``value``, the first paired with ``FIRST``."""
    places = F.explode(F.sequence(F.lit(1), F.length("value")))
    marked = strings.where("length(value) > 0").select(*keep, F.concat(F.lit(FIRST), F.col("value")).alias("marked"), places.alias("at"))
    return marked.select(*keep, F.expr("substring(marked, at, 2)").alias("pair"))


def model(samples: DataFrame) -> DataFrame:
    """pair, ratio (millionths of a nat) from ``samples`` (value, random), distinct strings of either kind."""
    spark = samples.sparkSession
    counts = steps(samples, ["random"]).groupBy("pair").agg(
        F.count_if("random").alias("yes"), F.count_if(~F.col("random")).alias("no"))
    grid = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in FIRST + ALPHABET])).alias("a")).select(
        "a", F.explode(F.array(*[F.lit(c) for c in ALPHABET])).alias("b")).select("a", F.concat("a", "b").alias("pair"))
    cells = grid.join(counts, "pair", "left").select("a", "pair", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("yes", "no")])
    totals = cells.groupBy("a").agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
    share = lambda part, whole: F.log((F.col(part) + 1.0) / (F.col(whole) + float(len(ALPHABET))))
    return cells.join(totals, "a").select("pair", F.round((share("yes", "all_yes") - share("no", "all_no")) * 1_000_000).cast("bigint").alias("ratio"))


def random_strings(strings: DataFrame, ratios: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The distinct ``value`` whose mean ratio a character is at least ``threshold``."""
    scored = steps(strings, ["value"]).join(F.broadcast(ratios), "pair")  # at most 68 x 67 rows
    means = scored.groupBy("value").agg((F.sum("ratio") / F.count("*")).alias("mean"))
    return means.where(F.col("mean") >= threshold * 1_000_000).select("value")


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans of each document."""
    found = cut_lineage(scanned(docs, ["doc_id"]))
    base = found.select(F.explode(F.concat(
        F.transform("assign", lambda s: F.regexp_extract(s["value"], ASSIGN, 2)), F.transform(F.concat("access", "hex"), lambda s: s["value"]))).alias("value"))
    loose = found.select("doc_id", "text_key", F.explode("tokens").alias("span"))
    tokens = loose.select(F.col("span.value").alias("value")).distinct()
    allowed = F.regexp_replace("value", r"[^A-Za-z0-9+/_=-]", "")
    samples = base.select(allowed.alias("value")).distinct().withColumn("random", F.lit(True)).unionByName(tokens.withColumn("random", F.lit(False)))
    secret = random_strings(tokens, model(samples), threshold)
    hits = loose.select("doc_id", "text_key", "span", F.col("span.value").alias("value")).join(secret, "value", "left_semi")
    # One row per distinct text of an id; a row that repeats both has the same spans.
    extra = hits.groupBy("doc_id", "text_key").agg(F.array_distinct(F.collect_list("span")).alias("extra"))
    joined = found.alias("f").join(extra.alias("e"), F.col("f.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("f.text_key") == F.col("e.text_key")), "left")
    columns = {k: F.col(f"f.{k}") for k in BASE}
    everything: dict[str, Column] = {**columns, "random": F.coalesce(F.col("e.extra"), F.array().cast(NO_SPANS))}
    return joined.select(
        F.col("f.doc_id").alias("doc_id"), *[F.size(columns[k]).cast("bigint").alias(f"n_{k}") for k in BASE],
        digest(listed(columns, by_start=True)).alias("base_sha256"), listed(everything, by_start=True).alias("spans"))
