"""Personal data: fixed forms, and more identifiers by bootstrapped contextual extraction.

The base forms (e-mail addresses, IP addresses, card numbers, phone numbers) are the seeds. Each seed and
each other token that holds a digit or an at sign is an instance, met in lexical patterns: the word on its left,
the word on its right, and both. Patterns and instances form a graph. A pattern of n instances of which k are identifiers
is confident when k is at least ``LEAST_SEEDS`` and k / (n + ``DAMPING``) at least ``CONFIDENT``; all instances of a
confident pattern are identifiers. That goes on in turns, found identifiers counting like seeds, until a turn finds none. Identifiers only
become more, so it ends, and the result doesn't depend on the order of turns. With the values below a pattern of 5
identifiers may have 5 other instances, one of 20 may have 28.

Patterns and instances count as distinct texts, so copies don't weigh. Texts are scanned once.

Defined results: null texts count as empty; rows that repeat a document are scanned each; an empty table gives an
empty result; without seeds nothing is learned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.spans import NO_SPANS, apart, digest, listed, with_spans
from lectern.session import cut_lineage

# The base forms.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SMALL_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
CONTEXT = 40
LEAST_SEEDS, DAMPING, CONFIDENT = 5, 2, 0.4
ONE = 1_000_000


def _luhn(digits: Column) -> Column:
    """Whether the check digit of up to 19 digits holds."""
    total = F.lit(0)
    turned = F.reverse(digits)
    for i in range(1, 20):
        one = F.coalesce(F.substring(turned, i, 1).try_cast("int"), F.lit(0))
        total = total + (one if i % 2 else F.when(one > 4, one * 2 - 9).otherwise(one * 2))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, r"[^0-9]", "")
    if kind == "ip":
        return value.rlike(SMALL_PARTS)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _passing(kind: str) -> Column:
    return F.filter(kind, lambda s: _valid(kind, s["value"]))


def _marked(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit(f"[{kind.upper()}]").alias("mark")))


def _beside(text: Column, span: Column) -> Column:
    before = F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1, F.least(span["start"], F.lit(CONTEXT)))
    after = F.substring(text, span["stop"] + 1, F.lit(CONTEXT))
    return F.struct(
        span["start"].alias("start"), span["stop"].alias("stop"), span["value"].alias("value"),
        F.lower(F.regexp_extract(before, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1)).alias("left"),
        F.lower(F.regexp_extract(after, r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)", 1)).alias("right"))


def scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of each row with its base spans and, with the words beside them, the instances ``seeds`` and ``others``."""
    texts = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    found = with_spans(texts, "_text", {**BASE, "tokens": TOKEN})
    found = found.withColumns({kind: _passing(kind) for kind in BASE})
    base = F.concat(*BASE)
    text = F.col("_text")
    return found.select(
        *keep, *BASE, F.xxhash64("_text").alias("text_key"),
        F.transform(base, lambda s: _beside(text, s)).alias("seeds"),
        F.transform(F.filter("tokens", lambda t: apart(t, base)), lambda s: _beside(text, s)).alias("others"))


def _patterns(x: str) -> Column:
    left, right = F.col(f"{x}.left"), F.col(f"{x}.right")
    named = F.array(F.concat(F.lit("L "), left), F.concat(F.lit("R "), right), F.concat(F.lit("B "), left, F.lit(" "), right))
    return F.filter(F.when((left != "") & (right != ""), named).when(left != "", F.slice(named, 1, 1)).when(right != "", F.slice(named, 2, 1)).otherwise(F.array().cast("array<string>")), lambda p: p.isNotNull())


def bootstrap(found: DataFrame, least_seeds: int = LEAST_SEEDS, confident: float = CONFIDENT) -> DataFrame:
    """pattern, value pairs of confident patterns and their instances that are no seeds."""
    met = found.select(F.explode(F.concat(
        F.transform("seeds", lambda s: s.withField("seed", F.lit(True))), F.transform("others", lambda s: s.withField("seed", F.lit(False))))).alias("x"))
    edges = cut_lineage(
        met.select(F.explode(_patterns("x")).alias("pattern"), F.col("x.value").alias("value"), F.col("x.seed").alias("seed"))
        .groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    # A seed is one in all its patterns, also where a longer token hid it.
    seeds = edges.where("seed").select("value").distinct().withColumn("known", F.lit(True))
    # Patterns of fewer instances never have enough identifiers, whatever is found.
    large = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= least_seeds)
    live = cut_lineage(edges.join(large, "pattern").join(seeds, "value", "left").select("pattern", "value", "n", F.coalesce("known", F.lit(False)).alias("seed")))
    state = live.withColumn("known", F.col("seed"))
    while True:
        k = state.groupBy("pattern", "n").agg(F.count_if("known").alias("k"))
        sure = k.where((F.col("k") >= least_seeds) & (F.col("k") * ONE >= (F.col("n") + DAMPING) * round(confident * ONE))).select("pattern")
        fresh = cut_lineage(state.where("not known").join(sure, "pattern", "left_semi").select("value").distinct())
        if fresh.isEmpty():
            return live.where("not seed").join(sure, "pattern", "left_semi").select("pattern", "value")
        state = cut_lineage(state.join(fresh.withColumn("fresh", F.lit(True)), "value", "left").select("pattern", "value", "n", "seed", (F.col("known") | F.col("fresh").isNotNull()).alias("known")))


def identified(docs: DataFrame, keep: list[str], **options) -> DataFrame:
    """``keep`` of each row with its base spans and ``learned`` ones, as arrays of (start, stop, value)."""
    found = cut_lineage(scanned(docs, list(dict.fromkeys(["doc_id", *keep]))))
    learned = bootstrap(found, **options)
    occurrences = found.select("doc_id", "text_key", F.explode("others").alias("x")).select(
        "doc_id", "text_key", F.struct("x.start", "x.stop", "x.value").alias("span"), F.col("x.value").alias("value"), F.explode(_patterns("x")).alias("pattern"))
    hits = occurrences.join(learned, ["pattern", "value"], "left_semi")
    extra = hits.groupBy("doc_id", "text_key").agg(F.array_distinct(F.collect_list("span")).alias("learned"))
    joined = found.alias("f").join(extra.alias("e"), F.col("f.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("f.text_key") == F.col("e.text_key")), "left")
    return joined.select(*[F.col(f"f.`{c}`").alias(c) for c in dict.fromkeys(["doc_id", *keep])], F.col("f.text_key").alias("text_key"), *[F.col(f"f.{k}").alias(k) for k in BASE], F.coalesce(F.col("e.learned"), F.array().cast(NO_SPANS)).alias("learned"))


def find(docs: DataFrame, **options) -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans of each document."""
    found = identified(docs, ["doc_id"], **options)
    base = {k: F.col(k) for k in BASE}
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE],
        digest(listed(base, by_start=False)).alias("base_sha256"), listed({**base, "learned": F.col("learned")}, by_start=False).alias("spans"))


def redacted(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each span's text replaced by its kind in brackets, and n_chars to match.

    Overlapping spans are covered by one mark, of the one that begins first.
    """
    found = identified(docs, ["doc_id"], **options)
    marks = F.array_sort(F.concat(*[_marked(k) for k in [*BASE, "learned"]]))
    # Only rows with a span meet their text again; one row per distinct text of an id.
    touched = found.select("doc_id", "text_key", marks.alias("_marks")).where(F.size("_marks") > 0).dropDuplicates(["doc_id", "text_key"])
    rows = docs.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = rows.alias("d").join(touched.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d._key") == F.col("t.text_key")), "left")

    def step(so_far: Column, m: Column) -> Column:
        gap = F.substring(F.col("d.text"), so_far["at"] + 1, F.greatest(m["start"] - so_far["at"], F.lit(0)))
        piece = F.when(m["start"] >= so_far["at"], F.concat(gap, m["mark"])).otherwise(F.lit(""))
        return F.struct(F.greatest(so_far["at"], m["stop"]).alias("at"), F.concat(so_far["parts"], F.array(piece)).alias("parts"))

    clean = F.aggregate(
        F.col("t._marks"), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")), step,
        lambda end: F.concat(F.array_join(end["parts"], ""), F.substring(F.col("d.text"), end["at"] + 1, F.length(F.col("d.text")))))
    text = F.when(F.col("t._marks").isNotNull(), clean).otherwise(F.col("d.text"))
    out = []
    for name in docs.columns:
        if name == "text":
            out.append(text.alias("text"))
        elif name == "n_chars":
            out.append(F.when(F.col("t._marks").isNotNull(), F.length(text)).otherwise(F.col("d.n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            out.append(F.col(f"d.`{name}`").alias(name))
    return joined.select(*out)
