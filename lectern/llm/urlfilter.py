"""URL filters: rules first, then naive Bayes over segmented hosts and path tokens.

Host names concatenate words, so each run of letters of a host is split into words by a unigram Viterbi
search. The word counts are those of all page texts and of all letter runs in hosts and paths. Nothing is sent to
every task for this: each distinct run is expanded into its substrings of up to ``LONGEST`` letters, these meet the word counts by a join,
and the search runs over the substrings of one run (at most 63 letters a label, so that group is bounded; longer runs,
which no host can have, are cut into such labels).

Urls that a rule judges are the labelled sample. Multinomial naive Bayes counts distinct labelled urls by
token, smoothed by one; a few fixed spam words count as seen in blocked urls ``LEXICON_WEIGHT`` times. Log ratios are
whole millionths, so sums don't depend on order. A url's score is the class ratio plus that of its tokens;
above zero it is blocked.

Defined results: a null url, or one without ``://``, has empty host and path and no tokens; repeated rows
are judged each; an empty table gives an empty result; without labelled urls of one class the class ratio is
smoothed by one and the words of the lexicon decide.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lectern.session import cut_lineage

# The rules (host, path start) and their verdicts.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
# Words of hosts and paths that sell or lure.
SPAM_WORDS = (
    "adult", "bet", "bonus", "casino", "cheap", "clickbait", "crack", "credit", "dating", "deals", "discount", "earn", "escort", "forex", "free",
    "gambling", "hack", "jackpot", "keygen", "loan", "lottery", "malware", "nude", "payday", "pharmacy", "phishing", "pills", "poker",
    "porn", "prize", "profit", "rich", "scam", "sex", "slots", "spam", "torrent", "viagra", "warez", "win", "winner", "xxx")
LEXICON_WEIGHT = 50
LONGEST, LABEL = 20, 63
ONE = 1_000_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (text, verdict), else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), r))
    found = None
    for domain, start, verdict in ordered:
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        value = F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def runs(text: Column) -> Column:
    """Runs of letters in lower case, in pieces of at most ``LABEL``."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{1," + str(LABEL) + "}"), F.lit(0))


def word_counts(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """word, n over the texts of all pages (tags, scripts and styles left out) and the letter runs of all urls."""
    text = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</\1>|<[^>]*>|&[a-z]+;", " ")
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?<!\p{L})\p{L}{1," + str(LONGEST) + r"}(?!\p{L})"), F.lit(0))
    near = urls.select(F.explode(F.concat(runs(F.col("host")), runs(F.col("path")))).alias("word"))
    return pages.select(F.explode(words).alias("word")).unionByName(near).where(F.length("word") <= LONGEST).groupBy("word").agg(F.count("*").alias("n"))


def best_split(length: int, pieces: list[tuple[int, int, float]], other: float) -> list[tuple[int, int]]:
    """The most likely split of ``length`` letters into ``pieces`` (start, stop, log probability).

    A letter no word covers costs ``other``. Of equally likely splits the one with longer first words is taken.
    """
    by_start: dict[int, list[tuple[int, float]]] = defaultdict(list)
    for start, stop, value in pieces:
        by_start[start].append((stop, value))
    best = [(-np.inf, 0)] * (length + 1)
    best[length] = (0.0, length)
    for start in range(length - 1, -1, -1):
        options = [(value + best[stop][0], stop) for stop, value in by_start[start]]
        options.append((other + best[start + 1][0], start + 1))
        best[start] = max(options)
    out, at = [], 0
    while at < length:
        out.append((at, best[at][1]))
        at = best[at][1]
    return out


def segments(distinct_runs: DataFrame, counts: DataFrame) -> DataFrame:
    """run, words of each distinct ``run``."""
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    starts = distinct_runs.select("run", F.explode(F.sequence(F.lit(0), F.length("run") - 1)).alias("start"))
    subs = starts.select("run", "start", F.explode(F.expr(f"sequence(start + 1, least(start + {LONGEST}, length(run)))")).alias("stop"))
    named = subs.withColumn("word", F.expr("substring(run, start + 1, stop - start)"))
    # A run met nowhere else would always be its own best word, so a word needs two occurrences.
    priced = named.join(counts.where("n > 1"), "word").withColumn("value", F.log(F.col("n") / float(total)))
    known = priced.groupBy("run").agg(F.collect_list(F.struct("start", "stop", "value")).alias("pieces"))
    other = float(np.log(0.1 / total) - 2.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for word, pieces in zip(batch["run"], batch["pieces"]):
                found = [(p["start"], p["stop"], p["value"]) for p in (pieces if pieces is not None else [])]
                out.append([word[a:b] for a, b in best_split(len(word), found, other)])
            yield pd.DataFrame({"run": batch["run"], "words": out})

    return distinct_runs.join(known, "run", "left").mapInPandas(run, "run string, words array<string>")


def _path_tokens(path: Column) -> Column:
    """Letter runs, and numbers by their length."""
    numbers = F.transform(F.regexp_extract_all(path, F.lit(r"[0-9]+"), F.lit(0)), lambda n: F.concat(F.lit("#"), F.length(n).cast("string")))
    return F.concat(runs(path), numbers)


def judge(pages: DataFrame, rules=RULES, lexicon=SPAM_WORDS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (millionths of a nat, above 0 is block) and the host's words."""
    urls = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = cut_lineage(urls.select("host", "path").distinct())
    ruled = parts.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    hosts = parts.select("host").distinct()
    met = hosts.select("host", F.posexplode(runs(F.col("host"))).alias("place", "run"))
    counts = cut_lineage(word_counts(pages, urls))
    split = segments(met.select("run").distinct(), counts)
    host_words = cut_lineage(met.join(split, "run").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "words"))).alias("w")).select("host", F.flatten(F.col("w.words")).alias("words")))

    hosted = host_words.select("host", F.explode("words").alias("word")).select("host", F.concat(F.lit("h:"), F.col("word")).alias("token"))
    pathed = parts.select("path").distinct().select("path", F.explode(_path_tokens(F.col("path"))).alias("word")).select("path", F.concat(F.lit("p:"), F.col("word")).alias("token"))
    labelled = ruled.where("found IS NOT NULL").select("host", "path", (F.col("found.verdict") == "block").cast("int").alias("blocked"))
    # Labelled urls are summed by host and by path before they meet tokens.
    summed = lambda key: labelled.groupBy(key).agg(F.sum("blocked").alias("bad"), F.sum(1 - F.col("blocked")).alias("good"))
    seen = hosted.join(summed("host"), "host").select("token", "bad", "good").unionByName(pathed.join(summed("path"), "path").select("token", "bad", "good"))
    spark = pages.sparkSession
    known = spark.range(1).select(F.explode(F.array(*[F.lit(p + w) for w in lexicon for p in ("h:", "p:")])).alias("token"), F.lit(LEXICON_WEIGHT).cast("bigint").alias("bad"), F.lit(0).cast("bigint").alias("good"))
    tokens = cut_lineage(seen.unionByName(known).groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    sums = tokens.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("b"), F.coalesce(F.sum("good"), F.lit(0)).alias("g"), F.count("*").alias("v")).first()
    classes = labelled.agg(F.coalesce(F.sum("blocked"), F.lit(0)).alias("b"), F.coalesce(F.sum(1 - F.col("blocked")), F.lit(0)).alias("g")).first()
    share = lambda c, whole: F.log((F.col(c) + 1.0) / float(whole + sums["v"] + 1))
    # The lexicon adds to its own words and takes nothing from the others.
    ratios = tokens.select("token", F.round((share("bad", sums["b"] - 2 * len(lexicon) * LEXICON_WEIGHT) - share("good", sums["g"])) * ONE).cast("bigint").alias("ratio"))
    base = int(round(np.log((classes["b"] + 1.0) / (classes["g"] + 1.0)) * ONE))
    by_host = hosted.join(ratios, "token").groupBy("host").agg(F.sum("ratio").alias("host_score"))
    by_path = pathed.join(ratios, "token").groupBy("path").agg(F.sum("ratio").alias("path_score"))

    scored = (
        ruled.join(by_host, "host", "left").join(by_path, "path", "left").join(host_words, "host", "left")
        .withColumn("score", F.coalesce("host_score", F.lit(0)) + F.coalesce("path_score", F.lit(0)) + base)
        .select("host", "path", "found", "score", F.array_join("words", " ").alias("words")))
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("score") > 0, "block").otherwise("allow"))
    return urls.join(scored, ["host", "path"]).select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "score", "words")
