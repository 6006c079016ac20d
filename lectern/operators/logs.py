"""Request and cache logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.columns import count_if
from lectern.functions.days import to_date
from lectern.functions.ordered import scan_groups
from lectern.functions.quantile import exact_quantiles
from lectern.operators.activity import in_range
from lectern.session import cut_lineage

SUBMIT_PATH = "/api/v1/user/exercises/"
PERCENTS = (5, 25, 50, 75, 95)

REQUEST_LINE = r'^[\d.]+ \S+ \S+ \[([^\]]+) [+-]\d{4}\] "([^"]+)"'
CACHE_LINE = r'^\t1:([\d.]+) memcache: ([^ ]+) "([^"]+)" ?(\((?:success|fail)\))?\s*(?:\((\d+) bytes\))?\s*(?:\(expires (\d+)\))?'

# The last part of a cache key's name that does not vary by user or item.
KEY_PREFIXES = (
    "_ag5", ":ag5", "last_action_cache_2_", "notifications_dict_for_", "VoteRateLimiter", "FlagRateLimiter",
    "api_topic_videos", "identity_bucket", "bingo_random", "profile_from_userid:", "blog_posts_id=", "oauth_token_1/",
    "_gae_alternative:", "__gae_mini_profiler_request_",
)
SETTERS = ("set", "set_multi", "add", "add_multi", "replace", "replace_multi")
COUNTERS = ("incr", "decr", "offset_multi")
GETTERS = ("get", "get_multi")
COUNTER_BYTES = 4


def _referer() -> tuple[Column, Column]:
    empty = (F.col("referer") == "-") | (F.length(F.trim("referer")) == 0)
    tutorial = F.col("referer").contains("/e/") | F.col("referer").contains("/v/")
    return empty, tutorial


def submissions(log: DataFrame, start: str, end: str) -> DataFrame:
    return log.where(in_range(start, end) & (F.col("method") == "POST") & F.col("url").contains(SUBMIT_PATH))


def submission_source(log: DataFrame, start: str, end: str) -> DataFrame:
    """Submissions per exercise (fifth path part) by where they came from."""
    empty, tutorial = _referer()
    return submissions(log, start, end).groupBy(F.get(F.split("url", "/"), F.lit(5)).alias("exercise")).agg(
        count_if(~empty & ~tutorial).alias("from_dashboard"), count_if(tutorial).alias("non_dashboard"),
        count_if(empty).alias("empty_referer"))


def submitter_counts(log: DataFrame, start: str, end: str) -> DataFrame:
    """Users with a submission, and those with one of each origin."""
    empty, tutorial = _referer()
    math = F.col("referer").contains("/math/")
    flags = {"math_on_dashboard": ~empty & ~tutorial, "math_non_dashboard": tutorial & math,
             "non_math_non_dashboard": tutorial & ~math, "empty_referer": empty}
    users = submissions(log, start, end).where("identity IS NOT NULL").groupBy("identity").agg(
        *[F.bool_or(c).alias(name) for name, c in flags.items()])
    return users.agg(F.count(F.lit(1)).alias("unique_users"), *[count_if(F.col(n)).alias(n) for n in flags])


def url_latency_stats(
    log: DataFrame, by: str = "url", day: str | None = None, measures: Sequence[str] = ("ms", "cpu_ms", "cpm"), width: float | None = None
) -> DataFrame:
    """Per day and url (or route): requests, mean response size and exact percentiles of each measure.

    Percentiles come from counts of distinct values, so a url with a third of all requests is no
    larger a group than its distinct values.
    """
    rows = log if day is None else log.where(F.col("dt") == to_date(day))
    out = rows.groupBy("dt", by).agg(F.count(F.lit(1)).alias("count"), F.avg("bytes").alias("avg_response_bytes"))
    tall = rows.select("dt", by, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v")) for m in measures])).alias("c")).select("dt", by, "c.*")
    picked = exact_quantiles(tall, ["dt", by, "measure"], "v", {f"pct{p}": p / 100 for p in PERCENTS}, width=width)
    wide = picked.groupBy("dt", by).agg(*[
        F.max(F.when(F.col("measure") == m, F.col(f"pct{p}"))).alias(f"{m}_pct{p}") for m in measures for p in PERCENTS])
    # Joined by grouping, which keeps requests without a url.
    both = out.unionByName(wide, allowMissingColumns=True)
    return both.groupBy("dt", by).agg(*[F.max(c).alias(c) for c in both.columns if c not in ("dt", by)])


def most_hit(stats: DataFrame, n: int = 100, by: str = "url") -> DataFrame:
    return stats.orderBy(F.col("count").desc(), F.col("dt").asc(), F.col(by).asc()).limit(n)


def url_series(stats: DataFrame, value: str, by: str = "url") -> DataFrame:
    """Daily rows of one url or route."""
    return stats.where(F.col(by) == value)


def event_param_extract(df: DataFrame, col: str, name: str) -> DataFrame:
    """Rows whose ``;``-separated event text holds ``x.<name>:``, with its value."""
    pattern = r"x\.\Q" + name + r"\E:([^;]*)"
    return df.where(F.col(col).rlike(pattern)).withColumn("value", F.regexp_extract(col, pattern, 1))


def message_attempt_match(problem_log: DataFrame, messages: DataFrame, secs: int = 600) -> DataFrame:
    """Problem logs with the message shown just before, if any: same person and exercise, as many
    problems done as the problem's number less one, and less than ``secs`` seconds apart.

    The latest of several records with the same identity wins on both sides.
    """
    keys = ["id", "exercise", "n"]
    logs = problem_log.groupBy("id", "exercise", (F.col("problem_number") - 1).alias("n")).agg(
        F.max_by(F.struct("info", "ts", "dt"), "ts").alias("p"))
    texts = messages.groupBy("id", "exercise", F.col("total_done").alias("n")).agg(F.max_by(F.struct("text", "ts"), "ts").alias("m"))
    near = F.abs(F.col("m.ts") - F.col("p.ts")) < secs
    return logs.join(texts, keys, "left").select(
        "id", F.col("p.info").alias("info"), F.when(near, F.col("m.text")).otherwise(F.lit("")).alias("text"), F.col("p.dt").alias("dt"))


def read_log_lines(spark, path: str) -> DataFrame:
    """Lines of text files with their place: file, start of the block they were read in, running id."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"))
    return cut_lineage(lines)


def key_prefix(key: Column, prefixes: Sequence[str] = KEY_PREFIXES) -> Column:
    return F.regexp_replace(key, "(" + "|".join(f"\\Q{p}\\E" for p in prefixes) + ").*", "$1...")


def _is_request() -> Column:
    return ~F.startswith("value", F.lit("\t")) & F.col("value").rlike(REQUEST_LINE)


def cache_log_parse(lines: DataFrame, ignore_before: str | None = None, prefixes: Sequence[str] = KEY_PREFIXES) -> DataFrame:
    """Cache commands with the request they belong to: the nearest request line before them in the file.

    ``line_id`` and ``request_id`` are places (file, block, running number), so lines logged at one time keep their order.
    ``ignore_before`` is a text; requests older than the first one that holds it are left out.
    """
    is_request = _is_request()
    request = F.struct(
        F.struct("file", "block", "seq").alias("request_id"),
        F.to_timestamp(F.regexp_extract("value", REQUEST_LINE, 1), "dd/MMM/yyyy:HH:mm:ss").alias("time"),
        F.regexp_extract("value", REQUEST_LINE, 2).alias("url"))
    tagged = lines.withColumns({"own": F.when(is_request, request)})
    # A block of a file is a chunk; its lines are further cut into runs of 100000.
    chunk = F.struct("block", F.floor(F.col("seq") / 100000).alias("run"))
    rows = scan_groups(tagged, ["file"], ["block", "seq"], chunk, last_known={"before": (F.col("own"), F.col("own").isNotNull())})
    placed = rows.withColumn("r", F.coalesce("own", "before")).where("r IS NOT NULL")
    if ignore_before is not None:
        start = placed.where(F.col("value").contains(ignore_before)).agg(F.min("r.time")).scalar()
        placed = placed.where(F.col("r.time") >= F.coalesce(start, F.col("r.time")))
    cell = lambda i: F.regexp_extract("value", CACHE_LINE, i)
    return placed.where(F.col("own").isNull() & F.col("value").rlike(CACHE_LINE)).select(
        F.col("r.request_id").alias("request_id"), F.col("r.time").alias("request_time"), F.col("r.url").alias("url"),
        cell(1).cast("double").alias("time"), F.struct("file", "block", "seq").alias("line_id"),
        cell(2).alias("command"), cell(3).alias("key"), key_prefix(cell(3), prefixes).alias("key_prefix"),
        (cell(4) != "(fail)").alias("success"), F.coalesce(cell(5).try_cast("bigint"), F.lit(0)).alias("num_bytes"),
        F.coalesce(cell(6).try_cast("bigint"), F.lit(0)).alias("expires"))


def _labelled(ops: DataFrame) -> DataFrame:
    command = F.col("command")
    logged_get = command.isin(*GETTERS, *COUNTERS)
    return ops.withColumns({
        "at": F.struct("time", "line_id"), "sets": command.isin(*SETTERS, *COUNTERS), "gets": command.isin(*GETTERS),
        "hit": logged_get & F.col("success"), "miss": logged_get & ~F.col("success"),
        "size": F.length("key") + F.when(command.isin(*COUNTERS), COUNTER_BYTES).when(command.isin(*SETTERS), F.col("num_bytes")).otherwise(0)})


def _key_states(ops: DataFrame) -> DataFrame:
    """One row per cache key: its first and last set, last get, last miss and last size."""
    when = lambda c: F.when(F.col(c), F.col("at"))
    return ops.groupBy("key", "key_prefix").agg(
        F.min(when("sets")).alias("first_set"), F.max(when("sets")).alias("last_set"), F.max(when("gets")).alias("last_get"),
        F.max(F.when(F.col("miss") & ~F.col("sets"), F.col("at"))).alias("last_miss"), F.max_by("size", when("sets")).alias("size"))


def _tall(df: DataFrame, report: str, key: Column, value: Column) -> DataFrame:
    return df.select(F.lit(report).alias("report"), key.cast("string").alias("key"), value.cast("double").alias("value"))


def cache_distribution(ops: DataFrame) -> DataFrame:
    """Operations per command, and successful and failed gets with their share in percent."""
    o = _labelled(ops)
    commands = o.groupBy("command").agg(F.count(F.lit(1)).alias("n"))
    totals = o.agg(count_if(F.col("hit")).alias("h"), count_if(F.col("miss")).alias("m"))
    share = F.lit(100.0) * F.col("h") / F.when(F.col("h") + F.col("m") > 0, F.col("h") + F.col("m"))
    cells = totals.select(F.explode(F.array(
        F.struct(F.lit("successful gets").alias("k"), F.col("h").cast("double").alias("v")),
        F.struct(F.lit("failed gets").alias("k"), F.col("m").cast("double").alias("v")),
        F.struct(F.lit("successful gets %").alias("k"), share.alias("v")),
        F.struct(F.lit("failed gets %").alias("k"), (F.lit(100.0) - share).alias("v")))).alias("c"))
    return _tall(commands, "distribution", F.col("command"), F.col("n")).unionByName(_tall(cells, "distribution", F.col("c.k"), F.col("c.v")))


def cache_failed_gets(ops: DataFrame) -> DataFrame:
    """Failed gets per key prefix."""
    n = _labelled(ops).where("miss").groupBy("key_prefix").agg(F.count(F.lit(1)).alias("n"))
    return _tall(n, "failed_gets", F.col("key_prefix"), F.col("n"))


def cache_access_pattern(ops: DataFrame) -> DataFrame:
    """Requests by (failed gets, sets, successful gets), and with or without both a failed get and a set."""
    o = _labelled(ops)
    per_request = o.groupBy("request_id").agg(
        count_if(F.col("miss")).alias("f"), count_if(F.col("sets") & ~F.col("hit") & ~F.col("miss")).alias("s"), count_if(F.col("hit")).alias("h"))
    triple = F.concat(F.lit("("), F.concat_ws(", ", "f", "s", "h"), F.lit(")"))
    both = F.when((F.col("f") > 0) & (F.col("s") > 0), "failed get and set").otherwise("no failed get and set")
    counts = per_request.select(F.explode(F.array(triple, both)).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return _tall(counts, "access_pattern", F.col("k"), F.col("n"))


def cache_evicted_gets(ops: DataFrame) -> DataFrame:
    """Failed gets after the key had been set, per prefix."""
    o = _labelled(ops)
    firsts = o.where("sets").groupBy("key").agg(F.min("at").alias("first_set"))
    n = o.where("miss AND NOT sets").join(firsts, "key").where("at > first_set").groupBy("key_prefix").agg(F.count(F.lit(1)).alias("n"))
    return _tall(n, "evicted_gets", F.col("key_prefix"), F.col("n"))


def cache_most_gets(ops: DataFrame, k: int = 10) -> DataFrame:
    """The k keys with the most successful gets."""
    n = _labelled(ops).where("hit").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return _tall(n.orderBy(F.col("n").desc(), F.col("key").asc()).limit(k), "most_gets", F.col("key"), F.col("n"))


def cache_set_never_get(ops: DataFrame) -> DataFrame:
    """Per prefix: keys not looked up after their last set, and keys looked up after a set."""
    s = _key_states(_labelled(ops)).where("last_set IS NOT NULL")
    unused = F.col("last_get").isNull() | (F.col("last_get") < F.col("last_set"))
    used = F.col("last_get") > F.col("first_set")
    n = s.groupBy("key_prefix").agg(count_if(unused).alias("u"), count_if(used).alias("g")).where("u > 0")
    return _tall(n, "set_never_get", F.col("key_prefix"), F.col("u")).unionByName(_tall(n, "set_and_get", F.col("key_prefix"), F.col("g")))


def cache_get_never_set(ops: DataFrame) -> DataFrame:
    """Successful gets of keys that had not been set before, per prefix, and their time range."""
    o = _labelled(ops)
    firsts = o.where("sets").groupBy("key").agg(F.min("at").alias("first_set"))
    rows = o.where("hit AND NOT sets").join(firsts, "key", "left").where("first_set IS NULL OR at < first_set")
    n = rows.groupBy("key_prefix").agg(F.count(F.lit(1)).alias("n"))
    span = rows.agg(F.min("time").alias("a"), F.max("time").alias("b"))
    return _tall(n, "get_never_set", F.col("key_prefix"), F.col("n")).unionByName(
        _tall(span, "get_never_set_range", F.lit("from"), F.col("a"))).unionByName(_tall(span, "get_never_set_range", F.lit("to"), F.col("b")))


def cache_space(ops: DataFrame) -> DataFrame:
    """Bytes of the last value of each key per prefix, for keys still live and keys seen to be evicted, and
    the bytes and items of either kind in all."""
    s = _key_states(_labelled(ops)).where("last_set IS NOT NULL").withColumn(
        "state", F.when(F.col("last_miss") > F.col("last_set"), "evicted").otherwise("live"))
    n = s.groupBy("state", "key_prefix").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("items"))
    cell = lambda report, key, value: F.struct(report.alias("report"), key.alias("key"), value.cast("double").alias("value"))
    total = F.concat("state", F.lit("_total"))
    cells = n.select(F.explode(F.array(
        cell(F.concat("state", F.lit("_bytes")), F.col("key_prefix"), F.col("bytes")),
        cell(total, F.lit("bytes"), F.col("bytes")), cell(total, F.lit("items"), F.col("items")))).alias("c"))
    return cells.groupBy("c.report", "c.key").agg(F.sum("c.value").alias("value"))


def cache_idle_requests(lines: DataFrame, ops: DataFrame) -> DataFrame:
    """How many requests the log lines hold, and how many of them made no cache command.

    ``lines`` are those ``ops`` was parsed from, both over the same time.
    """
    asked = lines.agg(count_if(_is_request()).alias("n"))
    busy = ops.select("request_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    cells = asked.select(F.lit("requests").alias("key"), F.col("n").alias("value")).unionByName(
        asked.select(F.lit("without cache commands").alias("key"), (F.col("n") - busy.scalar()).alias("value")))
    return _tall(cells, "idle_requests", F.col("key"), F.col("value"))


CACHE_REPORTS = {
    "distribution": cache_distribution, "failed_gets": cache_failed_gets, "access_pattern": cache_access_pattern,
    "evicted_gets": cache_evicted_gets, "most_gets": cache_most_gets, "set_never_get": cache_set_never_get,
    "get_never_set": cache_get_never_set, "space": cache_space,
}


def cache_report(ops: DataFrame, report: str) -> DataFrame:
    """One of the cache reports as (report, key, value)."""
    return CACHE_REPORTS[report](ops)


def log_search(
    requests: DataFrame, app_lines: DataFrame, *, time: str | None = None, minutes: int = 10, status: int | None = None,
    identity: str | None = None, url: str | None = None, agent: str | None = None, text: str | None = None,
) -> DataFrame:
    """Requests that meet every given condition, with their application lines, one line per row.

    A url or agent matches as it is or stripped of all but letters, digits, _ and dots; the url may also
    be the referer.  The text may be in the request line or in any of its application lines.
    """
    if all(v is None for v in (status, identity, url, agent, text)):
        raise ValueError("search too broad: give a status, identity, url, agent or text")
    hits = requests
    if time is not None:
        at = F.lit(time).cast("timestamp")
        hits = hits.where((F.col("time") <= at) & (F.col("time") >= at - F.expr(f"INTERVAL {int(minutes)} MINUTES")))

    def same(column: str, wanted: str) -> Column:
        return F.coalesce((F.col(column) == wanted) | (F.regexp_replace(column, r"[^\w.]", "") == wanted), F.lit(False))

    if status is not None:
        hits = hits.where(F.col("status") == status)
    if url is not None:
        hits = hits.where(same("url", url) | same("referer", url))
    if agent is not None:
        hits = hits.where(same("agent", agent))
    if identity is not None:
        owners = app_lines.where("identity IS NOT NULL").groupBy("request_id").agg(F.min_by("identity", "line_no").alias("identity"))
        hits = hits.join(owners.where(F.col("identity") == identity).select("request_id"), "request_id", "left_semi")
    if text is not None:
        within = app_lines.where(F.col("line").contains(text)).select("request_id").unionByName(
            requests.where(F.col("line").contains(text)).select("request_id")).distinct()
        hits = hits.join(within, "request_id", "left_semi")
    readable = F.replace(F.replace("line", F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n"))
    own = app_lines.join(hits.select("request_id"), "request_id", "left_semi").select("request_id", "line_no", readable.alias("line"))
    return hits.select("request_id", F.lit(0).cast("bigint").alias("line_no"), "line").unionByName(own)
