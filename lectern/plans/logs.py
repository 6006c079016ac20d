"""Queries of the log block."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import logs as ops
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.learning import rounded
from lectern.plans.registry import query
from lectern.session import new_folder

START, END = "2024-01-03", "2024-01-28"

# The key's prefix, one of all by the number of the event.
_ANY_PREFIX = f"{list(ops.KEY_PREFIXES)}[k // 2 % {len(ops.KEY_PREFIXES)} + 1]"

SQL_INPUTS.update({
    "b_requests": """
        SELECT event_id, ts, dt, "user", k, event_type, CASE WHEN k % 10 <> 9 THEN 'ident' || "user" END AS identity,
               CASE WHEN event_type = 'purchase' THEN 'GET' ELSE 'POST' END AS method,
               CASE WHEN event_type IN ('click', 'error') THEN '/api/v1/user/exercises/ex_' || (k % 12) || '/problems/' || k || '/attempt' ELSE '/page/' || (k % 20) END AS url,
               ['-', 'http://x.example.org/math/a/e/b', 'http://x.example.org/science/v/c', '  ', 'http://x.example.org/task/1'][k % 5 + 1] AS referer,
               floor(value * 100)::BIGINT AS bytes, floor(value * 10)::BIGINT AS ms, floor(value * 3)::BIGINT AS cpu_ms, value / 8 AS cpm,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, 'Mozilla/5.0 (' || (k % 4) || ')' AS agent FROM b_events""",
    "b_messages": """
        SELECT "user" AS id, exercise, problem_number - 1 AS total_done, 'text ' || event_id AS text, epoch_us(ts) / 1e6 + event_id % 1500 AS ts
        FROM b_numbered_log WHERE problem_type <> 'view'
        UNION ALL SELECT "user", exercise, problem_number - 1, 'again ' || event_id, epoch_us(ts) / 1e6 + event_id % 1500 - 100 FROM b_numbered_log WHERE event_id % 2 = 0""",
    "b_cache_ops": f"""
        SELECT event_id, floor(epoch(ts))::BIGINT AS request_time, '/page/' || (k % 20) AS url, (epoch_us(ts) + CASE WHEN event_id % 4 = 0 THEN 0 ELSE o * 1000 END) / 1e6 AS time, o,
               (epoch_us(ts) + CASE WHEN event_id % 4 = 0 THEN 0 ELSE o * 1000 END) * 100 + o AS seq, command, key,
               regexp_replace(key, '({"|".join(ops.KEY_PREFIXES)}).*', '\\1...') AS key_prefix, success, num_bytes, expires
        FROM (SELECT *, 10 AS o, 'get' AS command, CASE WHEN k % 2 = 0 THEN 'ns_ag5' || "user" ELSE {_ANY_PREFIX} || "user" END AS key, k % 3 <> 0 AS success, 0 AS num_bytes, 0 AS expires FROM b_events WHERE event_id % 11 <> 0
              UNION ALL SELECT *, 9, 'set', CASE WHEN k % 2 = 0 THEN 'ns_ag5' || "user" ELSE 'plain' || k END, true, 100 + k, 2160000 FROM b_events WHERE k % 3 = 0
              UNION ALL SELECT *, 11, 'incr', 'count' || (k % 7), k % 10 <> 0, 0, 0 FROM b_events WHERE k % 5 = 0)""",
    "b_ops": """
        SELECT *, command IN ('set', 'incr') AS sets, command = 'get' AS gets, command <> 'set' AND success AS hit, command <> 'set' AND NOT success AS miss,
               length(key) + CASE command WHEN 'incr' THEN 4 ELSE num_bytes END AS size FROM b_cache_ops""",
    "b_keys": """
        SELECT key, key_prefix, MIN(seq) FILTER (WHERE sets) AS fs, MAX(seq) FILTER (WHERE sets) AS ls, MAX(seq) FILTER (WHERE gets) AS lg,
               MAX(seq) FILTER (WHERE miss AND NOT sets) AS lm, arg_max(size, seq) FILTER (WHERE sets) AS size FROM b_ops GROUP BY 1, 2""",
})


def requests(b: Inputs):
    k, kind, value = F.col("k"), F.col("event_type"), F.col("value")
    referers = F.array(*[F.lit(r) for r in (
        "-", "http://x.example.org/math/a/e/b", "http://x.example.org/science/v/c", "  ", "http://x.example.org/task/1")])
    return b.events.select(
        "event_id", "ts", "dt", "user", "k", "event_type", F.when(k % 10 != 9, F.concat(F.lit("ident"), "user")).alias("identity"),
        F.when(kind == "purchase", "GET").otherwise("POST").alias("method"),
        F.when(kind.isin("click", "error"), F.concat(F.lit("/api/v1/user/exercises/ex_"), k % 12, F.lit("/problems/"), k, F.lit("/attempt")))
        .otherwise(F.concat(F.lit("/page/"), k % 20)).alias("url"),
        F.get(referers, k % 5).alias("referer"), F.floor(value * 100).alias("bytes"), F.floor(value * 10).alias("ms"), F.floor(value * 3).alias("cpu_ms"),
        (value / 8).alias("cpm"), F.when(kind == "error", 500).otherwise(200).alias("status"),
        F.concat(F.lit("Mozilla/5.0 ("), k % 4, F.lit(")")).alias("agent"))


@query("submission_source", "LO-1", """
    WITH r AS (SELECT *, referer = '-' OR length(trim(referer)) = 0 AS e, contains(referer, '/e/') OR contains(referer, '/v/') AS t FROM b_requests
               WHERE method = 'POST' AND contains(url, '/api/v1/user/exercises/') AND dt >= DATE '2024-01-03' AND dt < DATE '2024-01-28')
    SELECT string_split(url, '/')[6] AS exercise, COUNT(*) FILTER (WHERE NOT e AND NOT t) AS from_dashboard, COUNT(*) FILTER (WHERE t) AS non_dashboard,
           COUNT(*) FILTER (WHERE e) AS empty_referer FROM r GROUP BY 1""")
def submission_source(b: Inputs):
    return ops.submission_source(requests(b), START, END)


@query("submitter_counts", "LO-2", """
    WITH r AS (SELECT *, referer = '-' OR length(trim(referer)) = 0 AS e, contains(referer, '/e/') OR contains(referer, '/v/') AS t, contains(referer, '/math/') AS m FROM b_requests
               WHERE method = 'POST' AND contains(url, '/api/v1/user/exercises/') AND dt >= DATE '2024-01-03' AND dt < DATE '2024-01-28' AND identity IS NOT NULL),
    u AS (SELECT identity, MAX((NOT e AND NOT t)::INT) AS a, MAX((t AND m)::INT) AS b, MAX((t AND NOT m)::INT) AS c, MAX(e::INT) AS d FROM r GROUP BY 1)
    SELECT COUNT(*) AS unique_users, SUM(a)::BIGINT AS math_on_dashboard, SUM(b)::BIGINT AS math_non_dashboard, SUM(c)::BIGINT AS non_math_non_dashboard,
           SUM(d)::BIGINT AS empty_referer FROM u""")
def submitter_counts(b: Inputs):
    return ops.submitter_counts(requests(b), START, END)


_PCT = ", ".join(f"round(quantile_cont({m}, {p / 100}), 9) AS {m}_pct{p}" for m in ("ms", "cpu_ms", "cpm") for p in ops.PERCENTS)
SQL_INPUTS["b_url_stats"] = f"SELECT dt, url, COUNT(*) AS count, round(AVG(bytes), 9) AS avg_response_bytes, {_PCT} FROM b_requests GROUP BY 1, 2"


def url_stats(b: Inputs):
    return rounded(ops.url_latency_stats(requests(b)), 9)


query("url_latency_stats", "LO-3", "SELECT * REPLACE (dt::VARCHAR AS dt) FROM b_url_stats")(url_stats)

query("route_latency_stats", "LO-3", f"""
    SELECT dt::VARCHAR AS dt, split_part(url, '/', 2) AS url_route, COUNT(*) AS count, round(AVG(bytes), 6) AS avg_response_bytes,
           {', '.join(f'round(quantile_cont(ms, {p / 100}), 6) AS ms_pct{p}' for p in ops.PERCENTS)} FROM b_requests WHERE dt = DATE '2024-01-10' GROUP BY dt, 2""")(
    lambda b: rounded(ops.url_latency_stats(
        requests(b).withColumn("url_route", F.get(F.split("url", "/"), F.lit(1))), "url_route", "2024-01-10", ["ms"])))

query("most_hit_urls", "LO-3", "SELECT dt::VARCHAR AS dt, url, count FROM b_url_stats ORDER BY count DESC, b_url_stats.dt, url LIMIT 100")(
    lambda b: ops.most_hit(requests(b).groupBy("dt", "url").agg(F.count(F.lit(1)).alias("count"))))

query("url_series", "LO-3", "SELECT * REPLACE (dt::VARCHAR AS dt) FROM b_url_stats WHERE url = '/page/3'")(
    lambda b: ops.url_series(url_stats(b), "/page/3"))


@query("event_param_extract", "LO-4", """
    SELECT event_id, 'try ' || k AS value FROM b_events WHERE event_type <> 'view'""")
def event_param_extract(b: Inputs):
    text = F.concat(F.lit("param:seen;x.lesson.text_size:3;"), F.when(F.col("event_type") != "view", F.concat(F.lit("x.lesson.text:try "), "k", F.lit(";"))).otherwise(""),
                    F.lit("x.lesson.total:"), "event_id", F.lit(";"))
    return ops.event_param_extract(b.events.select("event_id", text.alias("event")), "event", "lesson.text").drop("event")


@query("message_attempt_match", "LO-5", """
    WITH m AS (SELECT id, exercise, total_done, arg_max(text, ts) AS text, MAX(ts) AS ts FROM b_messages GROUP BY 1, 2, 3)
    SELECT "user" AS id, 'log ' || event_id AS info, CASE WHEN abs(m.ts - epoch_us(p.ts) / 1e6) < 600 THEN m.text ELSE '' END AS text, dt::VARCHAR AS dt
    FROM b_numbered_log p LEFT JOIN m ON m.id = p."user" AND m.exercise = p.exercise AND m.total_done = p.problem_number - 1""")
def message_attempt_match(b: Inputs):
    ident = F.col("event_id")
    log = b.numbered_log.withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    logs = log.select(F.col("user").alias("id"), "exercise", "problem_number", F.concat(F.lit("log "), ident).alias("info"), F.col("t").alias("ts"), "dt")
    shown = log.select(F.col("user").alias("id"), "exercise", (F.col("problem_number") - 1).alias("total_done"), "event_id", "problem_type", "t")
    messages = shown.where("problem_type <> 'view'").select(
        "id", "exercise", "total_done", F.concat(F.lit("text "), ident).alias("text"), (F.col("t") + ident % 1500).alias("ts"),
    ).unionByName(shown.where("event_id % 2 = 0").select(
        "id", "exercise", "total_done", F.concat(F.lit("again "), ident).alias("text"), (F.col("t") + ident % 1500 - 100).alias("ts")))
    return ops.message_attempt_match(logs, messages)


def cache_lines(b: Inputs):
    """The events as raw log text, read back line by line: up to twelve lines each, some logged at one time."""
    k, micros = F.col("k"), F.unix_micros(F.col("ts").cast("timestamp"))
    line = lambda o, *rest: F.concat(F.lit("\n\t1:"), ((micros + F.when(F.col("event_id") % 4 == 0, 0).otherwise(o * 1000)).cast("decimal(20,0)") / 1000000).cast("decimal(20,6)").cast("string"), F.lit(" memcache: "), *rest)
    owned = F.concat(F.when(k % 2 == 0, F.lit("ns_ag5")).otherwise(F.get(F.array(*map(F.lit, ops.KEY_PREFIXES)), F.floor(k / 2) % len(ops.KEY_PREFIXES))), "user")
    text = F.concat(
        F.lit("10.0.0.1 - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "/page/'), k % 20, F.lit('" 200'),
        *[F.lit(f"\n\t1:0.{i} note: nothing to see") for i in range(8)],
        F.when(k % 3 == 0, line(9, F.lit('set "'), F.when(k % 2 == 0, owned).otherwise(F.concat(F.lit("plain"), k)), F.lit('" ('), 100 + k, F.lit(" bytes) (expires 2160000)"))).otherwise(""),
        F.when(F.col("event_id") % 11 != 0, line(10, F.lit('get "'), owned, F.when(k % 3 == 0, '" (fail)').otherwise('" (success)'))).otherwise(""),
        F.when(k % 5 == 0, line(11, F.lit('incr "count'), k % 7, F.when(k % 10 == 0, '" (fail)').otherwise('" (success)'))).otherwise(""))
    path = new_folder(b.spark, "log")
    b.events.select(text.alias("value")).write.text(path)
    return ops.read_log_lines(b.spark, path)


def cache_ops(b: Inputs):
    return ops.cache_log_parse(cache_lines(b))


@query("cache_idle_requests", "LO-7", """
    SELECT 'idle_requests' AS report, 'requests' AS key, COUNT(*)::DOUBLE AS value FROM b_events
    UNION ALL SELECT 'idle_requests', 'without cache commands', COUNT(*)::DOUBLE FROM b_events WHERE event_id % 11 = 0 AND k % 3 <> 0 AND k % 5 <> 0""")
def cache_idle_requests(b: Inputs):
    lines = cache_lines(b)
    return ops.cache_idle_requests(lines, ops.cache_log_parse(lines))


@query("cache_log_parse", "LO-6", "SELECT request_time, url, time, command, key, key_prefix, success, num_bytes::BIGINT AS num_bytes, expires::BIGINT AS expires FROM b_cache_ops")
def cache_log_parse(b: Inputs):
    return cache_ops(b).drop("request_id", "line_id").withColumn("request_time", F.unix_timestamp("request_time"))


_CACHE_SQL = {
    "distribution": """
        SELECT 'distribution' AS report, command AS key, COUNT(*)::DOUBLE AS value FROM b_ops GROUP BY 2
        UNION ALL SELECT 'distribution', 'successful gets', SUM(hit::INT)::DOUBLE FROM b_ops UNION ALL SELECT 'distribution', 'failed gets', SUM(miss::INT)::DOUBLE FROM b_ops
        UNION ALL SELECT 'distribution', 'successful gets %', 100.0 * SUM(hit::INT) / SUM(hit::INT + miss::INT) FROM b_ops
        UNION ALL SELECT 'distribution', 'failed gets %', 100.0 - 100.0 * SUM(hit::INT) / SUM(hit::INT + miss::INT) FROM b_ops""",
    "failed_gets": "SELECT 'failed_gets' AS report, key_prefix AS key, COUNT(*)::DOUBLE AS value FROM b_ops WHERE miss GROUP BY 2",
    "access_pattern": """
        WITH r AS (SELECT event_id, COUNT(*) FILTER (WHERE miss) AS f, COUNT(*) FILTER (WHERE sets AND NOT hit AND NOT miss) AS s, COUNT(*) FILTER (WHERE hit) AS h FROM b_ops GROUP BY 1)
        SELECT 'access_pattern' AS report, '(' || f || ', ' || s || ', ' || h || ')' AS key, COUNT(*)::DOUBLE AS value FROM r GROUP BY 2
        UNION ALL SELECT 'access_pattern', CASE WHEN f > 0 AND s > 0 THEN 'failed get and set' ELSE 'no failed get and set' END, COUNT(*)::DOUBLE FROM r GROUP BY 2""",
    "evicted_gets": """
        SELECT 'evicted_gets' AS report, o.key_prefix AS key, COUNT(*)::DOUBLE AS value FROM b_ops o JOIN b_keys k ON k.key = o.key WHERE miss AND NOT sets AND o.seq > k.fs GROUP BY 2""",
    "most_gets": """
        SELECT 'most_gets' AS report, key, n::DOUBLE AS value FROM (SELECT key, COUNT(*) AS n FROM b_ops WHERE hit GROUP BY 1 ORDER BY n DESC, key LIMIT 10)""",
    "set_never_get": """
        WITH n AS (SELECT key_prefix, COUNT(*) FILTER (WHERE lg IS NULL OR lg < ls) AS u, COUNT(*) FILTER (WHERE lg > fs) AS g FROM b_keys WHERE ls IS NOT NULL GROUP BY 1 HAVING u > 0)
        SELECT 'set_never_get' AS report, key_prefix AS key, u::DOUBLE AS value FROM n UNION ALL SELECT 'set_and_get', key_prefix, g::DOUBLE FROM n""",
    "get_never_set": """
        WITH r AS (SELECT o.* FROM b_ops o JOIN b_keys k ON k.key = o.key WHERE hit AND NOT sets AND (k.fs IS NULL OR o.seq < k.fs))
        SELECT 'get_never_set' AS report, key_prefix AS key, COUNT(*)::DOUBLE AS value FROM r GROUP BY 2
        UNION ALL SELECT 'get_never_set_range', 'from', MIN(time) FROM r UNION ALL SELECT 'get_never_set_range', 'to', MAX(time) FROM r""",
    "space": """
        WITH s AS (SELECT *, CASE WHEN lm > ls THEN 'evicted' ELSE 'live' END AS state FROM b_keys WHERE ls IS NOT NULL)
        SELECT state || '_bytes' AS report, key_prefix AS key, SUM(size)::DOUBLE AS value FROM s GROUP BY 1, 2
        UNION ALL SELECT state || '_total', 'bytes', SUM(size)::DOUBLE FROM s GROUP BY 1 UNION ALL SELECT state || '_total', 'items', COUNT(*)::DOUBLE FROM s GROUP BY 1""",
}
for _report, _sql in _CACHE_SQL.items():
    query(f"cache_{_report}", "LO-7", f"SELECT report, key, round(value, 6) AS value FROM ({_sql})")(
        lambda b, report=_report: rounded(ops.cache_report(cache_ops(b), report)))


@query("log_search", "LO-8", """
    WITH h AS (SELECT * FROM b_requests WHERE status = 200 AND url = '/page/1' AND ts <= TIMESTAMP '2024-01-20' AND ts >= TIMESTAMP '2024-01-10'
               AND (contains('request ' || url || ' ' || referer, 'science') OR k % 3 = 1))
    SELECT event_id AS request_id, 0 AS line_no, 'request ' || url || ' ' || referer AS line FROM h
    UNION ALL SELECT event_id, 1, 'note ' || event_id FROM h UNION ALL SELECT event_id, 2, 'science' || chr(9) || 'fair' FROM h WHERE k % 3 = 1""")
def log_search(b: Inputs):
    rows = requests(b)
    found = rows.select(F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("time"), "status", "url", "referer", "agent",
                        F.concat_ws(" ", F.lit("request"), "url", "referer").alias("line"))
    notes = F.array(F.struct(F.lit(1).cast("bigint").alias("line_no"), F.concat(F.lit("note "), "event_id").alias("line")),
                    F.when(F.col("k") % 3 == 1, F.struct(F.lit(2).cast("bigint").alias("line_no"), F.lit("science\\tfair").alias("line"))))
    app = rows.select(F.col("event_id").alias("request_id"), "identity", F.explode(F.array_compact(notes)).alias("n")).select("request_id", "identity", "n.*")
    return ops.log_search(found, app, time="2024-01-20", minutes=10 * 24 * 60, status=200, url="page1", text="science")
