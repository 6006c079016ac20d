"""Queries of the coach and geography blocks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lectern.operators import coach as ops, geo
from lectern.operators.activity import ACTIVITY_COUNTS
from lectern.plans.bindings import SQL_INPUTS, Inputs
from lectern.plans.registry import query
from lectern.session import cut_lineage

START, END = "1995-01-01", "2001-09-01"


def coached_users(b: Inputs):
    """Users with a list of coaches: the nation's, sometimes their own address or id, sometimes none."""
    nation = F.concat(F.lit("coach"), "c_nationkey")
    segment = F.col("c_mktsegment")
    return b.users.join(b.table("customer").select(F.col("c_custkey").alias("user"), "c_nationkey", "c_mktsegment"), "user").select(
        "user", "user_id", "user_email", "user_nickname", "joined", "identity", F.when(segment == "BUILDING", F.array(nation, F.col("user_email")))
        .when(segment == "FURNITURE", F.array(F.col("user_id"))).when(segment == "MACHINERY", F.array().cast("array<string>"))
        .otherwise(F.array(nation, F.lit("everyone"))).alias("coaches"))


SQL_INPUTS.update({
    "b_coach_mapping": """
        SELECT u."user", u.user_id, u.user_email, joined, coach, coach = u.user_email OR coach = u.user_id AS self_coach FROM (
            SELECT c_custkey, unnest(CASE c_mktsegment WHEN 'BUILDING' THEN ['coach' || c_nationkey, lower(c_name) || '@example.org']
                WHEN 'FURNITURE' THEN ['id' || c_custkey] WHEN 'MACHINERY' THEN [] ELSE ['coach' || c_nationkey, 'everyone'] END) AS coach
            FROM customer) JOIN b_users u ON u."user" = c_custkey""",
    "b_coach_summary": """
        SELECT coach, COUNT(*) AS num_students, bool_or(self_coach) AS self_coaching FROM b_coach_mapping GROUP BY 1""",
    "b_user_coach_summary": """
        SELECT m."user", COUNT(*) AS num_coaches, MAX(num_students) AS max_coach_students
        FROM b_coach_mapping m JOIN b_coach_summary s ON m.coach = s.coach WHERE NOT m.self_coach GROUP BY 1""",
    "b_pairs": """
        SELECT DISTINCT o_custkey AS "user", CAST(floor((o_totalprice / 1000) * (o_totalprice / 1000) / 100) AS BIGINT) AS coach,
               MIN(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS joined_on FROM orders""",
    "b_teachers": """
        SELECT coach AS teacher, joined_on AS dt FROM (
            SELECT *, row_number() OVER (PARTITION BY coach ORDER BY joined_on) AS n FROM b_pairs WHERE "user" <> coach) WHERE n = 10""",
    "b_students": """
        SELECT p."user" AS student, t.teacher, GREATEST(MIN(t.dt), MIN(p.joined_on)) AS dt
        FROM b_pairs p JOIN b_teachers t ON p.coach = t.teacher WHERE p."user" <> p.coach GROUP BY 1, 2""",
    "b_small_coaches": "SELECT coach, MIN(joined_on) AS dt FROM b_pairs GROUP BY 1 HAVING COUNT(*) < 10",
    "b_singles": """
        SELECT "user", coach, MIN(joined_on) AS dt FROM b_pairs WHERE "user" NOT IN (SELECT student FROM b_students) GROUP BY 1, 2""",
    "b_page_visits": """
        SELECT DISTINCT 'ident' || o_custkey AS identity, CAST(o_orderdate AS DATE) AS dt FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "b_order_counts": """
        SELECT o_custkey AS "user", CAST(o_orderdate AS DATE) AS dt, (o_orderstatus = 'P')::INT AS feedback_items, 1 AS videos_started,
               (o_orderstatus = 'F')::INT AS videos_completed, CAST(floor(o_totalprice / 50) AS BIGINT) AS videos_seconds,
               1 AS exercises_started, (o_orderstatus = 'O')::INT AS exercises_completed,
               CAST(floor(o_totalprice / 10000) AS BIGINT) AS exercises_problems_done,
               CAST(floor(o_totalprice / 20) AS BIGINT) AS exercises_seconds FROM orders""",
    "b_classes": """
        WITH n AS (SELECT DISTINCT coach AS teacher, "user" AS student FROM b_pairs WHERE coach <> "user")
        SELECT * FROM n WHERE teacher IN (SELECT teacher FROM n GROUP BY 1 HAVING COUNT(*) >= 10)""",
    "b_ranges": """
        SELECT (10 + 2 * n_nationkey) * 16777216::BIGINT + n_nationkey * 1000000 AS lo,
               (10 + 2 * n_nationkey) * 16777216::BIGINT + n_nationkey * 1000000 + 30000000 AS hi,
               'City ' || n_nationkey AS city, 'R' || n_regionkey AS region, 'C' || n_nationkey AS country_code,
               n_name AS country, n_nationkey * 1.5::DOUBLE AS latitude, n_nationkey * -2.5::DOUBLE AS longitude FROM nation""",
    "b_ips": """
        SELECT event_id, "user", dt, ipn, (ipn // 16777216) || '.' || (ipn // 65536 % 256) || '.' || (ipn // 256 % 256) || '.' || (ipn % 256) AS ip
        FROM (SELECT *, 167772160 + ("user" * 3875 * 997 * 41 + (k % 3) * 7777777) % 1000000000 AS ipn FROM b_events)""",
    "b_located": """
        SELECT i.*, COALESCE(city, 'null') AS city, COALESCE(region, 'null') AS region, COALESCE(country_code, 'null') AS country_code,
               COALESCE(country, 'null') AS country, latitude, longitude
        FROM b_ips i LEFT JOIN b_ranges r ON i.ipn BETWEEN r.lo AND r.hi""",
    "b_user_ip": """
        SELECT "user", ip, n FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY n DESC, ip) AS r FROM (
            SELECT "user", ip, COUNT(*) AS n FROM b_ips GROUP BY 1, 2)) WHERE r = 1""",
    "b_teacher_ip": """
        SELECT teacher, ip FROM (SELECT *, row_number() OVER (PARTITION BY teacher ORDER BY n DESC, ip) AS r FROM (
            SELECT teacher, ip, COUNT(*) AS n FROM b_students JOIN b_user_ip ON student = "user" GROUP BY 1, 2)) WHERE r = 1""",
    "b_teacher_country": """
        SELECT t.teacher, s.student_count, u.user_id, u.user_email, u.user_nickname, u.joined, t.ip, l.city, l.region, l.country_code,
               l.country, l.latitude, l.longitude
        FROM b_teacher_ip t JOIN (SELECT teacher, COUNT(*) AS student_count FROM b_students GROUP BY 1) s USING (teacher)
        JOIN b_users u ON u."user" = t.teacher
        JOIN (SELECT DISTINCT ip, city, region, country_code, country, latitude, longitude FROM b_located) l ON l.ip = t.ip""",
})


def pairs(b: Inputs):
    """Customers and their coaches, numbered by order size so that low numbers have large classes."""
    size = F.col("o_totalprice") / 1000
    orders = b.table("orders").select(
        F.col("o_custkey").alias("user"), F.floor(size * size / 100).cast("bigint").alias("coach"), F.to_date("o_orderdate").alias("dt"))
    first = orders.groupBy("user").agg(F.min("dt").alias("joined_on"))
    return orders.select("user", "coach").distinct().join(first, "user").select(
        "user", "coach", "joined_on", (F.col("user") == F.col("coach")).alias("self_coach"),
        F.concat(F.lit("ident"), "user").alias("identity"))


def order_counts(b: Inputs):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return b.table("orders").select(
        F.col("o_custkey").alias("user"), F.to_date("o_orderdate").alias("dt"), (status == "P").cast("int").alias("feedback_items"),
        F.lit(1).alias("videos_started"), (status == "F").cast("int").alias("videos_completed"),
        F.floor(price / 50).alias("videos_seconds"), F.lit(1).alias("exercises_started"),
        (status == "O").cast("int").alias("exercises_completed"), F.floor(price / 10000).alias("exercises_problems_done"),
        F.floor(price / 20).alias("exercises_seconds"))


def page_visits(b: Inputs):
    return b.table("orders").where("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("ident"), "o_custkey").alias("identity"), F.to_date("o_orderdate").alias("dt")).distinct()


def ranges(b: Inputs):
    key = F.col("n_nationkey").cast("bigint")
    low = (10 + 2 * key) * 16777216 + key * 1000000
    return b.table("nation").select(
        low.alias("lo"), (low + 30000000).alias("hi"), F.concat(F.lit("City "), key).alias("city"),
        F.concat(F.lit("R"), "n_regionkey").alias("region"), F.concat(F.lit("C"), key).alias("country_code"),
        F.col("n_name").alias("country"), (key * 1.5).alias("latitude"), (key * -2.5).alias("longitude"))


def dotted(n: Column) -> Column:
    return F.concat_ws(".", *[(F.floor(n / d) % 256).cast("string") for d in (16777216, 65536, 256, 1)])


def event_ips(b: Inputs):
    number = 167772160 + (F.col("user") * 3875 * 997 * 41 + (F.col("k") % 3) * 7777777) % 1000000000
    return cut_lineage(b.events.select("event_id", "user", "dt", dotted(number).alias("ip")))


@query("user_coach_mapping", "CO-1", 'SELECT "user", coach, self_coach FROM b_coach_mapping')
def user_coach_mapping(b: Inputs):
    return ops.user_coach_mapping(coached_users(b)).select("user", "coach", "self_coach")


@query("coach_summary", "CO-2", "SELECT * FROM b_coach_summary")
def coach_summary(b: Inputs):
    return ops.coach_summary(user_coach_mapping(b))


@query("user_coach_summary", "CO-3", "SELECT * FROM b_user_coach_summary")
def user_coach_summary(b: Inputs):
    return ops.user_coach_summary(user_coach_mapping(b), coach_summary(b))


@query("userdata_info", "CO-4", """
    SELECT u."user", user_id, user_email, user_nickname, joined::VARCHAR AS joined, registered,
           COALESCE(max_coach_students, 0) >= 1 AS is_coached, COALESCE(max_coach_students, 0) >= 10 AS is_student
    FROM b_users u LEFT JOIN b_user_coach_summary s ON u."user" = s."user" """)
def userdata_info(b: Inputs):
    return ops.userdata_info(b.users, user_coach_summary(b))


@query("teacher_since", "CO-5", "SELECT teacher, dt::VARCHAR AS dt FROM b_teachers")
def teacher_since(b: Inputs):
    return ops.teacher_since(pairs(b))


@query("student_since", "CO-6", "SELECT student, teacher, dt::VARCHAR AS dt FROM b_students")
def student_since(b: Inputs):
    return ops.student_since(pairs(b), teacher_since(b))


@query("small_coach_since", "CO-7", "SELECT coach, dt::VARCHAR AS dt FROM b_small_coaches")
def small_coach_since(b: Inputs):
    return ops.small_coach_since(pairs(b))


@query("small_class_users", "CO-8", 'SELECT "user", coach, dt::VARCHAR AS dt FROM b_singles')
def small_class_users(b: Inputs):
    return ops.small_class_users(pairs(b), student_since(b))


@query("cumulative_daily_count", "CO-9", """
    SELECT d::DATE::VARCHAR AS dt, (SELECT COUNT(*) FROM b_students WHERE b_students.dt <= d::DATE) AS count
    FROM (SELECT unnest(generate_series((SELECT MIN(dt) FROM b_students), DATE '2001-08-31', INTERVAL 1 DAY)) AS d)""")
def cumulative_daily_count(b: Inputs):
    return ops.cumulative_daily_count(student_since(b), END)


for _k in (1, 2, 4):
    query(f"rolling_active_users_{_k}d", "CO-10", f"""
        WITH a AS (SELECT DISTINCT "user", dt FROM b_events WHERE dt < DATE '2024-02-10'),
        t AS (SELECT "user", d, COUNT(*) AS n FROM (SELECT "user", unnest(generate_series(dt + 1, dt + 28, INTERVAL 1 DAY))::DATE AS d FROM a) GROUP BY 1, 2),
        s AS (SELECT unnest(generate_series((SELECT MIN(dt) FROM a), DATE '2024-02-09', INTERVAL 1 DAY))::DATE AS d)
        SELECT s.d::VARCHAR AS dt, COUNT(*) FILTER (WHERE n >= {_k}) AS users FROM s LEFT JOIN t ON s.d = t.d GROUP BY s.d""")(
        lambda b, k=_k: ops.rolling_active_users(b.events, "2024-02-10", min_days=k))

query("rolling_active_users_history", "CO-10", """
    WITH a AS (SELECT DISTINCT "user", dt FROM b_order_days WHERE dt < DATE '2001-09-01'),
    t AS (SELECT "user", d, COUNT(*) AS n FROM (SELECT "user", unnest(generate_series(dt + 1, dt + 28, INTERVAL 1 DAY))::DATE AS d FROM a) GROUP BY 1, 2),
    s AS (SELECT unnest(generate_series((SELECT MIN(dt) FROM a), DATE '2001-08-31', INTERVAL 1 DAY))::DATE AS d)
    SELECT s.d::VARCHAR AS dt, COUNT(*) FILTER (WHERE n >= 2) AS users FROM s LEFT JOIN t ON s.d = t.d GROUP BY s.d""")(
    lambda b: ops.rolling_active_users(b.order_days, END, min_days=2))


def class_days(b: Inputs):
    """Activity of students from their first day in the class on."""
    members = student_since(b).select(F.col("student").alias("user"), "teacher", F.col("dt").alias("began"))
    return members.join(b.order_days.distinct(), "user").where("dt >= began").select("user", "teacher", "dt", "began")


SQL_INPUTS["b_class_days"] = """
    SELECT student AS "user", teacher, o.dt, s.dt AS began FROM b_students s
    JOIN (SELECT DISTINCT "user", dt FROM b_order_days) o ON o."user" = s.student WHERE o.dt >= s.dt"""

for _name, _late in (("rolling_active_teachers", False), ("rolling_active_teachers_long_term", True)):
    query(_name, "CO-11", f"""
        WITH a AS (SELECT teacher, "user", dt FROM b_class_days WHERE dt < DATE '2001-09-01' {'AND began + 28 < dt' if _late else ''}),
        t AS (SELECT DISTINCT teacher, "user", unnest(generate_series(dt + 1, dt + 28, INTERVAL 1 DAY))::DATE AS d FROM a),
        c AS (SELECT d, teacher FROM t GROUP BY 1, 2 HAVING COUNT(*) >= 3),
        s AS (SELECT unnest(generate_series((SELECT MIN(dt) FROM a), DATE '2001-08-31', INTERVAL 1 DAY))::DATE AS d)
        SELECT s.d::VARCHAR AS dt, COUNT(c.teacher) AS teachers FROM s LEFT JOIN c ON s.d = c.d GROUP BY s.d""")(
        lambda b, late=_late: ops.rolling_active_teachers(class_days(b), END, threshold=3, since="began" if late else None))


def _student_teacher_sql() -> str:
    kinds = {"active": ("n1", 1), "highly_engaged": ("n1", 4), "long_term_active": ("nl", 1)}
    columns, sources = [], []
    for kind, (count, days) in kinds.items():
        for group, member, cls, threshold in (("teachers", "students", "t", 10), ("coaches", "coach_users", "c", 1)):
            first = "f.late_day" if count == "nl" else "f.day"
            columns.append(f"""(SELECT CASE WHEN s.d >= {first} THEN (SELECT COUNT(*) FROM (SELECT grp FROM g WHERE g.cls = '{cls}' AND g.d = s.d
                AND g.{count} >= {days} GROUP BY grp HAVING COUNT(*) >= {threshold})) END FROM f WHERE f.cls = '{cls}') AS {kind}_{group}""")
            columns.append(f"""(SELECT CASE WHEN s.d >= {first} THEN (SELECT COUNT(*) FROM u WHERE u.cls = '{cls}' AND u.d = s.d AND u.{count} >= {days})
                END FROM f WHERE f.cls = '{cls}') AS {kind}_{member}""")
    for name, table in (("teacher_count", "b_teachers"), ("student_count", "b_students"), ("coach_count", "b_small_coaches"),
                        ("coach_user_count", "b_singles")):
        sources.append(f"(SELECT COUNT(*) FROM {table} x WHERE x.dt <= s.d) AS {name}")
    for name, table in (("visiting_teachers", "vt"), ("visiting_coaches", "vc")):
        sources.append(f"""CASE WHEN s.d >= (SELECT MIN(dt) FROM {table}) THEN
            (SELECT COUNT(DISTINCT coach) FROM {table} x WHERE x.dt < s.d AND x.dt >= s.d - 28) END AS {name}""")
    return f"""
        WITH m AS (SELECT 't' AS cls, student AS usr, teacher AS grp, dt AS began FROM b_students
                   UNION ALL SELECT 'c', "user", coach, dt FROM b_singles),
        a AS (SELECT DISTINCT cls, usr, grp, o.dt, began + 28 < o.dt AS late FROM m JOIN b_order_days o ON o."user" = m.usr
              WHERE o.dt >= began AND o.dt < DATE '2001-09-01'),
        f AS (SELECT cls, MIN(dt) AS day, MIN(dt) FILTER (WHERE late) AS late_day FROM a GROUP BY 1),
        x AS (SELECT a.*, unnest(generate_series(dt + 1, dt + 28, INTERVAL 1 DAY))::DATE AS d FROM a),
        g AS (SELECT cls, grp, usr, d, COUNT(DISTINCT dt) AS n1, COUNT(DISTINCT dt) FILTER (WHERE late) AS nl FROM x GROUP BY 1, 2, 3, 4),
        u AS (SELECT cls, usr, d, COUNT(DISTINCT dt) AS n1, COUNT(DISTINCT dt) FILTER (WHERE late) AS nl FROM x GROUP BY 1, 2, 3),
        v AS (SELECT DISTINCT coach, v.dt FROM b_page_visits v JOIN b_pairs p ON v.identity = 'ident' || p."user" WHERE v.dt < DATE '2001-09-01'),
        vt AS (SELECT * FROM v WHERE coach IN (SELECT teacher FROM b_teachers)),
        vc AS (SELECT * FROM v WHERE coach IN (SELECT coach FROM b_small_coaches)),
        b0 AS (SELECT GREATEST((SELECT MIN(dt) FROM b_teachers), (SELECT MIN(dt) FROM b_students), (SELECT MIN(dt) FROM b_small_coaches),
                               (SELECT MIN(dt) FROM b_singles)) AS d0),
        s AS (SELECT unnest(generate_series(d0, DATE '2001-08-31', INTERVAL 1 DAY))::DATE AS d FROM b0)
        SELECT s.d::VARCHAR AS dt, {', '.join(sources)}, {', '.join(columns)} FROM s"""


@query("student_teacher_count", "CO-12", _student_teacher_sql())
def student_teacher_count(b: Inputs):
    return ops.student_teacher_count(pairs(b), b.order_days, page_visits(b), END)


@query("class_size_histogram", "CO-12", """
    SELECT n AS student_count, COUNT(*) AS class_count FROM (SELECT coach, COUNT(*) AS n FROM b_pairs WHERE coach <> "user" GROUP BY 1) GROUP BY 1""")
def class_size_histogram(b: Inputs):
    return ops.class_size_histogram(pairs(b))


@query("report_page_visits", "CO-13", """
    SELECT DISTINCT 'ident' || "user" AS identity, dt::VARCHAR AS dt,
           CASE k % 10 WHEN 0 THEN '/class_profile/' ELSE '/coach/reports?p=' END || (k // 10) AS url
    FROM b_events WHERE k % 10 <= 1 AND dt >= DATE '2024-01-03' AND dt < DATE '2024-01-28'""")
def report_page_visits(b: Inputs):
    k = F.col("k")
    page = F.when(k % 10 == 0, F.lit("/class_profile/")).when(k % 10 == 1, F.lit("/coach/reports?p=")).otherwise(F.lit("/exercise/"))
    log = b.events.select(
        F.concat(F.lit("ident"), "user").alias("identity"), F.concat(page, F.floor(k / 10)).alias("url"), "dt")
    return ops.report_page_visits(log, "2024-01-03", "2024-01-28", ["/class_profile", "/coach/reports"])


@query("group_mode", "CO-14", "SELECT * FROM b_user_ip")
def group_mode(b: Inputs):
    return ops.group_mode(event_ips(b), "user", "ip")


@query("teacher_country", "CO-15", "SELECT * REPLACE (joined::VARCHAR AS joined) FROM b_teacher_country")
def teacher_country(b: Inputs):
    return ops.teacher_country(student_since(b), group_mode(b), ranges(b), b.users)


SQL_INPUTS["b_class_activity"] = f"""
    WITH t AS (SELECT "user", {', '.join(f'SUM({c})::BIGINT AS {c}' for c in ACTIVITY_COUNTS)} FROM b_order_counts
               WHERE dt >= DATE '1996-01-01' AND dt < DATE '2000-01-01' GROUP BY 1)
    SELECT *, 'student' AS role FROM t WHERE "user" IN (SELECT student FROM b_classes)
    UNION ALL SELECT *, 'teacher' FROM t WHERE "user" IN (SELECT teacher FROM b_classes)"""


@query("class_activity", "CO-16", "SELECT * FROM b_class_activity")
def class_activity(b: Inputs):
    return ops.class_activity(ops.class_pairs(pairs(b)), order_counts(b), "1996-01-01", "2000-01-01")


_HOURS = (1, 5, 10, 15, 20, 25, 30)
SQL_INPUTS["b_most_active"] = f"""
    WITH st AS (SELECT teacher, COUNT(*) AS num_students, {', '.join(f'SUM({c})::BIGINT AS sum_student_{c}' for c in ACTIVITY_COUNTS)},
        {', '.join(f'COUNT(*) FILTER (WHERE {s}_seconds > {h * 3600}) AS students_{h}_hour_{k}_time' for k, s in (('video', 'videos'), ('exercise', 'exercises')) for h in _HOURS)}
        FROM b_classes c JOIN b_class_activity a ON a."user" = c.student AND a.role = 'student' GROUP BY 1),
    te AS (SELECT "user" AS teacher, {', '.join(f'{c} AS sum_teacher_{c}' for c in ACTIVITY_COUNTS)} FROM b_class_activity WHERE role = 'teacher')
    SELECT teacher, COALESCE(num_students, 0) AS num_students, {', '.join(f'COALESCE(sum_student_{c}, 0) AS sum_student_{c}' for c in ACTIVITY_COUNTS)},
        {', '.join(f'COALESCE(students_{h}_hour_{k}_time, 0) AS students_{h}_hour_{k}_time' for k in ('video', 'exercise') for h in _HOURS)},
        {', '.join(f'COALESCE(sum_teacher_{c}, 0) AS sum_teacher_{c}' for c in ACTIVITY_COUNTS)}
    FROM st FULL JOIN te USING (teacher)"""


@query("most_active_coaches", "CO-17", 'SELECT m.*, u.user_email AS email FROM b_most_active m LEFT JOIN b_users u ON u."user" = m.teacher')
def most_active_coaches(b: Inputs):
    classes = ops.class_pairs(pairs(b))
    return ops.most_active_coaches(classes, class_activity(b), b.users, _HOURS)


@query("most_active_coaches_by_place", "CO-17", """
    SELECT m.*, c.* EXCLUDE (teacher) REPLACE (joined::VARCHAR AS joined) FROM b_most_active m JOIN b_teacher_country c ON c.teacher = m.teacher""")
def most_active_coaches_by_place(b: Inputs):
    classes = ops.class_pairs(pairs(b))
    return ops.most_active_coaches(classes, class_activity(b), b.users, _HOURS, teacher_country(b))


@query("class_age_stats", "CO-18", """
    WITH a AS (SELECT c_custkey, (DATE '2001-09-01' - (DATE '1980-01-01' + CAST(c_custkey * 13 % 9000 AS INTEGER))) / 365.25::DOUBLE AS age
               FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')
    SELECT teacher, round(AVG(age), 6) AS avg_age, round(STDDEV_POP(age), 6) AS stddev_age, COUNT(*) AS n
    FROM b_classes JOIN a ON student = c_custkey GROUP BY 1""")
def class_age_stats(b: Inputs):
    born = b.table("customer").select(F.col("c_custkey").alias("user"), F.when(
        F.col("c_mktsegment") != "HOUSEHOLD",
        F.date_add(F.lit("1980-01-01").cast("date"), (F.col("c_custkey") * 13 % 9000).cast("int"))).alias("birthdate"))
    stats = ops.class_age_stats(ops.class_pairs(pairs(b)), born, END)
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_age", "stddev_age")})


@query("report_load_counts", "CO-18", """
    SELECT "user" AS user_key, COUNT(*) AS n FROM b_events WHERE event_type = 'click' AND dt >= DATE '2024-01-05' AND dt < DATE '2024-01-25' GROUP BY 1""")
def report_load_counts(b: Inputs):
    names = F.when(F.col("event_type") == "click", "['UserEvent', 'CoachReportLoadEvent']").otherwise("['UserEvent']")
    return ops.report_load_counts(b.events.select(F.col("user").alias("user_key"), names.alias("class"), "dt"), "2024-01-05", "2024-01-25")


@query("coach_headcounts", "CO-19", """
    WITH l AS (SELECT coach FROM b_coach_summary WHERE num_students >= 10),
    d AS (SELECT user_id AS coach FROM b_users JOIN customer ON c_custkey = "user" WHERE c_mktsegment = 'BUILDING')
    SELECT 'self_identified_teachers' AS metric, COUNT(*) AS value FROM d
    UNION ALL SELECT 'users_with_coach', COUNT(DISTINCT "user") FROM b_coach_mapping WHERE NOT self_coach
    UNION ALL SELECT 'coaches', COUNT(*) FROM b_coach_summary UNION ALL SELECT 'coaches_with_class', COUNT(*) FROM l
    UNION ALL SELECT 'students_of_classes', COUNT(DISTINCT "user") FROM b_coach_mapping WHERE NOT self_coach AND coach IN (SELECT coach FROM l)
    UNION ALL SELECT 'teachers_deduped', COUNT(*) FROM (SELECT coach FROM l UNION SELECT coach FROM d)""")
def coach_headcounts(b: Inputs):
    declared = b.users.join(b.table("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user")), "user")
    return ops.coach_headcounts(user_coach_mapping(b), declared.select(F.col("user_id").alias("coach")))


@query("split_ip_ranges", "GE-1", """
    SELECT p AS first_byte, GREATEST(lo, p * 16777216) AS lo, LEAST(hi, (p + 1) * 16777216 - 1) AS hi, country
    FROM (SELECT *, unnest(generate_series(lo // 16777216, hi // 16777216)) AS p FROM b_ranges)""")
def split_ip_ranges(b: Inputs):
    return geo.split_ip_ranges(ranges(b).select("lo", "hi", "country"))


@query("ip_geolocate", "GE-2", """
    SELECT event_id, ip, city, region, country_code, country, latitude, longitude FROM b_located""")
def ip_geolocate(b: Inputs):
    return geo.ip_geolocate(event_ips(b).select("event_id", "ip"), ranges(b))


def nested_ranges(b: Inputs):
    """The ranges of the nations, in each three smaller ones, and one around all."""
    inner = ranges(b).select(
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("i"), "*").select(
        (F.col("lo") + F.col("i") * 1000000).alias("lo"), (F.col("lo") + F.col("i") * 1000000 + F.when(F.col("i") == 3, 20000000).otherwise(700000)).alias("hi"),
        F.concat_ws("/", "city", "i").alias("city"))
    whole = b.spark.range(1).select(F.lit(0).cast("bigint").alias("lo"), F.lit(4294967295).alias("hi"), F.lit("Earth").alias("city"))
    return ranges(b).select("lo", "hi", "city").unionByName(inner).unionByName(whole)


@query("ip_geolocate_nested", "GE-2", """
    WITH i AS (SELECT unnest(generate_series(1, 3)) AS i),
    r AS (SELECT lo, hi, city FROM b_ranges UNION ALL SELECT 0, 4294967295, 'Earth'
          UNION ALL SELECT lo + i * 1000000, lo + i * 1000000 + CASE WHEN i = 3 THEN 20000000 ELSE 700000 END, city || '/' || i FROM b_ranges CROSS JOIN i)
    SELECT event_id, ip, arg_max(city, lo) AS city FROM b_ips JOIN r ON ipn BETWEEN lo AND hi GROUP BY 1, 2""")
def ip_geolocate_nested(b: Inputs):
    return geo.ip_geolocate(event_ips(b).select("event_id", "ip"), nested_ranges(b))


@query("region_ip_ranges", "GE-3", """
    WITH l AS (SELECT s_suppkey AS id, CASE WHEN s_nationkey % 2 = 0 THEN 'CA' ELSE 'NY' END AS state, s_nationkey AS city,
                      400 + s_suppkey % 30 AS area, CASE WHEN s_suppkey % 7 <> 0 THEN 94000 + s_suppkey END AS zip FROM supplier),
    k AS (SELECT id FROM l WHERE state = 'CA' AND (city IN (2, 4, 8) OR area IN (405, 415) OR zip IN (94003, 94010, 94014)))
    SELECT 167772160 + c_custkey * 256 AS "start", 167772160 + c_custkey * 256 + 256 AS "end" FROM customer WHERE c_nationkey IN (SELECT id FROM k)""")
def region_ip_ranges(b: Inputs):
    blocks = b.table("customer").select(
        F.col("c_nationkey").cast("bigint").alias("id"), F.concat(dotted(167772160 + F.col("c_custkey") * 256), F.lit("/24")).alias("subnet"))
    key = F.col("s_suppkey")
    locations = b.table("supplier").select(
        key.alias("id"), F.lit("US").alias("country"), F.when(F.col("s_nationkey") % 2 == 0, "CA").otherwise("NY").alias("state"),
        F.concat(F.lit("City"), "s_nationkey").alias("city"), (400 + key % 30).cast("string").alias("area_code"),
        F.when(key % 7 == 0, F.lit("E3L")).otherwise((94000 + key).cast("string")).alias("postalcode"))
    return geo.region_ip_ranges(
        blocks, locations, b.rows("city string", ("City2",), ("City4",), ("City8",)),
        b.rows("area_code int", (405,), (415,)), b.rows("zip int", (94003,), (94010,), (94014,)), "US", "CA")
