"""Registered enrollment queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrollment as E
from ..sources.adapter import END, enrollment_events, table, users, with_views


def _days(spark, d):
    return E.days_enrolled(enrollment_events(spark, d), END)


def _spans(spark, d):
    return E.enrollment_spans(enrollment_events(spark, d), END)


def _catalog(spark, d):
    r = table(spark, d, "region")
    k = F.col("r_regionkey").cast("string")
    return r.select(F.concat(F.lit("course-v1:org"), k, F.lit("+c"), k, F.lit("+2024")).alias("course_id"), F.col("r_name").alias("catalog_course_title"))


def _grades(spark, d):
    o = table(spark, d, "orders")
    c = (F.col("o_orderkey") % 3).cast("string")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int"))
    return o.select(
        F.col("o_custkey").alias("user_id"), F.concat(F.lit("course-v1:org"), c, F.lit("+c"), c, F.lit("+2024")).alias("course_id"), day.cast("timestamp").alias("modified"),
        F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B").otherwise("").alias("letter_grade"),
        F.when(F.col("o_orderkey") % 2 == 0, day.cast("timestamp")).alias("passed_timestamp"),
    )


def _programs(spark, d):
    p = table(spark, d, "part")
    c = (F.col("p_partkey") % 3).cast("string")
    return p.select(F.concat(F.lit("course-v1:org"), c, F.lit("+c"), c, F.lit("+2024")).alias("course_id"), F.col("p_partkey").alias("program_id"), F.col("p_type").alias("program_type"), F.col("p_name").alias("program_title"))


def _meta(spark, d):
    days = _days(spark, d)
    return E.course_meta_summary(E.enrollment_by_mode(days), _catalog(spark, d), E.passing_by_mode(_spans(spark, d), _grades(spark, d)), END)


def _anomalies(spark, d):
    """Enrollment events by what they change, or why they change nothing."""
    df = E.with_state(enrollment_events(spark, d))
    on = F.col("prior") == 1
    reason = (
        F.when((F.col("type") == "activated") & ~on, "enrolled").when((F.col("type") == "deactivated") & on, "unenrolled").when((F.col("type") == "mode_changed") & on, "mode_changed")
        .when(F.col("type") == "activated", "already_enrolled").when(F.col("type") == "deactivated", "already_unenrolled").otherwise("mode_change_while_unenrolled")
    )
    return df.groupBy(reason.alias("reason")).count().withColumnRenamed("count", "n")


QUERIES = {
    "days_enrolled": _days,
    "enrollment_summary": lambda s, d: E.enrollment_summary(enrollment_events(s, d), END),
    "enrollment_daily": lambda s, d: E.enrollment_daily(_days(s, d)),
    "enrollment_by_mode": lambda s, d: E.enrollment_by_mode(_days(s, d)),
    "enrollment_by_gender": lambda s, d: E.enrollment_by_gender(_spans(s, d), users(s, d)),
    "enrollment_by_birth_year": lambda s, d: E.enrollment_by_birth_year(_spans(s, d), users(s, d), END),
    "enrollment_by_education": lambda s, d: E.enrollment_by_education(_spans(s, d), users(s, d), END),
    "passing_by_mode": lambda s, d: E.passing_by_mode(_spans(s, d), _grades(s, d)),
    "course_meta_summary": _meta,
    "program_metadata": lambda s, d: E.program_metadata(_programs(s, d)),
    "enrollment_quality_counts": _anomalies,
}

STATE = """SELECT *, coalesce(lag(state) OVER w, 0) AS prior, lead(CAST(ts AS DATE)) OVER w AS after FROM (
 SELECT *, coalesce(last_value(CASE type WHEN 'activated' THEN 1 WHEN 'deactivated' THEN 0 END IGNORE NULLS) OVER (PARTITION BY course_id, user_id ORDER BY ts, type, mode, event_id), 0) AS state FROM enr)
 WINDOW w AS (PARTITION BY course_id, user_id ORDER BY ts, type, mode, event_id)"""
DAYS = f"""SELECT CAST(unnest(range(day, until + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date, course_id, user_id, at_end, day, chg, mode FROM (
 SELECT course_id, user_id, CAST(ts AS DATE) AS day, mode, state AS at_end, CAST(state - coalesce(lag(state) OVER (PARTITION BY course_id, user_id ORDER BY ts), 0) AS INTEGER) AS chg,
 coalesce(after, DATE '{END}') - 1 AS until FROM st WHERE after IS NULL OR after > CAST(ts AS DATE))"""
_D = with_views("enr", st=STATE, raw=DAYS, days="SELECT date, course_id, user_id, at_end, CASE WHEN date = day THEN chg ELSE 0 END AS change, mode FROM raw", )
_DU = with_views("enr", "usr", st=STATE, raw=DAYS, days="SELECT date, course_id, user_id, at_end, mode FROM raw")
_SUMS = "CAST(sum(at_end) AS BIGINT) AS count, count(user_id) AS cumulative_count"
_LAST = f"date = DATE '{END}' - 1"
_GRADES = """SELECT o_custkey AS user_id, 'course-v1:org' || (o_orderkey % 3) || '+c' || (o_orderkey % 3) || '+2024' AS course_id, DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS modified,
 CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' ELSE '' END AS letter_grade, CASE WHEN o_orderkey % 2 = 0 THEN DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) END AS passed FROM orders"""
_PASSING = """SELECT course_id, mode, CAST(sum(CASE WHEN passed IS NOT NULL AND letter_grade <> '' THEN 1 ELSE 0 END) AS BIGINT) AS passing_users FROM (
 SELECT g.user_id, g.course_id, letter_grade, passed, arg_max(mode, date) AS mode FROM (SELECT user_id, course_id, modified, g.letter_grade, g.passed FROM (SELECT user_id, course_id, max(modified) AS modified, arg_max({'letter_grade': letter_grade, 'passed': passed}, (modified, letter_grade, coalesce(passed, DATE '1970-01-01'))) AS g FROM grades GROUP BY ALL)) g
 JOIN days ON days.user_id = g.user_id AND days.course_id = g.course_id AND date <= modified GROUP BY ALL) GROUP BY ALL"""
_DG = with_views("enr", st=STATE, raw=DAYS, days="SELECT date, course_id, user_id, at_end, mode FROM raw", grades=_GRADES, passing=_PASSING, bm=f"SELECT course_id, date, mode, {_SUMS} FROM days GROUP BY ALL")
_EDU = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in E.EDUCATION.items())

ORACLES = {
    "days_enrolled": _D + " SELECT date, course_id, user_id, CAST(at_end AS INTEGER) AS at_end, CAST(change AS INTEGER) AS change, mode FROM days",
    "enrollment_summary": with_views("enr", st=STATE, f="SELECT *, type = 'activated' AND prior = 0 AS e, type = 'deactivated' AND prior = 1 AS l, (type = 'activated' AND prior = 0) OR (type = 'mode_changed' AND prior = 1) AS c FROM st")
    + """ SELECT course_id, user_id, arg_max(mode, ts) FILTER (c) AS current_enrollment_mode, arg_max(state, ts) = 1 AS current_enrollment_is_active, arg_min(mode, ts) FILTER (e) AS first_enrollment_mode,
 min(ts) FILTER (e) AS first_enrollment_time, max(ts) FILTER (l) AS last_unenrollment_time, min(ts) FILTER (c AND mode = 'verified') AS first_verified_enrollment_time, min(ts) FILTER (c AND mode = 'credit') AS first_credit_enrollment_time
 FROM f GROUP BY course_id, user_id HAVING count(*) FILTER (e) > 0""",
    "enrollment_daily": _D + f" SELECT course_id, date, {_SUMS} FROM days GROUP BY ALL",
    "enrollment_by_mode": _D + f" SELECT course_id, date, mode, {_SUMS} FROM days GROUP BY ALL",
    "enrollment_by_gender": _DU + f" SELECT course_id, date, nullif(gender, '') AS gender, CAST(sum(at_end) AS BIGINT) AS count, count(days.user_id) AS cumulative_count FROM days LEFT JOIN usr USING (user_id) GROUP BY ALL",
    "enrollment_by_birth_year": _DU + f" SELECT course_id, date, year_of_birth AS birth_year, CAST(sum(at_end) AS BIGINT) AS count, count(days.user_id) AS cumulative_count FROM days LEFT JOIN usr USING (user_id) WHERE {_LAST} GROUP BY ALL",
    "enrollment_by_education": _DU + f" SELECT course_id, date, CASE level_of_education {_EDU} END AS education_level, CAST(sum(at_end) AS BIGINT) AS count, count(days.user_id) AS cumulative_count FROM days LEFT JOIN usr USING (user_id) WHERE {_LAST} GROUP BY ALL",
    "passing_by_mode": _DG + " SELECT * FROM passing",
    "course_meta_summary": _DG + f""", cat AS (SELECT 'course-v1:org' || r_regionkey || '+c' || r_regionkey || '+2024' AS course_id, r_name AS catalog_course_title FROM region)
 SELECT cat.course_id, catalog_course_title, a.mode AS enrollment_mode, a.count, a.cumulative_count, a.count - coalesce(b.count, 0) AS count_change_7_days, coalesce(passing_users, 0) AS passing_users
 FROM bm a LEFT JOIN bm b ON a.course_id = b.course_id AND a.mode = b.mode AND b.date = DATE '{END}' - 8 LEFT JOIN cat ON cat.course_id = a.course_id LEFT JOIN passing p ON p.course_id = a.course_id AND p.mode = a.mode WHERE a.{_LAST}""",
    "program_metadata": "SELECT 'course-v1:org' || (p_partkey % 3) || '+c' || (p_partkey % 3) || '+2024' AS course_id, p_partkey AS program_id, p_type AS program_type, p_name AS program_title FROM part",
    "enrollment_quality_counts": with_views("enr", st=STATE) + """ SELECT CASE WHEN type = 'activated' AND prior = 0 THEN 'enrolled' WHEN type = 'deactivated' AND prior = 1 THEN 'unenrolled' WHEN type = 'mode_changed' AND prior = 1 THEN 'mode_changed'
 WHEN type = 'activated' THEN 'already_enrolled' WHEN type = 'deactivated' THEN 'already_unenrolled' ELSE 'mode_change_while_unenrolled' END AS reason, count(*) AS n FROM st GROUP BY ALL""",
}
DATES = {n: ["date"] for n in ("days_enrolled", "enrollment_daily", "enrollment_by_mode", "enrollment_by_gender", "enrollment_by_birth_year", "enrollment_by_education")}
