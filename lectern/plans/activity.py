"""Registered activity, calendar and location queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import activity as A
from ..operators import enrollment as E
from ..sources.adapter import END, START, activity_events, enrollment_events, events, ip_events, table, with_views
from .enrollment import DAYS, STATE


def _ranges(spark, d):
    """Countries from the nations: each has a range of 16 blocks' worth of the 10.x addresses; some addresses have none."""
    n = table(spark, d, "nation")
    lo = F.lit(167772160) + F.expr("n_nationkey div 5") * 65536 + F.col("n_nationkey") % 5 * 10000
    return n.select(lo.cast("long").alias("lo"), (lo + 8999).cast("long").alias("hi"), F.upper(F.substring("n_name", 1, 2)).alias("country_code"), F.col("n_name").alias("country_name"))


def _calendar(spark, d):
    """The days between the first and the last event."""
    first, last = events(spark, d).agg(F.min("date"), F.max("date")).first()
    return A.calendar(spark, str(first), str(last)).unionByName(A.calendar(spark, str(last), str(last.fromordinal(last.toordinal() + 1))))


def _daily(spark, d):
    return A.last_daily_ip(ip_events(spark, d))


def _country(spark, d):
    return A.last_country(_daily(spark, d), _ranges(spark, d))


QUERIES = {
    "calendar": _calendar,
    "user_activity_by_user": lambda s, d: A.user_activity(activity_events(s, d)),
    "course_activity_weekly": lambda s, d: A.course_activity_weekly(A.user_activity(activity_events(s, d)), A.calendar(s, START, END), START, END),
    "total_events_daily": lambda s, d: A.total_events_daily(events(s, d)),
    "total_events_report": lambda s, d: A.total_events_report(A.total_events_daily(events(s, d))),
    "last_daily_ip": lambda s, d: _daily(s, d).drop("ts", "event_id"),
    "ip_to_country": lambda s, d: A.locate(ip_events(s, d).select("event_id", "ip"), _ranges(s, d)),
    "last_country_of_user": _country,
    "country_per_course": lambda s, d: A.country_per_course(E.enrollment_spans(enrollment_events(s, d), END), _country(s, d)),
    "newest_events_per_user": lambda s, d: events(s, d).groupBy("user_id").agg(F.max_by("kind", F.struct("ts", "event_id")).alias("kind"), F.max("ts").alias("ts")),
}

_CAL = "SELECT CAST(unnest(generate_series((SELECT min(date) FROM ev), (SELECT max(date) FROM ev), INTERVAL 1 DAY)) AS DATE) AS date"
_UA = """SELECT user_id, course_id, date, unnest([x for x in ['ACTIVE', CASE WHEN source = 'server' AND type = 'problem_check' THEN 'ATTEMPTED_PROBLEM' END,
 CASE WHEN source IN ('browser', 'mobile') AND type = 'play_video' THEN 'PLAYED_VIDEO' END] if x IS NOT NULL]) AS category FROM act WHERE source <> 'task' AND type NOT LIKE 'edx.course.enrollment%'"""
_IP = "167772160 + (n_nationkey // 5) * 65536 + n_nationkey % 5 * 10000"
_RANGES = f"SELECT {_IP} AS lo, {_IP} + 8999 AS hi, upper(substr(n_name, 1, 2)) AS country_code, n_name AS country_name FROM nation"
_NUM = "167772160 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536 + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT)"
_COUNTRY = f"""SELECT user_id, coalesce(country_code, 'UNKNOWN') AS country_code, coalesce(country_name, 'UNKNOWN') AS country_name
 FROM (SELECT user_id, arg_max(ip, (ts, event_id)) AS ip FROM ips GROUP BY ALL) LEFT JOIN rng ON {_NUM} BETWEEN lo AND hi"""

ORACLES = {
    "calendar": with_views(c=_CAL) + """ SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, strftime(date, '%GW%V') AS iso_week,
 CAST(date_trunc('week', date) AS DATE) AS iso_week_start, CAST(date_trunc('week', date) AS DATE) + 7 AS iso_week_end, CAST(isodow(date) AS INTEGER) AS iso_weekday FROM c""",
    "user_activity_by_user": with_views("act", ua=_UA) + " SELECT *, count(*) AS count FROM ua GROUP BY ALL",
    "course_activity_weekly": with_views("act", ua=_UA, w="SELECT *, CAST(date_trunc('week', date) AS DATE) AS interval_start FROM ua")
    + f" SELECT course_id, interval_start, interval_start + 7 AS interval_end, category AS label, count(DISTINCT user_id) AS count FROM w WHERE interval_start >= DATE '{START}' AND interval_start + 7 <= DATE '{END}' AND date < DATE '{END}' GROUP BY ALL",
    "total_events_daily": with_views() + " SELECT date, count(*) AS event_count FROM ev GROUP BY ALL",
    "total_events_report": with_views() + " SELECT date, count(*) AS event_count FROM ev GROUP BY ALL ORDER BY date DESC",
    "last_daily_ip": with_views("ips") + " SELECT date, user_id, course_id, arg_max(ip, (ts, event_id)) AS ip FROM ips GROUP BY ALL",
    "ip_to_country": with_views("ips", rng=_RANGES) + f" SELECT event_id, ip, coalesce(country_code, 'UNKNOWN') AS country_code, coalesce(country_name, 'UNKNOWN') AS country_name FROM ips LEFT JOIN rng ON {_NUM} BETWEEN lo AND hi",
    "last_country_of_user": with_views("ips", rng=_RANGES) + " " + _COUNTRY,
    "country_per_course": with_views("enr", "ips", st=STATE, raw=DAYS, rng=_RANGES, cou=_COUNTRY)
    + " SELECT date, course_id, country_code, CAST(sum(at_end) AS BIGINT) AS count, count(raw.user_id) AS cumulative_count FROM raw LEFT JOIN cou USING (user_id) GROUP BY ALL",
    "newest_events_per_user": with_views() + " SELECT user_id, arg_max(kind, (ts, event_id)) AS kind, max(ts) AS ts FROM ev GROUP BY ALL",
}
DATES = {
    "calendar": ["date", "iso_week_start", "iso_week_end"], "user_activity_by_user": ["date"], "course_activity_weekly": ["interval_start", "interval_end"],
    "total_events_daily": ["date"], "total_events_report": ["date"], "last_daily_ip": ["date"], "country_per_course": ["date"],
}
