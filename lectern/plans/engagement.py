"""Registered engagement queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import engagement as G
from ..operators import enrollment as E
from ..sources.adapter import END, engagement_events, enrollment_events, events, table, users, with_views
from ..sources.sinks import written
from .enrollment import DAYS, STATE

BEFORE = "2024-01-24"


def _module(s, d):
    return G.module_engagement(engagement_events(s, d))


def _week(s, d, end=END):
    return G.weekly_summary(_module(s, d), end)


def _ranges(s, d):
    return G.metric_ranges(_week(s, d))


def _segments(s, d):
    return G.user_segments(_week(s, d), _ranges(s, d))


def _cohorts(s, d):
    """The customers of one market segment are in cohorts, each of one course and named after a nation; the group of others is unknown."""
    n = table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.concat_ws("+", F.concat(F.lit("course-v1:org"), F.col("n_nationkey") % 3), F.concat(F.lit("c"), F.col("n_nationkey") % 3), F.lit("2024")).alias("course_id"), F.col("n_name").alias("name"))
    c = table(s, d, "customer").select(F.col("c_custkey").alias("user_id"), F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey").cast("long")).alias("group_id"))
    return G.cohort_members(n, c)


def _days(s, d):
    return E.days_enrolled(enrollment_events(s, d), END)


def _roster(s, d, modules=None):
    modules = written(_module(s, d) if modules is None else modules)  # read by both weeks; the last week by the roster, its ranges and its segments
    week = written(G.weekly_summary(modules, END))
    segments = G.user_segments(week, G.metric_ranges(week))
    return G.learner_roster(_days(s, d), users(s, d), _cohorts(s, d), week, G.weekly_summary(modules, BEFORE), segments, END)


def _documents(s, d):
    """What the documents of the roster, two of each learner, hold: their id, some fields, and how many they leave out."""
    got = lambda p: F.get_json_object("source", f"$.{p}")
    return G.roster_documents(_roster(s, d), 2).select(
        "_id", got("username").alias("username"), got("enrollment_mode").alias("enrollment_mode"), got("videos_viewed").cast("long").alias("videos_viewed"), got("attempt_ratio_order").cast("long").alias("attempt_ratio_order"),
        got("problem_attempts_per_completed").cast("double").alias("ratio"), got("cohort").alias("cohort"), got("segments").alias("segments"), F.size(F.json_object_keys("source")).alias("n_fields"),
    )


def _student(s, d):
    """Report events: votes from views, pages from errors."""
    k = F.col("k") % 4
    forum = F.when(k == 0, "edx.forum.thread.voted").when(k == 1, "edx.forum.response.created").when(k == 2, "edx.forum.comment.created").otherwise("edx.forum.thread.created")
    path = F.concat(F.lit("/courses/o/c/r/courseware/ch"), (F.col("k") % 5).cast("string"), F.lit("/s"), (F.col("k") % 7).cast("string"), F.lit("/"))
    kind = F.when(F.col("kind") == "purchase", "problem_check").when(F.col("kind") == "click", "play_video").when(F.col("kind") == "signup", "book").when(F.col("kind") == "view", forum).otherwise(path)
    user = lambda c: F.concat(F.lit("user"), c.cast("string"))
    return events(s, d).select(
        "course_id", user(F.col("user_id")).alias("username"), "date", "ts", F.lit("server").alias("source"), kind.alias("type"),
        F.concat(F.substring("kind", 1, 1), (F.col("k") % 20).cast("string")).alias("entity_id"), (F.col("event_id") % 2 == 0).alias("correct"),
        F.when(F.col("event_id") % 3 == 0, "down").otherwise("up").alias("vote_value"), (F.col("event_id") % 7 == 0).alias("undo"), user((F.col("user_id") + 1) % 100).alias("target"),
    )


def _report(interval):
    return lambda s, d: G.student_engagement(_student(s, d), interval, END)


QUERIES = {
    "module_engagement": _module,
    "engagement_summary_weekly": _week,
    "metric_ranges": _ranges,
    "user_segments": _segments,
    "segment_text": lambda s, d: G.segment_text(_segments(s, d)),
    "first_enrollment_date": lambda s, d: G.first_enrollment_date(_days(s, d), END),
    "cohort_members": _cohorts,
    "learner_roster": _roster,
    "roster_documents": _documents,
    **{f"student_engagement_{i}": _report(i) for i in ("daily", "weekly", "all")},
    "engagement_report_weekly": lambda s, d: G.engagement_report(_days(s, d), users(s, d), _cohorts(s, d), G.student_engagement(_student(s, d), "weekly", END), "weekly", END),
    "engagement_table": lambda s, d: G.engagement_table(G.student_engagement(_student(s, d), "daily", END), "2024-01-10", "2024-01-17"),
}

_M = """SELECT course_id, username, date, entity_type, entity_id, action, count(*) AS count FROM (
 SELECT course_id, username, date, CASE type WHEN 'problem_check' THEN 'problem' WHEN 'play_video' THEN 'video' ELSE 'discussion' END AS entity_type, entity_id, CASE type WHEN 'problem_check' THEN 'attempted' WHEN 'play_video' THEN 'viewed' ELSE 'contributed' END AS action FROM eng
 UNION ALL SELECT course_id, username, date, 'problem', entity_id, 'completed' FROM eng WHERE type = 'problem_check' AND correct) GROUP BY ALL"""


def _w(end):
    return f"""SELECT course_id, username, coalesce(CAST(sum(count) FILTER (action = 'attempted') AS BIGINT), 0) AS problem_attempts, count(DISTINCT entity_id) FILTER (action = 'attempted') AS problems_attempted,
 count(DISTINCT entity_id) FILTER (action = 'completed') AS problems_completed, count(DISTINCT entity_id) FILTER (action = 'viewed') AS videos_viewed,
 coalesce(CAST(sum(count) FILTER (entity_type = 'discussion') AS BIGINT), 0) AS discussion_contributions, count(DISTINCT date) AS days_active, DATE '{end}' - 7 AS start_date, DATE '{end}' AS end_date,
 CASE WHEN problems_completed = 0 THEN CAST('inf' AS DOUBLE) ELSE CAST(problem_attempts AS DOUBLE) / problems_completed END AS problem_attempts_per_completed
 FROM m WHERE date >= DATE '{end}' - 7 AND date < DATE '{end}' GROUP BY ALL"""


_UN = " UNION ALL ".join(f"SELECT course_id, username, start_date, end_date, days_active, problem_attempts AS attempts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM wk" for m in G.METRICS)
_B = """SELECT course_id, metric, min(start_date) AS start_date, min(end_date) AS end_date,
 list_sort(list(value) FILTER (metric <> 'problem_attempts_per_completed' OR attempts > 0)) AS vs FROM un WHERE days_active > 0 GROUP BY ALL"""
_Q = "(CASE WHEN vs IS NULL THEN NULL WHEN {p} * (len(vs) - 1) = floor({p} * (len(vs) - 1)) THEN vs[CAST({p} * (len(vs) - 1) AS INTEGER) + 1] WHEN isinf(vs[CAST(floor({p} * (len(vs) - 1)) AS INTEGER) + 2]) THEN CAST('inf' AS DOUBLE) ELSE vs[CAST(floor({p} * (len(vs) - 1)) AS INTEGER) + 1] * (1 - ({p} * (len(vs) - 1) - floor({p} * (len(vs) - 1)))) + vs[CAST(floor({p} * (len(vs) - 1)) AS INTEGER) + 2] * ({p} * (len(vs) - 1) - floor({p} * (len(vs) - 1))) END)"
_BB = f"SELECT *, {_Q.format(p='CAST(0.15 AS DOUBLE)')} AS lo, {_Q.format(p='CAST(0.85 AS DOUBLE)')} AS hi FROM b"
_R = """SELECT course_id, start_date, end_date, metric, r.t AS range_type, r.a AS low_value, r.b AS high_value FROM (SELECT *, unnest([x for x in [
 CASE WHEN lo IS NULL THEN {'t': 'normal', 'a': CAST(0 AS DOUBLE), 'b': CAST('inf' AS DOUBLE)} END, CASE WHEN lo > 0 THEN {'t': 'low', 'a': CAST(0 AS DOUBLE), 'b': lo} END, CASE WHEN lo = hi THEN {'t': 'normal', 'a': lo, 'b': CAST('inf' AS DOUBLE)} END,
 CASE WHEN lo <> hi THEN {'t': 'normal', 'a': lo, 'b': hi} END, CASE WHEN lo <> hi THEN {'t': 'high', 'a': hi, 'b': CAST('inf' AS DOUBLE)} END] if x IS NOT NULL]) AS r FROM bb)"""
_S = """SELECT un.course_id, username, un.start_date, un.end_date, CASE WHEN un.metric = 'problem_attempts_per_completed' THEN 'struggling' ELSE 'highly_engaged' END AS segment, string_agg(DISTINCT un.metric, ',' ORDER BY un.metric) AS reason
 FROM un JOIN r ON r.course_id = un.course_id AND r.metric = un.metric AND range_type = 'high' AND un.metric <> 'problem_attempts' WHERE value >= low_value AND (value < high_value OR (isinf(value) AND isinf(high_value))) GROUP BY ALL"""
_CO = """SELECT c_custkey AS user_id, 'course-v1:org' || (n_nationkey % 3) || '+c' || (n_nationkey % 3) || '+2024' AS course_id, n_name AS cohort FROM customer JOIN nation ON n_nationkey = CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey END"""
_G = with_views("eng", m=_M, wk=_w(END), un=_UN, b=_B, bb=_BB, r=_R, sg=_S)
_FE = f"SELECT course_id, user_id, min(date) AS first_enrollment_date FROM raw WHERE at_end = 1 AND date < DATE '{END}' GROUP BY ALL"
_ROSTER = with_views("eng", "enr", "usr", m=_M, wk=_w(END), old=_w(BEFORE), un=_UN, b=_B, bb=_BB, r=_R, sg=_S, st=STATE, raw=DAYS, co=_CO, fe=_FE, tx="SELECT course_id, username, string_agg(DISTINCT segment, ',' ORDER BY segment) AS segments FROM sg GROUP BY ALL", ro=f"""
 SELECT d.course_id, u.username, d.user_id, name, d.mode AS enrollment_mode, first_enrollment_date, cohort, coalesce(w.problem_attempts, 0) AS problem_attempts, coalesce(w.problems_attempted, 0) AS problems_attempted, coalesce(w.problems_completed, 0) AS problems_completed,
 coalesce(w.videos_viewed, 0) AS videos_viewed, coalesce(w.discussion_contributions, 0) AS discussion_contributions, w.problem_attempts_per_completed,
 concat_ws(',', CASE WHEN at_end = 0 THEN 'unenrolled' END, CASE WHEN coalesce(o.days_active, 0) = 0 AND coalesce(w.days_active, 0) = 0 THEN 'inactive' END, CASE WHEN coalesce(o.days_active, 0) > 0 AND coalesce(w.days_active, 0) = 0 THEN 'disengaging' END, tx.segments) AS segments,
 CASE WHEN w.problem_attempts_per_completed IS NULL THEN -coalesce(w.problem_attempts, 0) ELSE coalesce(w.problem_attempts, 0) END AS attempt_ratio_order, year_of_birth, gender
 FROM raw d JOIN usr u USING (user_id) LEFT JOIN co ON co.user_id = d.user_id AND co.course_id = d.course_id LEFT JOIN wk w ON w.course_id = d.course_id AND w.username = u.username LEFT JOIN old o ON o.course_id = d.course_id AND o.username = u.username
 LEFT JOIN fe ON fe.course_id = d.course_id AND fe.user_id = d.user_id LEFT JOIN tx ON tx.course_id = d.course_id AND tx.username = u.username WHERE d.date = DATE '{END}' - 1""")

_SE = """SELECT course_id, 'user' || user_id AS username, date, ts, CASE kind WHEN 'purchase' THEN 'problem_check' WHEN 'click' THEN 'play_video' WHEN 'signup' THEN 'book' WHEN 'view' THEN
 ['edx.forum.thread.voted', 'edx.forum.response.created', 'edx.forum.comment.created', 'edx.forum.thread.created'][CAST(k % 4 + 1 AS INTEGER)] ELSE '/courses/o/c/r/courseware/ch' || (k % 5) || '/s' || (k % 7) || '/' END AS type,
 substr(kind, 1, 1) || (k % 20) AS entity_id, event_id % 2 = 0 AS correct, CASE WHEN event_id % 3 = 0 THEN 'down' ELSE 'up' END AS vote, event_id % 7 = 0 AS undo, 'user' || ((user_id + 1) % 100) AS target FROM ev"""
_SR = """SELECT course_id, username, type AS event, date, ts, entity_id, correct, vote, undo FROM se UNION ALL SELECT course_id, target, 'edx.forum.thread.vote_received', date, ts, entity_id, correct, vote, undo FROM se WHERE type = 'edx.forum.thread.voted'"""


def _vote(way, event):
    return f"CAST(sum(CASE WHEN event = '{event}' AND vote = '{way}' THEN CASE WHEN undo THEN -1 ELSE 1 END ELSE 0 END) AS BIGINT)"


def _report_sql(interval):
    key = {"daily": "date", "weekly": f"date + CAST((isodow(DATE '{END}' - 1) - isodow(date) + 7) % 7 AS INTEGER)", "all": f"DATE '{END}' - 1"}[interval]
    n = lambda e: f"count(*) FILTER (event = '{e}')"
    return f"""SELECT key AS date, course_id, username, count(DISTINCT date) AS days_active, count(DISTINCT entity_id) FILTER (event = 'problem_check') AS problems_attempted, {n('problem_check')} AS problem_attempts,
 count(DISTINCT entity_id) FILTER (event = 'problem_check' AND correct) AS problems_correct, count(DISTINCT entity_id) FILTER (event = 'play_video') AS videos_played, {n('edx.forum.thread.created')} AS forum_posts, {n('edx.forum.response.created')} AS forum_responses,
 {n('edx.forum.comment.created')} AS forum_comments, {_vote('up', 'edx.forum.thread.voted')} AS forum_upvotes_given, {_vote('down', 'edx.forum.thread.voted')} AS forum_downvotes_given, {_vote('up', 'edx.forum.thread.vote_received')} AS forum_upvotes_received,
 {_vote('down', 'edx.forum.thread.vote_received')} AS forum_downvotes_received, {n('book')} AS textbook_pages_viewed, coalesce(arg_max(event, ts) FILTER (starts_with(event, '/courses/')), '') AS last_subsection_viewed
 FROM (SELECT *, {key} AS key FROM sr) GROUP BY key, course_id, username"""


_ST = with_views(se=_SE, sr=_SR) + " "
ORACLES = {
    "module_engagement": with_views("eng", m=_M) + " SELECT * FROM m",
    "engagement_summary_weekly": with_views("eng", m=_M, wk=_w(END)) + " SELECT * FROM wk",
    "metric_ranges": _G + " SELECT * FROM r",
    "user_segments": _G + " SELECT * FROM sg",
    "segment_text": _G + " SELECT course_id, username, string_agg(DISTINCT segment, ',' ORDER BY segment) AS segments FROM sg GROUP BY ALL",
    "first_enrollment_date": with_views("enr", st=STATE, raw=DAYS) + " " + _FE,
    "cohort_members": _CO,
    "learner_roster": _ROSTER + " SELECT * FROM ro",
    "roster_documents": _ROSTER + """, doc AS (SELECT *, CASE WHEN isinf(problem_attempts_per_completed) THEN NULL ELSE problem_attempts_per_completed END AS ratio, CASE WHEN segments <> '' THEN '["' || replace(segments, ',', '","') || '"]' END AS parts FROM ro)
 SELECT course_id || '|' || username || suffix AS _id, username, enrollment_mode, videos_viewed, attempt_ratio_order, ratio, cohort, parts AS segments, CAST(17 - (CASE WHEN ratio IS NULL THEN 1 ELSE 0 END) - (CASE WHEN cohort IS NULL THEN 1 ELSE 0 END) - (CASE WHEN parts IS NULL THEN 1 ELSE 0 END)
 - (CASE WHEN first_enrollment_date IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS n_fields FROM doc, (VALUES (''), ('_1')) AS copies(suffix)""",
    **{f"student_engagement_{i}": _ST + _report_sql(i) for i in ("daily", "weekly", "all")},
    "engagement_report_weekly": with_views("enr", "usr", se=_SE, sr=_SR, st=STATE, raw=DAYS, co=_CO, en=_report_sql("weekly"))
    + " SELECT d.date, d.course_id, u.username, cohort, " + ", ".join(f"coalesce(en.{c}, 0) AS {c}" for c in G.COUNTERS)
    + f""", coalesce(last_subsection_viewed, '') AS last_subsection_viewed FROM raw d JOIN usr u USING (user_id) LEFT JOIN co ON co.user_id = d.user_id AND co.course_id = d.course_id LEFT JOIN en ON en.date = d.date AND en.course_id = d.course_id AND en.username = u.username
 WHERE at_end = 1 AND isodow(d.date) = isodow(DATE '{END}' - 1)""",
    "engagement_table": _ST + f"SELECT * FROM ({_report_sql('daily')}) WHERE date >= DATE '2024-01-10' AND date < DATE '2024-01-17'",
}
DATES = {
    "module_engagement": ["date"], "engagement_summary_weekly": ["start_date", "end_date"], "metric_ranges": ["start_date", "end_date"], "user_segments": ["start_date", "end_date"],
    "first_enrollment_date": ["first_enrollment_date"], "learner_roster": ["first_enrollment_date"], "engagement_report_weekly": ["date"], "engagement_table": ["date"],
    **{f"student_engagement_{i}": ["date"] for i in ("daily", "weekly", "all")},
}
