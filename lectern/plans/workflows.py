"""Registered workflows from log lines: one scan deals them to families, and each report starts there."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import activity as A
from ..operators import engagement as G
from ..operators import enrollment as E
from ..operators import families as X
from ..operators import outline as O
from ..operators import problems as P
from ..operators import video as V
from ..sources import readers as R
from ..sources import sinks as S
from ..sources.adapter import END, START, activity_events, engagement_events, enrollment_events, ip_events, users, video_events, with_views
from . import activity, engagement, enrollment, exports, structure, video


def _line(source, kind, context, payload, **more):
    """A log line of these parts."""
    time = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return F.to_json(F.struct(source.alias("event_source"), kind.alias("event_type"), time.alias("time"), context.alias("context"), payload.alias("event"), *[c.alias(n) for n, c in more.items()])).alias("value")


_where = lambda: F.struct("course_id", "user_id")
_course = lambda: F.struct("course_id")


def _enrollment_lines(s, d, shift=0):
    """No id is 0 where other families take part, as a user of that id doesn't count there."""
    return enrollment_events(s, d).withColumn("user_id", F.col("user_id") + shift).select(_line(F.lit("server"), F.concat(F.lit("edx.course.enrollment."), "type"), _course(), F.struct("course_id", "user_id", "mode")))


def _activity_lines(s, d):
    return activity_events(s, d).select(_line(F.col("source"), F.col("type"), _where(), F.lit("")))


def _video_lines(s, d):
    e = video_events(s, d).withColumn("user_id", F.col("user_id") + 1)
    seek = F.col("type") == "seek_video"
    payload = F.struct(F.concat(F.lit("\n"), "module_id").alias("id"), F.when(~seek, F.col("current_time")).alias("currentTime"), F.when(seek, F.col("current_time")).alias("new_time"), "old_time", "duration", F.lit("html5").alias("code"))
    return e.select(_line(F.lit("browser"), F.col("type"), _where(), F.to_json(payload)))


def _engagement_lines(s, d):
    payload = F.struct(
        F.when(F.col("type") == "problem_check", F.col("entity_id")).alias("problem_id"), F.when(F.col("type") == "play_video", F.col("entity_id")).alias("id"), F.when(F.col("type").startswith("edx.forum."), F.col("entity_id")).alias("commentable_id"),
        F.when(F.col("correct"), "Correct").otherwise("incorrect").alias("success"),
    )
    return engagement_events(s, d).select(_line(F.col("source"), F.col("type"), _course(), payload, username=F.concat(F.lit(" "), "username")))


def _address_lines(s, d):
    return ip_events(s, d).withColumn("user_id", F.col("user_id") + 1).select(_line(F.lit("browser"), F.lit("page_close"), _where(), F.lit(""), ip=F.col("ip")))


def _report_lines(s, d):
    payload = F.struct(
        F.when(F.col("type") == "problem_check", F.col("entity_id")).alias("problem_id"), F.when(F.col("type") == "play_video", F.col("entity_id")).alias("id"), F.when(F.col("correct"), "correct").alias("success"),
        "vote_value", F.col("undo").alias("undo_vote"), F.col("target").alias("target_username"),
    )
    return engagement._student(s, d).select(_line(F.col("source"), F.col("type"), _course(), payload, username=F.col("username")))


def _problem_lines(s, d):
    c = structure._checks(s, d)
    parts = F.transform_values("answers", lambda _, v: F.struct(v["value"].alias("answer"), v["response_type"].alias("response_type"), v["question"].alias("question"), v["variant"].alias("variant"), v["correct"].alias("correct")))
    payload = F.struct("problem_id", F.when(F.col("is_correct"), "correct").otherwise("incorrect").alias("success"), F.transform_values("answers", lambda _, v: v["value"]).alias("answers"), parts.alias("submission"))
    context = F.struct("course_id", F.struct(F.struct(F.col("tags").alias("saved_tags")).alias("tagging_aside")).alias("asides"))
    return c.select(_line(F.lit("server"), F.lit("problem_check"), context, payload, username=F.col("username")))


def _dealt(s, lines, *families):
    """The families of an interval's lines, written once by day and read back."""
    path = S.shared_path(s)
    X.deal(lines, families, START, "2024-03-01").write.partitionBy("date").parquet(path)
    return s.read.parquet(path)


def _rows(s, lines, name):
    """Rows of one family with the tie-breaker that the roll-ups order by, here always the same."""
    return X.family(_dealt(s, lines, name), name).withColumn("event_id", F.lit(0).cast("long"))


def _checks(s, d):
    return X.answer_parts(X.family(_dealt(s, _problem_lines(s, d), "problem"), "problem"))


def _roster(s, d):
    return engagement._roster(s, d, G.module_engagement(_rows(s, _engagement_lines(s, d), "engagement")))


def _bare_checks(s, d):
    """Checks whose events lack the facts of their problems, which metadata adds."""
    bare = F.transform_values("answers", lambda _, v: v.withField("response_type", F.lit("")).withField("question", F.lit("")))
    return _checks(s, d).withColumn("answers", bare)


def _metadata(s, d):
    entry = F.struct(F.lit("Which?").alias("question"), F.lit("multiplechoiceresponse").alias("response_type"))
    ids = structure._checks(s, d).select(F.explode(F.map_keys("answers")).alias("id")).distinct()
    return R.read_answer_metadata(ids.select(F.to_json(F.create_map(F.col("id"), entry)).alias("value")))


def _answers(s, d):
    """The answer distribution, with facts from metadata, as files, one folder a course, read back."""
    parts = P.fill_facts(P.first_and_last_answers(_bare_checks(s, d)), _metadata(s, d))
    path, df = S.shared_path(s), P.answer_distribution(parts)
    S.write_answer_csv(df.select("course_id", "answer_id", "value", "first_count", "last_count"), path)
    return s.read.csv(path, header=True, schema="course_id string, answer_id string, value string, first_count long, last_count long, course_dir string")


def _responses(s, d):
    """The report of responses as a file for each course, in order of place and user, read back."""
    path = S.shared_path(s)
    responses = P.latest_responses(_checks(s, d)).withColumns({"problem": F.concat(F.lit("Problem "), "problem_id"), "problem_id": F.translate("problem_id", "p", "n")})
    located = P.response_location(responses, O.course_outline(*structure._tree(s, d)))
    S.write_problem_response_csv(located, path, ["problem_id", "answer_id", "location", "last_attempt_date"], date_format="yyyy-MM-dd")
    return s.read.csv(path, header=True, schema="sort_idx int, username string, problem_id string, answer_id string, location string, last_attempt_date string, course_id string").drop("last_attempt_date")


def _report(s, d):
    """The weekly report as files by course and week, read back under its own headers."""
    path = S.shared_path(s)
    rows = _rows(s, _report_lines(s, d), "report")
    people = users(s, d).withColumn("email", F.concat("username", F.lit("@x.org")))
    report = G.engagement_report(engagement._days(s, d), people, engagement._cohorts(s, d), G.student_engagement(rows, "weekly", END), "weekly", END)
    S.write_engagement_csv(report, path, "weekly")
    back = s.read.csv(path, header=True)
    names = {"Course ID": "course_id", "End Date": "date", "Username": "username", "Email": "email", "Cohort": "cohort", "Days Active This Week": "days_active"} | {h: c for c, h in S.ENGAGEMENT_HEADERS.items() if c in G.COUNTERS[1:]}
    kept = [(F.col(f"`{h}`").cast("long") if c in G.COUNTERS else F.col(f"`{h}`")).alias(c) for h, c in names.items()]
    return back.select(*kept, F.coalesce(F.col("`URL of Last Subsection Viewed`"), F.lit("")).alias("last_subsection_viewed"))


def _by_course(s, d):
    """Events as compressed files by course and day, read back; the course is told by the address where the context has none."""
    path = S.shared_path(s)
    decoded = R.parse_lines(exports._lines(s, d).select(F.col("event").alias("value")), keep=("value",))
    from ..operators.events import course_id, field, once

    rows = once(decoded.select(course_id(True).alias("course"), F.substring(field("time"), 1, 10).alias("date"), F.col("value").alias("line"))).where("course IS NOT NULL")
    S.export_events_by_course(rows, path)
    back = s.read.text(path).select("course", F.col("date").cast("string").alias("date"), F.input_file_name().alias("file"))
    return back.groupBy("course", "date").agg(F.count("*").alias("n_events"), F.count_distinct("file").alias("n_files"))


def _by_org(s, d):
    path = S.shared_path(s)
    from ..operators.events import event_org, field, once

    decoded = R.parse_lines(exports._lines(s, d).select(F.col("event").alias("value")), keep=("value",))
    rows = once(decoded.select(event_org().alias("org"), F.substring(field("time"), 1, 10).alias("date"), F.col("value").alias("line"))).where("org IS NOT NULL")
    S.export_events_by_org(rows, path)
    return s.read.text(path).groupBy("org", F.col("year").cast("string").alias("year"), F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n_events"))


def _families(s, d):
    """How many events of each family, course and day one scan of one log finds."""
    e = exports.events(s, d)
    number = F.concat(F.lit("p"), (F.col("k") % 10).cast("string"))
    kind = F.when(F.col("kind") == "purchase", "problem_check").when(F.col("kind") == "click", "play_video").when(F.col("kind") == "signup", "edx.course.enrollment.activated").when(F.col("kind") == "view", "edx.forum.thread.created").otherwise("page_close")
    payload = F.struct("course_id", "user_id", F.lit("honor").alias("mode"), number.alias("problem_id"), number.alias("id"), number.alias("commentable_id"), F.lit("correct").alias("success"), F.create_map(F.lit("a_1"), F.lit("x")).alias("answers"), F.when(F.col("event_id") % 3 > 0, F.col("k")).alias("currentTime"))
    source = F.when(F.col("event_id") % 2 == 0, "server").otherwise("browser")
    name = F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("user"), F.col("user_id").cast("string"))).otherwise(" ")
    lines = e.select(_line(source, kind, _where(), payload, username=name, ip=F.when(F.col("event_id") % 7 > 0, "1.2.3.4").otherwise("")))
    dealt = _dealt(s, lines, *X.FAMILIES)
    found = F.explode(F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("family"), F.col(f"{f}.course_id").alias("course_id"))) for f in X.FAMILIES])))
    return dealt.select(F.col("date").cast("string").alias("date"), found.alias("x")).groupBy("date", "x.family", "x.course_id").agg(F.count("*").alias("n_events"))


QUERIES = {
    "event_families": _families,
    "enrollment_from_lines": lambda s, d: E.enrollment_daily(E.days_enrolled(_rows(s, _enrollment_lines(s, d), "enrollment"), END)),
    "activity_from_lines": lambda s, d: A.course_activity_weekly(A.user_activity(_rows(s, _activity_lines(s, d), "activity")), A.calendar(s, START, END), START, END),
    "video_from_lines": lambda s, d: V.video_timeline(V.video_usage(V.video_viewings(_rows(s, _video_lines(s, d), "video")))),
    "roster_from_lines": _roster,
    "location_from_lines": lambda s, d: A.country_per_course(E.enrollment_spans(_rows(s, _enrollment_lines(s, d, 1), "enrollment"), END), A.last_country(A.last_daily_ip(_rows(s, _address_lines(s, d), "address")), activity._ranges(s, d))),
    "answers_from_lines": _answers,
    "responses_from_lines": _responses,
    "tags_from_lines": lambda s, d: P.tags_distribution(_checks(s, d)),
    "report_from_lines": _report,
    "events_by_course_files": _by_course,
    "events_by_org_files": _by_org,
}

_X = "SELECT *, strftime(ts, '%Y-%m-%d') AS day, event_id % 2 = 0 AS srv, event_id % 5 > 0 AS named FROM ev"
_N = lambda name, when: f"SELECT day AS date, '{name}' AS family, course_id, count(*) AS n_events FROM x WHERE {when} GROUP BY ALL"
ORACLES = {
    "event_families": with_views(x=_X) + " " + " UNION ALL ".join([
        _N("enrollment", "kind = 'signup'"), _N("activity", "kind <> 'signup'"), _N("video", "kind = 'click' AND event_id % 3 > 0 AND user_id <> 0"), _N("engagement", "named AND (kind = 'purchase' AND srv OR kind IN ('click', 'view'))"),
        _N("problem", "kind = 'purchase' AND srv"), _N("report", "named AND (kind <> 'purchase' OR srv)"), _N("address", "event_id % 7 > 0 AND user_id <> 0"),
    ]),
    "enrollment_from_lines": enrollment.ORACLES["enrollment_daily"], "activity_from_lines": activity.ORACLES["course_activity_weekly"], "video_from_lines": video.ORACLES["video_timeline"], "roster_from_lines": engagement.ORACLES["learner_roster"],
    "location_from_lines": activity.ORACLES["country_per_course"], "answers_from_lines": exports.ORACLES["answer_files"], "tags_from_lines": structure.ORACLES["tags_distribution"],
    "responses_from_lines": f"SELECT sort_idx, username, problem_id, answer_id, location, course_id FROM ({exports.ORACLES['problem_response_location']})",
    "report_from_lines": f"SELECT *, username || '@x.org' AS email FROM ({engagement.ORACLES['engagement_report_weekly']})",
    "events_by_course_files": with_views() + " SELECT course_id AS course, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_events, 1 AS n_files FROM ev GROUP BY ALL",
    "events_by_org_files": with_views(x=f"SELECT {exports._ORG} AS org, strftime(ts, '%Y') AS year, strftime(ts, '%Y-%m-%d') AS date FROM ev") + " SELECT *, count(*) AS n_events FROM x WHERE org IS NOT NULL GROUP BY ALL",
}
DATES = {"enrollment_from_lines": ["date"], "activity_from_lines": ["interval_start", "interval_end"], "location_from_lines": ["date"], "roster_from_lines": ["first_enrollment_date"], "report_from_lines": ["date"]}
