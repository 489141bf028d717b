"""Learner engagement: daily actions, weekly summaries, metric ranges, segments, roster, and report counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("problem_attempts", "problems_attempted", "problems_completed", "problem_attempts_per_completed", "videos_viewed", "discussion_contributions")
INF = float("inf")
SUBSECTION = r"^/courses/[^/+]+[/+][^/+]+[/+][^/]+/courseware/[^/]+/[^/]+/.*$"


def engagement_actions(events: DataFrame) -> DataFrame:
    """course_id, username, date, entity_type, entity_id, action: an event may stand for several actions."""
    kind = F.col("type")
    act = lambda entity, action, when: F.when(when, F.struct(F.lit(entity).alias("entity_type"), F.lit(action).alias("action")))
    problem = (kind == "problem_check") & (F.col("source") == "server")
    actions = F.array_compact(F.array(
        act("problem", "attempted", problem), act("problem", "completed", problem & F.col("correct")),
        act("video", "viewed", kind == "play_video"), act("discussion", "contributed", kind.startswith("edx.forum.") & kind.endswith(".created")),
    ))
    named = events.where(F.col("username").isNotNull() & (F.length("username") <= 30) & F.col("course_id").isNotNull() & F.col("entity_id").isNotNull())
    return named.select("course_id", "username", "date", F.substring("entity_id", 1, 255).alias("entity_id"), F.explode(actions).alias("a")).select("course_id", "username", "date", "a.entity_type", "entity_id", "a.action")


def module_engagement(events: DataFrame) -> DataFrame:
    return engagement_actions(events).groupBy("course_id", "username", "date", "entity_type", "entity_id", "action").agg(F.count("*").alias("count"))


def weekly_summary(engagement: DataFrame, end: str) -> DataFrame:
    """The metrics of the seven days before end; attempts per completed problem are infinite if none was completed."""
    last = F.lit(end).cast("date")
    week = engagement.where((F.col("date") >= F.date_sub(last, 7)) & (F.col("date") < last))
    kind = lambda entity, action: (F.col("entity_type") == entity) & (F.col("action") == action)
    # First each learner's modules, so that counts of distinct modules and days are plain sums and bits.
    times = lambda when: F.coalesce(F.sum(F.when(when, F.col("count"))), F.lit(0))
    some = lambda when: F.coalesce(F.max(F.when(when & F.col("entity_id").isNotNull(), 1)), F.lit(0))
    day = F.call_function("shiftleft", F.lit(1), F.datediff(F.col("date"), F.date_sub(last, 7)))
    modules = week.groupBy("course_id", "username", "entity_type", "entity_id").agg(
        times(kind("problem", "attempted")).alias("attempts"), some(kind("problem", "attempted")).alias("attempted"), some(kind("problem", "completed")).alias("completed"),
        some(kind("video", "viewed")).alias("viewed"), times(F.col("entity_type") == "discussion").alias("contributions"), F.bit_or(day).alias("days"),
    )
    df = modules.groupBy("course_id", "username").agg(
        F.sum("attempts").alias("problem_attempts"), F.sum("attempted").alias("problems_attempted"), F.sum("completed").alias("problems_completed"), F.sum("viewed").alias("videos_viewed"),
        F.sum("contributions").alias("discussion_contributions"), F.bit_count(F.bit_or("days")).cast("long").alias("days_active"),
    )
    ratio = F.when(F.col("problems_completed") == 0, F.lit(INF)).otherwise(F.try_divide(F.col("problem_attempts").cast("double"), F.col("problems_completed")))
    return df.withColumns({"start_date": F.date_sub(last, 7), "end_date": last, "problem_attempts_per_completed": ratio})


def unpivoted(summary: DataFrame) -> DataFrame:
    """course_id, username, start_date, end_date, days_active, problem_attempts, metric, value."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS])
    return summary.select("course_id", "username", "start_date", "end_date", "days_active", F.col("problem_attempts").alias("attempts"), F.explode(pairs).alias("m")).select("*", "m.metric", "m.value").drop("m")


def metric_ranges(summary: DataFrame, low: float = 0.15, high: float = 0.85) -> DataFrame:
    """course_id, start_date, end_date, metric, range_type, low_value, high_value, from exact percentiles of active learners."""
    df = unpivoted(summary).where("days_active > 0")
    counts = ~((F.col("metric") == "problem_attempts_per_completed") & (F.col("attempts") == 0))
    bounds = df.groupBy("course_id", "metric").agg(
        F.min("start_date").alias("start_date"), F.min("end_date").alias("end_date"),
        F.percentile(F.when(counts, F.col("value")), F.array(F.lit(low), F.lit(high))).alias("p"),
    )
    bound = lambda i: F.when(F.isnan(F.get("p", F.lit(i))), F.lit(INF)).otherwise(F.get("p", F.lit(i)))
    made = lambda when, name, a, b: F.when(when, F.struct(F.lit(name).alias("range_type"), a.alias("low_value"), b.alias("high_value")))
    lo, hi, none = F.col("lo"), F.col("hi"), F.col("p").isNull()
    ranges = F.array_compact(F.array(
        made(none, "normal", F.lit(0.0), F.lit(INF)), made(lo > 0, "low", F.lit(0.0), lo),
        made(lo == hi, "normal", lo, F.lit(INF)), made(lo != hi, "normal", lo, hi), made(lo != hi, "high", hi, F.lit(INF)),
    ))
    df = bounds.withColumns({"lo": bound(0), "hi": bound(1)})
    return df.select("course_id", "start_date", "end_date", "metric", F.explode(ranges).alias("r")).select("course_id", "start_date", "end_date", "metric", "r.*")


def user_segments(summary: DataFrame, ranges: DataFrame) -> DataFrame:
    """Learners with a high metric: struggling for attempts per completed problem, else highly engaged; and why."""
    high = ranges.where("range_type = 'high' AND metric <> 'problem_attempts'").select("course_id", "metric", "low_value", "high_value")
    df = unpivoted(summary).join(high, ["course_id", "metric"])
    value, top = F.col("value"), F.col("high_value")
    df = df.where((value >= F.col("low_value")) & ((value < top) | ((value == INF) & (top == INF))))
    segment = F.when(F.col("metric") == "problem_attempts_per_completed", "struggling").otherwise("highly_engaged")
    df = df.groupBy("course_id", "username", "start_date", "end_date", segment.alias("segment"))
    return df.agg(F.array_join(F.sort_array(F.collect_set("metric")), ",").alias("reason"))


def segment_text(segments: DataFrame) -> DataFrame:
    return segments.groupBy("course_id", "username").agg(F.concat_ws(",", F.sort_array(F.collect_set("segment"))).alias("segments"))


def clean_profile_text(text: Column, size: int) -> Column:
    return F.substring(F.replace(F.regexp_replace(text, "[\t\n\r]", " "), F.lit("\\"), F.lit("")), 1, size)


def first_enrollment_date(days: DataFrame, end: str) -> DataFrame:
    return days.where((F.col("at_end") == 1) & (F.col("date") < F.lit(end).cast("date"))).groupBy("course_id", "user_id").agg(F.min("date").alias("first_enrollment_date"))


def cohort_members(groups: DataFrame, members: DataFrame) -> DataFrame:
    """user_id, course_id, cohort: members (group_id, user_id) with their groups (id, course_id, name)."""
    return members.join(groups, members["group_id"] == groups["id"]).select("user_id", "course_id", F.col("name").alias("cohort"))


def learner_roster(days: DataFrame, people: DataFrame, cohorts: DataFrame, now: DataFrame, before: DataFrame, segments: DataFrame, end: str) -> DataFrame:
    """Each learner enrolled on the last day with metrics, cohort, first enrollment and segments."""
    day, stop = F.col("date"), F.lit(end).cast("date")
    last = days.groupBy("course_id", "user_id").agg(
        F.max(F.when(day == F.date_sub(stop, 1), F.struct("at_end", "mode"))).alias("x"), F.min(F.when((F.col("at_end") == 1) & (day < stop), day)).alias("first_enrollment_date"),
    ).where("x IS NOT NULL").select("course_id", "user_id", "x.at_end", "x.mode", "first_enrollment_date")
    old = before.select("course_id", "username", F.col("days_active").alias("_old"))
    df = last.join(people, "user_id").join(cohorts, ["user_id", "course_id"], "left").join(now.drop("start_date", "end_date"), ["course_id", "username"], "left")
    df = df.join(old, ["course_id", "username"], "left").join(segment_text(segments), ["course_id", "username"], "left")
    was, is_ = F.coalesce("_old", F.lit(0)) > 0, F.coalesce("days_active", F.lit(0)) > 0
    text = F.concat_ws(",", F.when(F.col("at_end") == 0, "unenrolled"), F.when(~was & ~is_, "inactive"), F.when(was & ~is_, "disengaging"), F.col("segments"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    attempts = F.coalesce("problem_attempts", F.lit(0))
    return df.select(
        "course_id", "username", "user_id", clean_profile_text(F.col("name"), 100).alias("name"), F.col("mode").alias("enrollment_mode"), "first_enrollment_date", "cohort",
        *[zero(m) for m in METRICS if m != "problem_attempts_per_completed"], "problem_attempts_per_completed", text.alias("segments"),
        F.when(F.col("problem_attempts_per_completed").isNull(), -attempts).otherwise(attempts).alias("attempt_ratio_order"), "year_of_birth", "gender",
    )


def roster_documents(roster: DataFrame, copies: int = 1) -> DataFrame:
    """_id and JSON source of each learner; nulls and infinite numbers are left out, segments are a list."""
    df = roster.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    suffix = F.when(F.col("_copy") > 0, F.concat(F.lit("_"), F.col("_copy").cast("string"))).otherwise("")
    df = df.withColumn("_id", F.concat_ws("|", "course_id", F.concat("username", suffix)))
    finite = [F.when(F.abs(c) != INF, F.col(c)).alias(c) if kind == "double" else F.col(c) for c, kind in roster.dtypes if c != "segments"]
    parts = F.when(F.col("segments") != "", F.split("segments", ",")).alias("segments")
    return df.select("_id", F.to_json(F.struct(*finite, parts), {"ignoreNullFields": "true"}).alias("source"))


def student_events(events: DataFrame) -> DataFrame:
    """Events as rows of the report: a vote counts for the voter and, as vote_received, for the target."""
    kind, votes = F.col("type"), r"^edx\.forum\.(\w+)\.voted$"
    post = F.regexp_extract("type", votes, 1)
    up = F.col("vote_value")
    named = F.when(kind.rlike(SUBSECTION), "marker:subsection").otherwise(kind)
    keeps = F.when(kind == "problem_check", (F.col("source") == "server") & F.col("entity_id").isNotNull()).when(kind == "play_video", F.col("entity_id").isNotNull()).when(post != "", up.isin("up", "down")).otherwise(True)
    own = F.struct(F.col("username").alias("username"), named.alias("event"))
    received = F.when((post != "") & F.col("target").isNotNull(), F.struct(F.col("target").alias("username"), F.concat(F.lit("edx.forum."), post, F.lit(".vote_received")).alias("event")))
    df = events.where(keeps & F.col("username").isNotNull() & F.col("course_id").isNotNull()).withColumn("_e", F.explode(F.array_compact(F.array(own, received))))
    return df.select("course_id", F.col("_e.username").alias("username"), F.col("_e.event").alias("event"), "date", "ts", "entity_id", "correct", "vote_value", "undo", F.col("type").alias("path"))


def date_key(date: Column, interval: str, end: str) -> Column:
    """The date that a report groups by: the day, the last day of its report week, or the last complete day."""
    last = F.date_sub(F.lit(end).cast("date"), 1)
    if interval == "daily":
        return date
    if interval == "weekly":
        return F.date_add(date, F.pmod(F.weekday(last) - F.weekday(date), F.lit(7)))
    return last


def student_engagement(events: DataFrame, interval: str, end: str) -> DataFrame:
    """Counters by date key, course and user."""
    df = student_events(events).withColumn("key", date_key(F.col("date"), interval, end))
    is_ = lambda *names: F.col("event").isin(*names)
    count = lambda when: F.sum(F.when(when, 1).otherwise(0)).cast("long")
    some = lambda when: F.max(F.when(when & F.col("entity_id").isNotNull(), 1).otherwise(0)).cast("long")
    vote = lambda way, *names: F.sum(F.when(is_(*names) & (F.col("vote_value") == way), F.when(F.coalesce("undo", F.lit(False)), -1).otherwise(1)).otherwise(0)).cast("long")
    posts = ("edx.forum.response", "edx.forum.thread")
    given, taken = [f"{p}.voted" for p in posts], [f"{p}.vote_received" for p in posts]
    # First each learner's entities, so that counts of distinct entities are plain sums.
    entities = df.groupBy(F.col("key").alias("date"), "course_id", "username", "event", "entity_id").agg(
        some(is_("problem_check")).alias("problems_attempted"), count(is_("problem_check")).alias("problem_attempts"), some(is_("problem_check") & F.col("correct")).alias("problems_correct"), some(is_("play_video")).alias("videos_played"),
        count(is_("edx.forum.thread.created")).alias("forum_posts"), count(is_("edx.forum.response.created")).alias("forum_responses"), count(is_("edx.forum.comment.created")).alias("forum_comments"),
        vote("up", *given).alias("forum_upvotes_given"), vote("down", *given).alias("forum_downvotes_given"), vote("up", *taken).alias("forum_upvotes_received"), vote("down", *taken).alias("forum_downvotes_received"),
        count(is_("book")).alias("textbook_pages_viewed"), F.max(F.when(is_("marker:subsection"), F.struct("ts", "path"))).alias("marker"), F.collect_set("date").alias("dates"),  # at most the report's days
    )
    days = F.size(F.array_distinct(F.flatten(F.collect_set("dates")))).cast("long")
    return entities.groupBy("date", "course_id", "username").agg(
        days.alias("days_active"), *[F.sum(c).alias(c) for c in COUNTERS if c != "days_active"], F.coalesce(F.max("marker")["path"], F.lit("")).alias("last_subsection_viewed"),
    )


COUNTERS = (
    "days_active", "problems_attempted", "problem_attempts", "problems_correct", "videos_played", "forum_posts", "forum_responses", "forum_comments",
    "forum_upvotes_given", "forum_downvotes_given", "forum_upvotes_received", "forum_downvotes_received", "textbook_pages_viewed",
)


def engagement_report(days: DataFrame, people: DataFrame, cohorts: DataFrame, engagement: DataFrame, interval: str, end: str) -> DataFrame:
    """Every user enrolled on a report date, with zeros where nothing was done, and the cohort."""
    at = days.where("at_end = 1").withColumn("_key", date_key(F.col("date"), interval, end)).where("date = _key").drop("_key")
    df = at.select("date", "course_id", "user_id").join(people.select("user_id", "username", *[c for c in people.columns if c == "email"]), "user_id").join(cohorts, ["user_id", "course_id"], "left")
    df = df.join(engagement, ["date", "course_id", "username"], "left")
    email = ["email"] if "email" in people.columns else []
    return df.select("date", "course_id", "username", *email, "cohort", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTERS], F.coalesce("last_subsection_viewed", F.lit("")).alias("last_subsection_viewed"))


def engagement_table(engagement: DataFrame, start: str, end: str) -> DataFrame:
    return engagement.where((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date")))
