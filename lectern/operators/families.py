"""Log lines dealt to typed families of events in one scan.

Lines that can't hold what is asked for are told by their text before any is parsed; each other line is parsed once, and
each event becomes a row with a column for each family: a struct of the family's fields, or null where the event is no
such one. Written as Parquet, a family is read by its own column alone, so one scan of the logs serves every workflow.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import course_key_from_url, normalize_course_id
from ..functions.text import datestamp, event_time, event_time_string, event_username, stringify
from ..sources.readers import parse_lines
from . import events as X
from .activity import activity_labels
from .engagement import SUBSECTION
from .video import UNKNOWN, valid_offset

#: Texts of which one stands in every line of the family; without any, every line may hold one.
NEEDLES = {
    "enrollment": (".enrollment.",), "video": ("_video",), "engagement": ("problem_check", "play_video", "edx.forum."),
    "problem": ("problem_check",), "activity": (), "report": (), "address": (),
}
FAMILIES = tuple(NEEDLES)
#: The types of video events, the codes of players that are no video's name, the longest user name, the kinds of votes.
VIDEO = ("play_video", "pause_video", "seek_video", "stop_video")
PLAYERS = ("html5", "mobile")
LONGEST_NAME = 30


def lines_for(lines: DataFrame, families: Iterable[str], column: str = "value") -> DataFrame:
    """The lines that may hold events of the families, by their text alone."""
    needles = [NEEDLES[f] for f in families]
    if not all(needles):
        return lines
    fits = F.lit(False)
    for needle in sorted({n for some in needles for n in some}):
        fits = fits | F.col(column).contains(needle)
    return lines.where(fits)


def _of_payload(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("payload", f"$.{path}", kind)


def _named(path: str) -> Column:
    """A payload's text, trimmed; null where it is empty or missing."""
    return F.nullif(F.btrim(_of_payload(path), F.lit(" \t\r\n\f\x0B")), F.lit(""))


def _enrollment() -> Column:
    course, user, mode = normalize_course_id(_of_payload("course_id")), _of_payload("user_id").try_cast("long"), _of_payload("mode")
    kind = F.when(F.col("type").isin(*X.ENROLLMENT), F.replace("type", F.lit("edx.course.enrollment."), F.lit("")))
    return F.when(kind.isNotNull() & course.isNotNull() & user.isNotNull() & mode.isNotNull(), F.struct(course.alias("course_id"), user.alias("user_id"), "ts", kind.alias("type"), mode.alias("mode")))


def _activity() -> Column:
    good = F.col("user_id").isNotNull() & F.col("any_course").isNotNull() & (F.size(activity_labels(F.col("source"), F.col("type"))) > 0)
    return F.when(good, F.struct("user_id", F.col("any_course").alias("course_id"), "ts", "source", "type"))


def _video() -> Column:
    kind, module = F.col("type"), _named("id")
    absent = F.try_variant_get("payload", "$.currentTime", "variant").isNull()
    now = F.when(kind == "seek_video", valid_offset(_of_payload("new_time"))).when((kind == "pause_video") & absent, 0.0).otherwise(valid_offset(_of_payload("currentTime")))
    old = F.when(kind == "seek_video", valid_offset(_of_payload("old_time")))
    code = _of_payload("code")
    youtube = F.when((kind == "play_video") & ~code.isin(*PLAYERS), code)
    duration = F.coalesce(F.nullif(_of_payload("duration", "double"), F.lit(0.0)), F.lit(UNKNOWN))
    good = kind.isin(*VIDEO) & (F.col("user_id") != 0) & F.col("any_course").isNotNull() & module.isNotNull() & now.isNotNull() & ((kind != "seek_video") | old.isNotNull())
    return F.when(good, F.struct("user_id", F.col("any_course").alias("course_id"), module.alias("module_id"), "ts", "type", now.alias("current_time"), old.alias("old_time"), youtube.alias("youtube_id"), duration.alias("duration")))


def _correct() -> Column:
    return F.coalesce(F.lower(_of_payload("success")) == "correct", F.lit(False))


def _engagement(anonymous: str | None) -> Column:
    kind, name = F.col("type"), F.coalesce("username", F.lit(anonymous).cast("string"))
    entity = F.when((kind == "problem_check") & (F.col("source") == "server"), _of_payload("problem_id")).when(kind == "play_video", _named("id")).when(kind.startswith("edx.forum."), _of_payload("commentable_id"))
    good = (F.char_length(name) <= LONGEST_NAME) & F.col("any_course").isNotNull() & (entity != "")
    return F.when(good, F.struct(F.col("any_course").alias("course_id"), name.alias("username"), "ts", "source", "type", entity.alias("entity_id"), _correct().alias("correct")))


def _report() -> Column:
    kind, vote = F.col("type"), _of_payload("vote_value")
    entity = F.when(kind == "problem_check", F.nullif(_of_payload("problem_id"), F.lit(""))).when(kind == "play_video", F.nullif(_of_payload("id"), F.lit("")))
    voted = kind.rlike(r"^edx\.forum\.\w+\.voted")
    keeps = F.when(kind == "problem_check", (F.col("source") == "server") & entity.isNotNull()).when(kind == "play_video", entity.isNotNull()).when(kind.rlike(SUBSECTION), F.col("ts").isNotNull()).when(voted, vote.isin("up", "down")).otherwise(True)
    fields = F.struct(
        "course_id", "username", "ts", "source", "type", entity.alias("entity_id"), _correct().alias("correct"), F.when(voted, vote).alias("vote_value"),
        F.when(voted, F.coalesce(_of_payload("undo_vote", "boolean"), F.lit(False))).alias("undo"), F.when(voted, F.nullif(_of_payload("target_username"), F.lit(""))).alias("target"),
    )
    return F.when(F.col("username").isNotNull() & kind.isNotNull() & F.col("course_id").isNotNull() & F.col("payload").isNotNull() & keeps, fields)


def _address() -> Column:
    ip = F.nullif(X.field("ip"), F.lit(""))
    return F.when((F.col("user_id") != 0) & F.col("ts").isNotNull() & ip.isNotNull(), F.struct("user_id", "course_id", "ts", ip.alias("ip")))


PARTS = "map<string, struct<answer: string, input_type: string, response_type: string, question: string, variant: string, correct: boolean>>"


def _problem() -> Column:
    answers = F.from_json(_of_payload("answers"), "map<string, string>")
    states = F.from_json(_of_payload("correct_map"), "map<string, struct<correctness: string>>")
    plain = F.forall(F.map_keys(answers), lambda k: k.rlike(r"^[\x20-\x7e]+$"))
    tags = F.try_variant_get("event", "$.context.asides.tagging_aside.saved_tags", "string")
    listed, single = F.from_json(tags, "map<string, array<string>>"), F.transform_values(F.from_json(tags, "map<string, string>"), lambda _, v: F.array(v))
    good = (F.col("type") == "problem_check") & (F.col("source") == "server") & F.col("course_id").isNotNull() & _of_payload("problem_id").isNotNull() & (F.cardinality(answers) > 0) & plain
    fields = F.struct(
        "course_id", "username", "ts", _of_payload("problem_id").alias("problem_id"), _correct().alias("is_correct"), answers.alias("answers"), F.from_json(_of_payload("submission"), PARTS).alias("submission"),
        F.transform_values(states, lambda _, s: s["correctness"] == "correct").alias("correct"), F.coalesce(listed, single).alias("tags"),
    )
    return F.when(good, fields)


def deal(lines: DataFrame, families: Iterable[str] = FAMILIES, start: str | None = None, end: str | None = None, anonymous: str | None = None) -> DataFrame:
    """date and a column for each family, of the events of an interval (end excluded) that belong to any.

    anonymous: the name under which events without a user count as engagement; without it they don't.
    """
    families = tuple(families)
    decoded = decode(lines_for(lines, families))
    if start:
        decoded = decoded.where(F.col("date") >= start)
    if end:
        decoded = decoded.where(F.col("date") < end)
    make = {"enrollment": _enrollment, "activity": _activity, "video": _video, "engagement": lambda: _engagement(anonymous), "report": _report, "address": _address, "problem": _problem}
    rows = decoded
    for f in families:  # a step for each, so that its code stays small
        rows = X.once(rows.select(*rows.columns, make[f]().alias(f)))
    some = F.lit(False)
    for f in families:
        some = some | F.col(f).isNotNull()
    return rows.where(some).select(F.col("date").try_cast("date").alias("date"), *families)


def decode(lines: DataFrame) -> DataFrame:
    """event, payload, source, type, time, ts, date, username, user_id, course_id, and any_course, which may come from the address, of lines with a time and a type.

    Three steps, each over columns of the one before, keep what Spark compiles for each small.
    """
    events = X.once(parse_lines(lines))
    read = X.once(events.select(
        "event", X.payload().alias("payload"), X.field("event_source").alias("source"), X.field("event_type").alias("type"), X.field("page").alias("page"), event_time_string(X.field("time")).alias("time"), event_username(X.field("username")).alias("username"),
        X.field("context.user_id").try_cast("long").alias("user_id"), F.trim(X.field("context.course_id")).alias("own"), F.try_variant_get("event", "$.context", "variant").isNotNull().alias("placed"),
    )).where("time IS NOT NULL AND type IS NOT NULL")
    url = F.when(F.col("source") == "server", F.col("type")).when(F.col("source") == "browser", F.col("page"))
    from_url = F.when(F.col("placed") & (F.coalesce("own", F.lit("")) == ""), course_key_from_url(url))
    told = X.once(read.select("event", "payload", "source", "type", "time", "username", "user_id", F.when(F.col("placed"), normalize_course_id(F.col("own"))).alias("course_id"), from_url.alias("url_course")))
    return X.once(told.select("event", "payload", "source", "type", "time", event_time(F.col("time")).alias("ts"), datestamp(F.col("time")).alias("date"), "username", "user_id", "course_id", F.coalesce("course_id", "url_course").alias("any_course")))


def family(dealt: DataFrame, name: str) -> DataFrame:
    """The rows of one family, with their date."""
    return dealt.where(F.col(name).isNotNull()).select("date", f"{name}.*")


def answer_parts(problems: DataFrame) -> DataFrame:
    """Problem checks as course_id, problem_id, username, ts, is_correct, tags and answers by part: value, variant, correct,
    response_type and question, from the submission where the event has one, else from the plain answers."""
    part = lambda k, v: F.struct(
        v.alias("value"), F.coalesce(F.try_element_at("submission", k)["variant"], F.lit("")).alias("variant"), F.coalesce(F.try_element_at("submission", k)["correct"], F.try_element_at("correct", k)).alias("correct"),
        F.coalesce(F.try_element_at("submission", k)["response_type"], F.lit("")).alias("response_type"), F.coalesce(F.try_element_at("submission", k)["question"], F.lit("")).alias("question"),
    )
    several = lambda v: F.from_json(v, "array<string>")
    shown = F.transform_values("answers", lambda _, v: F.when(v.startswith("[") & several(v).isNotNull(), stringify(several(v))).otherwise(F.trim(v)))
    return problems.withColumn("answers", shown).select("course_id", "problem_id", "username", "ts", "is_correct", "tags", F.transform_values("answers", part).alias("answers"))


#: The facts that an event's payload may be given.
AUGMENTS = ("timestamp", "context", "username")


def augment_payload(decoded: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Decoded events with ``payload`` and the named facts (timestamp in seconds, context, username) added to it; events that lack one of them or a payload go."""
    fields = tuple(fields)
    if unknown := set(fields) - set(AUGMENTS):
        raise ValueError(f"unknown facts: {sorted(unknown)}")
    time, context = event_time(F.col("time")), F.try_variant_get("event", "$.context", "variant")
    facts = {"timestamp": F.unix_micros(time) / 1e6, "context": F.when(~F.is_variant_null(context), context), "username": X.field("username")}
    given = {f: F.try_variant_get(F.to_variant_object(F.struct(facts[f].alias("x"))), "$.x", "variant").alias(f"_{f}") for f in fields}
    names = [c for c in decoded.columns if c != "payload"]
    own = F.try_variant_get("payload", "$", "map<string,variant>").alias("_own")
    read = X.once(decoded.where("payload IS NOT NULL").select("*", own, *[facts[f].isNotNull().alias(f"_has_{f}") for f in fields], *given.values()))
    for f in fields:
        read = read.where(f"_has_{f}")
    added = F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[F.col(f"_{f}") for f in fields]))
    payload = F.to_variant_object(F.map_concat(F.map_filter("_own", lambda k, _: ~k.isin(*fields)), added))
    return X.once(read.select(*names, payload.alias("payload"))).select(*decoded.columns)


def parse_only(lines: DataFrame, start: str, end: str) -> DataFrame:
    """date and line of an interval's events: the least that a scan of logs can do."""
    rows = parse_lines(lines, keep=("value",)).select(datestamp(X.field("time")).alias("date"), F.col("value").alias("line"))
    return rows.where((F.col("date") >= start) & (F.col("date") < end))
