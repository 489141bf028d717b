"""Fields of tracking events held as VARIANT: payload, course, user, organisation, and what may be exported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import course_key_from_url, normalize_course_id, org_of_course
from ..functions.text import event_time_string, event_username, once

ENROLLMENT = {"edx.course.enrollment.activated": "activated", "edx.course.enrollment.deactivated": "deactivated", "edx.course.enrollment.mode_changed": "mode_changed"}


def field(path: str, kind: str = "string", event: str = "event") -> Column:
    return F.try_variant_get(event, f"$.{path}", kind)


def is_object(tree: Column, path: str = "$") -> Column:
    """Whether the value there is an object; told by a cast, as its schema costs a walk through all of it."""
    return F.try_variant_get(tree, path, "struct<>").isNotNull()


def payload() -> Column:
    """The payload as an object: parsed if it is text, empty if it is '', null if it is cut, key=value text or a list."""
    raw = F.try_variant_get("event", "$.event", "variant")
    text = F.try_variant_get("event", "$.event", "string")
    cut = (F.length(text) == 512) & text.contains("POST")
    pairs = text.contains("=") & ~text.contains("{")
    from_text = F.when(text == "", F.parse_json(F.lit("{}"))).when(cut | pairs, None).when(text.rlike(r"^\s*\{"), F.try_parse_json(text))  # numbers, lists and the like don't begin so
    return F.when(is_object(F.col("event"), "$.event"), raw).otherwise(from_text)


def course_id(from_url: bool = False) -> Column:
    """The context's course if valid; from the address only where the context has an empty one."""
    own = F.trim(field("context.course_id"))
    url = F.when(field("event_source") == "server", field("event_type")).when(field("event_source") == "browser", field("page"))
    fallback = course_key_from_url(url) if from_url else F.lit(None).cast("string")
    no_context = F.try_variant_get("event", "$.context", "variant").isNull()
    return F.when(no_context, None).when(F.coalesce(own, F.lit("")) == "", fallback).otherwise(normalize_course_id(own))


def decoded(events: DataFrame, from_url: bool = False) -> DataFrame:
    """event, payload, source, type, time, date, username, user_id, course_id. In steps, so that what Spark compiles for each stays small."""
    events = once(events.select("event"))
    read = once(events.select(
        "event", payload().alias("payload"), field("event_source").alias("source"), field("event_type").alias("type"), event_time_string(field("time")).alias("time"), event_username(field("username")).alias("username"),
        field("context.user_id").try_cast("long").alias("user_id"),
    ))
    return once(read.select("event", "payload", "source", "type", "time", F.split_part("time", F.lit("T"), F.lit(1)).alias("date"), "username", "user_id", course_id(from_url).alias("course_id")))


def server_events(lines: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """Lines that may hold server events of the type, told by their text before any parsing."""
    return lines.where(F.col(column).contains(kind) & F.col(column).contains("server"))


def enrollment_events(df: DataFrame) -> DataFrame:
    """course_id, user_id, time, type, mode of valid enrollment events among decoded ones."""
    kind = F.create_map(*[F.lit(x) for p in ENROLLMENT.items() for x in p])
    get = lambda p, k="string": F.try_variant_get("payload", f"$.{p}", k)
    df = once(df.where(F.col("type").isin(*ENROLLMENT)).select(normalize_course_id(get("course_id")).alias("course_id"), get("user_id").try_cast("long").alias("user_id"), "time", F.try_element_at(kind, F.col("type")).alias("type"), get("mode").alias("mode")))
    return df.dropna()


def problem_check_events(df: DataFrame) -> DataFrame:
    """course_id, username, time, problem_id, success, answers and submission of explicit server checks with answers."""
    get = lambda p, k="string": F.try_variant_get("payload", f"$.{p}", k)
    answers = F.from_json(get("answers"), "map<string, string>")
    df = once(df.where("type = 'problem_check' AND source = 'server'").select(
        "course_id", "username", "time", get("problem_id").alias("problem_id"), get("success").alias("success"), answers.alias("answers"),
        F.from_json(get("submission"), "map<string, struct<answer: string, input_type: string, response_type: string, question: string, variant: string, correct: boolean>>").alias("submission"),
    ))
    plain = F.forall(F.map_keys("answers"), lambda k: k.rlike(r"^[\x20-\x7e]+$"))
    return df.where(F.col("course_id").isNotNull() & F.col("problem_id").isNotNull() & (F.cardinality("answers") > 0) & plain)


def tagged_problem_events(df: DataFrame) -> DataFrame:
    """course_id, problem_id, time, is_correct, tags of server checks."""
    get = lambda p: F.try_variant_get("payload", f"$.{p}", "string")
    tags = F.from_json(F.try_variant_get("event", "$.context.asides.tagging_aside.saved_tags", "string"), "map<string, array<string>>")
    one = F.from_json(F.try_variant_get("event", "$.context.asides.tagging_aside.saved_tags", "string"), "map<string, string>")
    tags = F.coalesce(tags, F.transform_values(one, lambda _, v: F.array(v)))
    return df.where("type = 'problem_check' AND source = 'server'").select("course_id", get("problem_id").alias("problem_id"), "time", (get("success") == "correct").alias("is_correct"), tags.alias("tags")).dropna(subset=["course_id", "problem_id", "time"])


def event_org() -> Column:
    """The organisation by source. Server: the context's organisation, else of the course in the address, of an event
    that is no address the part of its problem's id. Browser: of the course in the page's address, the context is not
    asked. Mobile: the context's. In addresses of old courses it is the part after ``courses``."""
    context, kind, page = F.nullif(field("context.org_id"), F.lit("")), field("event_type"), field("page")
    part = lambda text, i: F.get(F.split(text, "/"), F.lit(i))

    def of_address(address: Column, at: int) -> Column:
        course = course_key_from_url(address)
        return F.when(course.contains("+"), org_of_course(course)).otherwise(part(address, at))

    problem = part(F.coalesce(field("event.problem_id"), F.try_variant_get(F.try_parse_json(field("event")), "$.problem_id", "string")), 2)
    server = F.when(context.isNotNull(), context).when(kind.contains("/courses/"), of_address(kind, 2)).when(~kind.contains("/"), problem)
    browser = F.when(page.contains("courses"), of_address(page, 4))
    source = field("event_source")
    return F.when(source == "server", server).when(source == "browser", browser).when(source == "mobile", context)


#: Fixed value: the host whose events are not exported.
STUDIO = "studio.edx.org"


def exportable(lines: DataFrame, orgs: DataFrame, studio: str = STUDIO) -> DataFrame:
    """org and line, as it came, of each event that an organisation may have. lines: event and the line itself. orgs: alias, org, courses (null: all).

    Events of the studio's host or of an empty one stay, so do those that their payload flags. What the checks read is
    taken from the event once, as columns of their own.
    """
    lines = once(lines.select("line", "event"))
    flagged = once(lines.select("line", "event", field("host").alias("host"), F.lower(F.try_variant_get(payload(), "$._export", "string")).alias("flag")))
    facts = once(once(flagged.select("*", event_org().alias("alias"))).select("line", "host", "flag", "alias", course_id(True).alias("course")))
    df = facts.where(~F.coalesce(F.col("host").isin("", studio), F.lit(False)) & ~F.coalesce(F.col("flag").isin("n", "f", "0", "false", "no"), F.lit(False)))
    df = df.join(F.broadcast(orgs), "alias")  # the configured organisations: as many rows as aliases
    return df.where(F.col("courses").isNull() | F.array_contains("courses", F.col("course"))).select("org", F.trim("line").alias("line"))


#: Addresses whose events may be released, the course's id replaced by its name.
RELEASABLE = (
    r"^/courses/\(course_id\)/jump_to_id/",
    r"^/courses/\(course_id\)/courseware/",
    r"^/courses/\(course_id\)/info/?$",
    r"^/courses/\(course_id\)/progress/?$",
    r"^/courses/\(course_id\)/course_wiki/?$",
    r"^/courses/\(course_id\)/about/?$",
    r"^/courses/\(course_id\)/teams/?$",
    r"^/courses/\(course_id\)/[a-fA-F\d]{32}/?$",
    r"^/courses/\(course_id\)/?$",
    r"^/courses/\(course_id\)/pdfbook/\d+(/chapter/\d+(/\d+)?)?/?$",
    r"^/courses/\(course_id\)/wiki((?!/_).)*$",
    r"^/courses/\(course_id\)/discussion/(threads|comments)",
    r"^/courses/\(course_id\)/discussion/(upload|users|forum/?)$",
    r"^/courses/\(course_id\)/discussion/[\w\-.]+/threads/create$",
    r"^/courses/\(course_id\)/discussion/forum/[\w\-.]+/(inline|search|threads)$",
    r"^/courses/\(course_id\)/discussion/forum/[\w\-.]+/threads/\w+$",
)


#: Rows up to which a whitelist is broadcast.
LISTED = 10_000


def releasable(events: DataFrame, whitelist: DataFrame, addresses: tuple[str, ...] = RELEASABLE) -> DataFrame:
    """Events that may be released: of servers, those whose address fits; others, those whose source and type are in the
    whitelist (event_source, event_type: a configured list). Synthetic events are not."""
    source, kind = field("event_source"), field("event_type")
    address = F.replace(kind, course_key_from_url(kind), F.lit("(course_id)"))
    fits = F.coalesce(F.coalesce(address, kind).rlike("|".join(f"(?:{a})" for a in addresses)), F.lit(False))
    made = F.try_variant_get("event", "$.synthesized", "variant").isNotNull()
    df = events.where(source.isNotNull() & kind.isNotNull() & ~made).withColumns({"_source": source, "_type": kind, "_implicit": (source == "server") & kind.startswith("/"), "_fits": fits})
    listed = whitelist.select(F.col("event_source").alias("_source"), F.col("event_type").alias("_type"), F.lit(True).alias("_listed")).distinct()
    small = listed.limit(LISTED + 1).count() <= LISTED
    df = df.join(F.broadcast(listed) if small else listed, ["_source", "_type"], "left")
    return df.where(F.when(F.col("_implicit"), F.col("_fits")).otherwise(F.coalesce("_listed", F.lit(False)))).drop("_source", "_type", "_implicit", "_fits", "_listed")


def synthetic_event(kind: Column, time: Column, course: Column, user: Column, payload: Column, reason: Column, after: Column | None = None, before: Column | None = None) -> Column:
    """Event text with the default envelope and a note of why it was made, and between which times."""
    nothing = F.lit(None).cast("string")
    return F.to_json(F.struct(
        F.lit("").alias("username"), F.lit("server").alias("event_source"), kind.alias("event_type"), kind.alias("name"), time.alias("time"), F.lit("").alias("host"), F.lit("").alias("ip"), F.lit("").alias("agent"), F.lit("").alias("page"),
        F.struct(course.alias("course_id"), org_of_course(course).alias("org_id"), F.lit("").alias("path"), user.alias("user_id")).alias("context"), payload.alias("event"),
        F.struct(reason.alias("reason"), F.lit("enrollment_validation").alias("synthesizer"), (nothing if after is None else after).alias("after_time"), (nothing if before is None else before).alias("before_time")).alias("synthesized"),
    ))


def validation_events(enrollments: DataFrame, dump_start: str, dump_end: str) -> DataFrame:
    """An event for each row of a snapshot (user_id, course_id, is_active, mode, created), saying what it held."""
    body = F.struct("course_id", "user_id", "mode", "is_active", F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created"), F.lit(dump_start).alias("dump_start"), F.lit(dump_end).alias("dump_end"))
    return enrollments.select(F.lit(dump_end).substr(1, 10).alias("date"), synthetic_event(F.lit("edx.course.enrollment.validated"), F.lit(dump_end), F.col("course_id"), F.col("user_id"), body, F.lit("found in snapshot")).alias("event"))
