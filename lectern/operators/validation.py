"""Enrollment validation: which events must be missing, told from what comes before and after them.

A validation says whether a learner was enrolled when a snapshot was dumped. An event is set beside the next one that
says whether the learner is enrolled, beside the next one of any kind for the mode, and, if it is the first of all, beside
the time at which the oldest validation says that the enrollment was created. What has to be known of later events is
so little that windows on one partitioning carry it; a history of any length streams through them and is never held.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import normalize_course_id
from ..functions.text import datestamp, event_time, once
from ..sources.readers import parse_lines
from . import events as X

KEY = ("course_id", "user_id")
PREFIX = "edx.course.enrollment."


def validation_history(decoded: DataFrame) -> DataFrame:
    """course_id, user_id, ts, type, mode, is_active, created, dump_start, dump_end of enrollment events and validations among decoded events."""
    get = lambda p, k="string": F.try_variant_get("payload", f"$.{p}", k)
    dumped = get("dump_start").isNotNull()
    of_dump = {c: F.when(dumped, event_time(get(c))) for c in ("created", "dump_start", "dump_end")}
    df = once(decoded.where(F.col("type").isin(*(PREFIX + t for t in ("activated", "deactivated", "mode_changed", "validated")))).select(
        normalize_course_id(get("course_id")).alias("course_id"), get("user_id").try_cast("long").alias("user_id"), event_time(F.col("time")).alias("ts"), F.replace("type", F.lit(PREFIX), F.lit("")).alias("type"), get("mode").alias("mode"),
        F.when(dumped, get("is_active", "boolean")).alias("is_active"), *[c.alias(n) for n, c in of_dump.items()],
    ))
    return df.dropna(subset=["course_id", "user_id", "ts", "mode"])


def expect_validation(events: DataFrame, expected: str) -> DataFrame:
    """Add a mark of type missing where the newest event of a learner is before the expected validation."""
    newest = events.groupBy(*KEY).agg(F.max("ts").alias("ts")).where(F.col("ts") < F.lit(expected).cast("timestamp"))
    marks = newest.select(*KEY, F.lit(expected).cast("timestamp").alias("ts"), F.lit("missing").alias("type"))
    return events.unionByName(marks, allowMissingColumns=True)


def reordered_in_dumps(events: DataFrame) -> DataFrame:
    """Validations move before the events that happened while their snapshot was dumped and that contradict them.

    events: those of a history, with dump_start and dump_end of validations. Of the events just before a validation, the
    run up to the first that lies outside the dump or agrees with it counts; the validation goes a microsecond before
    the earliest of the run. A validation and what lies between it and the one before form a group: two windows.
    """
    newest = W.partitionBy(*KEY).orderBy(F.col("ts").desc(), (F.col("type") == "validated").desc(), F.col("mode"))
    seen = F.col("type") == "validated"
    df = events.withColumn("_group", F.count(F.when(seen, 1)).over(newest))
    group = W.partitionBy(*KEY, "_group").orderBy(F.col("ts").desc(), seen.desc(), F.col("mode"))
    v = F.first(F.struct("type", "ts", "is_active", "mode", "dump_start", "dump_end")).over(group)
    df = df.withColumn("_v", v)
    inside = (F.col("_v.type") == "validated") & (F.col("ts") > F.col("_v.dump_start")) & (F.col("ts") < F.col("_v.dump_end"))
    active = F.coalesce("_v.is_active", F.lit(False))
    against = (active & (F.col("type") == "deactivated")) | (~active & (F.col("type") == "activated")) | ((F.col("type") == "mode_changed") & ~F.col("mode").eqNullSafe(F.col("_v.mode")))
    bad = F.coalesce(inside & against, F.lit(False))
    run = ~seen & (F.sum((~seen & ~bad).cast("int")).over(group) == 0)
    df = df.withColumn("_run", run)
    first = F.min(F.when(F.col("_run"), F.col("ts"))).over(W.partitionBy(*KEY, "_group"))
    moved = F.when(seen & first.isNotNull(), first - F.expr("INTERVAL 1 MICROSECOND")).otherwise(F.col("ts"))
    return df.withColumn("_ts", moved).withColumn("ts", F.col("_ts")).drop("_group", "_v", "_run", "_ts")


def _state(kind: Column, active: Column) -> Column:
    name = F.when(kind == "mode_changed", "mode_change").otherwise(F.regexp_replace(kind, "ated$", "ate"))
    return F.when(kind == "validated", F.when(F.coalesce(active, F.lit(False)), "validate(active)").otherwise("validate(inactive)")).otherwise(name)


def _moment(time: Column, microseconds: int) -> Column:
    return time + F.expr(f"INTERVAL {microseconds} MICROSECOND")


def _made(ts: Column, kind: Column | str, mode: Column, reason: Column, after: Column, before: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(ts.alias("ts"), kind.alias("type"), mode.alias("mode"), reason.alias("reason"), after.cast("timestamp").alias("after_time"), before.alias("before_time"))


def missing_enrollment_events(events: DataFrame, start: str, nonstate: bool = False, before_start: bool = False, earliest: str | None = None) -> DataFrame:
    """course_id, user_id, ts, type, mode, reason, after_time, before_time of each event that is missing.

    events: course_id, user_id, ts, type (activated, deactivated, mode_changed, validated, missing), mode, is_active and
    created (of validations). nonstate: also where two events that agree follow each other. before_start: also before
    the interval. earliest: the least time of an event at the beginning.

    A missing change of state goes a microsecond after the event that it follows. A missing change of mode goes a
    microsecond after the same event, or after the change of state that was found there.
    """
    w = W.partitionBy(*KEY).orderBy(F.col("ts").desc(), F.col("type").desc(), F.col("mode").desc())
    newer, so_far = w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(W.unboundedPreceding, W.currentRow)
    facts = F.struct("ts", "type", "mode", F.coalesce("is_active", F.lit(False)).alias("is_active"))
    states = F.when(F.col("type") != "mode_changed", facts)
    df = events.withColumns({
        "_now": facts, "_after": F.last(states, ignorenulls=True).over(newer), "_next": F.lag(facts).over(w), "_first": F.last(states, ignorenulls=True).over(so_far),
        "_created": F.last(F.when(F.col("type") == "validated", F.struct("created")), ignorenulls=True).over(so_far), "_oldest": F.lead(F.lit(1)).over(w).isNull(),
    })
    is_ = lambda c, kind, active=None: (F.col(f"{c}.type") == kind) if active is None else (F.col(f"{c}.type") == kind) & (F.col(f"{c}.is_active") == F.lit(active))
    extra = F.lit(nonstate)
    off = (is_("_now", "activated") & (is_("_after", "missing") | is_("_after", "validated", False) | (extra & is_("_after", "activated")))) | (
        is_("_now", "validated", True) & (is_("_after", "validated", False) | (extra & is_("_after", "activated")))
    ) | (extra & is_("_now", "deactivated") & is_("_after", "missing"))
    on = (is_("_now", "deactivated") & (is_("_after", "validated", True) | (extra & is_("_after", "deactivated")))) | (
        is_("_now", "validated", False) & (is_("_after", "validated", True) | (extra & is_("_after", "deactivated")))
    )
    said = lambda c: _state(F.col(f"{c}.type"), F.col(f"{c}.is_active"))
    found = F.when(off, "deactivated").when(on, "activated")
    change = F.when(found.isNotNull(), _made(_moment(F.col("ts"), 1), found, F.col("mode"), F.concat_ws(" => ", said("_now"), said("_after")), F.col("ts"), F.col("_after.ts")))

    told = F.coalesce(F.col("_next.mode") != "", F.lit(False)) & ~F.col("_next.type").isin("missing", "mode_changed", "activated") & ~F.col("mode").eqNullSafe(F.col("_next.mode"))
    last = F.when(found.isNotNull(), _moment(F.col("ts"), 1)).otherwise(F.col("ts"))
    modes = F.concat(F.lit(" ("), F.coalesce("mode", F.lit("")), F.lit("=>"), F.col("_next.mode"), F.lit(")"))
    mode = F.when(told, _made(_moment(last, 1), "mode_changed", F.col("_next.mode"), F.concat(said("_now"), F.lit(" => "), said("_next"), modes), last, F.col("_next.ts")))

    created, state = F.col("_created.created"), F.concat(F.lit("start => "), said("_first"))
    within = created.isNotNull() & (F.lit(before_start) | (created >= F.lit(start).cast("timestamp")))
    at = F.greatest(created, F.lit(earliest).cast("timestamp")) if earliest else created
    head = lambda ts, kind, after=created: _made(ts, kind, F.col("mode"), state, after, F.col("_first.ts"))
    unknown = F.lit(None).cast("timestamp")
    begun = F.when(is_("_first", "deactivated") & within, F.array(head(at, "activated")))
    begun = begun.when(is_("_first", "deactivated") & F.lit(before_start), F.array(head(_moment(F.col("_first.ts"), -1), "activated", unknown)))
    begun = begun.when(is_("_first", "validated", True) & within, F.array(head(at, "activated")))
    begun = begun.when(is_("_first", "validated", False) & within & extra, F.array(head(at, "activated"), head(_moment(at, 1), "deactivated")))
    # In a step of its own: what stands below a filter of a list isn't compiled.
    df = once(df.select(*KEY, change.alias("_change"), mode.alias("_mode"), F.when(F.col("_oldest"), begun).alias("_begun")))
    made = F.concat(F.array("_change", "_mode"), F.coalesce("_begun", F.array()))
    return df.select(*KEY, F.explode(F.array_compact(made)).alias("_made")).select(*KEY, "_made.*")


def iso(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def synthetic_events(missing: DataFrame) -> DataFrame:
    """date and text of the events that stand for missing ones."""
    body = F.struct("course_id", "user_id", "mode")
    text = X.synthetic_event(F.concat(F.lit(PREFIX), "type"), iso(F.col("ts")), F.col("course_id"), F.col("user_id"), body, F.col("reason"), iso(F.col("after_time")), iso(F.col("before_time")))
    return missing.select(F.to_date("ts").alias("date"), text.alias("event"))


def dump_events(dumps: DataFrame) -> DataFrame:
    """Validation events of snapshots of any number of days: user_id, course_id, is_active, mode, created, dump_start, dump_end."""
    body = F.struct("course_id", "user_id", "mode", "is_active", *[iso(F.col(c)).alias(c) for c in ("created", "dump_start", "dump_end")])
    text = X.synthetic_event(F.lit(f"{PREFIX}validated"), iso(F.col("dump_end")), F.col("course_id"), F.col("user_id"), body, F.lit("found in snapshot"))
    return dumps.select(F.to_date("dump_end").alias("date"), text.alias("event"))


def validate_enrollments(lines: DataFrame, dumps: DataFrame, start: str, end: str, expected: str | None = None, **options) -> DataFrame:
    """date and text of the events that an interval's log lines (value) and snapshots show to be missing.

    Snapshots become validation events beside the logged ones, validations move before what happened during their dump,
    learners without an expected one are marked, and what is missing becomes events of their own.
    """
    of_dumps = dump_events(dumps).where((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") <= F.lit(end).cast("date"))).select(F.col("event").alias("value"))
    enrollment = lines.select("value").where(F.col("value").contains(PREFIX))  # told by the text before any parsing
    decoded = X.decoded(parse_lines(enrollment.unionByName(of_dumps)))
    history = validation_history(decoded.where((datestamp(F.col("time")) >= start) & (datestamp(F.col("time")) <= end)))
    history = reordered_in_dumps(history)
    if expected:
        history = expect_validation(history, expected)
    return synthetic_events(missing_enrollment_events(history, start, **options))
