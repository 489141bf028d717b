"""Enrollment histories: a state for each user and course, day by day, and the roll-ups of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Codes of the education level and their names.
EDUCATION = {
    "none": "none", "other": "other", "el": "primary", "jhs": "junior_secondary", "hs": "secondary", "a": "associates",
    "b": "bachelors", "m": "masters", "p": "doctorate", "p_se": "doctorate", "p_oth": "doctorate",
}
KEY = ("course_id", "user_id")


def with_state(events: DataFrame) -> DataFrame:
    """Add state (1 enrolled, 0 not) after each event and prior before it. Mode changes keep the state."""
    by = W.partitionBy(*KEY).orderBy("ts", "type", "mode", "event_id")
    said = F.when(F.col("type") == "activated", 1).when(F.col("type") == "deactivated", 0)
    df = events.withColumn("state", F.coalesce(F.last(said, ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, W.currentRow)), F.lit(0)))
    return df.withColumn("prior", F.coalesce(F.lag("state").over(by), F.lit(0)))


def enrollment_spans(events: DataFrame, end: str) -> DataFrame:
    """course_id, user_id, day, until, at_end, change, mode: a row for each state, from the day on which it began to its last.

    What joins learners joins these and only then makes days of them (``days_of``): a state lasts a month as a rule, so that
    the join moves far fewer rows than one of days.
    """
    by = W.partitionBy(*KEY).orderBy("ts", "type", "mode", "event_id")
    df = with_state(events.where(F.col("ts") < F.lit(end).cast("timestamp"))).withColumn("day", F.to_date("ts"))
    df = df.withColumn("after", F.lead("day").over(by)).where("after IS NULL OR after > day")
    days = W.partitionBy(*KEY).orderBy("day")
    df = df.select(
        *KEY, "day", "mode", F.col("state").alias("at_end"),
        (F.col("state") - F.coalesce(F.lag("state").over(days), F.lit(0))).alias("change"),
        F.date_sub(F.coalesce("after", F.lit(end).cast("date")), 1).alias("until"),
    )
    return df


def days_of(spans: DataFrame) -> DataFrame:
    """A row for each day of each state, with its columns; what has days already stays."""
    if "until" not in spans.columns:
        return spans
    df = spans.withColumn("date", F.explode(F.sequence("day", "until")))
    return df.withColumn("change", F.when(F.col("date") == F.col("day"), F.col("change")).otherwise(0)).drop("day", "until")


def days_enrolled(events: DataFrame, end: str) -> DataFrame:
    """date, course_id, user_id, at_end, change, mode: a row for each day from the first event to the day before end."""
    return days_of(enrollment_spans(events, end)).select("date", *KEY, "at_end", "change", "mode")


def enrollment_summary(events: DataFrame, end: str) -> DataFrame:
    """One row for each user and course that ever enrolled: first, last and current enrollment."""
    df = with_state(events.where(F.col("ts") < F.lit(end).cast("timestamp")))
    enrolls = (F.col("type") == "activated") & (F.col("prior") == 0)
    leaves = (F.col("type") == "deactivated") & (F.col("prior") == 1)
    counts = enrolls | ((F.col("type") == "mode_changed") & (F.col("prior") == 1))
    at = F.struct("ts", "type", "mode", "event_id")
    first = lambda when, value: F.min_by(F.when(when, F.col(value)), F.when(when, at))
    df = df.groupBy(*KEY).agg(
        F.max_by(F.when(counts, F.col("mode")), F.when(counts, at)).alias("current_enrollment_mode"),
        (F.max_by("state", at) == 1).alias("current_enrollment_is_active"),
        first(enrolls, "mode").alias("first_enrollment_mode"),
        F.min(F.when(enrolls, F.col("ts"))).alias("first_enrollment_time"),
        F.max(F.when(leaves, F.col("ts"))).alias("last_unenrollment_time"),
        F.min(F.when(counts & (F.col("mode") == "verified"), F.col("ts"))).alias("first_verified_enrollment_time"),
        F.min(F.when(counts & (F.col("mode") == "credit"), F.col("ts"))).alias("first_credit_enrollment_time"),
    )
    return df.where("first_enrollment_time IS NOT NULL")


def _sums() -> list[Column]:
    return [F.sum("at_end").cast("long").alias("count"), F.count("user_id").alias("cumulative_count")]


def enrollment_daily(days: DataFrame) -> DataFrame:
    return days.groupBy("course_id", "date").agg(*_sums())


def enrollment_by_mode(days: DataFrame) -> DataFrame:
    return days.groupBy("course_id", "date", "mode").agg(*_sums())


def enrollment_by_gender(days: DataFrame, profiles: DataFrame) -> DataFrame:
    """From days or, better, spans."""
    gender = F.nullif(F.col("gender"), F.lit(""))
    return days_of(days.join(profiles.select("user_id", gender.alias("gender")), "user_id", "left")).groupBy("course_id", "date", "gender").agg(*_sums())


def on_last_day(days: DataFrame, end: str) -> DataFrame:
    last = F.date_sub(F.lit(end).cast("date"), 1)
    if "until" in days.columns:
        return days.where(F.col("until") == last).withColumn("date", last)
    return days.where(F.col("date") == last)


def enrollment_by_birth_year(days: DataFrame, profiles: DataFrame, end: str) -> DataFrame:
    df = on_last_day(days, end).join(profiles.select("user_id", F.col("year_of_birth").alias("birth_year")), "user_id", "left")
    return df.groupBy("course_id", "date", "birth_year").agg(*_sums())


def enrollment_by_education(days: DataFrame, profiles: DataFrame, end: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in EDUCATION.items() for x in pair])
    level = F.try_element_at(names, F.col("level_of_education"))
    df = on_last_day(days, end).join(profiles.select("user_id", level.alias("education_level")), "user_id", "left")
    return df.groupBy("course_id", "date", "education_level").agg(*_sums())


def passing_by_mode(days: DataFrame, grades: DataFrame) -> DataFrame:
    """As-of join: each grade takes the mode of the closest enrollment day up to its change. grades: user_id, course_id,
    modified, letter_grade, passed_timestamp; of several grades the newest counts. One equality join; the inequality is a filter, and
    max_by keeps the closest day. Of spans, which don't overlap, the last that began by then holds the closest day."""
    date = "day" if "until" in days.columns else "date"
    g = grades.groupBy("user_id", "course_id").agg(
        F.max("modified").alias("modified"), F.max_by(F.struct("letter_grade", "passed_timestamp"), F.struct("modified", "letter_grade", F.coalesce(F.col("passed_timestamp").cast("timestamp"), F.timestamp_seconds(F.lit(0))))).alias("g")
    ).select("user_id", "course_id", "modified", "g.letter_grade", "g.passed_timestamp")
    near = g.join(days.select("user_id", "course_id", date, "mode"), ["user_id", "course_id"]).where(F.col(date) <= F.to_date("modified"))
    near = near.groupBy("user_id", "course_id", "letter_grade", "passed_timestamp").agg(F.max_by("mode", date).alias("mode"))
    passes = F.col("passed_timestamp").isNotNull() & (F.col("letter_grade") != "")
    return near.groupBy("course_id", "mode").agg(F.sum(F.when(passes, 1).otherwise(0)).cast("long").alias("passing_users"))


def course_meta_summary(by_mode: DataFrame, catalog: DataFrame, passing: DataFrame, end: str) -> DataFrame:
    """Counts by mode on the last day, their change in seven days, the catalog's facts and the passing users."""
    last = F.date_sub(F.lit(end).cast("date"), 1)
    now = by_mode.where(F.col("date") == last)
    week = by_mode.where(F.col("date") == F.date_sub(last, 7)).select("course_id", "mode", F.col("count").alias("before"))
    df = now.join(week, ["course_id", "mode"], "left").join(catalog, "course_id", "left").join(passing, ["course_id", "mode"], "left")
    return df.select(
        *catalog.columns, F.col("mode").alias("enrollment_mode"), "count", "cumulative_count",
        (F.col("count") - F.coalesce("before", F.lit(0))).alias("count_change_7_days"), F.coalesce("passing_users", F.lit(0)).alias("passing_users"),
    )


def program_metadata(program_courses: DataFrame) -> DataFrame:
    return program_courses.select("course_id", "program_id", "program_type", "program_title")
