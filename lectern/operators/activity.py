"""Learner activity by day and week, event totals, the calendar, and where learners are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .enrollment import days_of

ENROLLMENT = ("edx.course.enrollment.activated", "edx.course.enrollment.deactivated", "edx.course.enrollment.mode_changed")


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """A row for each day from start to the day before end."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))).alias("date"))
    week = F.date_trunc("week", "date").cast("date")
    iso = F.concat(F.date_format(F.date_add(week, 3), "yyyy"), F.lit("W"), F.lpad(F.weekofyear("date").cast("string"), 2, "0"))
    return days.select(
        "date", F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"), iso.alias("iso_week"),
        week.alias("iso_week_start"), F.date_add(week, 7).alias("iso_week_end"), (F.weekday("date") + 1).alias("iso_weekday"),
    )


def activity_labels(source: Column, kind: Column) -> Column:
    """Labels of an event: none for tasks and enrollment, else ACTIVE and what it was."""
    server = source == "server"
    labels = F.array(
        F.lit("ACTIVE"),
        F.when(server & (kind == "problem_check"), "ATTEMPTED_PROBLEM"),
        F.when(server & kind.startswith("edx.forum.") & kind.endswith(".created"), "POSTED_FORUM"),
        F.when(source.isin("browser", "mobile") & (kind == "play_video"), "PLAYED_VIDEO"),
    )
    counts = kind.isNotNull() & (source != "task") & ~kind.isin(*ENROLLMENT)
    return F.when(counts, F.array_compact(labels)).otherwise(F.array().cast("array<string>"))


def user_activity(events: DataFrame) -> DataFrame:
    """How many events of each label a user has in a course and on a day."""
    df = events.select("user_id", "course_id", "date", F.explode(activity_labels(F.col("source"), F.col("type"))).alias("category"))
    return df.groupBy("user_id", "course_id", "date", "category").agg(F.count("*").alias("count"))


def course_activity_weekly(activity: DataFrame, days: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct users by course, whole ISO week within the interval, and label."""
    whole = (F.col("iso_week_start") >= F.lit(start).cast("date")) & (F.col("iso_week_end") <= F.lit(end).cast("date"))
    df = activity.join(F.broadcast(days.where(whole)), "date")  # a row for each day of the interval
    return df.groupBy("course_id", F.col("iso_week_start").alias("interval_start"), F.col("iso_week_end").alias("interval_end"), F.col("category").alias("label")).agg(
        F.countDistinct("user_id").alias("count")
    )


def total_events_daily(events: DataFrame) -> DataFrame:
    return events.groupBy("date").agg(F.count("*").alias("event_count"))


def total_events_report(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.desc("date"))


def last_daily_ip(events: DataFrame) -> DataFrame:
    """The address of the latest event of each user in a course on a day."""
    return events.groupBy("date", "user_id", "course_id").agg(F.max_by("ip", F.struct("ts", "event_id")).alias("ip"), F.max("ts").alias("ts"), F.max(F.struct("ts", "event_id"))["event_id"].alias("event_id"))


def ip_number(ip: Column) -> Column:
    """IPv4 address as a number, null if it isn't one."""
    parts = F.split(ip, r"\.")
    octet = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("long")
    return F.when(F.size(parts) == 4, octet(1) * 16777216 + octet(2) * 65536 + octet(3) * 256 + octet(4))


def locate(df: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Range join with address ranges (lo, hi, country_code, country_name), UNKNOWN where none holds the address.

    Ranges are spread over the 65,536 blocks of 65,536 addresses that they touch, so the join is an equality on the
    block and a filter. Ranges do not overlap, so an address meets one row at most.
    """
    spread = ranges.withColumn("_block", F.explode(F.sequence(F.expr("lo div 65536"), F.expr("hi div 65536")))).withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
    df = df.withColumn("_ip", ip_number(F.col(ip)))
    df = df.withColumn("_b", F.coalesce(F.expr("_ip div 65536"), -1 - F.pmod(F.xxhash64(ip), F.lit(4096))))  # others spread, as blocks that no range has
    found = df.join(spread, (F.col("_b") == F.col("_block")) & (F.col("_ip") >= F.col("_lo")) & (F.col("_ip") <= F.col("_hi")), "left")
    unknown = {c: F.coalesce(c, F.lit("UNKNOWN")) for c in ("country_code", "country_name")}
    return found.withColumns(unknown).drop("_ip", "_b", "_block", "_lo", "_hi")


def last_country(daily: DataFrame, ranges: DataFrame) -> DataFrame:
    newest = daily.groupBy("user_id").agg(F.max_by("ip", F.struct("ts", "event_id")).alias("ip"))
    return locate(newest, ranges).select("user_id", "country_code", "country_name")


def country_per_course(days: DataFrame, country: DataFrame) -> DataFrame:
    """From days or, better, spans of enrollment."""
    df = days_of(days.join(country, "user_id", "left"))
    return df.groupBy("date", "course_id", "country_code").agg(F.sum("at_end").cast("long").alias("count"), F.count("user_id").alias("cumulative_count"))
