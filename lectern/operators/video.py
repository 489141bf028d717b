"""Video viewings from play, pause, seek and stop events, and how videos are watched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN, SECONDS, SHORTEST, LONGEST_OFFSET, DROPOFF = -1.0, 5, 0.25, 36000.0, 0.05


def valid_offset(x: Column) -> Column:
    """The number if it is one in [0, 36000], else null."""
    x = x.try_cast("double")
    return F.when(~F.isnan(x) & x.between(0.0, LONGEST_OFFSET), x)


def clean_events(events: DataFrame) -> DataFrame:
    """Events with user, course and module, and the offsets that their type needs."""
    now, old = valid_offset(F.col("current_time")), valid_offset(F.col("old_time"))
    now = F.when((F.col("type") == "pause_video") & now.isNull(), 0.0).otherwise(now)
    duration = F.when(F.col("duration").isNull() | (F.col("duration") == 0), UNKNOWN).otherwise(F.col("duration"))
    df = events.withColumns({"current_time": now, "old_time": old, "duration": duration})
    named = F.col("user_id").isNotNull() & F.col("course_id").isNotNull() & F.col("module_id").isNotNull()
    return df.where(named & F.when(F.col("type") == "seek_video", F.col("old_time").isNotNull() & F.col("current_time").isNotNull()).otherwise(F.col("current_time").isNotNull()))


def video_viewings(events: DataFrame) -> DataFrame:
    """A viewing is a play whose next event isn't one. It starts where a seek before it led, if no play lies between."""
    by = W.partitionBy("user_id", "course_id", "module_id").orderBy("ts", "type", "current_time", "event_id")
    sofar = by.rowsBetween(W.unboundedPreceding, -1)
    play = F.col("type") == "play_video"
    df = events.withColumn("_before", F.lag("type").over(by)).withColumn("_plays", F.sum(play.cast("int")).over(by))
    # an event ends a viewing if it directly follows a play; only those count as ends
    ends = ~play & (F.col("_before") == "play_video")
    end = F.struct("type", "current_time", F.col("_plays").alias("plays"))
    df = df.withColumn("_end", F.last(F.when(ends, end), ignorenulls=True).over(sofar))
    df = df.withColumn("_next", F.lead(F.struct("type", "current_time", "old_time")).over(by))
    resumed = (F.col("_end.type") == "seek_video") & (F.col("_end.plays") == F.col("_plays") - 1)
    start = F.when(resumed, F.col("_end.current_time")).otherwise(F.col("current_time"))
    stop = F.when(F.col("_next.type") == "seek_video", F.col("_next.old_time")).otherwise(F.col("_next.current_time"))
    df = df.where(play & (F.col("_next.type") != "play_video")).withColumns({"start_offset": start, "end_offset": stop, "reason": F.col("_next.type")})
    good = ((F.col("duration") == UNKNOWN) | (F.col("end_offset") <= F.col("duration") + 1)) & (F.col("end_offset") - F.col("start_offset") >= SHORTEST)
    return df.where(good).select("user_id", "course_id", "module_id", F.col("duration").alias("video_duration"), F.col("ts").alias("start_timestamp"), "start_offset", "end_offset", "reason")


def viewings_by_date(viewings: DataFrame, start: str, end: str) -> DataFrame:
    date = F.to_date("start_timestamp")
    return viewings.withColumn("date", date).where((date >= F.lit(start).cast("date")) & (date < F.lit(end).cast("date")))


def segment(seconds: Column) -> Column:
    return F.floor(F.floor(seconds) / SECONDS).cast("int")


def video_usage(viewings: DataFrame, dropoff: float = DROPOFF) -> DataFrame:
    """Users and views of each watched five-second segment of a module, and who saw its start and its end."""
    key = ("course_id", "module_id")
    per = viewings.withColumn("segment", F.explode(F.sequence(segment(F.col("start_offset")), segment(F.col("end_offset")))))
    per = per.groupBy(*key, "segment").agg(F.countDistinct("user_id").alias("num_users"), F.count("*").alias("num_views"))
    by = W.partitionBy(*key).orderBy("segment")
    sharp = F.lead("num_users").over(by) <= F.col("num_users") * dropoff
    per = per.withColumn("_sharp", sharp)
    length = viewings.groupBy(*key).agg(F.when(F.min("video_duration") == UNKNOWN, UNKNOWN).otherwise(F.max("video_duration")).alias("known"))
    whole = per.groupBy(*key).agg(F.max(F.when(F.col("_sharp"), F.col("segment"))).alias("drop"), F.max("segment").alias("last")).join(length, [*key])
    unknown = F.col("known") == UNKNOWN
    final = F.coalesce("drop", "last")
    duration = F.when(unknown, (final + 1) * SECONDS - 1.0).otherwise(F.col("known"))
    whole = whole.select(*key, duration.alias("duration"), F.when(unknown, final).otherwise(segment(F.col("known"))).alias("final"), F.col("last"))
    df = per.join(whole, [*key])
    at_end = segment(F.greatest(F.col("duration") - 30, F.col("duration") * 0.95))
    all_ = W.partitionBy(*key)
    seen = lambda s: F.coalesce(F.max(F.when(F.col("segment") == s, F.col("num_users"))).over(all_), F.lit(0))
    df = df.withColumns({"users_at_start": seen(0), "users_at_end": seen(at_end), "_stops": F.max(F.col("segment") == F.col("final")).over(all_)})
    df = df.where(~F.col("_stops") | (F.col("segment") <= F.col("final")))
    return df.select(
        F.concat_ws("|", *key).alias("pipeline_video_id"), *key, F.floor("duration").cast("int").alias("duration"), F.lit(SECONDS).alias("segment_length"),
        "users_at_start", "users_at_end", "segment", "num_users", "num_views",
    )


def video_summary(usage: DataFrame) -> DataFrame:
    keys = ("pipeline_video_id", "course_id", "module_id", "duration", "segment_length", "users_at_start", "users_at_end")
    return usage.groupBy(*keys).agg((F.sum("num_views") * F.col("segment_length")).alias("total_viewed_seconds"))


def video_timeline(usage: DataFrame) -> DataFrame:
    return usage.select("pipeline_video_id", "segment", "num_users", "num_views")


def iso_duration(text: Column) -> Column:
    """Seconds of an ISO 8601 duration such as PT1H2M3S, null if it isn't one."""
    form = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?$"
    part = lambda i: F.coalesce(F.regexp_extract(text, form, i).try_cast("long"), F.lit(0))
    return F.when(text.rlike(form) & (text != "PT"), part(1) * 3600 + part(2) * 60 + part(3))


def known_durations(viewings: DataFrame, durations: DataFrame) -> DataFrame:
    """Viewings whose unknown duration is that of the video that their player named (youtube_id), where a catalog has it.

    durations: video_id, seconds; one row for each video.
    """
    listed = durations.where("seconds > 0").select(F.col("video_id").alias("youtube_id"), "seconds").dropDuplicates(["youtube_id"])
    df = viewings.join(listed, "youtube_id", "left")
    return df.withColumn("video_duration", F.when(F.col("video_duration") == UNKNOWN, F.coalesce(F.col("seconds").cast("double"), F.lit(UNKNOWN))).otherwise(F.col("video_duration"))).drop("seconds")
