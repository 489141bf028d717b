"""Registered video queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import video as V
from ..sources.adapter import END, table, video_events, with_views


def _viewings(spark, d):
    return V.video_viewings(V.clean_events(video_events(spark, d)))


def _usage(spark, d):
    return V.video_usage(_viewings(spark, d))


def _durations(spark, d):
    p = table(spark, d, "part")
    h, m, s = F.col("p_size") % 3, F.col("p_size") % 60, F.col("p_partkey") % 60
    text = F.concat(F.lit("PT"), F.when(h > 0, F.concat(h.cast("string"), F.lit("H"))).otherwise(""), m.cast("string"), F.lit("M"), s.cast("string"), F.lit("S"))
    return p.select(F.col("p_partkey").alias("video_id"), V.iso_duration(text).alias("seconds"))


def _known(spark, d):
    """Viewings of unknown length take the length that the catalog has of their video; some have none there."""
    code = F.concat(F.lit("yt"), (F.col("user_id") % 40).cast("string"))
    p = table(spark, d, "part").select(F.concat(F.lit("yt"), F.col("p_partkey").cast("string")).alias("video_id"), F.concat(F.lit("PT"), F.col("p_size").cast("string"), F.lit("M")).alias("text"))
    durations = p.select("video_id", V.iso_duration(F.col("text")).alias("seconds"))
    return V.known_durations(_viewings(spark, d).withColumn("youtube_id", code), durations).select("user_id", "module_id", "start_timestamp", "youtube_id", "video_duration")


QUERIES = {
    "known_video_durations": _known,
    "video_viewings": _viewings,
    "viewings_by_date": lambda s, d: V.viewings_by_date(_viewings(s, d), "2024-01-08", "2024-01-22"),
    "video_usage": _usage,
    "video_summary": lambda s, d: V.video_summary(_usage(s, d)),
    "video_timeline": lambda s, d: V.video_timeline(_usage(s, d)),
    "video_iso_durations": _durations,
}

_N = "SELECT *, lag(type) OVER w AS before, sum(CASE WHEN type = 'play_video' THEN 1 ELSE 0 END) OVER w AS plays, lead({'t': type, 'c': current_time_, 'o': old_time}) OVER w AS nxt FROM vid WINDOW w AS (PARTITION BY user_id, course_id, module_id ORDER BY ts, type, current_time_, event_id)"
_E = """SELECT *, last_value(CASE WHEN type <> 'play_video' AND before = 'play_video' THEN {'t': type, 'c': current_time_, 'p': plays} END IGNORE NULLS)
 OVER (PARTITION BY user_id, course_id, module_id ORDER BY ts, type, current_time_, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM n"""
_V = """SELECT * FROM (SELECT user_id, course_id, module_id, duration AS video_duration, ts AS start_timestamp, CASE WHEN e.t = 'seek_video' AND e.p = plays - 1 THEN e.c ELSE current_time_ END AS start_offset,
 CASE WHEN nxt.t = 'seek_video' THEN nxt.o ELSE nxt.c END AS end_offset, nxt.t AS reason FROM e WHERE type = 'play_video' AND nxt.t <> 'play_video')
 WHERE (video_duration = -1 OR end_offset <= video_duration + 1) AND end_offset - start_offset >= 0.25"""
_P = "SELECT course_id, module_id, segment, count(DISTINCT user_id) AS num_users, count(*) AS num_views FROM (SELECT *, unnest(range(CAST(floor(start_offset) AS BIGINT) // 5, CAST(floor(end_offset) AS BIGINT) // 5 + 1)) AS segment FROM v) GROUP BY ALL"
_W = """SELECT course_id, module_id, max(segment) FILTER (nu <= num_users * 0.05) AS dp, max(segment) AS lst FROM (SELECT *, lead(num_users) OVER (PARTITION BY course_id, module_id ORDER BY segment) AS nu FROM p) GROUP BY ALL"""
_L = "SELECT course_id, module_id, CASE WHEN min(video_duration) = -1 THEN -1 ELSE max(video_duration) END AS known FROM v GROUP BY ALL"
_F = """SELECT w.course_id, w.module_id, CASE WHEN known = -1 THEN (coalesce(dp, lst) + 1) * 5 - 1.0 ELSE known END AS duration, CASE WHEN known = -1 THEN coalesce(dp, lst) ELSE CAST(floor(known) AS BIGINT) // 5 END AS fin
 FROM w JOIN l ON w.course_id = l.course_id AND w.module_id = l.module_id"""
_U = """SELECT * EXCLUDE (stops, fin) FROM (SELECT p.course_id || '|' || p.module_id AS pipeline_video_id, p.course_id, p.module_id, CAST(floor(duration) AS INTEGER) AS duration, 5 AS segment_length,
 coalesce(max(CASE WHEN segment = 0 THEN num_users END) OVER k, 0) AS users_at_start,
 coalesce(max(CASE WHEN segment = CAST(floor(greatest(duration - 30, duration * 0.95)) AS BIGINT) // 5 THEN num_users END) OVER k, 0) AS users_at_end,
 CAST(segment AS INTEGER) AS segment, num_users, num_views, bool_or(segment = fin) OVER k AS stops, fin FROM p JOIN f ON p.course_id = f.course_id AND p.module_id = f.module_id WINDOW k AS (PARTITION BY p.course_id, p.module_id))
 WHERE NOT stops OR segment <= fin"""
_VIEWS = with_views("vid", n=_N, e=_E, v=_V)
_USAGE = with_views("vid", n=_N, e=_E, v=_V, p=_P, w=_W, l=_L, f=_F, u=_U)

ORACLES = {
    "video_viewings": _VIEWS + " SELECT * FROM v",
    "known_video_durations": _VIEWS + " SELECT user_id, module_id, start_timestamp, 'yt' || (user_id % 40) AS youtube_id, CASE WHEN video_duration = -1 THEN coalesce(CASE WHEN p_size > 0 THEN CAST(p_size * 60 AS DOUBLE) END, -1) ELSE video_duration END AS video_duration FROM v LEFT JOIN part ON p_partkey = user_id % 40",
    "viewings_by_date": _VIEWS + " SELECT *, CAST(start_timestamp AS DATE) AS date FROM v WHERE date >= DATE '2024-01-08' AND date < DATE '2024-01-22'",
    "video_usage": _USAGE + " SELECT * FROM u",
    "video_summary": _USAGE + " SELECT * EXCLUDE (segment, num_users, num_views), CAST(sum(num_views) * any_value(segment_length) AS BIGINT) AS total_viewed_seconds FROM u GROUP BY ALL",
    "video_timeline": _USAGE + " SELECT pipeline_video_id, segment, num_users, num_views FROM u",
    "video_iso_durations": "SELECT p_partkey AS video_id, CAST(p_size % 3 * 3600 + p_size % 60 * 60 + p_partkey % 60 AS BIGINT) AS seconds FROM part",
}
DATES = {"viewings_by_date": ["date"]}
