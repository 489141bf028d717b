"""Deterministic views that give the star-schema tables the shapes of tracking events, snapshots and catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The month that the events table covers, closed-open, and the last week of it.
START, END = "2024-01-01", "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ts, user_id, kind, value, k, course_id, date."""
    k = F.get_json_object("props", "$.k").cast("long")
    df = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.col("event_type").alias("kind"), "value", k.alias("k"))
    c = (F.col("k") % 3).cast("string")
    return df.withColumn("course_id", F.concat(F.lit("course-v1:org"), c, F.lit("+c"), c, F.lit("+2024"))).withColumn("date", F.to_date("ts"))


def pick(col, **values):
    """A column that maps the names of values to their values, null for others."""
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(col == name, value if not isinstance(value, str) else F.lit(value)).otherwise(out)
    return out


def enrollment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """course_id, user_id, ts, type, mode, event_id."""
    kind = pick(F.col("kind"), signup="activated", error="deactivated", purchase="mode_changed")
    mode = F.element_at(F.array(*map(F.lit, ("honor", "verified", "credit"))), (F.col("event_id") % 3 + 1).cast("int"))
    df = events(spark, sf_dir).withColumn("type", kind).where(F.col("type").isNotNull())
    return df.select("course_id", "user_id", "ts", "type", mode.alias("mode"), "event_id")


def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """course_id, user_id, date, ts, source, type."""
    source = pick(F.col("kind"), view="browser", click="browser", purchase="server", signup="server", error="task")
    kind = pick(F.col("kind"), view="page_view", click="play_video", purchase="problem_check", signup="edx.course.enrollment.activated", error="problem_check")
    return events(spark, sf_dir).select("course_id", "user_id", "date", "ts", source.alias("source"), kind.alias("type"))


def video_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, course_id, module_id, ts, type, current_time, old_time, duration, event_id."""
    kind = pick(F.col("kind"), click="play_video", view="pause_video", error="stop_video", purchase="seek_video")
    df = events(spark, sf_dir).withColumn("type", kind).where(F.col("type").isNotNull())
    seek = F.col("kind") == "purchase"
    return df.select(
        "user_id", "course_id", F.concat(F.lit("v"), (F.col("k") % 3).cast("string")).alias("module_id"), "ts", "type",
        F.when(seek, F.col("value") / 2).otherwise(F.col("value")).alias("current_time"),
        F.when(seek, F.col("value")).alias("old_time"),
        F.when(F.col("event_id") % 5 == 0, F.lit(-1.0)).otherwise(F.lit(600.0)).alias("duration"),
        "event_id",
    )


def engagement_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """course_id, username, date, ts, source, type, entity_id, correct."""
    kind = pick(F.col("kind"), purchase="problem_check", click="play_video", signup="edx.forum.thread.created")
    df = events(spark, sf_dir).withColumn("type", kind).where(F.col("type").isNotNull())
    letter = F.substring(pick(F.col("kind"), purchase="p", click="v", signup="f"), 1, 1)
    return df.select(
        "course_id", F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"), "date", "ts", F.lit("server").alias("source"), "type",
        F.concat(letter, (F.col("k") % 20).cast("string")).alias("entity_id"), (F.col("event_id") % 2 == 0).alias("correct"),
    )


def ip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, course_id, date, ts, ip, event_id."""
    ip = F.concat_ws(".", F.lit("10"), (F.col("user_id") % 4).cast("string"), (F.col("k") % 256).cast("string"), (F.col("event_id") % 256).cast("string"))
    return events(spark, sf_dir).select("user_id", "course_id", "date", "ts", ip.alias("ip"), "event_id")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, username, name, gender, year_of_birth, level_of_education."""
    education = F.element_at(F.array(*map(F.lit, ("p", "m", "b", "a", "hs", "jhs", "el", "none", "other", "", "x"))), (F.col("c_custkey") % 11 + 1).cast("int"))
    gender = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "f").when(F.col("c_mktsegment") == "AUTOMOBILE", "m").otherwise("")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.concat(F.lit("user"), F.col("c_custkey").cast("string")).alias("username"), F.col("c_name").alias("name"),
        gender.alias("gender"), (1950 + F.col("c_custkey") % 50).cast("int").alias("year_of_birth"), education.alias("level_of_education"),
    )


#: The same views in DuckDB's SQL.
SQL = {
    "ev": """SELECT event_id, ts, user_id, event_type AS kind, value, CAST(props->>'$.k' AS BIGINT) AS k,
 'course-v1:org' || (k % 3) || '+c' || (k % 3) || '+2024' AS course_id, CAST(ts AS DATE) AS date FROM events""",
    "enr": """SELECT course_id, user_id, ts, CASE kind WHEN 'signup' THEN 'activated' WHEN 'error' THEN 'deactivated' ELSE 'mode_changed' END AS type,
 CASE event_id % 3 WHEN 0 THEN 'honor' WHEN 1 THEN 'verified' ELSE 'credit' END AS mode, event_id FROM ev WHERE kind IN ('signup', 'error', 'purchase')""",
    "act": """SELECT course_id, user_id, date, ts, CASE kind WHEN 'view' THEN 'browser' WHEN 'click' THEN 'browser' WHEN 'error' THEN 'task' ELSE 'server' END AS source,
 CASE kind WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'play_video' WHEN 'signup' THEN 'edx.course.enrollment.activated' ELSE 'problem_check' END AS type FROM ev""",
    "vid": """SELECT user_id, course_id, 'v' || (k % 3) AS module_id, ts, CASE kind WHEN 'click' THEN 'play_video' WHEN 'view' THEN 'pause_video' WHEN 'error' THEN 'stop_video' ELSE 'seek_video' END AS type,
 CASE WHEN kind = 'purchase' THEN value / 2 ELSE value END AS current_time_, CASE WHEN kind = 'purchase' THEN value END AS old_time, CASE WHEN event_id % 5 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(600 AS DOUBLE) END AS duration, event_id
 FROM ev WHERE kind IN ('click', 'view', 'error', 'purchase')""",
    "eng": """SELECT course_id, 'user' || user_id AS username, date, ts, CASE kind WHEN 'purchase' THEN 'problem_check' WHEN 'click' THEN 'play_video' ELSE 'edx.forum.thread.created' END AS type,
 CASE kind WHEN 'purchase' THEN 'p' WHEN 'click' THEN 'v' ELSE 'f' END || (k % 20) AS entity_id, event_id % 2 = 0 AS correct FROM ev WHERE kind IN ('purchase', 'click', 'signup')""",
    "ips": """SELECT user_id, course_id, date, ts, '10.' || (user_id % 4) || '.' || (k % 256) || '.' || (event_id % 256) AS ip, event_id FROM ev""",
    "usr": """SELECT c_custkey AS user_id, 'user' || c_custkey AS username, c_name AS name, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'f' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'm' ELSE '' END AS gender,
 CAST(1950 + c_custkey % 50 AS INTEGER) AS year_of_birth, ['p', 'm', 'b', 'a', 'hs', 'jhs', 'el', 'none', 'other', '', 'x'][CAST(c_custkey % 11 + 1 AS INTEGER)] AS level_of_education FROM customer""",
}


def with_views(*names: str, **more: str) -> str:
    """``WITH`` clause of the views, in order, and further named queries."""
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in [("ev", SQL["ev"]), *((n, SQL[n]) for n in names if n != "ev"), *more.items()])
