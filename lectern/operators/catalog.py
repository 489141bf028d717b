"""Catalog datasets from course runs and programs with nested seats, subjects and courses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = ("course_id", "catalog_course", "catalog_course_title", "start_time", "end_time", "enrollment_start_time", "enrollment_end_time", "content_language", "pacing_type", "level_type", "availability")


def catalog_courses(runs: DataFrame) -> DataFrame:
    return runs.select(*[c for c in RUN if c in runs.columns])


def catalog_seats(runs: DataFrame) -> DataFrame:
    return runs.select("course_id", F.explode("seats").alias("s")).select("course_id", F.col("s.type").alias("course_seat_type"), F.col("s.price").alias("course_seat_price"), F.col("s.currency").alias("course_seat_currency"))


def catalog_subjects(courses: DataFrame, root: str) -> DataFrame:
    df = courses.select(F.explode("course_runs").alias("r"), "subjects").select(F.col("r.key").alias("course_id"), F.explode("subjects").alias("s"))
    return df.select("course_id", F.concat(F.lit(root), F.col("s.slug")).alias("subject_uri"), F.col("s.name").alias("subject_title"))


def program_courses(runs: DataFrame) -> DataFrame:
    df = runs.select("course_id", "catalog_course", F.explode("programs").alias("p"))
    return df.select("course_id", "catalog_course", F.col("p.uuid").alias("program_id"), F.col("p.type").alias("program_type"), F.col("p.title").alias("program_title"))


def program_course_order(programs: DataFrame) -> DataFrame:
    df = programs.select(F.col("uuid").alias("program_id"), F.posexplode("courses").alias("at", "c"))
    return df.select("program_id", F.col("c.key").alias("catalog_course"), (F.col("at") + 1).alias("program_slot_number"))


def program_courses_with_order(courses: DataFrame, order: DataFrame) -> DataFrame:
    return courses.join(order, ["program_id", "catalog_course"], "left")
