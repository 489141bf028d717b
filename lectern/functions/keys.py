"""Course and organisation ids: new ``course-v1:org+course+run`` and legacy ``org/course/run``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = r"[\w\-~.:]+"
NEW, LEGACY = rf"^course-v1:({PART})\+{PART}\+{PART}\z", rf"^({PART})/{PART}/{PART}\z"


def valid_course_id(course: Column) -> Column:
    return F.coalesce(course.rlike(NEW) | course.rlike(LEGACY), F.lit(False))


def normalize_course_id(course: Column) -> Column:
    return F.when(valid_course_id(F.trim(course)), F.trim(course))


def valid_org_id(org: Column) -> Column:
    return F.coalesce(org.rlike(r"^[\w\-~.]+\z"), F.lit(False))


def org_of_course(course: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(course, NEW, 1), F.lit("")), F.nullif(F.regexp_extract(course, LEGACY, 1), F.lit("")))


def filename_safe(course: Column, char: str = "_") -> Column:
    return F.regexp_replace(F.regexp_replace(course, r"^[a-z0-9\-]+:", ""), r"[^\w.\-]", char)


def course_key_from_url(url: Column) -> Column:
    """The course of a block address, else of a course address."""
    block = F.regexp_extract(url, rf"/xblock/block-v1:({PART}\+{PART}\+{PART})\+type@", 1)
    new = F.regexp_extract(url, rf"/courses/(course-v1:{PART}\+{PART}\+{PART})(?:[/?#]|\z)", 1)
    old = F.regexp_extract(url, rf"/courses/(?!v\d+/)({PART}/{PART}/{PART})(?:[/?#]|\z)", 1)
    return F.when(block != "", F.concat(F.lit("course-v1:"), block)).when(new != "", new).when(old != "", old)
