"""The result tables of the reports: their columns and keys, and publishing of several that all take their place or none."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.engagement import COUNTERS
from .sinks import checked, result_nulls


@dataclass(frozen=True)
class Result:
    """Columns in order, the columns that no two rows share, and those that a reader looks rows up by."""

    columns: tuple[str, ...]
    key: tuple[str, ...]
    lookup: tuple[str, ...] = ("course_id",)


def _daily(by: str | None = None) -> Result:
    key = ("course_id", "date", *([by] if by else []))
    return Result((*key, "count", "cumulative_count"), key)


def _engagement() -> Result:
    key = ("date", "course_id", "username")
    return Result((*key, *COUNTERS, "last_subsection_viewed"), key, ("course_id", "date"))


RESULTS = {
    "course_enrollment_daily": _daily(),
    "course_enrollment_gender_daily": _daily("gender"),
    "course_enrollment_birth_year_daily": _daily("birth_year"),
    "course_enrollment_education_level_daily": _daily("education_level"),
    "course_enrollment_mode_daily": _daily("mode"),
    "course_enrollment_location_current": _daily("country_code"),
    "course_meta_summary_enrollment": Result(("course_id", "catalog_course_title", "enrollment_mode", "count", "cumulative_count", "count_change_7_days", "passing_users"), ("course_id", "enrollment_mode")),
    "course_program_metadata": Result(("course_id", "program_id", "program_type", "program_title"), ("course_id", "program_id")),
    "course_activity": Result(("course_id", "interval_start", "interval_end", "label", "count"), ("course_id", "interval_start", "label")),
    "video": Result(("pipeline_video_id", "course_id", "module_id", "duration", "segment_length", "users_at_start", "users_at_end", "total_viewed_seconds"), ("pipeline_video_id",)),
    "video_timeline": Result(("pipeline_video_id", "segment", "num_users", "num_views"), ("pipeline_video_id", "segment"), ("pipeline_video_id",)),
    "module_engagement": Result(("course_id", "username", "date", "entity_type", "entity_id", "action", "count"), ("course_id", "username", "date", "entity_type", "entity_id", "action"), ("course_id", "username")),
    "module_engagement_metric_ranges": Result(("course_id", "start_date", "end_date", "metric", "range_type", "low_value", "high_value"), ("course_id", "metric", "range_type")),
    "answer_distribution": Result(("course_id", "problem_id", "answer_id", "value", "variant", "correct", "question", "first_count", "last_count"), ("course_id", "answer_id", "value", "variant"), ("problem_id",)),
    "tags_distribution": Result(("course_id", "problem_id", "total_submissions", "correct_submissions", "tag_name", "tag_value"), ("course_id", "problem_id", "tag_name", "tag_value")),
    "grade_distribution": Result(("course_id", "module_id", "grade", "max_grade", "count"), ("course_id", "module_id", "grade", "max_grade"), ("module_id",)),
    "sequential_open_distribution": Result(("course_id", "module_id", "count"), ("course_id", "module_id"), ("module_id",)),
    "student_engagement_daily": _engagement(),
    "student_engagement_weekly": _engagement(),
    "student_engagement_all": _engagement(),
    "enterprise_user": Result(("enterprise_id", "enterprise_name", "user_id", "user_sso_id", "username", "last_activity_date"), ("enterprise_id", "user_id"), ("enterprise_id",)),
    "enterprise_enrollment": Result(
        ("enterprise_id", "enterprise_name", "user_id", "username", "user_sso_id", "course_id", "course_title", "course_duration_weeks", "user_current_enrollment_mode", "is_active", "enrollment_created", "has_passed", "last_activity_date", "course_price", "discount_price", "offer"),
        ("enterprise_id", "user_id", "course_id"), ("enterprise_id",),
    ),
}


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def publish(results: dict[str, DataFrame], root: str, allow_empty: tuple[str, ...] = ()) -> None:
    """Replace the tables below the root by these results, by name.

    Each is brought to its declared columns, written beside the old ones, in order of what it is looked up by, and checked as written: rows at all, no key twice.
    Only when all have passed do they take their place; if one can't, those that did give theirs back.
    """
    if unknown := sorted(set(results) - set(RESULTS)):
        raise ValueError(f"no such results: {', '.join(unknown)}")
    if not results:
        return
    spark = next(iter(results.values())).sparkSession
    fs, path = _fs(spark, root)
    stage = f"{root}/_staged-{uuid.uuid4().hex}"
    try:
        for name, df in results.items():
            spec = RESULTS[name]
            if lacks := [c for c in spec.columns if c not in df.columns]:
                raise ValueError(f"{name} lacks {', '.join(lacks)}")
            ready = result_nulls(df.select(*spec.columns)).sortWithinPartitions(*spec.lookup)
            ready.write.parquet(f"{stage}/new/{name}")
            checked(spark.read.schema(ready.schema).parquet(f"{stage}/new/{name}"), name in allow_empty, list(spec.key))
        moved: list[tuple[str, str]] = []

        def move(here: str, there: str) -> None:
            fs.mkdirs(path(there).getParent())
            if not fs.rename(path(here), path(there)):
                raise OSError(f"can't move {here} to {there}")
            moved.append((here, there))

        try:
            for name in results:
                if fs.exists(path(f"{root}/{name}")):
                    move(f"{root}/{name}", f"{stage}/old/{name}")
                move(f"{stage}/new/{name}", f"{root}/{name}")
        except BaseException:
            for here, there in reversed(moved):
                fs.rename(path(there), path(here))
            raise
    finally:
        fs.delete(path(stage), True)


def read_result(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}").select(*RESULTS[name].columns)
