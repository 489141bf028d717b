"""Sinks: partitions, result tables, one file for each key, and exports."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partition(df: DataFrame, path: str, partition: str = "dt", mode: str = "overwrite") -> None:
    """Replace the partitions that the rows belong to, or append to them; other partitions stay."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def create_table(df: DataFrame, name: str, partition: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)


def recover_partitions(spark: SparkSession, name: str) -> None:
    spark.catalog.recoverPartitions(name)


def result_nulls(df: DataFrame) -> DataFrame:
    """The marks None and \\N, NaN and infinite numbers become null."""

    def clean(c: str, kind: str) -> Column:
        if kind in ("double", "float"):
            return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c))
        return F.when(~F.col(c).isin("None", "\\N"), F.col(c)) if kind == "string" else F.col(c)

    return df.select(*[clean(c, kind).alias(c) for c, kind in df.dtypes])


def checked(df: DataFrame, allow_empty: bool = False, key: list[str] | None = None) -> DataFrame:
    """The rows, refused if there are none or if two share a key."""
    if not allow_empty and df.isEmpty():
        raise ValueError("no rows to write")
    if key and not df.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"rows share a key of {key}")
    return df


def replace_result(df: DataFrame, path: str, allow_empty: bool = False, key: list[str] | None = None) -> None:
    checked(result_nulls(df), allow_empty, key).write.mode("overwrite").parquet(path)


def replace_by_swap(df: DataFrame, path: str) -> None:
    """Write beside the old rows, move these away, take their place, then delete them; what fails leaves the old rows."""
    spark = df.sparkSession
    checked(df).write.mode("overwrite").parquet(f"{path}.new")
    at, new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new", f"{path}.old"))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"can't move {path} away")
    if not fs.rename(new, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"can't move {path}.new to {path}")
    fs.delete(old, True)


def replace_slice(df: DataFrame, path: str, by: str = "date") -> None:
    write_partition(df, path, by)


def one_file_per_key(df: DataFrame, keys: list[str], path: str, kind: str = "csv", sort: list | None = None, **options) -> None:
    """All rows of a key in one file of its folder, as these formats ask: a large key is one task. Exports that may have
    several files to a key take ``parts_per_key``."""
    df = df.repartition(*keys)
    (df.sortWithinPartitions(*keys, *(sort or [])).write.mode("overwrite").partitionBy(*keys).options(**options).format(kind)).save(path)


def parts_per_key(df: DataFrame, keys: list[str], path: str, kind: str = "parquet", rows: int = 1_000_000, **options) -> None:
    """The rows of a key in its folder, in files of at most so many rows; a large key is dealt to as many tasks as it has files."""
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / rows).alias("_parts"))
    part = F.floor(F.rand(11) * F.col("_parts")).cast("int")
    dealt = df.join(sizes, keys).withColumn("_part", part).drop("_parts")
    writer = dealt.repartition(*keys, "_part").drop("_part").write.mode("overwrite").option("maxRecordsPerFile", rows)
    writer.partitionBy(*keys).options(**options).format(kind).save(path)


def write_answer_csv(df: DataFrame, path: str) -> None:
    """Per course, in a folder named by the hash of its id, with a header, rows in order of all columns."""
    one_file_per_key(df.withColumn("course_dir", F.sha1("course_id")), ["course_dir"], path, "csv", df.columns, header="true")


def problem_response_rows(df: DataFrame, fields: list[str], date_format: str | None = None, list_separator: str | None = None) -> DataFrame:
    def shown(c: str, kind: str) -> Column:
        if kind.startswith("array") and list_separator:
            return F.array_join(c, list_separator)
        return F.date_format(c, date_format) if date_format and kind in ("timestamp", "date") else F.col(c)

    kinds = dict(df.dtypes)
    return df.select("course_id", "sort_idx", "username", *[shown(c, kinds[c]).alias(c) for c in fields if c not in ("course_id", "sort_idx", "username")])


def write_problem_response_csv(df: DataFrame, path: str, fields: list[str], **how) -> None:
    one_file_per_key(problem_response_rows(df, fields, **how), ["course_id"], path, "csv", [F.col("sort_idx").cast("int"), "username"], header="true")


#: Fixed by the format: the headers of an engagement report after the course, in order, by the column that each shows.
ENGAGEMENT_HEADERS = {
    "username": "Username", "email": "Email", "cohort": "Cohort", "days_active": "Days Active", "problems_attempted": "Unique Problems Attempted", "problem_attempts": "Total Problem Attempts",
    "problems_correct": "Unique Problems Correct", "videos_played": "Unique Videos Played", "forum_posts": "Discussion Posts", "forum_responses": "Discussion Responses", "forum_comments": "Discussion Comments",
    "forum_upvotes_given": "Discussion Upvotes Given", "forum_downvotes_given": "Discussion Downvotes Given", "forum_upvotes_received": "Discussion Upvotes Received",
    "forum_downvotes_received": "Discussion Downvotes Received", "textbook_pages_viewed": "Textbook Pages Viewed", "last_subsection_viewed": "URL of Last Subsection Viewed",
}
DATE_HEADERS = {"daily": ("Date", "Was Active"), "weekly": ("End Date", "Days Active This Week"), "all": ("End Date", "Days Active")}


def engagement_rows(report: DataFrame, interval: str) -> DataFrame:
    """A report under its headers, which follow the interval; facts that the report lacks are empty."""
    date, active = DATE_HEADERS[interval]
    headers = ENGAGEMENT_HEADERS | {"days_active": active}
    value = lambda c: F.col(c) if c in report.columns else F.lit("")
    return report.select(F.col("course_id").alias("Course ID"), F.col("date").cast("string").alias(date), *[value(c).alias(h) for c, h in headers.items()])


def write_engagement_csv(report: DataFrame, path: str, interval: str, label: str | None = None) -> None:
    """A file for each course and date, in a folder named by the hash of the course's id, rows in order of all columns.

    label: what stands for the date of the files, such as the whole interval.
    """
    rows = engagement_rows(report, interval)
    date = F.lit(label) if label else F.col(rows.columns[1])
    keyed = rows.withColumns({"course_dir": F.sha1(F.col("`Course ID`")), "report": F.concat(F.lit(f"student_engagement_{interval}_"), date)})
    one_file_per_key(keyed, ["course_dir", "report"], path, "csv", [F.col(f"`{c}`") for c in rows.columns], header="true")


def export_events_by_course(events: DataFrame, path: str) -> None:
    """events: course, date, line."""
    one_file_per_key(events.select("course", "date", "line"), ["course", "date"], path, "text", compression="gzip")


def export_events_by_org(events: DataFrame, path: str) -> None:
    df = events.withColumn("year", F.substring(F.col("date").cast("string"), 1, 4))
    one_file_per_key(df.select("org", "year", "date", "line"), ["org", "year", "date"], path, "text", compression="gzip")


def export_student_module(df: DataFrame, path: str) -> None:
    one_file_per_key(df, ["course_id"], path, "csv", sep="\t", header="true")


def synthetic_log_files(events: DataFrame, path: str, by: str = "date") -> None:
    one_file_per_key(events.select(by, F.col("event").alias("value")), [by], path, "text", compression="gzip")


def shared_path(spark: SparkSession) -> str:
    """A new path in the checkpoint folder that the session names; one of our own only where all run on this machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-store-")
    return f"{folder.rstrip('/')}/store-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows as a written table, so that what reads them doesn't compute them again."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
