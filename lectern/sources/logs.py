"""Log files chosen by their names before any is opened.

Files are rows: their listing is a table, and a condition on the path of a scan prunes the files it reads, so neither
names nor lines pass through the driver.
"""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where a file's name has its date, or else its epoch seconds, unless patterns say so.
PATTERNS = (r".*?(?P<date>\d{4}-\d{2}-\d{2})[^/]*", r".*?(?<!\d)(?P<date>\d{8})(?!\d)[^/]*", r".*?(?<!\d)(?P<timestamp>\d{10})(?!\d)[^/]*")


def list_files(spark: SparkSession, roots: list[str], include: tuple[str, ...] = ("*",)) -> DataFrame:
    """path and length of the files below the roots whose path below its root fits a shell pattern, but for empty ones. No file is opened."""
    out = None
    for root in roots:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
        below = F.regexp_replace("path", rf"^.*?{re.escape(root.split(':', 1)[-1].strip('/'))}/*", "")
        fits = F.lit(False)
        for shell in include:
            fits = fits | below.rlike(_java(fnmatch.translate(shell)))
        files = files.where(fits & (F.col("length") > 0))
        out = files if out is None else out.unionByName(files)
    return out


def _java(pattern: str) -> str:
    """A Python pattern as a Java one: groups are named alike, the end is marked otherwise."""
    return re.sub(r"\(\?P<", "(?<", pattern).replace("\\Z", "\\z")


def selected(path: Column, start: str, end: str, patterns: tuple[str, ...] = PATTERNS, expand: int = 2, date_format: str | None = None) -> Column:
    """Whether a path is one of an interval (end excluded) widened by some days on both sides.

    The first pattern that fits the path from its beginning decides, by its group ``date`` or else ``timestamp``;
    one without either takes all that it fits. A date that can't be read is outside.
    """
    low, high = F.date_sub(F.lit(start).cast("date"), expand), F.date_add(F.lit(end).cast("date"), expand)
    out = F.lit(False)
    for pattern in reversed(patterns):
        groups, java = re.compile(pattern).groupindex, rf"^(?:{_java(pattern)})"
        part = lambda name: F.nullif(F.regexp_extract(path, java, groups[name]), F.lit(""))  # noqa: E731, B023
        if "date" in groups:
            day = F.try_to_date(part("date"), date_format) if date_format else F.coalesce(F.try_to_date(part("date"), "yyyy-MM-dd"), F.try_to_date(part("date"), "yyyyMMdd"))
            inside = F.coalesce((day >= low) & (day < high), F.lit(False))
        elif "timestamp" in groups:
            day = F.to_date(F.timestamp_seconds(part("timestamp").try_cast("long")))
            inside = F.coalesce((day >= low) & (day < high), F.lit(False))
        else:
            inside = F.lit(True)
        out = F.when(path.rlike(java), inside).otherwise(out)
    return out


def select_log_files(files: DataFrame, start: str, end: str, patterns: tuple[str, ...] = PATTERNS, expand: int = 2, date_format: str | None = None) -> DataFrame:
    """The rows of a listing (path, ...) whose files may hold events of the interval."""
    return files.where(selected(F.col("path"), start, end, patterns, expand, date_format))


def read_log_files(spark: SparkSession, roots: list[str], start: str, end: str, patterns: tuple[str, ...] = PATTERNS, expand: int = 2, date_format: str | None = None) -> DataFrame:
    """value and file of the lines in the selected files below the roots. The condition is on the files' paths, so Spark opens no other."""
    lines = spark.read.option("recursiveFileLookup", "true").text(roots)
    kept = lines.where(selected(F.col("_metadata.file_path"), start, end, patterns, expand, date_format))
    return kept.select("value", F.col("_metadata.file_path").alias("file"))
