"""Late data: recent days are built anew, older ones stay. Windows are calendar weeks and the trailing seven days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import write_partition


def recent(df: DataFrame, end: str, days: int = 3, date: str = "date") -> DataFrame:
    last = F.lit(end).cast("date")
    return df.where((F.col(date) >= F.date_sub(last, days)) & (F.col(date) < last))


def reprocess_recent(df: DataFrame, path: str, end: str, days: int = 3, date: str = "date") -> None:
    """Replace the partitions of the last days by these rows' ones."""
    write_partition(recent(df, end, days, date), path, date)


def received_date(received_at: Column, time: Column) -> Column:
    return F.split_part(F.coalesce(received_at, time), F.lit("T"), F.lit(1))


def week_start(date: Column) -> Column:
    return F.date_trunc("week", date).cast("date")


def trailing(date: Column, end: str, days: int = 7) -> Column:
    last = F.lit(end).cast("date")
    return (date >= F.date_sub(last, days)) & (date < last)


def trailing_weeks(end: str, n: int) -> tuple[Column, Column]:
    """First and last day (exclusive) of the n whole ISO weeks before the week that holds the end."""
    stop = week_start(F.lit(end).cast("date"))
    return F.date_sub(stop, 7 * n), stop
