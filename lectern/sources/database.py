"""Tables of databases: read in ranges into dated partitions, and replaced within one transaction.

Rows go between the executors and the database; the driver sends statements only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import checked, result_nulls, write_partition


def read_table(
    spark: SparkSession, url: str, table: str, columns: Sequence[str] = (), where: str | None = None, split: str | None = None, parts: int = 8, **options
) -> DataFrame:
    """The named columns (all, without any) of the rows that a condition picks; with a column to split by, each part is one
    range between its least and greatest value, which one query of a single row asks for."""
    reader = lambda query: spark.read.format("jdbc").option("url", url).option("dbtable", query).options(**options)
    picked = f"(SELECT {', '.join(columns) or '*'} FROM {table}{f' WHERE {where}' if where else ''}) picked"
    if not split:
        return reader(picked).load()
    low, high = reader(f"(SELECT MIN({split}) AS low, MAX({split}) AS high FROM {table}{f' WHERE {where}' if where else ''}) bounds").load().first()
    if low is None:
        return reader(picked).load()
    return reader(picked).option("partitionColumn", split).option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", parts).load()


def import_table(spark: SparkSession, url: str, table: str, path: str, day: str, **how) -> DataFrame:
    """Read a table as ``read_table`` does, into the partition ``dt=day`` of a path, which replaces an earlier one of that day; the rows as read back."""
    write_partition(read_table(spark, url, table, **how).withColumn("dt", F.lit(day).cast("date")), path, "dt")
    return spark.read.parquet(path).where(F.col("dt") == F.lit(day).cast("date"))


def dump_query(spark: SparkSession, url: str, query: str, path: str, **options) -> None:
    """The rows of a query as tab-separated text: dates and times as ISO, null as a dash, nothing quoted."""
    df = spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()

    def shown(name: str, kind: str):
        if kind == "timestamp":
            return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.col(f"`{name}`").cast("string")

    df.select(F.concat_ws("\t", *[F.coalesce(shown(c, k), F.lit("-")) for c, k in df.dtypes])).write.mode("overwrite").text(path)


@contextmanager
def transaction(spark: SparkSession, url: str, driver: str | None = None):
    """A statement of a connection whose changes all take place at the end, or none if anything fails."""
    if driver:
        spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            yield statement
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
    finally:
        connection.close()


def replace_table(df: DataFrame, url: str, table: str, allow_empty: bool = False, key: list[str] | None = None, driver: str | None = None, **options) -> None:
    """Replace the rows of a table by these, refused if there are none or two share a key. The rows are written beside the table first;
    then one transaction deletes the old rows and takes over the new ones, so that a failure at any point leaves the old."""
    spark, beside = df.sparkSession, f"{table}_{uuid.uuid4().hex[:8]}"
    options = options | ({"driver": driver} if driver else {})
    ready = checked(result_nulls(df), allow_empty, key)
    names = ", ".join(df.columns)
    try:
        ready.write.mode("overwrite").options(**options).jdbc(url, beside)
        with transaction(spark, url, driver) as statement:
            statement.executeUpdate(f"DELETE FROM {table}")
            quoted = ", ".join(f'"{c}"' for c in df.columns)
            statement.executeUpdate(f"INSERT INTO {table} ({names}) SELECT {quoted} FROM {beside}")
    finally:
        try:
            with transaction(spark, url, driver) as statement:
                statement.executeUpdate(f"DROP TABLE {beside}")
        except Exception:  # noqa: BLE001 - it was never made, and the failure that is on its way says why
            pass
