"""Readers of tracking logs, database snapshots, catalogs and small inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import backslash_decode, once


def parse_lines(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Event lines as VARIANT: the line itself, else its text from the first to the last brace; others are dropped. Named columns stay."""
    raw = F.col(column)
    inner = F.regexp_extract(raw, r"(?s)^.*?(\{.*\})\s*$", 1)
    parsed = F.coalesce(F.when(raw.rlike(r"^\s*\{"), F.try_parse_json(raw)), F.try_parse_json(F.nullif(inner, F.lit(""))))
    return once(lines.select(*keep, parsed.alias("event"))).where("event IS NOT NULL")  # both begin with a brace, so what can be read is an object


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_lines(spark.read.text(path))


def read_snapshot(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A dumped table: fields end at \\x01, \\N is null."""
    return spark.read.schema(schema).csv(path, sep="\x01", nullValue="\\N", quote="", timestampFormat="yyyy-MM-dd HH:mm:ss[.S]")


def read_mysqldump_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep=",", quote="'", escape="\\")


def read_mysql_tsv(spark: SparkSession, path: str, schema: str, escaped: bool) -> DataFrame:
    df = spark.read.schema(schema).csv(path, sep="\t", quote="")
    if not escaped:
        return df
    return df.select(*[backslash_decode(F.col(c)).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes])


def read_record_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed records; a line with the wrong number of fields is an error."""
    return spark.read.schema(schema).csv(path, sep="\t", nullValue="\\N", quote="", mode="FAILFAST")


COURSE_LIST = "id string, course_id string, name string, org string, number string, blocks_url string, short_description string, enrollment_start string, enrollment_end string, start string, `end` string, start_display string, start_type string, effort string, pacing string"


def read_course_list(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(COURSE_LIST).json(path)
    return df.withColumn("course_id", F.coalesce("id", "course_id")).drop("id").withColumnsRenamed({"start": "start_date", "end": "end_date"}).where("course_id IS NOT NULL")


BLOCKS = "course_id string, root string, blocks map<string, struct<id string, type string, display_name string, children array<string>>>"


def read_course_blocks(lines: DataFrame) -> DataFrame:
    df = lines.select(F.from_json("value", BLOCKS).alias("c")).select("c.*")
    return df.where(F.col("course_id").isNotNull() & F.col("root").isNotNull() & F.map_contains_key("blocks", F.coalesce("root", F.lit(""))))


def read_catalog(spark: SparkSession, path: str, schema: str, partner: str) -> DataFrame:
    return spark.read.schema(schema).json(path).withColumn("partner_short_code", F.lit(partner))


def latest_partition(df: DataFrame, dt: str = "dt") -> DataFrame:
    """Rows of the largest partition value present. One value reaches the driver, then the scan prunes by it."""
    return df.where(F.col(dt) == F.lit(df.agg(F.max(dt)).first()[0]))


def union_history(old: DataFrame, recent: DataFrame, since: str, date: str = "date") -> DataFrame:
    """History before the date, and the recomputed days from it on."""
    day = F.lit(since).cast("date")
    return old.where(F.col(date) < day).unionByName(recent.where(F.col(date) >= day))


def read_answer_metadata(lines: DataFrame) -> DataFrame:
    kind = "map<string, struct<question: string, response_type: string, input_type: string, problem_display_name: string, answer_value_id_map: map<string, string>>>"
    return lines.select(F.explode(F.from_json("value", kind)).alias("answer_id", "meta")).select("answer_id", "meta.*")


FORUM = """_id struct<`$oid`: string>, _type string, author_id string, author_username string, body string, title string, course_id string,
 votes struct<up: array<string>, down: array<string>>, abuse_flaggers array<string>, historical_abuse_flaggers array<string>, endorsement struct<user_id: string>"""


def read_forum_posts(spark: SparkSession, path: str) -> DataFrame:
    """Forum posts of a dump, a JSON line each; lines that can't be read are dropped."""
    posts = spark.read.schema(FORUM + ", _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    return posts.where("_id IS NOT NULL").drop("_bad")


def read_event_whitelist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("label string, event_source string, event_type string").csv(path, sep="\t", comment="#")


def org_config(spark: SparkSession, config: dict[str, dict], only: list[str] | None = None) -> DataFrame:
    """alias, org, courses: each organisation under its own name and its aliases."""
    rows = [(alias, org, c.get("courses")) for org, c in config.items() if not only or org in only for alias in [org, *c.get("other_names", [])]]
    return spark.createDataFrame(rows, "alias string, org string, courses array<string>")


def user_directory(users: DataFrame, profiles: DataFrame) -> DataFrame:
    df = users.select(F.col("id").try_cast("long").alias("user_id"), F.trim("username").alias("username")).where("user_id IS NOT NULL AND username <> ''")
    return df.join(profiles.select("user_id", "name"), "user_id", "left")
