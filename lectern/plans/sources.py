"""Registered queries of log files chosen by name, landed files and published results, and their SQL. All write in the folder
that the session names, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as C
from ..operators import catalog as K
from ..operators import enrollment as E
from ..operators import outline as O
from ..operators import video as V
from ..operators.events import field
from ..sources import logs as L
from ..sources import readers as R
from ..sources import results as P
from ..sources import sinks as S
from ..sources.adapter import END, enrollment_events, events, table, with_views
from ..streaming import reprocess as W
from . import enrollment, exports, structure, video
from .structure import _tree


def _logs(s, d):
    """Lines of a week from daily files, whose names alone decide which are opened."""
    path = S.shared_path(s)
    S.synthetic_log_files(exports._lines(s, d), path)
    pattern = r".*/date=(?P<date>[0-9-]+)/part-.*\.gz"
    lines = L.read_log_files(s, [path], "2024-01-10", "2024-01-13", (r".*/_[^/]*", pattern), expand=2)
    return lines.groupBy(F.regexp_extract("file", "date=([0-9-]+)", 1).alias("day")).agg(F.count("*").alias("n_lines"), F.count_distinct("file").alias("n_files"))


def _listing(s, d):
    """How many files of each day the listing has, and how many of them an interval takes."""
    path = S.shared_path(s)
    S.synthetic_log_files(exports._lines(s, d), path)
    files = L.list_files(s, [path], ("date=2024-01-0*/part-*", "date=2024-01-1*/part-*"))
    taken = L.select_log_files(files, "2024-01-05", "2024-01-06", (r".*/date=(?P<date>[0-9-]+)/.*",), expand=1).select("path", F.lit(1).alias("taken"))
    day = F.regexp_extract("path", "date=([0-9-]+)", 1)
    return files.join(taken, "path", "left").groupBy(day.alias("day")).agg(F.count("*").alias("n_files"), F.count("taken").alias("n_taken"))


def _published(s, d):
    """Three results published together; then one more with a key twice, which changes none of them."""
    path = S.shared_path(s)
    days = S.written(E.days_enrolled(enrollment_events(s, d), END))
    daily, mode = S.written(E.enrollment_daily(days)), E.enrollment_by_mode(days)
    timeline = S.written(V.video_timeline(V.video_usage(V.video_viewings(V.clean_events(video.video_events(s, d))))))  # published more than once
    P.publish({"course_enrollment_daily": daily.limit(1), "video_timeline": timeline.limit(1)}, path)
    P.publish({"course_enrollment_daily": daily, "course_enrollment_mode_daily": mode, "video_timeline": timeline}, path)
    try:
        P.publish({"course_enrollment_daily": daily.limit(1), "video_timeline": timeline.unionByName(timeline)}, path)
        refused = False
    except ValueError:
        refused = True
    counts = [P.read_result(s, path, n).agg(F.lit(n).alias("result"), F.count("*").alias("n_rows"), F.sum(c).cast("long").alias("total")) for n, c in (("course_enrollment_daily", "count"), ("course_enrollment_mode_daily", "cumulative_count"), ("video_timeline", "num_views"))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).withColumn("refused", F.lit(refused))


def _records(s, d):
    """Typed records from tab-separated text with nulls."""
    path = S.shared_path(s)
    c = table(s, d, "customer")
    c.select(F.concat_ws("\t", F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 3 == 0, "\\N").otherwise(F.col("c_name")), F.col("c_acctbal").cast("string"))).write.text(path)
    return R.read_record_tsv(s, path, "id long, name string, balance double")


def _blocks(s, d):
    """Outlines from lines of course structures, of which some lack their root."""
    blocks, edges = _tree(s, d)
    children = edges.groupBy(F.col("parent").alias("block_id")).agg(F.sort_array(F.collect_list(F.struct("at", "child"))).alias("c")).select("block_id", F.transform("c", lambda x: x["child"]).alias("children"))
    entry = F.struct(F.col("block_id").alias("id"), F.col("block_type").alias("type"), "display_name", "children")
    one = blocks.join(children, "block_id", "left").agg(F.map_from_entries(F.collect_list(F.struct("block_id", entry))).alias("blocks"))
    lines = one.select(F.to_json(F.struct(F.lit("course-v1:w+o+r").alias("course_id"), F.lit("root").alias("root"), "blocks")).alias("value"))
    lines = lines.unionByName(s.range(2).select(F.lit('{"course_id": "x", "root": "none", "blocks": {}}').alias("value")))
    outline = O.course_outline(*O.edges_of(R.read_course_blocks(lines)))
    return outline.select("block_id", "block_type", "course_path", "sort_idx", "is_orphan")


def _whitelist(s, d):
    """Events that a landed whitelist names."""
    path = S.shared_path(s)
    kinds = table(s, d, "events").select("event_type").distinct().where("event_type IN ('click', 'error')")
    kinds.select(F.concat_ws("\t", F.lit("label"), F.lit("server"), "event_type").alias("value")).unionByName(s.range(1).select(F.lit("# label\tserver\tview").alias("value"))).write.text(path)
    listed = R.read_event_whitelist(s, path).where("event_type IS NOT NULL").select("event_source", F.col("event_type").alias("kind"))
    return events(s, d).join(F.broadcast(listed), "kind").groupBy("event_source", "kind").agg(F.count("*").alias("n_events"))


def _catalog(s, d):
    """Runs, seats and programs of a catalog from landed JSON."""
    path = S.shared_path(s)
    n = table(s, d, "nation")
    key = F.concat(F.lit("run"), F.col("n_nationkey").cast("string"))
    seats = F.array(F.struct(F.lit("verified").alias("type"), F.col("n_nationkey").cast("string").alias("price"), F.lit("USD").alias("currency")), F.struct(F.lit("audit").alias("type"), F.lit("0").alias("price"), F.lit("USD").alias("currency")))
    programs = F.array(F.struct(F.col("n_regionkey").cast("string").alias("uuid"), F.lit("MicroMasters").alias("type"), F.lit("T").alias("title")))
    n.select(key.alias("course_id"), F.lit("c").alias("catalog_course"), seats.alias("seats"), programs.alias("programs")).write.json(f"{path}/runs")
    n.groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_nationkey")).alias("k")).select(F.col("n_regionkey").cast("string").alias("uuid"), F.transform("k", lambda k: F.struct(F.concat(F.lit("c"), k.cast("string")).alias("key"))).alias("courses")).write.json(f"{path}/programs")
    runs = R.read_catalog(s, f"{path}/runs", "course_id string, catalog_course string, seats array<struct<type: string, price: string, currency: string>>, programs array<struct<uuid: string, type: string, title: string>>", "p")
    order = K.program_course_order(R.read_catalog(s, f"{path}/programs", "uuid string, courses array<struct<key: string>>", "p"))
    seat = F.explode("seats")
    prices = runs.select("course_id", seat.alias("seat")).groupBy("course_id").agg(F.max(F.col("seat.price").cast("double")).alias("price"), F.count("*").alias("n_seats"))
    return prices.join(runs.select("course_id", F.col("programs")[0]["uuid"].alias("program")), "course_id").join(order.groupBy(F.col("program_id").alias("program")).agg(F.count("*").alias("n_courses")), "program")


def _tables(s, d):
    """Nations as a table of the catalog by region, one of whose partitions came by another way."""
    path = S.shared_path(s)
    name = f"nations_{path[-12:]}"
    n = table(s, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("region"))
    S.write_partition(n.where("region < 3"), path, "region")
    s.sql(f"CREATE TABLE {name} (n_nationkey BIGINT, n_name STRING, region BIGINT) USING parquet PARTITIONED BY (region) LOCATION '{path}'")
    S.recover_partitions(s, name)
    before = s.table(name).count()  # one number
    S.write_partition(n.where("region >= 3"), path, "region")
    S.recover_partitions(s, name)
    out = S.written(s.table(name).withColumn("before", F.lit(before)))
    s.sql(f"DROP TABLE {name}")
    return out.select("n_nationkey", "n_name", "region", "before")


def _orgs(s, d):
    c = table(s, d, "customer")
    org = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("org "), F.col("c_custkey").cast("string"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("org.-~_"), F.col("c_custkey").cast("string")))
    return c.select("c_custkey", C.valid_org_id(org).alias("valid"))


def _weeks(s, d):
    """Events of the two whole weeks before the one that holds a day."""
    first, stop = W.trailing_weeks("2024-01-25", 2)
    return events(s, d).where((F.col("date") >= first) & (F.col("date") < stop)).groupBy("date").agg(F.count("*").alias("n_events"))


def _late(s, d):
    """Events by the day on which they were received, where a phone kept them."""
    e = events(s, d)
    received = F.when(F.col("event_id") % 3 == 0, F.date_format(F.date_add("date", 2), "yyyy-MM-dd'T'00:00:01"))
    line = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), F.struct(received.alias("received_at")).alias("context")))
    rows = R.parse_lines(e.select(line.alias("value")))
    return rows.groupBy(W.received_date(field("context.received_at"), field("time")).alias("day")).agg(F.count("*").alias("n_events"))


QUERIES = {
    "log_files_selected": _logs, "log_file_listing": _listing, "published_results": _published, "record_files": _records, "course_block_files": _blocks, "whitelist_file": _whitelist, "catalog_run_files": _catalog,
    "recovered_partitions": _tables, "org_ids": _orgs, "trailing_weeks": _weeks, "late_by_receipt": _late,
}
DATES = {"trailing_weeks": ["date"]}

_T = lambda name, column, sql: f"SELECT '{name}' AS result, count(*) AS n_rows, CAST(sum({column}) AS BIGINT) AS total, true AS refused FROM ({sql})"
ORACLES = {
    "log_files_selected": with_views() + " SELECT strftime(date, '%Y-%m-%d') AS day, count(*) AS n_lines, 1 AS n_files FROM ev WHERE date >= DATE '2024-01-08' AND date < DATE '2024-01-15' GROUP BY ALL",
    "log_file_listing": with_views() + " SELECT strftime(date, '%Y-%m-%d') AS day, 1 AS n_files, CASE WHEN date >= DATE '2024-01-04' AND date < DATE '2024-01-07' THEN 1 ELSE 0 END AS n_taken FROM ev WHERE date < DATE '2024-01-20' GROUP BY ALL",
    "published_results": f"{_T('course_enrollment_daily', 'count', enrollment.ORACLES['enrollment_daily'])} UNION ALL {_T('course_enrollment_mode_daily', 'cumulative_count', enrollment.ORACLES['enrollment_by_mode'])} UNION ALL {_T('video_timeline', 'num_views', video.ORACLES['video_timeline'])}",
    "record_files": "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS name, CAST(c_acctbal AS DOUBLE) AS balance FROM customer",
    "course_block_files": f"SELECT block_id, block_type, course_path, sort_idx, is_orphan FROM ({structure.ORACLES['course_outline']})",
    "whitelist_file": "SELECT 'server' AS event_source, event_type AS kind, count(*) AS n_events FROM events WHERE event_type IN ('click', 'error') GROUP BY ALL",
    "catalog_run_files": """SELECT 'run' || n_nationkey AS course_id, CAST(n_nationkey AS DOUBLE) AS price, CAST(2 AS BIGINT) AS n_seats, CAST(n_regionkey AS VARCHAR) AS program, count(*) OVER (PARTITION BY n_regionkey) AS n_courses FROM nation""",
    "recovered_partitions": "SELECT n_nationkey, n_name, n_regionkey AS region, (SELECT count(*) FROM nation WHERE n_regionkey < 3) AS before FROM nation",
    "org_ids": "SELECT c_custkey, c_custkey % 3 = 1 AS valid FROM customer",
    "trailing_weeks": with_views() + " SELECT date, count(*) AS n_events FROM ev WHERE date >= DATE '2024-01-08' AND date < DATE '2024-01-22' GROUP BY ALL",
    "late_by_receipt": with_views() + " SELECT strftime(CASE WHEN event_id % 3 = 0 THEN date + 2 ELSE date END, '%Y-%m-%d') AS day, count(*) AS n_events FROM ev GROUP BY ALL",
}
