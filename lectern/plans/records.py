"""Registered queries of records with a schema, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import records as R
from ..functions.records import Field
from ..operators import families as X
from ..operators.events import decoded
from ..sources.adapter import table, with_views
from ..sources.readers import parse_lines
from .exports import _lines

#: Paths of log lines; some of what stands there doesn't fit.
EVENT = [
    Field("source", "string", length=6, path="root.Event_Source"), Field("kind", "string", length=12, path="root.event_type"), Field("at", "timestamp", path="root.time_utc"), Field("bare_time", "timestamp", path="root.time"),
    Field("user_id", "integer", path="root.context.user_id"), Field("user_number", "integer", path="root.username"), Field("is_right", "boolean", path="root.event.success"), Field("answers", "string", path="root.event.answers"),
    Field("course_id", "string", length=100, path="root.context.course_id"), Field("day", "string", length=10),
]
#: Order rows: priorities are short texts, a third of the keys is no number.
ORDER = [Field("key", "integer", nullable=False), Field("status", "string", length=1, nullable=False), Field("priority", "string", length=8), Field("clerk", "string", length=5, truncate=True), Field("note", "string", length=200, squeeze=True), Field("placed", "date"), Field("open", "boolean")]


def _flat(s, d):
    lines = _lines(s, d).select("date", F.replace("event", F.lit('"event_source"'), F.concat(F.lit('"time_utc":"2024-01-01T00:00:00+01:00","event_source"'))).alias("value"))
    events = parse_lines(lines, keep=("date",)).withColumn("n", F.try_variant_get("event", "$.context.user_id", "long"))
    return R.flatten_by_mapping(events, "event", EVENT, calculated={"day": F.col("date").cast("string")})


def _checked(s, d):
    o = table(s, d, "orders")
    k = F.col("o_orderkey")
    rows = o.select(
        F.when(k % 3 == 0, F.concat(F.lit("k"), k.cast("string"))).otherwise(k.cast("string")).alias("key"), F.when(k % 5 > 0, F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"),
        F.concat(F.lit("Clerk#"), F.col("o_custkey").cast("string")).alias("clerk"), F.concat(F.col("o_orderpriority"), F.lit(" \n\t b"), k.cast("string")).alias("note"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed"), F.when(k % 2 == 0, "1").otherwise("0").alias("open"), k.alias("row_key"),
    )
    return R.enforce_schema(rows, ORDER, keep=("row_key",))


def _augmented(s, d):
    """Payloads with their time, context and user; a line in four lacks its user."""
    lines = _lines(s, d).select(F.when(F.get_json_object("event", "$.context.user_id").cast("long") % 4 == 0, F.replace("event", F.lit('"username"'), F.lit('"nobody"'))).otherwise(F.col("event")).alias("value"))
    df = X.augment_payload(decoded(parse_lines(lines)), X.AUGMENTS)
    get = lambda p, k="string": F.try_variant_get("payload", f"$.{p}", k)
    return df.select(get("timestamp", "double").cast("long").alias("seconds"), get("username").alias("username"), get("context.course_id").alias("course_id"), get("problem_id").alias("problem_id"))


def _parsed(s, d):
    df = X.parse_only(_lines(s, d).select(F.col("event").alias("value")), "2024-01-10", "2024-01-20")
    return df.groupBy("date").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def _pruned(s, d):
    """The customer table without what may not leave."""
    assert R.keep_tables(["auth_user", "auth_profile", "other"], [], ["auth_p"]) == ["auth_user", "other"]
    return R.prune_columns(table(s, d, "customer"), "customer", [r"customer\.c_(name|acct)", r"orders\.c_", "c_custkey"]).select("c_custkey", "c_nationkey", "c_mktsegment")


QUERIES = {
    "flattened_events": lambda s, d: _flat(s, d).select("record.*"), "rejected_values": lambda s, d: R.rejected_values(_flat(s, d)).groupBy("field", "path", "value").agg(F.count("*").alias("n")),
    "clean_records": lambda s, d: R.clean_rows(_checked(s, d)), "schema_violations": lambda s, d: R.violations(_checked(s, d), "row_key"), "augmented_payloads": _augmented, "parse_only": _parsed, "pruned_columns": _pruned,
}
DATES = {"clean_records": ["placed"]}

_SRC = "CASE kind WHEN 'click' THEN 'browser' WHEN 'error' THEN 'mobile' ELSE 'server' END"
_TYPE = "CASE kind WHEN 'purchase' THEN 'problem_check' WHEN 'view' THEN '/courses/' || course_id || '/x' WHEN 'signup' THEN 'save_problem_fail' ELSE 'page_close' END"
_CUT = lambda x, n: f"CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n - 4}) || '...' ELSE {x} END"
_V = lambda field, rule, value, when: f"SELECT row_key, '{field}' AS field, '{rule}' AS rule, {value} AS value FROM o WHERE {when}"
_O = """SELECT o_orderkey AS row_key, CASE WHEN o_orderkey % 3 = 0 THEN 'k' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS key, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS status, o_orderpriority AS priority, 'Clerk#' || o_custkey AS clerk,
 o_orderpriority || ' b' || o_orderkey AS note, CAST(o_orderdate AS DATE) AS placed, o_orderkey % 2 = 0 AS "open" FROM orders"""
ORACLES = {
    "flattened_events": with_views(x=f"SELECT *, {_SRC} AS s, {_TYPE} AS t FROM ev") + f""" SELECT {_CUT('s', 6)} AS source, {_CUT('t', 12)} AS kind, TIMESTAMP '2023-12-31 23:00:00' AS "at", CAST(NULL AS TIMESTAMP) AS bare_time, CAST(user_id AS INTEGER) AS user_id, CAST(NULL AS INTEGER) AS user_number,
 true AS is_right, CAST(NULL AS VARCHAR) AS answers, course_id, strftime(date, '%Y-%m-%d') AS day FROM x""",
    "rejected_values": with_views(x="SELECT 'bare_time' AS field, 'root.time' AS path, '\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '\"' AS value FROM ev UNION ALL SELECT 'user_number', 'root.username', '\"user' || user_id || '\"' FROM ev") + " SELECT *, count(*) AS n FROM x GROUP BY ALL",
    "clean_records": f"WITH o AS ({_O}) SELECT CAST(key AS INTEGER) AS key, status, priority, substr(clerk, 1, 5) AS clerk, note, placed, \"open\" FROM o WHERE row_key % 3 > 0 AND status IS NOT NULL AND length(priority) <= 8",
    "schema_violations": f"WITH o AS ({_O}) {_V('key', 'type', 'key', 'row_key % 3 = 0')} UNION ALL {_V('status', 'null', 'NULL', 'status IS NULL')} UNION ALL {_V('priority', 'length', 'priority', 'length(priority) > 8')}",
    "augmented_payloads": with_views() + " SELECT CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds, 'user' || user_id AS username, course_id, 'i4x://org' || (k % 3) || '/c/problem/p' || (k % 10) AS problem_id FROM ev WHERE user_id % 4 > 0",
    "pruned_columns": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "parse_only": with_views(x=f"SELECT strftime(ts, '%Y-%m-%d') AS date, {_SRC} AS s, {_TYPE} AS t, * EXCLUDE (date) FROM ev") + """ SELECT date, count(*) AS n_lines, CAST(sum(
 length('{"event_source":"' || s || '","event_type":"' || t || '","host":"h.org","username":"user' || user_id || '","page":"https://h.org/courses/' || course_id || '/","time":"2024-01-01T00:00:00","context":{"course_id":"' || course_id || '","user_id":' || user_id
 || CASE WHEN kind = 'error' AND k % 2 = 0 THEN ',"org_id":"org' || (k % 3) || '"' ELSE '' END || ',"asides":{"tagging_aside":{"saved_tags":{"skill":["s' || (k % 5) || '"]}}}},"event":{"problem_id":"i4x://org' || (k % 3) || '/c/problem/p' || (k % 10)
 || '","success":"' || CASE WHEN event_id % 2 = 0 THEN 'correct' ELSE 'incorrect' END || '","answers":{"x_2_1":"a' || (event_id % 4) || '"}}}')) AS BIGINT) AS n_chars FROM x WHERE date >= '2024-01-10' AND date < '2024-01-20' GROUP BY ALL""",
}
