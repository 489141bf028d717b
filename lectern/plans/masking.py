"""Registered queries of masked course data, written and read back, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import encode_id
from ..operators import event_masking as E
from ..sources import sinks as S
from ..sources.adapter import events, ip_events, table, users, with_views
from .activity import _NUM, _RANGES, _ranges
from .text import SEED, _remap


def _directory(s, d):
    """The learners whose gender is known, with names of their own."""
    u = users(s, d).where("gender <> ''")
    return u.select("user_id", "username", F.concat(F.lit("Ann Lee"), F.col("user_id").cast("string")).alias("name"))


def _lines(s, d):
    """course and value: checks of servers, some with the payload as text, page events of browsers, pages of courses, and what may not leave."""
    e = events(s, d).join(ip_events(s, d).select("event_id", "ip"), "event_id")
    n = F.col("user_id").cast("string")
    kind = F.when(F.col("kind") == "purchase", "problem_check").when(F.col("kind") == "view", F.concat(F.lit("/courses/"), "course_id", F.lit("/info"))).when(F.col("kind") == "signup", "save_problem_fail").otherwise("page_close")
    source = F.when(F.col("kind") == "click", "browser").when(F.col("kind") == "error", "mobile").otherwise("server")
    said = F.concat(F.lit("by user"), n, F.lit(" or Lee"), n, F.lit(" ("), n, F.lit(") a@b.org"))
    body = F.struct("user_id", F.struct(F.lit("x").alias("file_upload_key"), said.alias("text")).alias("answer"), F.lit("u").alias("url"))
    ip = F.when(F.col("event_id") % 5 == 0, "2601::1").when(F.col("event_id") % 5 == 1, "").otherwise(F.col("ip"))
    head = F.struct(
        source.alias("event_source"), kind.alias("event_type"), F.lit("h.org").alias("host"), F.concat(F.lit("user"), n).alias("username"), F.lit("p").alias("page"), ip.alias("ip"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"),
        F.struct("course_id", "user_id", F.lit("/x").alias("path")).alias("context"), F.lit("@").alias("event"),
    )
    text = F.to_json(body)
    payload = F.when(F.col("event_id") % 2 == 0, text).otherwise(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('\\"')), F.lit('"')))
    return e.select(F.col("course_id").alias("course"), F.replace(F.to_json(head), F.lit('"@"'), payload).alias("value"))


def _masked_events(s, d):
    path = S.shared_path(s)
    whitelist = s.createDataFrame([("browser", "page_close"), ("server", "problem_check")], "event_source string, event_type string")
    S.export_events_by_course(E.masked_events(_lines(s, d), _directory(s, d), whitelist, _ranges(s, d), SEED), path)
    get = lambda p: F.get_json_object("value", f"$.{p}")
    payload = F.coalesce(F.when(get("event").startswith("{"), get("event")))
    back = s.read.text(path).select("course", F.col("date").cast("string").alias("date"), "value")
    return back.select(
        "course", "date", get("event_source").alias("source"), get("event_type").alias("type"), get("username").alias("username"), get("context.user_id").cast("long").alias("user_id"), get("augmented.country_code").alias("country_code"),
        F.get_json_object(payload, "$.answer").alias("answer"), F.get_json_object(payload, "$.user_id").cast("long").alias("payload_user_id"), F.coalesce(F.get_json_object(payload, "$.url"), get("ip"), get("host"), get("page"), get("context.path")).alias("left"), F.lower(F.regexp_extract("value", r'"event":(.)', 1)).alias("payload_begins"),
    )


def _masked_tables(s, d):
    """Rows of a course's tables, as JSON."""
    o, n = table(s, d, "orders"), table(s, d, "nation")
    tables = {
        "certificates_generatedcertificate": o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.lit("u").alias("download_url"), F.col("o_orderstatus").alias("grade"), F.lit("k").alias("key"), F.lit("Ann").alias("name")),
        "student_courseenrollment": o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("mode")),
        "wiki_article": n.select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("owner_id")),
        "teams": n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
        "student_languageproficiency": n.select(F.col("n_nationkey").alias("id"), F.lower("n_name").alias("code")),
        "auth_user": users(s, d).select(F.col("user_id").alias("id"), "username", F.col("name").alias("first_name"), F.lit("x@y.org").alias("email")),
    }
    masked = E.mask_course_tables(tables, _directory(s, d), SEED)
    out = None
    for name, df in masked.items():
        rows = df.select(F.lit(name).alias("table"), F.to_json(F.struct(*df.columns)).alias("row"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _codes(s, d):
    return table(s, d, "customer").select("c_custkey", encode_id(F.lit("course"), F.col("c_mktsegment"), F.col("c_custkey").cast("string")).alias("code"))


QUERIES = {"masked_events": _masked_events, "masked_course_tables": _masked_tables, "encoded_ids": _codes}

_KNOWN = "CASE WHEN c_custkey IS NULL THEN {} ELSE {} END"
_ANSWER = _KNOWN.format("'by user' || user_id || ' or Lee' || user_id || ' (<<USER_ID>>) <<EMAIL>>'", "'by <<USERNAME>> or <<FULLNAME>> (<<USER_ID>>) <<EMAIL>>'")
_J = lambda *pairs: "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in pairs) + " || '}'"
_Q = lambda x: f"'\"' || {x} || '\"'"
ORACLES = {
    "masked_events": with_views("ips", rng=_RANGES, x="SELECT ev.*, CASE event_id % 5 WHEN 0 THEN '2601::1' WHEN 1 THEN '' ELSE ip END AS ip FROM ev JOIN (SELECT event_id, ip FROM ips) USING (event_id) WHERE kind IN ('purchase', 'view', 'click')")
    + f""" SELECT course_id AS course, strftime(ts, '%Y-%m-%d') AS date, CASE kind WHEN 'click' THEN 'browser' ELSE 'server' END AS source, CASE kind WHEN 'purchase' THEN 'problem_check' WHEN 'view' THEN '/courses/' || course_id || '/info' ELSE 'page_close' END AS type,
 {_KNOWN.format("'" + E.REDACTED + "'", "'username_' || " + _remap('user_id'))} AS username, {_remap('user_id')} AS user_id, CASE WHEN event_id % 5 > 1 THEN coalesce(country_code, 'UNKNOWN') END AS country_code,
 '{{"text":"' || {_ANSWER} || '"}}' AS answer, {_remap('user_id')} AS payload_user_id, NULL AS "left", CASE WHEN event_id % 2 = 0 THEN '{{' ELSE '"' END AS payload_begins
 FROM x LEFT JOIN customer ON c_custkey = user_id AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') LEFT JOIN rng ON CASE WHEN event_id % 5 > 1 THEN {_NUM} END BETWEEN lo AND hi""",
    "masked_course_tables": f"""SELECT 'certificates_generatedcertificate' AS "table", {_J(('id', 'o_orderkey'), ('user_id', _remap('o_custkey')), ('download_url', _Q("''")), ('grade', _Q('o_orderstatus')), ('key', _Q("''")), ('name', _Q("''")))} AS row FROM orders
 UNION ALL SELECT 'student_courseenrollment', {_J(('id', 'o_orderkey'), ('user_id', _remap('o_custkey')), ('mode', _Q('o_orderstatus')))} FROM orders
 UNION ALL SELECT 'wiki_article', {_J(('id', 'n_nationkey'), ('owner_id', _remap('n_regionkey')))} FROM nation UNION ALL SELECT 'teams', {_J(('id', 'n_nationkey'), ('name', _Q('n_name')))} FROM nation
 UNION ALL SELECT 'student_languageproficiency', {_J(('id', 'n_nationkey'), ('code', _Q('lower(n_name)')))} FROM nation
 UNION ALL SELECT 'auth_user', {_J(('id', _remap('c_custkey')), ('username', _Q("'username_' || " + _remap('c_custkey'))), ('first_name', _Q("''")), ('email', _Q("''")))} FROM customer""",
    "encoded_ids": """WITH t AS (SELECT c_custkey, encode('course|' || c_mktsegment || '|' || c_custkey) AS b FROM customer),
 h AS (SELECT c_custkey, octet_length(b) AS n, rpad(hex(b), CAST(ceil(octet_length(b) / 5.0) * 10 AS INTEGER), '0') AS x FROM t),
 g AS (SELECT c_custkey, n, i, CAST('0x' || substr(x, CAST(i * 10 + 1 AS INTEGER), 10) AS BIGINT) AS v FROM h, unnest(range(len(x) // 10)) AS u(i)),
 s AS (SELECT c_custkey, n, string_agg(list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((v >> (35 - 5 * j)) & 31) + 1 AS INTEGER), 1) for j in range(8)], 'string_agg', ''), '' ORDER BY i) AS t FROM g GROUP BY ALL)
 SELECT c_custkey, rpad(substr(t, 1, CAST(ceil(n * 8 / 5.0) AS INTEGER)), CAST(ceil(n / 5.0) * 8 AS INTEGER), '=') AS code FROM s""",
}
