"""Registered queries of problems, outlines, catalogs and event decoding, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as K
from ..operators import events as X
from ..operators import outline as O
from ..operators import problems as P
from ..sources import readers as R
from ..sources.adapter import events, table, with_views


def _checks(s, d):
    """Problem checks from purchases: ten problems of two parts."""
    e = events(s, d).where("kind = 'purchase'")
    problem = F.concat(F.lit("p"), (F.col("k") % 10).cast("string"))
    value = F.concat(F.lit("choice_"), (F.col("event_id") % 4).cast("string"))
    part = lambda v, c: F.struct(v.alias("value"), F.when(F.col("event_id") % 3 == 0, "").otherwise("2").alias("variant"), c.alias("correct"), F.lit("multiplechoiceresponse").alias("response_type"), F.lit("Which?").alias("question"))
    answers = F.create_map(F.concat(problem, F.lit("_2_1")), part(value, F.col("event_id") % 2 == 0), F.concat(problem, F.lit("_3_1")), part(F.lit("choice_9"), F.lit(True)))
    tags = F.create_map(F.lit("difficulty"), F.array(F.when(F.col("event_id") % 2 == 0, "easy").otherwise("hard")), F.lit("skill"), F.array(F.lit("s1"), F.concat(F.lit("s"), (F.col("event_id") % 5).cast("string"))))
    return e.select("course_id", problem.alias("problem_id"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"), "ts", answers.alias("answers"), (F.col("event_id") % 2 == 0).alias("is_correct"), tags.alias("tags"))


def _tree(s, d):
    """One course: the world holds regions, they hold nations, they hold suppliers; nation 3 hangs under two regions."""
    c = F.lit("course-v1:w+o+r").alias("course_id")
    r = table(s, d, "region").select("r_regionkey", F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"), F.col("r_name").alias("name"))
    n = table(s, d, "nation").select("n_nationkey", "n_regionkey", F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"))
    u = table(s, d, "supplier").select("s_suppkey", "s_nationkey", F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"))
    root = s.range(1).select(F.lit("root").alias("id"), F.lit("World").alias("name"))
    kinds = [(root, "course"), (r, "chapter"), (n, "sequential"), (u, "vertical")]
    blocks = None
    for df, kind in kinds:
        one = df.select(c, F.col("id").alias("block_id"), F.lit(kind).alias("block_type"), F.col("name").alias("display_name"), (F.col("id") == "root").alias("is_root"))
        blocks = one if blocks is None else blocks.unionByName(one)
    edge = lambda p, k, at: (c, p.alias("parent"), at.cast("int").alias("at"), k.alias("child"))
    edges = r.select(*edge(F.lit("root"), F.col("id"), F.col("r_regionkey"))).unionByName(n.where("n_regionkey < 4").select(*edge(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), F.col("id"), F.col("n_nationkey"))))
    edges = edges.unionByName(n.where("n_nationkey = 3").select(*edge(F.lit("r4"), F.col("id"), F.col("n_nationkey")))).unionByName(u.select(*edge(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")), F.col("id"), F.col("s_suppkey"))))
    return blocks, edges


def _outline(s, d):
    """Nations of region 4 have no way from the root, so they and their suppliers are orphans."""
    return O.course_outline(*_tree(s, d))


def _runs(s, d):
    li = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("type"), F.col("l_extendedprice").alias("price"), F.lit("USD").alias("currency"))).alias("seats"),
        F.collect_list(F.struct((F.col("l_partkey") % 5).cast("string").alias("uuid"), F.col("l_linestatus").alias("type"), F.lit("T").alias("title"))).alias("programs"))
    return li.select(F.col("l_orderkey").cast("string").alias("course_id"), (F.col("l_orderkey") % 7).cast("string").alias("catalog_course"), "seats", "programs")


def _programs(s, d):
    p = s.range(5).select(F.col("id").cast("string").alias("uuid"), F.transform(F.sequence(F.col("id"), F.lit(6)), lambda i: F.struct(i.cast("string").alias("key"))).alias("courses"))
    return K.program_course_order(p)


def _lines(s, d):
    """Enrollment events as log lines, some with a prefix, some with the payload as text, some cut."""
    e = events(s, d)
    kind = F.when(F.col("kind") == "signup", "edx.course.enrollment.activated").when(F.col("kind") == "error", "edx.course.enrollment.deactivated").otherwise("page")
    body = F.to_json(F.struct("course_id", "user_id", F.lit("honor").alias("mode")))
    line = F.concat(F.lit('{"event_source": "server", "username": " u ", "event_type": "'), kind, F.lit('", "time": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('+00:00", "context": {"course_id": "'), F.col("course_id"), F.lit('", "user_id": '), F.col("user_id").cast("string"), F.lit('}, "event": '), F.when(F.col("event_id") % 2 == 0, body).otherwise(F.regexp_extract(F.to_json(F.array(body)), r"(?s)^\[(.*)\]$", 1)), F.lit("}"))
    return e.select(F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("log: "), line)).when(F.col("event_id") % 5 == 1, F.substring(line, 1, 40)).otherwise(line).alias("value"))


def _decoded(s, d):
    lines = _lines(s, d)
    return X.enrollment_events(X.decoded(R.parse_lines(lines)))


QUERIES = {
    "problem_answers_first_last": lambda s, d: P.first_and_last_answers(_checks(s, d)).drop("question", "response_type"),
    "answer_distribution": lambda s, d: P.answer_distribution(P.first_and_last_answers(_checks(s, d))).drop("variant"),
    "latest_problem_response": lambda s, d: P.latest_responses(_checks(s, d)),
    "tags_distribution": lambda s, d: P.tags_distribution(_checks(s, d)),
    "course_outline": _outline,
    "catalog_seats": lambda s, d: K.catalog_seats(_runs(s, d)),
    "program_courses_with_order": lambda s, d: K.program_courses_with_order(K.program_courses(_runs(s, d)), _programs(s, d)),
    "decode_enrollment_events": _decoded,
}

_CH = """SELECT course_id, 'p' || (k % 10) AS problem_id, 'user' || user_id AS username, ts, event_id, row_number() OVER (PARTITION BY course_id, 'p' || (k % 10), user_id ORDER BY ts) AS a, row_number() OVER (PARTITION BY course_id, 'p' || (k % 10), user_id ORDER BY ts DESC) AS z,
 count(*) OVER (PARTITION BY course_id, 'p' || (k % 10), user_id) AS n, min(ts) OVER (PARTITION BY course_id, 'p' || (k % 10), user_id) AS f FROM ev WHERE kind = 'purchase'"""
_PA = """SELECT *, problem_id || '_2_1' AS answer_id, 'choice_' || (event_id % 4) AS value, event_id % 2 = 0 AS correct FROM ch UNION ALL SELECT *, problem_id || '_3_1', 'choice_9', true FROM ch"""
_FL = "SELECT course_id, problem_id, username, ts, a = 1 AS is_first, z = 1 AS is_last, answer_id, value, CASE WHEN event_id % 3 = 0 THEN '' ELSE '2' END AS variant, correct FROM pa WHERE a = 1 OR z = 1"
_W = with_views(ch=_CH, pa=_PA, fl=_FL)
_TR = {
    "e": """SELECT 'root' AS p, 'r' || r_regionkey AS c, r_regionkey AS pos FROM region UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, n_nationkey FROM nation WHERE n_regionkey < 4 UNION ALL SELECT 'r4', 'n3', 3 UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, s_suppkey FROM supplier""",
    "b": """SELECT 'root' AS id, 'course' AS t, 'World' AS name UNION ALL SELECT 'r' || r_regionkey, 'chapter', r_name FROM region UNION ALL SELECT 'n' || n_nationkey, 'sequential', n_name FROM nation UNION ALL SELECT 's' || s_suppkey, 'vertical', s_name FROM supplier""",
    "w": """SELECT 'root' AS id, CAST([] AS BIGINT[]) AS pl, NULL AS parent, CAST([] AS VARCHAR[]) AS names UNION ALL SELECT w.c, [w.pos], w.p, ['World'] FROM e w JOIN b ON b.id = w.c WHERE w.p = 'root'
 UNION ALL SELECT y.c, [x.pos, y.pos], y.p, ['World', x2.name] FROM e x JOIN e y ON x.c = y.p JOIN b x2 ON x2.id = x.c WHERE x.p = 'root'
 UNION ALL SELECT z.c, [x.pos, y.pos, z.pos], z.p, ['World', x2.name, y2.name] FROM e x JOIN e y ON x.c = y.p JOIN e z ON y.c = z.p JOIN b x2 ON x2.id = x.c JOIN b y2 ON y2.id = y.c WHERE x.p = 'root'""",
    "v": "SELECT id, min(pl) AS pl, arg_min(parent, pl) AS parent, arg_min(names, pl) AS names FROM w GROUP BY ALL",
}
ORACLES = {
    "problem_answers_first_last": _W + " SELECT * FROM fl",
    "answer_distribution": _W + """ SELECT course_id, arg_max(problem_id, (ts, username)) AS problem_id, answer_id, arg_max(value, (ts, username)) AS value, arg_max(correct, (ts, username)) AS correct, 'Which?' AS question, count(*) FILTER (is_first) AS first_count, count(*) FILTER (is_last) AS last_count
 FROM fl GROUP BY course_id, answer_id, value || '_' || CASE WHEN variant = '' THEN '1' ELSE variant END""",
    "latest_problem_response": _W + " SELECT course_id, problem_id, username, answer_id, value AS answer, correct AS was_correct, n AS total_attempts, f AS first_attempt_date, ts AS last_attempt_date FROM pa WHERE z = 1",
    "tags_distribution": with_views(ch=_CH, g="SELECT course_id, problem_id, count(*) AS total_submissions, count(*) FILTER (event_id % 2 = 0) AS correct_submissions, arg_max(event_id, (ts, event_id)) AS e FROM ch GROUP BY ALL")
    + """ SELECT course_id, problem_id, total_submissions, correct_submissions, 'difficulty' AS tag_name, CASE WHEN e % 2 = 0 THEN 'easy' ELSE 'hard' END AS tag_value FROM g UNION ALL SELECT course_id, problem_id, total_submissions, correct_submissions, 'skill', unnest(['s1', 's' || (e % 5)]) FROM g""",
    "course_outline": "WITH " + ", ".join(f"{k} AS ({v})" for k, v in _TR.items()) + """ SELECT 'course-v1:w+o+r' AS course_id, b.id AS block_id, t AS block_type, b.name AS display_name, parent AS parent_block_id,
 CAST(CASE WHEN v.id IS NULL THEN (SELECT count(*) FROM b) ELSE row_number() OVER (ORDER BY v.id IS NULL, pl) - 1 END AS INTEGER) AS sort_idx, CASE WHEN v.id IS NULL THEN '(Deleted block :)' ELSE array_to_string(names, ' / ') END AS course_path,
 b.id = 'root' AS is_root, v.id IS NULL AS is_orphan, (SELECT count(*) FROM e WHERE e.c = b.id AND e.p IN (SELECT id FROM v)) > 1 AS is_dag FROM b LEFT JOIN v ON v.id = b.id""",
    "catalog_seats": "SELECT CAST(l_orderkey AS VARCHAR) AS course_id, l_returnflag AS course_seat_type, l_extendedprice AS course_seat_price, 'USD' AS course_seat_currency FROM lineitem",
    "program_courses_with_order": """SELECT CAST(l_orderkey AS VARCHAR) AS course_id, CAST(l_orderkey % 7 AS VARCHAR) AS catalog_course, CAST(l_partkey % 5 AS VARCHAR) AS program_id, l_linestatus AS program_type, 'T' AS program_title,
 CASE WHEN l_orderkey % 7 >= l_partkey % 5 THEN CAST(l_orderkey % 7 - l_partkey % 5 + 1 AS INTEGER) END AS program_slot_number FROM lineitem""",
    "decode_enrollment_events": with_views() + """ SELECT course_id, user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000000' AS time, CASE kind WHEN 'signup' THEN 'activated' ELSE 'deactivated' END AS type, 'honor' AS mode FROM ev WHERE kind IN ('signup', 'error') AND event_id % 5 <> 1""",
}
