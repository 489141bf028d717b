"""Registered queries of exports, written files read back, masked tables and event decoding, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as H
from ..operators import catalog as K
from ..operators import events as X
from ..operators import outline as O
from ..operators import privacy as M
from ..operators import problems as P
from ..operators import shop as B
from ..operators import validation as V
from ..sources import readers as R
from ..sources import sinks as S
from ..sources.adapter import events, table, users, with_views
from ..streaming import reprocess as L
from . import structure, text


def _path(s):
    return S.shared_path(s)


def _lines(s, d):
    """Problem checks of servers, page events of browsers and events of phones, as log lines."""
    e = events(s, d)
    problem = F.concat(F.lit("i4x://org"), (F.col("k") % 3).cast("string"), F.lit("/c/problem/p"), (F.col("k") % 10).cast("string"))
    answers = F.to_json(F.struct(F.concat(F.lit("a"), (F.col("event_id") % 4).cast("string")).alias("x_2_1")))
    kind = F.when(F.col("kind") == "purchase", "problem_check").when(F.col("kind") == "view", F.concat(F.lit("/courses/"), "course_id", F.lit("/x"))).when(F.col("kind") == "signup", "save_problem_fail").otherwise("page_close")
    source = F.when(F.col("kind") == "click", "browser").when(F.col("kind") == "error", "mobile").otherwise("server")
    body = F.struct(
        problem.alias("problem_id"), F.when(F.col("event_id") % 2 == 0, "correct").otherwise("incorrect").alias("success"), F.from_json(answers, "map<string, string>").alias("answers"),
    )
    tags = F.struct(F.struct(F.struct(F.array(F.concat(F.lit("s"), (F.col("k") % 5).cast("string"))).alias("skill")).alias("saved_tags")).alias("tagging_aside"))
    org = F.when((F.col("kind") == "error") & (F.col("k") % 2 == 0), F.concat(F.lit("org"), (F.col("k") % 3).cast("string")))
    context = F.struct(F.col("course_id"), F.col("user_id"), org.alias("org_id"), tags.alias("asides"))
    line = F.to_json(F.struct(
        source.alias("event_source"), kind.alias("event_type"), F.lit("h.org").alias("host"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"), F.concat(F.lit("https://h.org/courses/"), "course_id", F.lit("/")).alias("page"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), context.alias("context"), body.alias("event"),
    ))
    return e.select("date", line.alias("event"))


def _decoded(s, d):
    """Written as compressed text by day, and read back as events."""
    path = _path(s)
    S.synthetic_log_files(_lines(s, d), path)
    return R.read_events(s, path)


def _problem_checks(s, d):
    df = X.problem_check_events(X.decoded(_decoded(s, d)))
    return df.select("course_id", "username", "time", "problem_id", "success", F.to_json("answers").alias("answers"))


def _tagged(s, d):
    df = X.tagged_problem_events(X.decoded(_decoded(s, d)))
    return df.select("course_id", "problem_id", "time", "is_correct", F.to_json("tags").alias("tags"))


def _exported(s, d):
    """Lines that each organisation may have; org2 takes part under another name and for one course. Some events come of
    the studio, of no host or of an empty one, and some are flagged."""
    orgs = R.org_config(s, {"org0": {}, "second": {"other_names": ["org2"], "courses": ["course-v1:org2+c2+2024"]}})
    second = F.substring(F.get_json_object("event", "$.time"), -2, 2).cast("int")
    host = F.element_at(F.array(F.lit("h.org"), F.lit(X.STUDIO), F.lit(""), F.lit("studio.h.org")), second % 4 + 1)
    flagged = F.when(second % 3 == 0, F.replace("event", F.lit('"success"'), F.lit('"_export":"False","success"'))).otherwise(F.col("event"))
    lines = _lines(s, d).withColumn("event", flagged).select("date", F.replace("event", F.lit('"host":"h.org"'), F.concat(F.lit('"host":"'), host, F.lit('"'))).alias("event"))
    path = _path(s)
    S.synthetic_log_files(lines, path)
    df = X.exportable(R.parse_lines(s.read.text(path).withColumnRenamed("value", "line"), "line", ("line",)), orgs)
    get = lambda p: F.get_json_object("line", f"$.{p}")
    return df.select("org", get("event_source").alias("source"), get("host").alias("host"), get("context.course_id").alias("course_id"), get("username").alias("username"), get("time").alias("time"))


def _location(s, d):
    responses = P.latest_responses(structure._checks(s, d)).withColumns({"problem": F.concat(F.lit("Problem "), "problem_id"), "problem_id": F.translate("problem_id", "p", "n")})
    return P.response_location(responses, structure._outline(s, d)).select("course_id", "problem_id", "username", "answer_id", "location", "sort_idx")


def _answers_file(s, d):
    """The answer distribution as files, one folder a course, read back."""
    path, df = _path(s), P.answer_distribution(P.first_and_last_answers(structure._checks(s, d)))
    S.write_answer_csv(df.select("course_id", "answer_id", "value", "first_count", "last_count"), path)
    return s.read.csv(path, header=True, schema="course_id string, answer_id string, value string, first_count long, last_count long, course_dir string")


def _modules(s, d):
    o = table(s, d, "orders")
    state = F.to_json(F.struct(F.concat(F.lit("write to mail"), "o_orderkey", F.lit("@x.org")).alias("answer"), (F.col("o_custkey") % 5).alias("n"), F.array(F.lit("plain")).alias("l")))
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("student_id"), F.concat(F.lit("course"), (F.col("o_orderkey") % 3).cast("string")).alias("course_id"), state.alias("state"))


def _modules_file(s, d):
    """Student states as tab-separated files, one folder a course, read back."""
    path = _path(s)
    S.export_student_module(_modules(s, d), path)
    return s.read.csv(path, header=True, sep="\t", schema="id long, student_id long, state string, course_id string").select("id", "student_id", "course_id", "state")


def _directory(s, d):
    u = users(s, d)
    return R.user_directory(u.select(F.col("user_id").alias("id"), F.concat(F.lit(" "), "username").alias("username")), u.select("user_id", "name"))


def _masked_modules(s, d):
    return M.mask_student_module(_modules(s, d), _directory(s, d), text.SEED).select("id", "student_id", "course_id", "state")


def _masked_wiki(s, d):
    o = table(s, d, "orders")
    said = F.concat(F.lit("by USER"), "o_custkey", F.lit("\\nuser"), "o_custkey", F.lit(" ("), "o_custkey", F.lit(") on www.facebook.com"))
    df = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), said.alias("content"), F.lit("a@b.org").alias("title"), F.lit("").alias("user_message"), F.lit("x").alias("automatic_log"), F.lit("1.2.3.4").alias("ip_address"))
    return M.mask_wiki_revision(df, _directory(s, d), text.SEED)


def _masked_posts(s, d):
    o = table(s, d, "orders")
    one = F.array(F.col("o_custkey").cast("string"))
    df = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("author_id"), F.concat(F.lit("user"), "o_custkey").alias("author_username"), F.concat(F.lit("call user"), "o_custkey", F.lit(" at 555-1234")).alias("body"), one.alias("abuse_flaggers"), F.struct(one.alias("up"), F.array().cast("array<string>").alias("down")).alias("votes"))
    return M.mask_forum_posts(df, _directory(s, d), text.SEED).select("id", "author_id", "author_username", "body", F.col("abuse_flaggers")[0].alias("flagger"), F.col("votes.up")[0].alias("voter"))


def _masked_structure(s, d):
    p = table(s, d, "part").select(F.col("p_partkey").alias("id"), F.element_at(F.array(F.lit("video"), F.lit("html")), (F.col("p_partkey") % 2 + 1).cast("int")).alias("category"), F.create_map(F.lit("name"), F.col("p_name"), F.lit("type"), F.col("p_type")).alias("metadata"))
    df = M.mask_course_structure(p, {"video": ["name"]})
    return df.select("id", F.array_join("redacted", ",").alias("redacted"), F.to_json("metadata").alias("metadata"))


def _masked_profile(s, d):
    u = users(s, d).select("user_id", "name", F.lit("Berlin").alias("city"), "gender", "year_of_birth")
    return M.mask_table(u, "auth_userprofile", text.SEED)


def _contacts(s, d):
    """How many learners have an address that fits the name picked for them."""
    df = M.fake_contact(users(s, d).select("username", F.lit("").alias("name"), F.lit("").alias("email")), ["Ann Bo", "Cy Dee"])
    fits = F.col("email") == F.concat(F.replace(F.lower("name"), F.lit(" "), F.lit("_")), F.lit("@example.com"))
    return df.agg(F.count("*").alias("n_learners"), F.count_if(fits).alias("n_fit"))


def _runs_files(s, d):
    """Catalog facts of course runs and subjects, from JSON lines written and read back."""
    path = _path(s)
    n = table(s, d, "nation").select(F.col("n_name").alias("course_id"), F.lit("c").alias("catalog_course"), F.lower("n_name").alias("catalog_course_title"), F.array(F.struct(F.col("n_name").alias("key"))).alias("course_runs"), F.array(F.struct(F.lower("n_name").alias("slug"), F.col("n_name").alias("name"))).alias("subjects"))
    n.write.json(path)
    back = R.read_catalog(s, path, "course_id string, catalog_course string, catalog_course_title string, course_runs array<struct<key: string>>, subjects array<struct<slug: string, name: string>>", "p")
    facts = K.catalog_courses(back)
    return facts.join(K.catalog_subjects(back, "/s/"), "course_id")


def _course_list(s, d):
    path = _path(s)
    table(s, d, "nation").select(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("id"), F.when(F.col("n_nationkey") % 5 > 0, F.lower("n_name")).alias("course_id"), F.concat(F.lit("T "), "n_name").alias("name"), F.lit("2024-01-01").alias("start")).write.json(path)
    return R.read_course_list(s, path).select("course_id", "name", "start_date")


def _dumps(s, d):
    """Customers as dumps of three formats, read back: fields that end at \\x01, comma-separated in quotes, tab-separated with escapes."""
    c, paths = table(s, d, "customer").select("c_custkey", "c_name", F.concat("c_mktsegment", F.lit("\t\\x"), "c_name").alias("note")), [_path(s) for _ in range(3)]
    c.select(F.concat_ws("\x01", "c_custkey", "c_name", F.lit("\\N"))).write.text(paths[0])
    c.select(F.concat(F.col("c_custkey").cast("string"), F.lit(",'"), "c_name", F.lit("\\'','a,b'"))).write.text(paths[1])
    c.select(F.concat_ws("\t", "c_custkey", "c_name", H.backslash_encode(F.col("note")))).write.text(paths[2])
    snapshot = R.read_snapshot(s, paths[0], "id long, a string, b string").select("id", F.col("a").alias("name"), F.col("b").isNull().alias("no_note"))
    csv = R.read_mysqldump_csv(s, paths[1], "id long, q string, m string").select("id", "q", "m")
    tsv = R.read_mysql_tsv(s, paths[2], "id long, t string, note string", True).select("id", "note")
    return snapshot.join(csv, "id").join(tsv, "id")


def _released(s, d):
    """How many events may be released, by source and type: some addresses, and what the whitelist names."""
    whitelist = s.createDataFrame([("browser", "page_close"), ("server", "problem_check"), ("server", "/courses/other")], "event_source string, event_type string")
    lines = _lines(s, d).withColumn("event", F.when(F.col("event").contains("/x"), F.replace("event", F.lit("/x"), F.lit("/info"))).otherwise(F.col("event")))
    df = X.releasable(R.parse_lines(lines, "event"), whitelist)
    return df.groupBy(X.field("event_source").alias("source"), X.field("event_type").alias("type")).agg(F.count("*").alias("n_events"))


def _metadata(s, d):
    """Purchases as answers, some with facts of their own; metadata names two of four choices."""
    e = events(s, d).where("kind = 'purchase'")
    k = F.col("event_id") % 4
    kind = F.when(k < 2, "choiceresponse").when(k == 2, "stringresponse").otherwise("")
    parts = e.select("event_id", F.concat(F.lit("a"), (F.col("k") % 3).cast("string")).alias("answer_id"), F.when(F.col("event_id") % 5 == 0, F.array(F.lit("own"))).alias("answer"), F.array(F.concat(F.lit("c"), k.cast("string"))).alias("answer_value_id"), kind.alias("response_type"), F.when(F.col("event_id") % 3 == 0, "Own?").alias("question"))
    lines = s.createDataFrame([('{"a0": {"question": "Zero?", "response_type": "choiceresponse", "answer_value_id_map": {"c0": "none", "c3": "three"}}, "a1": {"question": "One?", "response_type": "stringresponse"}}',)], "value string")
    df = P.with_metadata(parts, R.read_answer_metadata(lines))
    return df.select("event_id", "answer_id", F.array_join("answer", ",").alias("answer"), F.array_join("answer_value_id", ",").alias("value"), "response_type", "question")


def _history(s, d):
    """Enrollment events and validations, whose dumps began two days before them and end with them."""
    e = events(s, d).where("kind <> 'click'")
    kind = F.when(F.col("kind") == "signup", "activated").when(F.col("kind") == "error", "deactivated").when(F.col("kind") == "purchase", "mode_changed").otherwise("validated")
    e = e.select("event_id", "course_id", F.col("user_id"), "ts", kind.alias("type"), F.when(F.col("event_id") % 2 == 0, "honor").otherwise("verified").alias("mode"), F.when(F.col("kind") == "view", F.col("k") % 2 == 0).alias("is_active"))
    seen = F.col("type") == "validated"
    e = e.withColumns({"dump_start": F.when(seen, F.col("ts") - F.expr("INTERVAL 2 DAYS")), "dump_end": F.when(seen, F.col("ts"))})
    return V.reordered_in_dumps(e).select("event_id", "ts")


def _best_lines(s, d):
    """Order lines at the user's best price; of products, every fifth has no uuid."""
    p = table(s, d, "part").select(F.col("p_partkey").alias("product_id"))
    attributes = s.createDataFrame([(1, "UUID"), (2, "certificate_type")], "id long, code string")
    values = p.select("product_id", F.explode(F.array_compact(F.array(F.when(F.col("product_id") % 5 > 0, F.lit(1).cast("long")), F.lit(2).cast("long")))).alias("attribute_id"))
    values = values.withColumn("value_text", F.concat(F.when(F.col("attribute_id") == 1, "u").otherwise("x"), (F.col("product_id") % 7).cast("string")))
    products = B.product_uuids(p, attributes, values)
    li, o = table(s, d, "lineitem"), table(s, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    lines = li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.concat(F.lit("c"), (F.col("l_suppkey") % 3).cast("string")).alias("course_id"), F.col("l_quantity").cast("double").alias("price"))
    lines = lines.join(o, "order_id").join(products, "product_id")
    best = lines.groupBy("user_id", "course_id", "uuid").agg(F.max("price").alias("price"))
    return B.lines_at_best_price(lines, best)


def _expected(s, d):
    """Learners whose newest event is before the validation that was due."""
    df = V.expect_validation(events(s, d).select("course_id", "user_id", "ts", F.lit("activated").alias("type")), "2024-01-20")
    return df.where("type = 'missing'").select("course_id", "user_id", "ts")


def _validations(s, d):
    o = table(s, d, "orders").select(F.col("o_custkey").alias("user_id"), F.concat(F.lit("course-v1:o+c+r"), F.col("o_orderkey").cast("string")).alias("course_id"), (F.col("o_orderkey") % 2 == 0).alias("is_active"), F.lit("honor").alias("mode"), F.col("o_orderdate").cast("timestamp").alias("created"))
    df = X.validation_events(o, "2024-01-01T00:00:00.000000", "2024-01-02T00:00:00.000000")
    get = lambda p: F.get_json_object("event", f"$.{p}")
    return df.select("date", get("event_type").alias("type"), get("context.org_id").alias("org"), get("event.course_id").alias("course_id"), get("event.user_id").cast("long").alias("user_id"), get("event.is_active").alias("is_active"), get("event.created").alias("created"), get("synthesized.reason").alias("reason"))


def _texts(s, d):
    n = table(s, d, "nation")
    listed = F.array(F.concat(F.lit(" "), "n_name"), F.lower("n_name"))
    return n.select(
        "n_nationkey", H.stringify(listed).alias("listed"), H.clean_choice_text(F.concat(F.lit("<label for='x'>"), "n_name", F.lit("</label>\n  b"))).alias("choice"), H.record_text(F.col("n_name"), 4).alias("cut"), H.record_text(F.col("n_name"), 6, False).alias("fits"),
        L.received_date(F.when(F.col("n_nationkey") % 2 == 0, "2024-01-05T01:00:00"), F.lit("2024-01-04T23:00:00")).alias("received"), L.week_start(F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_nationkey").cast("int"))).alias("week"),
    )


QUERIES = {
    "problem_check_events": _problem_checks, "tagged_problem_events": _tagged, "exported_events": _exported, "problem_response_location": _location, "answer_files": _answers_file, "student_module_files": _modules_file,
    "mask_student_module": _masked_modules, "mask_wiki_revision": _masked_wiki, "mask_forum_posts": _masked_posts, "mask_course_structure": _masked_structure, "mask_user_profile": _masked_profile, "fake_contacts": _contacts,
    "catalog_files": _runs_files, "course_list_files": _course_list, "dump_files": _dumps, "expected_validations": _expected, "validation_events": _validations, "scalar_texts": _texts,
    "released_events": _released, "answers_with_metadata": _metadata, "lines_at_best_price": _best_lines, "reordered_validations": _history,
}
DATES = {"scalar_texts": ["week"]}

_SRC = "CASE kind WHEN 'click' THEN 'browser' WHEN 'error' THEN 'mobile' ELSE 'server' END"
_ORG = "CASE WHEN kind = 'error' THEN CASE WHEN k % 2 = 0 THEN 'org' || (k % 3) END ELSE 'org' || (k % 3) END"
_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000000' AS time"
_R = text._remap
_STATE = """'{"answer":"' || SAID || '","n":' || (o_custkey % 5) || ',"l":["plain"]}'"""


def _module(student, said):
    return f"SELECT o_orderkey AS id, {student} AS student_id, 'course' || (o_orderkey % 3) AS course_id, {_STATE.replace('SAID', said)} AS state FROM orders"


ORACLES = {
    "problem_check_events": with_views() + f""" SELECT course_id, 'user' || user_id AS username, {_TIME}, 'i4x://org' || (k % 3) || '/c/problem/p' || (k % 10) AS problem_id, CASE WHEN event_id % 2 = 0 THEN 'correct' ELSE 'incorrect' END AS success,
 '{{"x_2_1":"a' || (event_id % 4) || '"}}' AS answers FROM ev WHERE kind = 'purchase'""",
    "tagged_problem_events": with_views() + f""" SELECT course_id, 'i4x://org' || (k % 3) || '/c/problem/p' || (k % 10) AS problem_id, {_TIME}, event_id % 2 = 0 AS is_correct, '{{"skill":["s' || (k % 5) || '"]}}' AS tags FROM ev WHERE kind = 'purchase'""",
    "exported_events": with_views(t="SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time FROM ev", c="SELECT *, CAST(second(ts) AS INTEGER) AS h FROM t", x=f"SELECT *, {_SRC} AS source, {_ORG} AS org, ['h.org', '{X.STUDIO}', '', 'studio.h.org'][h % 4 + 1] AS host FROM c")
    + """ SELECT CASE org WHEN 'org2' THEN 'second' ELSE org END AS org, source, host, course_id, 'user' || user_id AS username, time FROM x WHERE org IN ('org0', 'org2') AND h % 4 IN (0, 3) AND h % 3 > 0""",
    "problem_response_location": f"""SELECT r.course_id, 'n' || substr(problem_id, 2) AS problem_id, username, answer_id, coalesce(course_path, '(Deleted block :)') || ' / Problem ' || problem_id AS location, coalesce(sort_idx, -1) AS sort_idx
 FROM ({structure.ORACLES["latest_problem_response"]}) r LEFT JOIN ({structure.ORACLES["course_outline"]}) o ON o.block_id = 'n' || substr(problem_id, 2)""",
    "answer_files": f"SELECT course_id, answer_id, value, first_count, last_count, sha1(course_id) AS course_dir FROM ({structure.ORACLES['answer_distribution']})",
    "student_module_files": _module("o_custkey", "'write to mail' || o_orderkey || '@x.org'"),
    "mask_student_module": _module(_R("o_custkey"), "'write to <<EMAIL>>'"),
    "mask_wiki_revision": f"""SELECT o_orderkey AS id, {_R('o_custkey')} AS user_id, 'by <<USERNAME>>\\n<<USERNAME>> (<<USER_ID>>) on www.<<EMAIL_CONTEXT>>.com' AS content, 'a@b.org' AS title, '' AS user_message, '' AS automatic_log, '' AS ip_address FROM orders""",
    "mask_forum_posts": f"SELECT o_orderkey AS id, CAST({_R('o_custkey')} AS VARCHAR) AS author_id, 'username_' || {_R('o_custkey')} AS author_username, 'call <<USERNAME>> at ' || CASE o_custkey WHEN 555 THEN '<<USER_ID>>-1234' WHEN 1234 THEN '555-<<USER_ID>>' ELSE '<<PHONE_NUMBER>>' END AS body, CAST({_R('o_custkey')} AS VARCHAR) AS flagger, CAST({_R('o_custkey')} AS VARCHAR) AS voter FROM orders",
    "mask_course_structure": """SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'type' ELSE 'name,type' END AS redacted, CASE WHEN p_partkey % 2 = 0 THEN '{"name":"' || p_name || '"}' ELSE '{}' END AS metadata FROM part""",
    "mask_user_profile": with_views("usr") + f" SELECT {_R('user_id')} AS user_id, '' AS name, '' AS city, gender, year_of_birth FROM usr",
    "fake_contacts": "SELECT count(*) AS n_learners, count(*) AS n_fit FROM customer",
    "catalog_files": "SELECT n_name AS course_id, 'c' AS catalog_course, lower(n_name) AS catalog_course_title, '/s/' || lower(n_name) AS subject_uri, n_name AS subject_title FROM nation",
    "course_list_files": "SELECT * FROM (SELECT coalesce(CASE WHEN n_nationkey % 2 = 0 THEN n_name END, CASE WHEN n_nationkey % 5 > 0 THEN lower(n_name) END) AS course_id, 'T ' || n_name AS name, '2024-01-01' AS start_date FROM nation) WHERE course_id IS NOT NULL",
    "dump_files": "SELECT c_custkey AS id, c_name AS name, true AS no_note, c_name || '''' AS q, 'a,b' AS m, c_mktsegment || chr(9) || '\\x' || c_name AS note FROM customer",
    "expected_validations": "SELECT course_id, user_id, TIMESTAMP '2024-01-20' AS ts FROM (" + with_views() + " SELECT course_id, user_id, max(ts) AS last FROM ev GROUP BY ALL) WHERE last < TIMESTAMP '2024-01-20'",
    "validation_events": """SELECT '2024-01-02' AS date, 'edx.course.enrollment.validated' AS type, 'o' AS org, 'course-v1:o+c+r' || o_orderkey AS course_id, o_custkey AS user_id, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS is_active,
 strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000000' AS created, 'found in snapshot' AS reason FROM orders""",
    "released_events": with_views(x=f"SELECT {_SRC} AS source, CASE kind WHEN 'purchase' THEN 'problem_check' WHEN 'view' THEN '/courses/' || course_id || '/info' WHEN 'signup' THEN 'save_problem_fail' ELSE 'page_close' END AS type FROM ev")
    + " SELECT source, type, count(*) AS n_events FROM x WHERE source = 'server' AND type LIKE '/courses/%' OR source = 'browser' AND type = 'page_close' OR source = 'server' AND type = 'problem_check' GROUP BY ALL",
    "lines_at_best_price": """WITH l AS (SELECT l_orderkey AS order_id, o_custkey AS user_id, 'c' || (l_suppkey % 3) AS course_id, CASE WHEN l_partkey % 5 > 0 THEN 'u' || (l_partkey % 7) END AS uuid, CAST(l_quantity AS DOUBLE) AS price
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey), b AS (SELECT user_id, course_id, uuid, max(price) AS price FROM l GROUP BY ALL)
 SELECT DISTINCT l.*, b.course_id AS best_course, b.uuid AS best_uuid FROM l JOIN b ON l.user_id = b.user_id AND l.price = b.price AND (l.course_id = b.course_id OR l.uuid = b.uuid)""",
    "answers_with_metadata": with_views(
        p="SELECT event_id, k % 3 AS a, event_id % 4 AS c, event_id % 5 = 0 AS own, CASE WHEN event_id % 4 < 2 THEN 'choiceresponse' WHEN event_id % 4 = 2 THEN 'stringresponse' ELSE '' END AS rt, event_id % 3 = 0 AS q FROM ev WHERE kind = 'purchase'",
        r="SELECT *, CASE WHEN rt = '' AND a = 0 THEN 'choiceresponse' WHEN rt = '' AND a = 1 THEN 'stringresponse' ELSE rt END AS response_type FROM p",
    ) + """ SELECT event_id, 'a' || a AS answer_id, CASE WHEN own THEN 'own' WHEN a = 2 OR a = 1 AND response_type = 'choiceresponse' THEN NULL WHEN response_type = 'choiceresponse' THEN CASE c WHEN 0 THEN 'none' WHEN 3 THEN 'three' ELSE '' END ELSE 'c' || c END AS answer,
 CASE WHEN NOT own AND a < 2 AND response_type <> 'choiceresponse' THEN NULL ELSE 'c' || c END AS value, response_type, CASE WHEN q THEN 'Own?' WHEN a = 0 THEN 'Zero?' WHEN a = 1 THEN 'One?' END AS question FROM r""",
    "reordered_validations": with_views(
        h="""SELECT event_id, course_id, user_id, ts, CASE kind WHEN 'signup' THEN 'activated' WHEN 'error' THEN 'deactivated' WHEN 'purchase' THEN 'mode_changed' ELSE 'validated' END AS type, CASE WHEN event_id % 2 = 0 THEN 'honor' ELSE 'verified' END AS mode, k % 2 = 0 AS act FROM ev WHERE kind <> 'click'""",
        b="""SELECT v.event_id AS v, e.ts, e.ts > v.ts - INTERVAL 2 DAY AND (v.act AND e.type = 'deactivated' OR NOT v.act AND e.type = 'activated' OR e.type = 'mode_changed' AND e.mode <> v.mode) AS bad
 FROM h v JOIN h e ON v.course_id = e.course_id AND v.user_id = e.user_id AND v.type = 'validated' AND e.ts < v.ts""",
        g="SELECT v, min(ts) AS first FROM b WHERE bad AND NOT EXISTS (SELECT 1 FROM b c WHERE c.v = b.v AND NOT c.bad AND c.ts >= b.ts) GROUP BY v",
    ) + " SELECT event_id, coalesce(first - INTERVAL 1 MICROSECOND, ts) AS ts FROM h LEFT JOIN g ON v = event_id",
    "scalar_texts": """SELECT n_nationkey, '[' || n_name || '|' || lower(n_name) || ']' AS listed, n_name || ' b' AS choice, substr(n_name, 1, 4) AS cut, CASE WHEN length(n_name) <= 6 THEN n_name END AS fits,
 CASE WHEN n_nationkey % 2 = 0 THEN '2024-01-05' ELSE '2024-01-04' END AS received, CAST(date_trunc('week', DATE '2024-01-01' + CAST(n_nationkey AS INTEGER)) AS DATE) AS week FROM nation""",
}
