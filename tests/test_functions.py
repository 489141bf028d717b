"""Small hand-written rows for decoding, ids, masking and the rules that SQL does not cover."""

import base64
import json

from pyspark.sql import functions as F

from lectern.functions import keys, text
from lectern.operators import engagement as G
from lectern.operators import events as X
from lectern.operators import outline, privacy, problems, video
from lectern.sources import logs, readers, sinks


def values(spark, rows, kind, make):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_course_ids(spark):
    ids = ["course-v1:a+b+c", "a/b/c", "a/b", "course-v1:a+b+c\n", "course-v1:a+b", None, ""]
    assert values(spark, ids, "string", keys.valid_course_id) == [True, True, False, False, False, False, False]
    assert values(spark, ids, "string", keys.org_of_course) == ["a", "a", None, None, None, None, None]
    urls = ["/courses/course-v1:a+b+c/info", "http://x/courses/a/b/c/", "/courses/v1/b/c/", "/xblock/block-v1:a+b+c+type@problem+block@p", "/about", None]
    assert values(spark, urls, "string", keys.course_key_from_url) == ["course-v1:a+b+c", "a/b/c", None, "course-v1:a+b+c", None, None]
    assert values(spark, ["course-v1:a+b+c d"], "string", lambda c: keys.filename_safe(c, "-")) == ["a-b-c-d"]


def decoded(spark, *rows):
    lines = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, value string").orderBy("i")
    return X.decoded(readers.parse_lines(lines), from_url=True)


def test_lines_and_payloads(spark):
    base = {"event_source": "server", "event_type": "/courses/a/b/c/", "time": "2013-12-17T15:38:32+00:00", "context": {"course_id": "", "user_id": 7}, "username": " u "}
    lines = [json.dumps(base | {"event": e}) for e in ({"a": 1}, '{"a": 1}', "", "a=1&b=2", [1], "x" * 508 + "POST", "not json")]
    rows = decoded(spark, *lines, "prefix " + lines[0], "# note", "", lines[0][:30]).select(F.to_json("payload").alias("p"), "time", "date", "username", "user_id", "course_id").collect()
    assert [r.p for r in rows] == ['{"a":1}', '{"a":1}', "{}", None, None, None, None, '{"a":1}']
    assert {(r.time, r.date, r.username, r.user_id, r.course_id) for r in rows} == {("2013-12-17T15:38:32.000000", "2013-12-17", "u", 7, "a/b/c")}


def test_context_course_rules(spark):
    def line(course, **more):
        return json.dumps({"event_source": "browser", "event_type": "x", "page": "http://h/courses/a/b/c/", "time": "2013-12-17T15:38:32", "event": "", "context": {"course_id": course}} | more)

    got = [r.course_id for r in decoded(spark, line("o/p/q"), line("bad"), line(""), json.dumps({"event_source": "browser", "page": "/courses/a/b/c/"})).collect()]
    assert got == ["o/p/q", None, "a/b/c", None]


def test_offsets_and_durations(spark):
    assert values(spark, ["12.5", "nan", "inf", "-1", "36001", "x", None], "string", video.valid_offset) == [12.5, None, None, None, None, None, None]
    assert values(spark, ["PT1H2M3S", "PT5M", "PT7S", "PT", "x"], "string", video.iso_duration) == [3723, 300, 7, None, None]


def test_escapes_and_ids(spark):
    raw = "a\tb\\n\\c\r\nd"
    assert values(spark, [raw], "string", lambda c: text.backslash_decode(text.backslash_encode(c))) == [raw]
    numbers = [0, 1, 12345, 2**32 - 1, 2**32, -1]
    assert values(spark, numbers, "long", lambda c: text.restore_id(text.remap_id(c, 7), 7)) == [0, 1, 12345, 2**32 - 1, None, None]
    assert values(spark, [123456], "long", lambda c: text.remap_id(c, 42)) == [273678626]
    codes = values(spark, ["", "a", "ab", "abc", "abcd", "Arbitrary Scope\ufffd|é|v"], "string", lambda c: text.base32(c.cast("binary")))
    assert codes == [base64.b32encode(x.encode()).decode() for x in ("", "a", "ab", "abc", "abcd", "Arbitrary Scope\ufffd|é|v")]
    assert values(spark, [*codes, "a", "A1======"], "string", lambda c: text.unbase32(c).cast("string")) == ["", "a", "ab", "abc", "abcd", "Arbitrary Scope\ufffd|é|v", None, None]
    assert values(spark, ["k"], "string", lambda c: text.decode_id(text.encode_id(c, F.lit("t"), F.lit("v")))) == [["k", "t", "v"]]


def test_masks(spark):
    said = "Mail Ann.Lee@x.org or +1 555 123 4567, see https://www.facebook.com/ann; Ann Lee is ann7 (77)"
    masked = values(spark, [said], "string", lambda c: privacy.mask_text(c, F.lit("ann7"), F.lit(77), F.lit("Ann Lee"), False))[0]
    assert masked == "Mail <<EMAIL>> or <<PHONE_NUMBER>>, see <<FACEBOOK>>; <<FULLNAME>> is <<USERNAME>> (<<USER_ID>>)"
    mails = ["o'brien@x.org", "a!b#c/d=e@x-y.co", "x@y", "call 555-1234 or (555) 123-4567", "+49 151 2345678", "3.1415926"]
    assert values(spark, mails, "string", lambda c: privacy.mask_phones(privacy.mask_emails(c))) == ["<<EMAIL>>", "<<EMAIL>>", "x@y", "call <<PHONE_NUMBER>> or <<PHONE_NUMBER>>", "<<PHONE_NUMBER>>", "3.1415926"]
    names = ["Ann (Bo) d/o Lee-Ray, Jr.", "The Can", "a+b"]
    df = spark.createDataFrame([(i, n, "ann Bo, LEE-RAY jr. Ann Bo Lee-Ray Jr; the can; a+b") for i, n in enumerate(names)], "i int, n string, t string")
    assert [r.m for r in df.orderBy("i").select(privacy.mask_fullname(F.col("t"), F.col("n")).alias("m")).collect()] == [
        "<<FULLNAME>> Bo, <<FULLNAME>> jr. <<FULLNAME>> Bo <<FULLNAME>> Jr; the can; a+b", "ann Bo, LEE-RAY jr. Ann Bo Lee-Ray Jr; <<FULLNAME>>; a+b", "ann Bo, LEE-RAY jr. Ann Bo Lee-Ray Jr; the can; a+b",
    ]


def test_masked_leaves(spark):
    texts = ['{"a": "x@y.org"}', "broken", '{"n": 5, "x@y.org": {"b": ["é \\" x@y.org", null, true]}, "l": [1.50]}', '["x@y.org"]', '"x@y.org"', "{}", None]
    assert values(spark, texts, "string", lambda c: privacy.mask_leaves(c, privacy.mask_emails)) == [
        '{"a": "<<EMAIL>>"}', "{}", '{"n": 5, "x@y.org": {"b": ["é \\" <<EMAIL>>", null, true]}, "l": [1.50]}', '["<<EMAIL>>"]', '"<<EMAIL>>"', "{}", "{}",
    ]


def test_masks_that_were_missed(spark):
    """Numbers with spaces, names after escaped line ends, messages and logs of wiki revisions."""
    assert values(spark, ["12 345 678 901", "1 2"], "string", privacy.mask_possible_phones) == ["<<POSSIBLE_PHONE_NUMBER>>", "1 2"]
    leaf = lambda c: privacy.mask_leaves(c, lambda v: privacy.mask_username(v, F.lit("ann")))
    texts = ["x\\nann y", "x\\\\nann", "x\nann", "\\nbob", "a\\b"]
    assert values(spark, [json.dumps([t]) for t in texts], "string", leaf) == [json.dumps([t.replace("ann", "<<USERNAME>>")]) for t in texts]
    row = spark.createDataFrame([(1, 7, "by\\nann", "ann", "said", "log", "1.2.3.4")], "id int, user_id long, content string, title string, user_message string, automatic_log string, ip_address string")
    people = spark.createDataFrame([(7, "ann", "Bo Lee")], "user_id long, username string, name string")
    assert tuple(privacy.mask_wiki_revision(row, people, 42).first())[2:] == ("by\\n<<USERNAME>>", "ann", "", "", "")


def test_what_is_exported(spark):
    base = {"event_source": "server", "event_type": "/courses/a/b/c/x", "time": "2013-12-17T15:38:32", "host": "h"}
    events = [base, base | {"event": {"_export": "False"}}, base | {"event": json.dumps({"_export": 0})}, base | {"host": "studio.edx.org"}, base | {"host": "mystudio.org"}, base | {"host": ""}, {k: v for k, v in base.items() if k != "host"}, base | {"context": {"course_user_tags": {"_export": "no"}}}]
    lines = spark.createDataFrame([(f" {json.dumps(e)} ",) for e in events], "line string")
    found = X.exportable(readers.parse_lines(lines, "line", ("line",)), readers.org_config(spark, {"a": {}}))
    assert sorted(r.line for r in found.collect()) == sorted(json.dumps(events[i]) for i in (0, 4, 6, 7))


def summary(spark, rows):
    columns = "username string, problem_attempts long, problems_attempted long, problems_completed long, problem_attempts_per_completed double, videos_viewed long, discussion_contributions long, days_active long"
    return spark.createDataFrame(rows, columns).withColumns({"course_id": F.lit("c"), "start_date": F.lit("2024-01-01").cast("date"), "end_date": F.lit("2024-01-08").cast("date")})


def test_metric_ranges_with_infinite_ratios(spark):
    inf = float("inf")
    rows = [(f"u{i}", 5, 5, 1, r, 0, 0, 1) for i, r in enumerate((1.0, 2.0, 3.0, inf, inf))] + [("idle", 0, 0, 0, inf, 0, 0, 0)]
    got = {(r.metric, r.range_type): (r.low_value, r.high_value) for r in G.metric_ranges(summary(spark, rows)).collect()}
    assert got["problem_attempts_per_completed", "low"] == (0.0, 1.6) and got["problem_attempts_per_completed", "high"] == (inf, inf)
    assert got["videos_viewed", "normal"] == (0.0, inf) and ("videos_viewed", "high") not in got
    segments = {(r.username, r.segment) for r in G.user_segments(summary(spark, rows), G.metric_ranges(summary(spark, rows))).collect()}
    assert ("u3", "struggling") in segments and ("u0", "struggling") not in segments


def outline_rows(spark, root, blocks, **how):
    courses = spark.createDataFrame([("c", root, blocks)], "course_id string, root string, blocks map<string, struct<id: string, type: string, display_name: string, children: array<string>>>")
    rows = outline.course_outline(*outline.edges_of(courses), **how).collect()
    return sorted(((r.block_id, r.block_type, r.display_name, r.is_root, r.is_orphan, r.is_dag, r.parent_block_id, r.course_path, r.sort_idx) for r in rows), key=lambda r: r[-1])


def test_outline(spark):
    block = lambda i, *children, kind="block": (i, kind, i.upper(), list(children) or None)
    assert outline_rows(spark, "abc", {"abc": block("abc", kind="course")}) == [("abc", "course", "ABC", True, False, False, None, "", 0)]
    many = {b[0]: b for b in (block("abc", "def", "stu"), block("def", "jkl", "mno"), block("ghi"), block("jkl", "vwx"), block("mno", "pqr"), block("pqr", "jkl"), block("stu"), block("vwx"))}
    want = [
        ("abc", "block", "ABC", True, False, False, None, "", 0), ("def", "block", "DEF", False, False, False, "abc", "ABC", 1), ("jkl", "block", "JKL", False, False, True, "def", "ABC / DEF", 2),
        ("vwx", "block", "VWX", False, False, False, "jkl", "ABC / DEF / JKL", 3), ("mno", "block", "MNO", False, False, False, "def", "ABC / DEF", 4), ("pqr", "block", "PQR", False, False, False, "mno", "ABC / DEF / MNO", 5),
        ("stu", "block", "STU", False, False, False, "abc", "ABC", 6), ("ghi", "block", "GHI", False, True, False, None, "(Deleted block :)", 8),
    ]
    assert outline_rows(spark, "abc", many) == want
    assert outline_rows(spark, "abc", many, orphans_first=True) == [(*want[-1][:-1], -1), *want[:-1]]


def test_outline_of_ways_that_return_and_of_many_levels(spark):
    rows = outline_rows(spark, "r", {"r": ("r", "course", "R", ["a", "a"]), "a": ("a", "html", "A", ["r", "a", "none"])})
    assert [(r[0], r[5], r[7], r[8]) for r in rows] == [("r", True, "", 0), ("a", True, "R", 1)]
    deep = {f"b{i}": (f"b{i}", "html", f"B{i}", [f"b{i + 1}"] if i < 55 else None) for i in range(56)}
    rows = outline_rows(spark, "b0", deep)
    assert not any(r[4] for r in rows) and rows[-1][7].count(" / ") == 54 and rows[-1][8] == 55


def test_location_of_responses(spark):
    df = spark.createDataFrame([("c", "x", "Sum", 2), ("c", "gone", "Old", 1)], "course_id string, problem_id string, problem string, first_attempt_date int")
    blocks = spark.createDataFrame([("c", "x", "R / A", 3)], "course_id string, block_id string, course_path string, sort_idx int")
    assert [(r.location, r.sort_idx) for r in problems.response_location(df, blocks).collect()] == [("(Deleted block :) / Old", -1), ("R / A / Sum", 3)]


def test_organisations_of_events(spark):
    context = {"course_id": "course-v1:own+c+r"}
    events = [
        ({"event_source": "server", "event_type": "/courses/a/b/c/x", "context": {"org_id": "ctx"}}, "ctx"), ({"event_source": "server", "event_type": "/courses/course-v1:n+c+r/x", "context": context}, "n"),
        ({"event_source": "server", "event_type": "/courses/a/b/c/x"}, "a"), ({"event_source": "server", "event_type": "/about"}, None), ({"event_source": "server", "event_type": "save_problem_fail", "event": {"problem_id": "i4x://org/b/p"}}, "org"),
        ({"event_source": "server", "event_type": "other", "context": context, "event": {}}, None), ({"event_source": "browser", "event_type": "x", "page": "https://h/courses/a/b/c/", "event": "problem-foo-bar"}, "a"),
        ({"event_source": "browser", "event_type": "x", "page": "https://h/about", "event": "problem-foo-bar", "context": {"org_id": "ctx"}}, None), ({"event_source": "browser", "event_type": "x", "page": "https://h/courses/course-v1:n+c+r/"}, "n"),
        ({"event_source": "mobile", "event_type": "x", "context": context}, None), ({"event_source": "mobile", "event_type": "x", "context": {"org_id": "m"}}, "m"), ({"event_source": "task", "event_type": "x", "context": {"org_id": "m"}}, None),
    ]
    lines = spark.createDataFrame([(i, json.dumps(e)) for i, (e, _) in enumerate(events)], "i int, value string").orderBy("i")
    assert [r.o for r in readers.parse_lines(lines).select(X.event_org().alias("o")).collect()] == [o for _, o in events]


def test_files(spark, tmp_path):
    (tmp_path / "snap").write_text("1\x01ann\x01\\N\n2\x01bob\x01x\n")
    assert [tuple(r) for r in readers.read_snapshot(spark, str(tmp_path / "snap"), "id int, name string, note string").orderBy("id").collect()] == [(1, "ann", None), (2, "bob", "x")]
    (tmp_path / "dump.csv").write_text("1,'a\\'b','x,y'\n")
    assert [tuple(r) for r in readers.read_mysqldump_csv(spark, str(tmp_path / "dump.csv"), "id int, a string, b string").collect()] == [(1, "a'b", "x,y")]
    paths = spark.createDataFrame([("/l/tracking.log-20240105.gz",), ("/l/tracking.log-2024-02-05",), ("/l/t.1704412800.log",), ("/l/none",)], "path string")
    assert sorted(r.path for r in logs.select_log_files(paths, "2024-01-06", "2024-01-08").collect()) == ["/l/t.1704412800.log", "/l/tracking.log-20240105.gz"]
    df = spark.createDataFrame([("c1", "b"), ("c1", "a"), ("c2", "z")], "course_id string, answer string")
    sinks.write_answer_csv(df, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True)
    assert back.count() == 3 and len(list((tmp_path / "out").glob("*/*.csv"))) == 2


def test_ids_are_encoded_from_their_bytes_once(spark):
    """Bytes of a row are written as digits once, not for every symbol."""
    import base64

    from lectern.functions import text as H

    texts = ["", "a", "ab", "abc", "abcd", "abcde", "course|x|123456789", "é" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    coded = df.select("t", H.base32(F.col("t").cast("binary")).alias("c"))
    assert {r.t: r.c for r in coded.collect()} == {t: base64.b32encode(t.encode()).decode() for t in texts}
    assert [r.d for r in coded.select(H.unbase32(F.col("c")).cast("string").alias("d")).collect()] == texts
    assert coded._jdf.queryExecution().optimizedPlan().toString().count("hex(") == 1
