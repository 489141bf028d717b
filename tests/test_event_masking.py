"""Masked events, row by row, and trees rewritten by rules."""

import json

import pytest
from pyspark.sql import functions as F

from lectern.operators import event_masking as E
from lectern.sources import readers

SEED = 42
IDS = {1: 2048, 2: 2147483648, 3: 2147485696, 4: 8388608}
BASE = {
    "username": "staff", "host": "test_host", "event_source": "server", "event_type": "edx.course.enrollment.activated", "context": {"course_id": "a/b/c", "org_id": "a", "user_id": 4},
    "time": "2013-12-17T15:38:32.805444+00:00", "ip": "127.0.0.1", "event": {"course_id": "a/b/c", "mode": "honor"},
}
WANT = {"username": "username_8388608", "event_source": "server", "event_type": BASE["event_type"], "context": {"course_id": "a/b/c", "org_id": "a", "user_id": 8388608}, "time": BASE["time"], "event": BASE["event"], "augmented": {"country_code": "UNKNOWN"}}
SAID = "audit performed by John, +1(805)213-4567  john@example.com"
KNOWN = "<<FULLNAME>> performed by <<FULLNAME>>, <<PHONE_NUMBER>>  <<EMAIL>>"

#: What an event differs in, and what its masked form differs in.
CASES = [
    ({"username": "audit", "context": {"user_id": 2}}, {"username": "username_2147483648", "context": {"user_id": 2147483648}}),
    ({"username": "does_not_match_2", "context": {"user_id": 2}}, {"username": E.REDACTED, "context": {"user_id": 2147483648}}),
    ({"username": "audit", "context": {"user_id": "2"}}, {"username": "username_2147483648", "context": {"user_id": 2147483648}}),
    ({"username": "audit", "context": {"user_id": ""}}, {"username": "username_2147483648", "context": {"user_id": ""}}),
    ({"username": "unmapped", "context": {"user_id": 12345}}, {"username": E.REDACTED, "context": {"user_id": 302000641}}),
    ({"context": {"user_id": 2, "username": "audit"}}, {"context": {"user_id": 2147483648, "username": "username_2147483648"}}),
    ({"context": {"user_id": 2, "username": " unmapped "}}, {"context": {"user_id": 2147483648, "username": E.REDACTED}}),
    ({"event": {"user_id": 2, "username": "audit", "instructor": "staff", "student": "unmapped", "user": "verified"}}, {"event": {"user_id": 2147483648, "username": "username_2147483648", "instructor": "username_8388608", "student": E.REDACTED, "user": "username_2147485696"}}),
    ({"event": '{"code": "6Fr", "user_id": 2, "currentTime": 630.437320479}'}, {"event": '{"code":"6Fr","currentTime":630.437320479,"user_id":2147483648}'}),
    ({"ip": "127.0.0.1", "referer": "http://h/blah", "page": "http://h/blah"}, {}),
    ({"context": {"host": "h", "ip": "127.0.0.1", "path": "http://h/"}}, {"context": {}}),
    ({"context": {"client": {"device": "d", "ip": "127.0.0.1", "os": {"name": "x"}}}}, {"context": {"client": {"os": {"name": "x"}}}}),
    ({"event": {"certificate_id": "i", "certificate_url": "u", "source_url": "u", "fileName": "f", "GET": {}, "POST": {}}}, {"event": {}}),
    ({"event": {"answer": {"file_upload_key": "k"}, "saved_response": {"file_upload_key": "k", "x": None}}}, {"event": {"answer": {}, "saved_response": {"x": None}}}),
    ({"event": {"answer": "choice", "n": [1, 2.5, True]}}, {"event": {"answer": "choice", "n": [1, 2.5, True]}}),
    ({"event": '{"POST": {"i": ["c"]}, "GET": {}}'}, {"event": "{}"}),
    ({"event": "input_2_1=choice_"}, {"event": "input_2_1=choice_"}), ({"event": ""}, {"event": ""}), ({"event": {}}, {"event": {}}), ({"event": ["staff"]}, {"event": ["staff"]}),
    ({"event": {"body": SAID}}, {"event": {"body": "audit performed by John, <<PHONE_NUMBER>>  <<EMAIL>>"}}),
    ({"event": {"username": "audit", "body": SAID}}, {"event": {"username": "username_2147483648", "body": KNOWN}}),
    ({"event": {"user_id": "2", "body": SAID}}, {"event": {"user_id": 2147483648, "body": KNOWN}}),
    ({"username": "audit", "event": {"body": SAID}}, {"username": "username_2147483648", "event": {"body": KNOWN}}),
    ({"context": {"user_id": 2}, "event": {"body": "x\\n" + SAID}}, {"context": {"user_id": 2147483648}, "event": {"body": "x\\n" + KNOWN}}),
    ({"event": {"any": ["nesting", {"of": "static", "in": {"done": "by staff"}, "contact": "phone +1(805)213-4567  staff@example.com"}]}}, {"event": {"any": ["nesting", {"of": "<<FULLNAME>>", "in": {"done": "by <<FULLNAME>>"}, "contact": "phone <<PHONE_NUMBER>>  <<EMAIL>>"}]}}),
    ({"ip": "10.0.0.7"}, {"augmented": {"country_code": "DE"}}),
    ({"ip": "2601:548:4001:2796:7dad:21a6:77df:d3dc"}, {"augmented": None}), ({"ip": ""}, {"augmented": None}),
    ({"augmented": {"country_code": "XX"}}, {}),
]


@pytest.fixture(scope="module")
def sides(spark):
    people = [(1, "honor", "Honor Student"), (2, "audit", "Audit John"), (3, "verified", "Verified Vera"), (4, "staff", "Static Staff"), (None, None, None)]
    directory = spark.createDataFrame(people, "user_id long, username string, name string")
    whitelist = spark.createDataFrame([("server", BASE["event_type"]), ("browser", "edx.instructor.report.downloaded")], "event_source string, event_type string")
    ranges = spark.createDataFrame([(10 << 24, (10 << 24) + 255, "DE", "Germany")], "lo long, hi long, country_code string, country_name string")
    return directory, whitelist, ranges


def test_masked_events(spark, sides):
    lines = spark.createDataFrame([(json.dumps(BASE | change), i) for i, (change, _) in enumerate(CASES)], "value string, line int")
    found = {r["line_no"]: json.loads(r["line"]) for r in E.masked_events(lines.withColumnRenamed("line", "line_no"), *sides, SEED).collect()}
    want = {i: {k: v for k, v in (WANT | change).items() if v is not None} for i, (_, change) in enumerate(CASES)}
    assert [(i, found.get(i)) for i in want if found.get(i) != want[i]] == []


def test_events_that_may_not_leave(spark, sides):
    course = "/courses/course-v1:x+y+z"
    kept = [{}, {"event_type": f"{course}/info"}, {"event_type": f"{course}/wiki/some/thing"}, {"event_source": "browser", "event_type": "edx.instructor.report.downloaded"}]
    gone = [{"synthesized": {"reason": "x"}}, {"event_type": f"{course}/modx"}, {"event_type": f"{course}/wiki/_action"}, {"event_source": "browser"}, {"event_type": None}, {"event_source": None}]
    lines = [json.dumps({k: v for k, v in (BASE | c).items() if v is not None}) for c in kept + gone] + ["broken {", ""]
    found = E.masked_events(spark.createDataFrame([(x, "c") for x in lines], "value string, course string"), *sides, SEED).collect()
    assert sorted(json.loads(r.line)["event_type"] for r in found) == sorted((BASE | c)["event_type"] for c in kept) and {(r.course, r.date) for r in found} == {("c", "2013-12-17")}


def test_rewritten_trees(spark):
    rules = {"a": None, "b": {"c": None, "d": {"e": lambda v: E.variant(F.lit("new"))}}, "f": lambda v: E.variant(F.try_variant_get(v, "$", "long") + 1)}
    trees = ['{"a":1,"b":{"c":1,"d":{"e":[1],"x":null},"y":2},"f":4,"z":"a"}', '{"b":[{"c":1}]}', "[1]", '"a"', "{}", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(trees)], "i int, t string").withColumn("v", F.parse_json("t"))
    assert [r.o for r in df.orderBy("i").select(F.to_json(E.rewrite(F.col("v"), rules)).alias("o")).collect()] == ['{"b":{"d":{"e":"new","x":null},"y":2},"f":5,"z":"a"}', '{"b":[{"c":1}]}', "[1]", '"a"', "{}", None]


def test_tables_of_a_course(spark, sides):
    rows = {"student_courseenrollment": spark.createDataFrame([(9, 4)], "id int, user_id long"), "courseware_studentmodule": spark.createDataFrame([(9, 4, '{"a": "by staff"}')], "id int, student_id long, state string")}
    masked = E.mask_course_tables(rows, sides[0], SEED)
    assert tuple(masked["student_courseenrollment"].first()) == (9, IDS[4]) and tuple(masked["courseware_studentmodule"].first())[1:] == (IDS[4], '{"a": "by <<FULLNAME>>"}')
    with pytest.raises(ValueError):
        E.mask_course_tables({"other": rows["student_courseenrollment"]}, sides[0], SEED)


def test_lines_keep_what_is_beside_them(spark):
    df = readers.parse_lines(spark.createDataFrame([('{"a": 1}', "x"), ("none", "y")], "value string, k string"), keep=("k",))
    assert [(r.k, r.e) for r in df.select("k", F.to_json("event").alias("e")).collect()] == [("x", '{"a":1}')]


def test_leaves_are_masked_once(spark):
    """What masks a text stands once in the plan, as nothing within a lambda is shared."""
    from lectern.operators import privacy as P

    df = spark.createDataFrame([('{"a":"x a@b.org","b":["Lee1"]}', ["user1"], ["Lee1"], [1])], "j string, u array<string>, n array<string>, i array<long>")
    masked = df.select(P.mask_leaves(F.col("j"), lambda text: P.mask_known(text, P.known_patterns(F.col("u"), F.col("i"), F.col("n")))).alias("m"))
    assert masked.first().m == '{"a":"x <<EMAIL>>","b":["<<FULLNAME>>"]}'
    assert masked._jdf.queryExecution().optimizedPlan().toString().count("<<EMAIL>>") == 1
