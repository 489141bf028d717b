"""Records against their schema, trees flattened into them, and lines dealt to families, on small rows."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from lectern.functions import records as R
from lectern.functions.records import Field
from lectern.operators import families as X
from lectern.operators.events import decoded
from lectern.sources import readers

UTC = datetime.datetime


def checked(spark, field, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = R.enforce_schema(df, [field], keep=("i",)).orderBy("i").collect()
    return [(r.record.x, [v.rule for v in r.violations]) for r in rows]


def test_schema_rules(spark):
    assert checked(spark, Field("x", length=3), ["abc", "abcd", None, ""]) == [("abc", []), ("abcd", ["length"]), (None, []), ("", [])]
    assert checked(spark, Field("x", length=3, truncate=True, squeeze=True, nullable=False), ["a  bcd", None]) == [("a ", []), (None, ["null"])]
    assert checked(spark, Field("x", "integer"), ["12", "x", "1.5"]) == [(12, []), (None, ["type"]), (None, ["type"])]
    assert checked(spark, Field("x"), [12], "int") == [(None, ["type"])] and checked(spark, Field("x", "float"), [12], "int") == [(12.0, [])]
    assert checked(spark, Field("x", "boolean"), ["1", "0", "yes", None]) == [(True, []), (False, []), (False, []), (None, [])]
    assert checked(spark, Field("x", "date"), ["2013-1-02", "2013-13-01", "20130101"]) == [(datetime.date(2013, 1, 2), []), (None, ["type"]), (None, ["type"])]
    times = checked(spark, Field("x", "timestamp"), ["2013-01-02T03:04:05.000006", "2013-01-02 03:04:05", "1899-12-31 00:00:00", "2013"])
    assert times == [(UTC(2013, 1, 2, 3, 4, 5, 6), []), (UTC(2013, 1, 2, 3, 4, 5), []), (UTC(1899, 12, 31), ["range"]), (None, ["type"])]


def test_whole_records(spark):
    df = spark.createDataFrame([("a", "1"), ("bc", "x")], "name string, n string")
    schema = [Field("name", length=1), Field("n", "integer")]
    rows = R.enforce_schema(df, schema)
    assert [tuple(r) for r in R.clean_rows(rows).collect()] == [("a", 1)]
    assert sorted(tuple(r) for r in R.violations(rows).collect()) == [("n", "type", "x"), ("name", "length", "bc")]
    with pytest.raises(Exception, match="to the field"):
        R.strict_rows(rows).collect()
    with pytest.raises(ValueError, match="unknown fields: n"):
        R.enforce_schema(df, schema[:1])
    with pytest.raises(ValueError, match="missing: more"):
        R.enforce_schema(df, [*schema, Field("more")])
    assert R.clean_rows(R.enforce_schema(df.limit(1), [*schema, Field("more")], sparse=True)).first().more is None
    assert R.clean_rows(R.enforce_schema(df.limit(0), schema)).collect() == []
    with pytest.raises(ValueError):
        Field("x", length=0)


def test_flattened_trees(spark):
    trees = [
        {"A": {"B": "x\ty\u0000"}, "n": "12", "f": "1.5", "b": "", "t": "2013-12-17T15:38:32.805444+01:00", "l": [1]}, {"a": {"b": True}, "n": 1.9, "f": True, "b": "false", "t": "2013-12-17T15:38:32", "l": {"x": 1}},
        {"a": {"b": 1.5}, "n": "1.9", "f": "x", "b": 0, "t": "1800-01-01T00:00:00Z"}, {"a": "b", "n": None, "t": 5}, {"a": {"b": "0123456789"}},
    ]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(trees)], "i int, t string").withColumn("v", F.parse_json("t"))
    schema = [Field("text", length=9, path="root.a.b"), Field("n", "integer", path="root.n"), Field("f", "float", path="root.f"), Field("b", "boolean", path="root.b"), Field("t", "timestamp", path="root.t"), Field("l", path="root.l"), Field("own", "integer")]
    flat = R.flatten_by_mapping(df, "v", schema, keep=("i",), calculated={"own": F.col("i").cast("string")})
    assert [tuple(r.record) for r in flat.orderBy("i").collect()] == [
        ("x\\ty\\0", 12, 1.5, False, UTC(2013, 12, 17, 14, 38, 32, 805444), None, 0), ("True", 1, 1.0, True, None, None, 1), ("1.5", None, None, False, None, None, 2), (None, None, None, None, None, None, 3), ("01234...", None, None, None, None, None, 4),
    ]
    assert sorted((r.i, r.field, r.value) for r in R.rejected_values(flat, "i").collect()) == [(1, "t", '"2013-12-17T15:38:32"'), (2, "f", '"x"'), (2, "n", '"1.9"'), (2, "t", '"1800-01-01T00:00:00Z"'), (3, "t", "5")]
    with pytest.raises(ValueError):
        R.flatten_by_mapping(df, "v", [Field("x", path="a.b")])


def test_columns_and_tables_that_stay(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, email int, email_ok int")
    assert R.prune_columns(df, "auth_user", [r"auth_user\.email$", r"other\..*"]).columns == ["id", "email_ok"]
    assert R.keep_tables(["a", "ab", "b"], [], ["a"]) == ["b"] and R.keep_tables(["a", "ab", "b"], ["a"], ["ab"]) == ["a", "ab"] and R.keep_tables(["a"], [], []) == ["a"]


BASE = {"username": " ann ", "event_source": "server", "event_type": "page_close", "context": {"course_id": "a/b/c", "user_id": 7}, "time": "2013-12-17T15:38:32.5+00:00", "ip": "1.2.3.4", "event": {}}


def dealt(spark, *changes, **how):
    lines = [json.dumps({k: v for k, v in (BASE | c).items() if v is not None}) for c in changes]
    return X.deal(spark.createDataFrame([(x,) for x in lines], "value string"), **how)


def video(spark, kind, event, **more):
    rows = X.family(dealt(spark, {"event_type": kind, "event": event} | more), "video").collect()
    return [(r.module_id, r.current_time, r.old_time, r.youtube_id, r.duration) for r in rows]


def test_video_events(spark):
    assert video(spark, "play_video", {"id": "\nv ", "currentTime": "5.5", "code": "yt", "duration": 90}) == [("v", 5.5, None, "yt", 90.0)]
    assert video(spark, "play_video", '{"id": "v", "currentTime": 5, "code": "html5", "duration": null}') == [("v", 5.0, None, None, -1.0)]
    assert video(spark, "pause_video", {"id": "v"}) == [("v", 0.0, None, None, -1.0)] and video(spark, "play_video", {"id": "v"}) == [] and video(spark, "stop_video", {"id": "v"}) == []
    assert video(spark, "pause_video", {"id": "v", "currentTime": "x"}) == [] and video(spark, "pause_video", {"id": "v", "currentTime": None}) == []
    assert video(spark, "seek_video", {"id": "v", "new_time": 7, "old_time": 3}) == [("v", 7.0, 3.0, None, -1.0)] and video(spark, "seek_video", {"id": "v", "new_time": 7}) == []
    assert video(spark, "play_video", {"id": " ", "currentTime": 1}) == [] and video(spark, "play_video", {"id": "v", "currentTime": 1e9}) == [] and video(spark, "play_video", {"id": "v", "currentTime": "nan"}) == []
    assert video(spark, "play_video", {"id": "v", "currentTime": 1}, context={"course_id": "a/b/c", "user_id": ""}) == [] and video(spark, "play_video", {"id": "v", "currentTime": 1}, context={"course_id": "bad", "user_id": 7}) == []


def test_engagement_and_reports(spark):
    def found(name, *changes, **how):
        return [tuple(r)[1:] for r in X.family(dealt(spark, *changes, **how), name).drop("ts", "source").collect()]

    check = {"event_type": "problem_check", "event": {"problem_id": "p", "success": "Correct"}}
    assert found("engagement", check, check | {"event_source": "browser"}, check | {"username": "x" * 31}, check | {"username": ""}, check | {"event": {}}) == [("a/b/c", "ann", "problem_check", "p", True)]
    assert found("engagement", check | {"username": ""}, anonymous="nobody") == [("a/b/c", "nobody", "problem_check", "p", True)]
    forum = {"event_type": "edx.forum.thread.voted", "event": {"commentable_id": "f", "vote_value": "up", "undo_vote": True, "target_username": "bob"}}
    assert found("engagement", forum, {"event_type": "play_video", "event": {"id": "\nv"}}) == [("a/b/c", "ann", "edx.forum.thread.voted", "f", False), ("a/b/c", "ann", "play_video", "v", False)]
    assert found("report", forum, forum | {"event": {"vote_value": "x"}}, check, check | {"event": {}}, {"event": "a=b"}, {"event_type": "book"}) == [
        ("a/b/c", "ann", "edx.forum.thread.voted", None, False, "up", True, "bob"), ("a/b/c", "ann", "problem_check", "p", True, None, None, None), ("a/b/c", "ann", "book", None, False, None, None, None),
    ]
    assert found("address", {}, {"ip": ""}, {"context": {"user_id": 0}}, {"context": {"user_id": "x"}}, {"context": {"user_id": "8"}}) == [(7, "a/b/c", "1.2.3.4"), (8, None, "1.2.3.4")]
    assert found("activity", {}, {"event_source": "task"}, {"event_type": None}, {"time": None}, {"context": {"course_id": "", "user_id": 7}, "event_type": "/courses/x/y/z/"}) == [(7, "a/b/c", "page_close"), (7, "x/y/z", "/courses/x/y/z/")]


def test_problems_and_intervals(spark):
    check = {"event_type": "problem_check", "event": {"problem_id": "p", "success": "incorrect", "answers": {"a_2_1": ["x", "y"], "a_3_1": " z "}, "correct_map": {"a_2_1": {"correctness": "correct"}}, "submission": {"a_3_1": {"answer": "Z", "variant": 5, "correct": False, "response_type": "s", "question": "Q"}}}}
    rows = X.answer_parts(X.family(dealt(spark, check, check | {"event": {"problem_id": "p", "answers": {}}}, check | {"event": {"problem_id": "p", "answers": {"é": "x"}}}), "problem")).collect()
    assert [{k: tuple(v) for k, v in r.answers.items()} for r in rows] == [{"a_2_1": ("[x|y]", "", True, "", ""), "a_3_1": ("z", "5", False, "s", "Q")}]
    days = [{"time": f"2013-12-{d}T00:00:00"} for d in (15, 16, 17)]
    assert [str(r.date) for r in dealt(spark, *days, start="2013-12-16", end="2013-12-17").collect()] == ["2013-12-16"]
    lines = spark.createDataFrame([('{"event_type": "play_video"',), ("problem_check",), ("other",)], "value string")
    assert [r.value for r in X.lines_for(lines, ("video", "problem")).collect()] == ['{"event_type": "play_video"', "problem_check"] and X.lines_for(lines, ("video", "activity")).count() == 3
    assert X.deal(spark.createDataFrame([("",), ("# x",)], "value string")).collect() == []


def test_augmented_payloads_and_the_least_scan(spark):
    lines = spark.createDataFrame([(json.dumps(BASE | c),) for c in ({"event": {"a": 1, "username": "own"}}, {"event": "x=1"}, {"username": None}, {"context": None}, {"time": "x"})], "value string")
    df = X.augment_payload(decoded(readers.parse_lines(lines)), X.AUGMENTS)
    assert [json.loads(r.p) for r in df.select(F.to_json("payload").alias("p")).collect()] == [{"a": 1, "username": " ann ", "timestamp": 1387294712.5, "context": BASE["context"]}]
    assert X.augment_payload(decoded(readers.parse_lines(lines)), ["username"]).count() == 3
    with pytest.raises(ValueError):
        X.augment_payload(df, ["other"])
    assert [r.date for r in X.parse_only(lines, "2013-12-17", "2013-12-18").collect()] == ["2013-12-17"] * 4


def test_forum_posts(spark, tmp_path):
    post = {"_id": {"$oid": "5"}, "_type": "Comment", "author_id": "7", "body": "b", "votes": {"up": ["8"], "down": [], "count": 1}, "other": 1}
    (tmp_path / "posts.mongo").write_text(json.dumps(post) + "\n{broken\n\n")
    assert [(r._id[0], r.author_id, r.votes.up, r.title) for r in readers.read_forum_posts(spark, str(tmp_path)).collect()] == [("5", "7", ["8"], None)]


def test_objects_of_a_tree_are_read_once(spark):
    """Rejected values come from explode, under which every column would be computed anew."""
    df = spark.createDataFrame([('{"A":{"b":"x","C":2},"d":"z"}',)], "j string").select(F.parse_json("j").alias("t"))
    fields = [Field("b", "integer", path="root.a.b"), Field("c", "integer", path="root.a.c"), Field("d", "integer", path="root.d"), Field("e", "integer", path="root.d.e")]
    rejected = R.rejected_values(R.flatten_by_mapping(df, "t", fields))
    assert sorted(map(tuple, rejected.collect())) == [("b", "root.a.b", '"x"'), ("d", "root.d", '"z"')]
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_entries") == 3
