"""Missing enrollment events, on small histories: kinds a(ctivated), d(eactivated), m(ode changed), v(alidated active), i (validated inactive)."""

import datetime

import pytest
from pyspark.sql import functions as F

from lectern.operators import validation as V

A, D, M = "activated", "deactivated", "mode_changed"
KINDS = {"a": A, "d": D, "m": M, "v": "validated", "i": "validated"}
BORN = "2013-04-01 00:00:01.123456"


def at(text):
    return datetime.datetime.fromisoformat(text + ("" if "." in text else " 00:00:01.123456"))


def event(spec):
    """kind, time, mode; a validation's snapshot took the thirty seconds before it."""
    kind, time, *mode = spec.split("|")
    ts, seen = at(time), kind in "vi"
    return KINDS[kind], ts, (mode or ["honor"])[0], kind == "v" if seen else None, at(BORN) if seen else None, ts - datetime.timedelta(seconds=30) if seen else None, ts if seen else None


#: History, and what is missing: time, type, mode, reason, after, before. All transitions count, before the interval too.
ALL = [
    (["v|2013-09-01"], [(BORN, A, "honor", "start => validate(active)", BORN, "2013-09-01")]),
    (["i|2013-09-01"], [(BORN, A, "honor", "start => validate(inactive)", BORN, "2013-09-01"), ("2013-04-01 00:00:01.123457", D, "honor", "start => validate(inactive)", BORN, "2013-09-01")]),
    (["v|2013-09-01", "a|2013-04-01"], []),
    (["i|2013-09-01", "d|2013-05-01"], [(BORN, A, "honor", "start => deactivate", BORN, "2013-05-01")]),
    (["d|2013-05-01"], [("2013-05-01 00:00:01.123455", A, "honor", "start => deactivate", None, "2013-05-01")]),
    (["d|2013-05-01 00:00:01.000000"], [("2013-05-01 00:00:00.999999", A, "honor", "start => deactivate", None, "2013-05-01 00:00:01.000000")]),
    (["i|2013-09-01", "d|2013-05-01", "a|2013-04-01"], []),
    (["a|2013-04-01", "d|2013-09-01 00:00:00.123456", "v|2013-09-01"], []),
    (["a|2013-09-01", "d|2013-05-01", "a|2013-04-01"], []),
    (["v|2013-09-01", "v|2013-08-01", "v|2013-07-01"], [(BORN, A, "honor", "start => validate(active)", BORN, "2013-07-01")]),
    (["v|2013-09-01", "i|2013-08-01", "d|2013-05-01", "a|2013-04-01"], [("2013-08-01 00:00:01.123457", A, "honor", "validate(inactive) => validate(active)", "2013-08-01", "2013-09-01")]),
    (["i|2013-09-01", "v|2013-08-01", "a|2013-01-01"], [("2013-08-01 00:00:01.123457", D, "honor", "validate(active) => validate(inactive)", "2013-08-01", "2013-09-01")]),
    (["a|2013-09-01", "v|2013-08-01", "a|2013-04-01"], [("2013-08-01 00:00:01.123457", D, "honor", "validate(active) => activate", "2013-08-01", "2013-09-01")]),
    (["i|2013-09-01", "a|2013-04-01 00:00:01.999999"], [("2013-04-01 00:00:02.000000", D, "honor", "activate => validate(inactive)", "2013-04-01 00:00:01.999999", "2013-09-01")]),
    (["v|2013-09-01", "d|2013-08-01", "a|2013-01-01"], [("2013-08-01 00:00:01.123457", A, "honor", "deactivate => validate(active)", "2013-08-01", "2013-09-01")]),
    (["d|2013-09-01", "d|2013-08-01", "a|2013-01-01"], [("2013-08-01 00:00:01.123457", A, "honor", "deactivate => deactivate", "2013-08-01", "2013-09-01")]),
    (["a|2013-09-01", "a|2013-01-01"], [("2013-01-01 00:00:01.123457", D, "honor", "activate => activate", "2013-01-01", "2013-09-01")]),
    (["d|2013-10-01", "i|2013-09-01", "d|2013-08-01", "a|2013-04-01"], [("2013-09-01 00:00:01.123457", A, "honor", "validate(inactive) => deactivate", "2013-09-01", "2013-10-01")]),
    (["v|2013-09-01|verified", "a|2013-04-01"], [("2013-04-01 00:00:01.123457", M, "verified", "activate => validate(active) (honor=>verified)", "2013-04-01", "2013-09-01")]),
    (["m|2013-05-01", "a|2013-04-01"], []),
    (["v|2013-09-01|verified", "m|2013-05-01|verified", "a|2013-04-01"], []),
    (["v|2013-09-01|audited", "m|2013-05-01|verified", "a|2013-04-01"], [("2013-05-01 00:00:01.123457", M, "audited", "mode_change => validate(active) (verified=>audited)", "2013-05-01", "2013-09-01")]),
    (["m|2013-05-01|verified"], []),
    # a change of state and of mode at one place; the mode at the start is that of the oldest event
    (["i|2013-09-01|verified", "a|2013-04-01"], [("2013-04-01 00:00:01.123457", D, "honor", "activate => validate(inactive)", "2013-04-01", "2013-09-01"), ("2013-04-01 00:00:01.123458", M, "verified", "activate => validate(inactive) (honor=>verified)", "2013-04-01 00:00:01.123457", "2013-09-01")]),
    (["v|2013-09-01|verified", "m|2013-05-01|audit"], [(BORN, A, "audit", "start => validate(active)", BORN, "2013-09-01"), ("2013-05-01 00:00:01.123457", M, "verified", "mode_change => validate(active) (audit=>verified)", "2013-05-01", "2013-09-01")]),
]
#: Only changes of state, within the interval.
FEW = [
    (["v|2013-09-01"], ALL[0][1]), (["i|2013-09-01"], []), (["d|2013-05-01"], []), (["a|2013-09-01", "a|2013-01-01"], []), (["a|2013-09-01", "v|2013-08-01", "a|2013-04-01"], []),
    (["d|2013-09-01", "d|2013-08-01", "a|2013-01-01"], []), ALL[10], ALL[11], ALL[14],
]


def found(spark, histories, expected=None, **options):
    rows = [("c", i, *event(e)) for i, h in enumerate(histories) for e in h]
    df = spark.createDataFrame(rows, "course_id string, user_id long, type string, ts timestamp, mode string, is_active boolean, created timestamp, dump_start timestamp, dump_end timestamp")
    df = V.reordered_in_dumps(df)
    df = V.expect_validation(df, expected) if expected else df
    out = [[] for _ in histories]
    for r in V.missing_enrollment_events(df, "2013-01-01", **options).orderBy("ts").collect():
        out[r.user_id].append((r.ts, r.type, r.mode, r.reason, r.after_time, r.before_time))
    return out


def wanted(cases):
    time = lambda t: t and at(t)
    return [[(time(ts), k, m, r, time(a), time(b)) for ts, k, m, r, a, b in want] for _, want in cases]


@pytest.mark.parametrize("cases, options", [(ALL, {"nonstate": True, "before_start": True}), (FEW, {})])
def test_missing_events(spark, cases, options):
    assert found(spark, [h for h, _ in cases], **options) == wanted(cases)


def test_earliest_time_and_expected_validations(spark):
    late = found(spark, [["v|2013-09-01"], ["d|2013-09-01", "v|2013-05-02"]], nonstate=True, before_start=True, earliest="2013-06-01 00:00:00")
    assert [[r[:2] for r in x] for x in late] == [[(at("2013-06-01 00:00:00.000000"), A)], [(at("2013-06-01 00:00:00.000000"), A)]]
    marked = found(spark, [["a|2013-04-01"], ["d|2013-08-01", "a|2013-04-01"], ["a|2014-10-02"]], expected="2014-10-01 11:00:00", nonstate=True)
    assert [[(r[0], r[1], r[3]) for r in x] for x in marked] == [[(at("2013-04-01 00:00:01.123457"), D, "activate => missing")], [(at("2013-08-01 00:00:01.123457"), D, "deactivate => missing")], []]
    assert found(spark, [["d|2013-08-01", "a|2013-04-01"]], expected="2014-10-01 11:00:00") == [[]]


def test_lines_that_are_no_enrollment(spark):
    line = '{"event_source": "server", "event_type": "edx.course.enrollment.%s", "time": "%s", "event": {"course_id": "%s", "user_id": %s%s}}'
    good = line % (D, "2013-05-01T00:00:01+00:00", "a/b/c", 7, ', "mode": "honor"')
    lines = [good, good[:60], "", line % ("other", "2013-05-01T00:00:01", "a/b/c", 7, ', "mode": "honor"'), line % (D, "x", "a/b/c", 7, ', "mode": "honor"'), line % (D, "2013-05-01T00:00:01", "abc", 7, ', "mode": "honor"'), line % (D, "2013-05-01T00:00:01", "a/b/c", "null", ', "mode": "honor"'), line % (D, "2013-05-01T00:00:01", "a/b/c", 8, "")]
    dumps = spark.createDataFrame([], "user_id long, course_id string, is_active boolean, mode string, created timestamp, dump_start timestamp, dump_end timestamp")
    made = V.validate_enrollments(spark.createDataFrame([(x,) for x in lines], "value string"), dumps, "2013-01-01", "2014-01-01", before_start=True)
    get = lambda p: F.get_json_object("event", f"$.{p}")
    assert [tuple(r) for r in made.select(get("time"), get("event.user_id"), get("event_type"), get("synthesized.before_time"), get("synthesized.after_time")).collect()] == [("2013-05-01T00:00:00.999999", "7", V.PREFIX + A, "2013-05-01T00:00:01.000000", None)]


def test_missing_events_are_computed_before_they_are_listed(spark):
    """Events of a row stand in columns of their own before a filter of their list, below which nothing is compiled."""
    row = ("c", 1, "2024-01-02 00:00:00", "activated", "honor", None, None)
    df = spark.createDataFrame([row, (*row[:2], "2024-01-03 00:00:00", *row[3:])], "course_id string, user_id long, ts string, type string, mode string, is_active boolean, created timestamp").withColumn("ts", F.col("ts").cast("timestamp"))
    missing = V.missing_enrollment_events(df, "2024-01-01", nonstate=True)
    assert [(r.type, r.reason) for r in missing.collect()] == [("deactivated", "activate => activate")]
    assert missing._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 2
