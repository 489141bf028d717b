"""Registered validation queries and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import validation as V
from ..sources import readers as R
from ..sources import sinks as S
from ..sources.adapter import END, START, events, pick, with_views

EXPECTED = "2024-01-25"


def _history(s, d):
    """Enrollment events, and views as validations."""
    kind = pick(F.col("kind"), signup="activated", error="deactivated", purchase="mode_changed", view="validated")
    mode = F.when(F.col("event_id") % 2 == 0, "honor").otherwise("verified")
    e = events(s, d).withColumn("type", kind).where(F.col("type").isNotNull())
    seen = F.col("type") == "validated"
    return e.select("course_id", "user_id", "ts", "type", mode.alias("mode"), F.when(seen, F.col("k") % 2 == 0).alias("is_active"), F.when(seen, F.col("ts") - F.expr("INTERVAL 5 DAYS")).alias("created"))


def _chain(s, d):
    """From log lines and snapshots to files of the events that are missing, read back. Every option but the earliest time is on."""
    h, path = _history(s, d), S.shared_path(s)
    body = F.struct("course_id", "user_id", "mode")
    kind = F.concat(F.lit(V.PREFIX), "type")
    line = F.to_json(F.struct(F.lit("server").alias("event_source"), kind.alias("event_type"), F.concat(V.iso(F.col("ts")), F.lit("+00:00")).alias("time"), F.struct("course_id").alias("context"), body.alias("event")))
    lines = h.where("type <> 'validated'").select(line.alias("value")).unionByName(h.limit(3).select(F.lit("# no event").alias("value")))
    dumps = h.where("type = 'validated'").select("user_id", "course_id", "is_active", "mode", "created", (F.col("ts") - F.expr("INTERVAL 2 DAYS")).alias("dump_start"), F.col("ts").alias("dump_end"))
    S.synthetic_log_files(V.validate_enrollments(lines, dumps, START, END, EXPECTED, nonstate=True), path)
    get = lambda p: F.get_json_object("value", f"$.{p}")
    return s.read.text(path).select(
        get("event.course_id").alias("course_id"), get("event.user_id").cast("long").alias("user_id"), get("time").alias("time"), F.replace(get("event_type"), F.lit(V.PREFIX), F.lit("")).alias("type"), get("event.mode").alias("mode"),
        get("context.org_id").alias("org"), get("synthesized.reason").alias("reason"), get("synthesized.after_time").alias("after_time"), get("synthesized.before_time").alias("before_time"), F.col("date").cast("string").alias("file_date"),
    )


QUERIES = {"missing_enrollment_events": lambda s, d: V.missing_enrollment_events(_history(s, d), START), "enrollment_validation": _chain}

_H = """SELECT event_id, course_id, user_id, ts, CASE kind WHEN 'signup' THEN 'activated' WHEN 'error' THEN 'deactivated' WHEN 'purchase' THEN 'mode_changed' ELSE 'validated' END AS type, CASE WHEN event_id % 2 = 0 THEN 'honor' ELSE 'verified' END AS mode,
 coalesce(CASE WHEN kind = 'view' THEN k % 2 = 0 END, false) AS act, CASE WHEN kind = 'view' THEN ts - INTERVAL 5 DAY END AS created FROM ev WHERE kind <> 'click'"""
_SAID = "CASE WHEN {0}.type = 'validated' THEN 'validate' || CASE WHEN {0}.act THEN '(active)' ELSE '(inactive)' END WHEN {0}.type = 'mode_changed' THEN 'mode_change' WHEN {0}.type = 'missing' THEN 'missing' ELSE replace({0}.type, 'ated', 'ate') END"


def _missing(h: str, extra: bool) -> dict[str, str]:
    """Common table expressions whose last, ``made``, has the missing events of the history ``h``."""
    x, fact = str(extra).lower(), "{'ts': ts, 'type': type, 'mode': mode, 'act': act}"
    stated = f"CASE WHEN type <> 'mode_changed' THEN {fact} END"
    one = "INTERVAL 1 MICROSECOND"
    return {
        "w": f"""SELECT *, {fact} AS e, last_value({stated} IGNORE NULLS) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a, lag({fact}) OVER p AS n, last_value({stated} IGNORE NULLS) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f,
 last_value(CASE WHEN type = 'validated' THEN created END IGNORE NULLS) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS born, lead(1) OVER p IS NULL AS oldest FROM {h} WINDOW p AS (PARTITION BY course_id, user_id ORDER BY ts DESC, type DESC, mode DESC)""",
        "c": f"""SELECT *, CASE WHEN type = 'activated' AND (a.type = 'missing' OR a.type = 'validated' AND NOT a.act OR {x} AND a.type = 'activated') THEN 'deactivated'
 WHEN type = 'deactivated' AND (a.type = 'validated' AND a.act OR {x} AND a.type = 'deactivated') THEN 'activated' WHEN {x} AND type = 'deactivated' AND a.type = 'missing' THEN 'deactivated'
 WHEN type = 'validated' AND act AND (a.type = 'validated' AND NOT a.act OR {x} AND a.type = 'activated') THEN 'deactivated' WHEN type = 'validated' AND NOT act AND (a.type = 'validated' AND a.act OR {x} AND a.type = 'deactivated') THEN 'activated' END AS found FROM w""",
        "made": f"""SELECT course_id, user_id, ts + {one} AS ts, found AS type, mode, {_SAID.format('e')} || ' => ' || {_SAID.format('a')} AS reason, ts AS after_time, a.ts AS before_time FROM c WHERE found IS NOT NULL
 UNION ALL SELECT course_id, user_id, CASE WHEN found IS NULL THEN ts + {one} ELSE ts + {one} + {one} END, 'mode_changed', n.mode, {_SAID.format('e')} || ' => ' || {_SAID.format('n')} || ' (' || mode || '=>' || n.mode || ')', CASE WHEN found IS NULL THEN ts ELSE ts + {one} END, n.ts FROM c WHERE n.type IN ('deactivated', 'validated') AND n.mode <> mode
 UNION ALL SELECT course_id, user_id, born, 'activated', mode, 'start => ' || {_SAID.format('f')}, born, f.ts FROM c WHERE oldest AND born >= TIMESTAMP '{START}' AND (f.type = 'deactivated' OR f.type = 'validated' AND (f.act OR {x}))
 UNION ALL SELECT course_id, user_id, born + {one}, 'deactivated', mode, 'start => ' || {_SAID.format('f')}, born, f.ts FROM c WHERE {x} AND oldest AND born >= TIMESTAMP '{START}' AND f.type = 'validated' AND NOT f.act""",
    }


_MOVED = {
    "b": """SELECT v.event_id AS v, e.ts, e.ts > v.ts - INTERVAL 2 DAY AND (v.act AND e.type = 'deactivated' OR NOT v.act AND e.type = 'activated' OR e.type = 'mode_changed' AND e.mode <> v.mode) AS bad
 FROM h v JOIN h e ON v.course_id = e.course_id AND v.user_id = e.user_id AND v.type = 'validated' AND e.ts < v.ts""",
    "g": "SELECT v, min(ts) AS first FROM b WHERE bad AND NOT EXISTS (SELECT 1 FROM b c WHERE c.v = b.v AND NOT c.bad AND c.ts >= b.ts) GROUP BY v",
    "m": "SELECT course_id, user_id, coalesce(first - INTERVAL 1 MICROSECOND, ts) AS ts, type, mode, act, created FROM h LEFT JOIN g ON v = event_id",
    "x": f"SELECT * FROM m UNION ALL SELECT course_id, user_id, TIMESTAMP '{EXPECTED}', 'missing', NULL, false, NULL FROM m GROUP BY ALL HAVING max(ts) < TIMESTAMP '{EXPECTED}'",
}
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"
ORACLES = {
    "missing_enrollment_events": with_views(h=_H, **_missing("h", False)) + " SELECT * FROM made",
    "enrollment_validation": with_views(h=_H, **_MOVED, **_missing("x", True))
    + f" SELECT course_id, user_id, {_ISO.format('ts')} AS time, type, mode, replace(split_part(course_id, '+', 1), 'course-v1:', '') AS org, reason, {_ISO.format('after_time')} AS after_time, {_ISO.format('before_time')} AS before_time, strftime(ts, '%Y-%m-%d') AS file_date FROM made",
}
