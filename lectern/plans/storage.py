"""Registered distributions, orders, enterprise and storage queries and their SQL. Storage queries write a table in the
warehouse or checkpoint folder that the session names, and read it again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import activity as A
from ..operators import enrollment as E
from ..operators import shop as S
from ..sources import readers as R
from ..sources import sinks
from ..sources.adapter import END, activity_events, enrollment_events, events, table, users, with_views
from ..streaming import reprocess as K
from .enrollment import _GRADES, STATE, _grades


def _course(k):
    c = (k % 3).cast("string")
    return F.concat(F.lit("course-v1:org"), c, F.lit("+c"), c, F.lit("+2024"))


def _modules(s, d):
    li = table(s, d, "lineitem")
    return li.select(
        _course(F.col("l_suppkey")).alias("course_id"), F.concat(F.lit("m"), F.col("l_partkey").cast("string")).alias("module_id"),
        F.when(F.col("l_returnflag") == "N", "sequential").otherwise("problem").alias("module_type"), F.when(F.col("l_linenumber") < 6, F.col("l_quantity")).alias("grade"), F.lit(50.0).alias("max_grade"),
    )


def _lines(s, d):
    li = table(s, d, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice", "l_returnflag")
    o = table(s, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), _course(F.col("l_suppkey")).alias("course_id"), (F.col("l_partkey") % 7).cast("string").alias("uuid"),
        F.col("l_extendedprice").alias("price"), (F.col("l_returnflag") == "R").alias("refunded"),
    )


def _enterprise(s, d):
    c = table(s, d, "customer")
    links = c.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i")).withColumn("course_id", _course(F.col("i"))).select((F.col("c_nationkey") % 5).alias("enterprise_id"), F.col("c_custkey").alias("user_id"), "course_id")
    r = table(s, d, "region")
    customers = r.select(F.col("r_regionkey").cast("int").alias("enterprise_id"), F.col("r_name").alias("enterprise_name"))
    courses = r.select(F.concat_ws("+", F.concat(F.lit("course-v1:org"), F.col("r_regionkey").cast("string")), F.concat(F.lit("c"), F.col("r_regionkey").cast("string")), F.lit("2024")).alias("course_id"), F.col("r_name").alias("course_title"), F.lit("2024-01-01").cast("date").alias("course_start"), F.date_add(F.lit("2024-02-01").cast("date"), F.col("r_regionkey").cast("int") * 5).alias("course_end"))
    social = table(s, d, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("id"), F.concat(F.lit("idp:"), F.col("o_orderkey").cast("string")).alias("uid"))
    grades = _grades(s, d).groupBy("user_id", "course_id").agg(F.max("letter_grade").alias("letter_grade"), F.max("passed_timestamp").alias("passed_timestamp"))
    prices = S.orders_best_price(_lines(s, d)).groupBy("user_id", "course_id").agg(F.max("price").alias("price"))
    discounts = c.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i")).withColumn("course_id", _course(F.col("i"))).select(F.col("c_custkey").alias("user_id"), "course_id", F.when(F.col("c_custkey") % 3 == 0, "Percentage").when(F.col("c_custkey") % 3 == 1, "Absolute").alias("benefit_type"), (F.col("c_custkey") % 40).cast("double").alias("benefit_value"))
    return links, customers, courses, social, grades, prices, discounts


def _enrollment(s, d):
    links, customers, courses, social, grades, prices, discounts = _enterprise(s, d)
    return S.enterprise_enrollment(links, customers, users(s, d), E.enrollment_summary(enrollment_events(s, d), END), grades, A.user_activity(activity_events(s, d)), courses, social, prices, discounts)


def _enterprise_user(s, d):
    links, customers, _, social, *_ = _enterprise(s, d)
    return S.enterprise_user(links, customers, users(s, d), social, A.user_activity(activity_events(s, d)))


def _by_day(s, d):
    return events(s, d).groupBy("date", "kind").agg(F.count("*").alias("n"))


def _written(s, d):
    """Write a table by day, replace two of its days, and read it again."""
    path, df = sinks.shared_path(s), _by_day(s, d)
    sinks.write_partition(df, path, "date")
    sinks.replace_slice(df.where("date IN ('2024-01-05', '2024-01-06')").withColumn("n", F.col("n") * 10), path, "date")
    return s.read.parquet(path).select("date", "kind", "n")


def _reprocessed(s, d):
    path, df = sinks.shared_path(s), _by_day(s, d)
    sinks.write_partition(df.withColumn("n", F.lit(0).cast("long")), path, "date")
    K.reprocess_recent(df, path, "2024-01-20", 3)
    return s.read.parquet(path).select("date", "kind", "n")


def _latest(s, d):
    return R.latest_partition(_by_day(s, d), "date")


def _swapped(s, d):
    path = sinks.shared_path(s)
    sinks.replace_result(_by_day(s, d), path, key=["date", "kind"])
    sinks.replace_by_swap(_by_day(s, d).where("kind <> 'error'"), path)
    return s.read.parquet(path)


def _nulls(s, d):
    x = F.when(F.col("k") % 4 == 0, F.lit(float("inf"))).when(F.col("k") % 4 == 1, F.lit(float("nan"))).otherwise(F.col("value"))
    t = F.when(F.col("k") % 3 == 0, "\\N").when(F.col("k") % 3 == 1, "None").otherwise(F.col("kind"))
    return sinks.result_nulls(events(s, d).select("event_id", x.alias("x"), t.alias("t")))


QUERIES = {
    "grade_distribution": lambda s, d: S.grade_distribution(_modules(s, d)),
    "sequential_open_distribution": lambda s, d: S.sequential_open_distribution(_modules(s, d)),
    "orders_best_price": lambda s, d: S.orders_best_price(_lines(s, d)),
    "order_line_counts": lambda s, d: S.order_line_counts(_lines(s, d)),
    "last_activity": lambda s, d: S.last_activity(A.user_activity(activity_events(s, d)), "user_id", "course_id"),
    "enterprise_enrollment": _enrollment,
    "enterprise_user": _enterprise_user,
    "write_and_replace_partition": _written,
    "reprocess_recent": _reprocessed,
    "read_latest_partition": _latest,
    "replace_result_by_swap": _swapped,
    "result_nulls": _nulls,
    "union_history": lambda s, d: R.union_history(_by_day(s, d).withColumn("n", F.lit(0).cast("long")), _by_day(s, d), "2024-01-15"),
    "user_directory": lambda s, d: R.user_directory(users(s, d).select(F.col("user_id").alias("id"), "username"), users(s, d)),
    "tumbling_weeks": lambda s, d: events(s, d).groupBy(K.week_start(F.col("date")).alias("week")).agg(F.count("*").alias("n")),
    "trailing_week": lambda s, d: events(s, d).where(K.trailing(F.col("date"), END)).groupBy("kind").agg(F.count("*").alias("n")),
}

_C = lambda x: f"'course-v1:org' || ({x} % 3) || '+c' || ({x} % 3) || '+2024'"
_MOD = f"SELECT {_C('l_suppkey')} AS course_id, 'm' || l_partkey AS module_id, CASE WHEN l_returnflag = 'N' THEN 'sequential' ELSE 'problem' END AS module_type, CASE WHEN l_linenumber < 6 THEN l_quantity END AS grade, CAST(50 AS DOUBLE) AS max_grade FROM lineitem"
_LIN = f"SELECT l_orderkey AS order_id, o_custkey AS user_id, {_C('l_suppkey')} AS course_id, CAST(l_partkey % 7 AS VARCHAR) AS uuid, l_extendedprice AS price, l_returnflag = 'R' AS refunded FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_UA = """SELECT user_id, course_id, date FROM act WHERE source <> 'task' AND type NOT LIKE 'edx.course.enrollment%'"""
_BD = "SELECT date, kind, count(*) AS n FROM ev GROUP BY ALL"
_ENT = {
    "links": f"SELECT c_nationkey % 5 AS enterprise_id, c_custkey AS user_id, {_C('i')} AS course_id FROM customer, (SELECT unnest([0, 1, 2]) AS i)",
    "cust": "SELECT r_regionkey AS enterprise_id, r_name AS enterprise_name FROM region",
    "soc": "SELECT o_custkey AS user_id, split_part(arg_max('idp:' || o_orderkey, o_orderkey), ':', -1) AS user_sso_id FROM orders GROUP BY ALL",
}

_ENR = with_views("enr", "act", "usr", st=STATE, f="SELECT *, type = 'activated' AND prior = 0 AS e, (type = 'activated' AND prior = 0) OR (type = 'mode_changed' AND prior = 1) AS c FROM st",
    sm="SELECT course_id, user_id, arg_max(mode, ts) FILTER (c) AS mode, arg_max(state, ts) = 1 AS active, min(ts) FILTER (e) AS first FROM f GROUP BY course_id, user_id HAVING count(*) FILTER (e) > 0",
    ua=_UA, la="SELECT user_id, course_id, max(date) AS last_activity_date FROM ua GROUP BY ALL", gr=_GRADES, g="SELECT user_id, course_id, max(letter_grade) AS letter_grade, max(passed) AS passed FROM gr GROUP BY ALL",
    lin=_LIN, pr="SELECT user_id, course_id, max(price) AS price FROM lin WHERE NOT refunded GROUP BY ALL", **_ENT,
    crs=f"SELECT 'course-v1:org' || r_regionkey || '+c' || r_regionkey || '+2024' AS course_id, r_name AS course_title, CAST(ceil((DATE '2024-02-01' + CAST(r_regionkey * 5 AS INTEGER) - DATE '2024-01-01') / 7.0) AS BIGINT) AS weeks FROM region",
    di=f"SELECT c_custkey AS user_id, {_C('i')} AS course_id, CASE WHEN c_custkey % 3 = 0 THEN 'Percentage' ELSE 'Absolute' END AS bt, CAST(c_custkey % 40 AS DOUBLE) AS bv FROM customer, (SELECT unnest([0, 1, 2]) AS i) WHERE c_custkey % 3 < 2")

ORACLES = {
    "grade_distribution": f"SELECT course_id, module_id, grade, max_grade, count(*) AS count FROM ({_MOD}) WHERE grade IS NOT NULL GROUP BY ALL",
    "sequential_open_distribution": f"SELECT course_id, module_id, count(*) AS count FROM ({_MOD}) WHERE module_type = 'sequential' GROUP BY ALL",
    "orders_best_price": f"SELECT user_id, course_id, uuid, max(price) AS price FROM ({_LIN}) WHERE NOT refunded GROUP BY ALL",
    "order_line_counts": f"SELECT order_id, count(*) AS line_count FROM ({_LIN}) GROUP BY ALL",
    "last_activity": with_views("act", ua=_UA) + " SELECT user_id, course_id, max(date) AS last_activity_date FROM ua GROUP BY ALL",
    "enterprise_enrollment": _ENR + """ SELECT DISTINCT k.enterprise_id, enterprise_name, k.user_id, username, user_sso_id, k.course_id, course_title, weeks AS course_duration_weeks, sm.mode AS user_current_enrollment_mode, active AS is_active, first AS enrollment_created,
 coalesce(letter_grade <> '', false) AND passed IS NOT NULL AS has_passed, last_activity_date, round(price, 2) AS course_price,
 round(CASE WHEN price IS NULL THEN 0.0 ELSE greatest(CASE bt WHEN 'Percentage' THEN price * (1 - bv / 100) WHEN 'Absolute' THEN price - bv ELSE price END, 0) END, 2) AS discount_price,
 CASE bt WHEN 'Percentage' THEN printf('%.2f', bv) || '%' WHEN 'Absolute' THEN '$' || printf('%.2f', bv) END AS offer
 FROM links k JOIN cust USING (enterprise_id) JOIN usr USING (user_id) LEFT JOIN soc ON soc.user_id = k.user_id JOIN sm ON sm.user_id = k.user_id AND sm.course_id = k.course_id LEFT JOIN crs ON crs.course_id = k.course_id
 LEFT JOIN g ON g.user_id = k.user_id AND g.course_id = k.course_id LEFT JOIN la ON la.user_id = k.user_id AND la.course_id = k.course_id LEFT JOIN pr ON pr.user_id = k.user_id AND pr.course_id = k.course_id LEFT JOIN di ON di.user_id = k.user_id AND di.course_id = k.course_id""",
    "enterprise_user": with_views("act", "usr", ua=_UA, la="SELECT user_id, max(date) AS last_activity_date FROM ua GROUP BY ALL", **_ENT)
    + " SELECT DISTINCT k.enterprise_id, enterprise_name, k.user_id, user_sso_id, username, last_activity_date FROM links k JOIN cust USING (enterprise_id) JOIN usr USING (user_id) LEFT JOIN soc ON soc.user_id = k.user_id LEFT JOIN la ON la.user_id = k.user_id",
    "write_and_replace_partition": with_views(b=_BD) + " SELECT date, kind, CASE WHEN date IN (DATE '2024-01-05', DATE '2024-01-06') THEN n * 10 ELSE n END AS n FROM b",
    "reprocess_recent": with_views(b=_BD) + " SELECT date, kind, CASE WHEN date >= DATE '2024-01-17' AND date < DATE '2024-01-20' THEN n ELSE 0 END AS n FROM b",
    "read_latest_partition": with_views(b=_BD) + " SELECT * FROM b WHERE date = (SELECT max(date) FROM b)",
    "replace_result_by_swap": with_views(b=_BD) + " SELECT * FROM b WHERE kind <> 'error'",
    "result_nulls": with_views() + " SELECT event_id, CASE WHEN k % 4 >= 2 THEN value END AS x, CASE WHEN k % 3 = 2 THEN kind END AS t FROM ev",
    "union_history": with_views(b=_BD) + " SELECT date, kind, CASE WHEN date < DATE '2024-01-15' THEN 0 ELSE n END AS n FROM b",
    "user_directory": with_views("usr") + " SELECT user_id, username, name FROM usr",
    "tumbling_weeks": with_views() + " SELECT CAST(date_trunc('week', date) AS DATE) AS week, count(*) AS n FROM ev GROUP BY ALL",
    "trailing_week": with_views() + f" SELECT kind, count(*) AS n FROM ev WHERE date >= DATE '{END}' - 7 AND date < DATE '{END}' GROUP BY ALL",
}
DATES = {
    "last_activity": ["last_activity_date"], "enterprise_enrollment": ["last_activity_date"], "enterprise_user": ["last_activity_date"], "write_and_replace_partition": ["date"],
    "reprocess_recent": ["date"], "read_latest_partition": ["date"], "replace_result_by_swap": ["date"], "union_history": ["date"], "tumbling_weeks": ["week"],
}
