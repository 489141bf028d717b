"""Registered enterprise report and its SQL, over one set of table definitions that both engines read."""

from __future__ import annotations

import re

from ..operators import enterprise as N
from ..sources.adapter import table

#: Tables of the platform and of the shop, from the star schema; names in braces are its tables.
TABLES = {
    "customers": "SELECT concat('e', r_regionkey) AS uuid, r_name AS name, r_regionkey AS site_id FROM {region}",
    "customer_users": "SELECT c_custkey + 5000 AS id, c_custkey AS user_id, concat('e', c_nationkey % 5) AS enterprise_id, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS linked FROM {customer}",
    "course_links": "SELECT DISTINCT o_custkey + 5000 AS customer_user_id, concat('c', o_orderkey % 6) AS course_id FROM {orders}",
    "enrollments": "SELECT o_custkey * 10 + o_orderkey % 6 AS id, o_custkey AS user_id, concat('c', o_orderkey % 6) AS course_id, min(o_orderdate) AS created, CASE WHEN o_orderkey % 6 < 2 THEN 'verified' ELSE 'audit' END AS mode FROM {orders} GROUP BY o_custkey, o_orderkey % 6",
    "users": "SELECT c_custkey AS id, concat('user', c_custkey) AS username, concat('user', c_custkey, '@x.org') AS email, concat('2020-01-0', 1 + c_custkey % 9) AS date_joined, substr(c_mktsegment, 1, 2) AS country FROM {customer}",
    "summary": "SELECT o_custkey AS user_id, concat('c', o_orderkey % 6) AS course_id, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS last_unenrollment_time FROM {orders} GROUP BY o_custkey, o_orderkey % 6",
    "activity": "SELECT o_custkey AS user_id, concat('c', o_orderkey % 6) AS course_id, o_orderdate AS date FROM {orders} WHERE o_orderstatus <> 'P'",
    "consent": "SELECT DISTINCT concat('user', o_custkey) AS username, concat('c', o_orderkey % 6) AS course_id, o_custkey % 2 = 0 AS granted FROM {orders} WHERE o_orderpriority LIKE '1%'",
    "grades": "SELECT o_custkey AS user_id, concat('c', o_orderkey % 6) AS course_id, CASE max(o_orderkey) % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' END AS letter_grade, max(o_orderkey) % 100 AS percent_grade, CASE WHEN max(o_orderkey) % 2 = 0 THEN max(o_orderdate) END AS passed_timestamp FROM {orders} GROUP BY o_custkey, o_orderkey % 6",
    "social": "SELECT o_orderkey AS id, o_custkey AS user_id, CASE WHEN o_orderkey % 4 = 0 THEN 'other' ELSE 'tpa-saml' END AS provider, concat('idp:', o_orderkey) AS uid FROM {orders}",
    "courses": "SELECT concat('c', r_regionkey) AS course_id, r_name AS catalog_course_title, DATE '2024-01-01' AS start_time, CASE WHEN r_regionkey % 2 = 0 THEN DATE '2024-02-10' ELSE DATE '2024-03-01' END AS end_time, CASE WHEN r_regionkey = 1 THEN 'self_paced' ELSE 'instructor_paced' END AS pacing_type, r_regionkey + 3 AS weeks_to_complete, 1 AS min_effort, 5 AS max_effort, concat('k', r_regionkey) AS catalog_course FROM {region}",
    "shop_orders": "SELECT o_orderkey AS id, concat('N', o_orderkey) AS number, o_custkey + 900000 AS user_id, o_totalprice AS total FROM {orders}",
    "shop_users": "SELECT c_custkey + 900000 AS id, concat('user', c_custkey) AS username FROM {customer}",
    "order_lines": "SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS price FROM {lineitem}",
    "products": "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 > 0 THEN concat('c', p_partkey % 6) END AS course_id FROM {part}",
    "attributes": "SELECT r_regionkey AS id, CASE WHEN r_regionkey = 1 THEN 'UUID' ELSE r_name END AS code FROM {region}",
    "attribute_values": "SELECT p_partkey AS product_id, r_regionkey AS attribute_id, concat('u-', CASE WHEN r_regionkey = 1 THEN p_partkey % 7 ELSE 99 END) AS value_text FROM {part} CROSS JOIN {region} WHERE r_regionkey IN (1, 2) AND p_size > 3",
    "refunds": "SELECT l_orderkey * 100 + l_linenumber AS id, l_orderkey * 10 + l_linenumber AS order_line_id, CASE WHEN l_linestatus = 'F' THEN 'Complete' ELSE 'Open' END AS status FROM {lineitem} WHERE l_returnflag <> 'N'",
    "discounts": "SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'F' THEN o_custkey % 5 END AS voucher_id, o_custkey % 6 AS offer_id FROM {orders} WHERE o_orderstatus <> 'P'",
    "vouchers": "SELECT r_regionkey AS id, r_name AS name, concat('CODE', r_regionkey) AS code FROM {region}",
    "offers": "SELECT r_regionkey AS id, CASE WHEN r_regionkey = 0 THEN 'Voucher' ELSE 'Site' END AS offer_type, r_regionkey % 4 AS benefit_id FROM {region}",
    "benefits": "SELECT r_regionkey AS id, CASE r_regionkey WHEN 1 THEN 'x.PercentageDiscount' WHEN 2 THEN 'x.AbsoluteDiscount' END AS proxy_class, CASE WHEN r_regionkey = 3 THEN 'Fixed' END AS type, concat(r_regionkey, '0.00') AS value FROM {region}",
    "entitlements": "SELECT concat('u', o_orderkey % 7) AS course_uuid, concat('N', o_orderkey) AS order_number, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey * 10 + o_orderkey % 6 END AS enrollment_id FROM {orders}",
}


def _tables(s, d):
    out = {}
    for name, sql in TABLES.items():
        names = sorted(set(re.findall(r"\{(\w+)\}", sql)))
        out[name] = s.sql(sql, **{n: table(s, d, n) for n in names})
    return out


QUERIES = {"course_orders": lambda s, d: N.course_orders(_tables(s, d)), "enterprise_report": lambda s, d: N.enterprise_report(_tables(s, d))}

_CTES = "WITH " + ",\n".join(f"t_{n} AS ({re.sub(r'[{}]', '', q)})" for n, q in TABLES.items())
_BEST = """SELECT o.user_id, p.course_id, av.value_text AS uuid, max(l.price) AS price FROM t_shop_orders o JOIN t_order_lines l ON l.order_id = o.id JOIN t_products p ON p.id = l.product_id JOIN t_attributes a ON a.code = 'UUID'
 LEFT JOIN t_attribute_values av ON av.attribute_id = a.id AND av.product_id = p.id LEFT JOIN t_refunds r ON r.order_line_id = l.id WHERE r.id IS NULL OR r.status <> 'Complete' GROUP BY ALL"""
_ORDERS = """SELECT DISTINCT u.username, coalesce(p.course_id, en.course_id) AS course_id, l.price AS course_price, CASE WHEN (SELECT count(*) FROM t_order_lines x WHERE x.order_id = o.id) > 1 THEN NULL ELSE o.total END AS discount_price,
 CASE WHEN f.id IS NULL OR f.offer_type = 'Voucher' THEN NULL ELSE CASE WHEN b.proxy_class IS NULL THEN b.type WHEN b.proxy_class LIKE '%Percentage%' THEN 'Percentage' ELSE 'Absolute' END || ', ' || b.value || ' (#' || f.id || ')' END AS offer, v.name AS coupon_name, v.code AS coupon_code
 FROM t_shop_orders o JOIN t_shop_users u ON u.id = o.user_id JOIN t_order_lines l ON l.order_id = o.id JOIN t_products p ON p.id = l.product_id JOIN t_attributes a ON a.code = 'UUID'
 LEFT JOIN t_attribute_values av ON av.attribute_id = a.id AND av.product_id = p.id JOIN best ON best.user_id = o.user_id AND best.price = l.price LEFT JOIN t_discounts d ON d.order_id = o.id LEFT JOIN t_vouchers v ON v.id = d.voucher_id
 LEFT JOIN t_offers f ON f.id = d.offer_id LEFT JOIN t_benefits b ON b.id = f.benefit_id LEFT JOIN t_entitlements e ON e.course_uuid = replace(best.uuid, '-', '') AND e.order_number = o.number AND e.enrollment_id IS NOT NULL
 LEFT JOIN t_enrollments en ON en.id = e.enrollment_id LEFT JOIN t_refunds r ON r.order_line_id = l.id WHERE (r.id IS NULL OR r.status <> 'Complete') AND (p.course_id = best.course_id OR av.value_text = best.uuid)"""
_REPORT = """SELECT DISTINCT c.uuid AS enterprise_id, c.name AS enterprise_name, cu.user_id AS lms_user_id, cu.id AS enterprise_user_id, k.course_id, en.created AS enrollment_created_timestamp, en.mode AS user_current_enrollment_mode, co.granted AS consent_granted, g.letter_grade,
 CASE WHEN g.passed_timestamp IS NOT NULL AND g.letter_grade <> '' THEN 1 ELSE 0 END AS has_passed, g.passed_timestamp, split_part(so.uid, ':', 2) AS enterprise_sso_uid, c.site_id AS enterprise_site_id, crs.catalog_course_title AS course_title, crs.start_time AS course_start, crs.end_time AS course_end,
 crs.pacing_type AS course_pacing_type, CASE WHEN crs.pacing_type = 'self_paced' THEN CAST(crs.weeks_to_complete AS VARCHAR) ELSE CAST(CAST(ceil(date_diff('day', crs.start_time, crs.end_time) / 7.0) AS BIGINT) AS VARCHAR) END AS course_duration_weeks, crs.min_effort AS course_min_effort, crs.max_effort AS course_max_effort,
 u.date_joined AS user_account_creation_timestamp, u.email AS user_email, u.username AS user_username, crs.catalog_course AS course_key, u.country AS user_country_code, act.d AS last_activity_date, od.coupon_name, od.coupon_code, od.offer, g.percent_grade AS current_grade, od.course_price, od.discount_price, sm.last_unenrollment_time AS unenrollment_timestamp
 FROM t_course_links k JOIN t_customer_users cu ON cu.id = k.customer_user_id JOIN t_customers c ON c.uuid = cu.enterprise_id JOIN t_enrollments en ON en.course_id = k.course_id AND en.user_id = cu.user_id JOIN t_users u ON u.id = cu.user_id
 LEFT JOIN t_summary sm ON sm.course_id = k.course_id AND sm.user_id = cu.user_id LEFT JOIN (SELECT user_id, course_id, max(date) AS d FROM t_activity GROUP BY ALL) act ON act.course_id = k.course_id AND act.user_id = cu.user_id
 LEFT JOIN t_consent co ON co.username = u.username AND co.course_id = k.course_id LEFT JOIN t_grades g ON g.user_id = cu.user_id AND g.course_id = k.course_id
 LEFT JOIN (SELECT user_id, arg_max(uid, id) AS uid FROM t_social WHERE provider = 'tpa-saml' GROUP BY user_id) so ON so.user_id = cu.user_id JOIN t_courses crs ON crs.course_id = k.course_id LEFT JOIN od ON od.username = u.username AND od.course_id = k.course_id WHERE cu.linked = 1"""
ORACLES = {
    "course_orders": f"{_CTES}, best AS ({_BEST}), od AS ({_ORDERS}) SELECT * FROM od WHERE course_id IS NOT NULL",
    "enterprise_report": f"{_CTES}, best AS ({_BEST}), od AS ({_ORDERS}) {_REPORT}",
}
DATES = {"enterprise_report": ["course_start", "course_end"]}
