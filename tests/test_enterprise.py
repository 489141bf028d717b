"""The lines of course orders are read and dealt once, though two steps need them."""

import pytest

from lectern.plans import enterprise


@pytest.mark.parametrize("name", ["course_orders", "enterprise_report"])
def test_lines_are_dealt_once(spark, sf, name):
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        plan = enterprise.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("FileScan parquet [l_") == 3  # the lines, their refunds, and how many an order has
