"""Every registered query against its SQL in DuckDB, on the smallest tables; shuffled input; empty input."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.operators import enrollment as E
from lectern.operators import video as V
from lectern.plans import registry
from lectern.sources.adapter import END, enrollment_events, video_events

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows(records, columns):
    def plain(v):
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(plain(r[c]) for c in sorted(columns)) for r in records)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(name, spark, sf, oracle):
    got = registry.QUERIES[name](spark, sf)
    want = oracle.execute(registry.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows([r.asDict() for r in got.collect()], columns) == rows([dict(zip(columns, r, strict=True)) for r in want.fetchall()], columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(name, spark, sf):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_order_of_input_does_not_matter(spark, sf):
    events = enrollment_events(spark, sf)
    shuffled = events.orderBy(F.rand(3)).repartition(7)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(E.days_enrolled(events, END)) == key(E.days_enrolled(shuffled, END))
    videos = video_events(spark, sf)
    assert key(V.video_viewings(videos)) == key(V.video_viewings(videos.orderBy(F.rand(5)).repartition(5)))


def test_empty_input(spark, sf):
    events = enrollment_events(spark, sf).limit(0)
    assert E.enrollment_daily(E.days_enrolled(events, END)).count() == 0
    assert V.video_usage(V.video_viewings(video_events(spark, sf).limit(0))).count() == 0
