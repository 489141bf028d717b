"""The ways beyond a size limit give the same rows as those within it."""

import pytest
from pyspark.sql import functions as F

from lectern.llm import language_id, line_dedup, near_dup, packing, topk_search


def rows(df):
    return sorted(map(str, df.collect()))


def test_near_dup_by_shuffle_and_small_blocks(spark, sf, monkeypatch):
    want = rows(near_dup.op2_near_dedup(spark, sf))
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 0)
    monkeypatch.setattr(near_dup, "IN_BLOCK", 2)
    assert rows(near_dup.op2_near_dedup(spark, sf)) == want


def test_lines_by_shuffle_and_salts(spark, sf, monkeypatch):
    want = rows(line_dedup.op5_line_dedup(spark, sf))
    for name, value in {"BROADCAST_ROWS": 0, "LONG_LIST": 3, "COUNTERS": 64}.items():
        monkeypatch.setattr(line_dedup, name, value)
    assert rows(line_dedup.op5_line_dedup(spark, sf)) == want


def test_hosts_by_shuffle(spark, sf, monkeypatch):
    want = rows(language_id.op7_language_id(spark, sf))
    monkeypatch.setattr(language_id, "MAX_HOSTS", 0)
    monkeypatch.setattr(language_id, "LARGE", 20)
    assert rows(language_id.op7_language_id(spark, sf)) == want


@pytest.mark.parametrize("ranked", [10, 50])
def test_packing_in_many_ranks(spark, sf, monkeypatch, ranked):
    monkeypatch.setattr(packing, "RANKED", ranked)
    found = packing.op9_packing(spark, sf).toPandas().sort_values(["sequence_id", "offset"])
    assert (found.groupby("sequence_id").length.cumsum() - found.length == found.offset).all()


def test_search_in_small_blocks(spark, sf, monkeypatch):
    want = rows(topk_search.op3_topk_search(spark, sf))
    monkeypatch.setattr(topk_search, "BUCKET", 16)
    monkeypatch.setattr(topk_search, "QUERIES_IN_BLOCK", 5)
    monkeypatch.setattr(topk_search, "SEEDS", 25)
    assert rows(topk_search.op3_topk_search(spark, sf)) == want


def test_batches_of_components(spark):
    """A chain of links in any order is one component."""
    from lectern.llm.common import Scratch

    edges = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") * 7 % 61).alias("b"))
    got = {r.node: r.component for r in near_dup.components(Scratch(spark, "test"), edges).collect()}
    root = {n: n for n in range(62)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(1, 60):
        x, y = find(a), find(a * 7 % 61)
        root[max(x, y)] = min(x, y)
    assert all(got[n] == find(n) for n in got)
