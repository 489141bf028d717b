"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from lectern.llm import decontaminate, language_id, license_scan, line_dedup, near_dup, packing, pii, suffix_dedup, topk_search, url_filter

LONG = "word sequence that goes on and on " * 4000
ROWS = [
    (1, "The MIT license. mail a.b@example.com now and the of and to", "en", "src0"), (1, "The MIT license. mail a.b@example.com now and the of and to", "en", "src0"),
    (2, None, None, None), (3, "", "en", "src1"), (4, LONG, "en", "src0"), (5, "   \n\n ", "de", ""), (None, "no id here at all, none", "en", "src0"), (6, "é漢字 Ünïcödé\x00 text", "fr", "src2"),
]
#: Names that the operators use inside or return.
CLASH = ["label", "key", "h", "component", "kept", "spans", "pii", "language", "host", "path", "rule", "verdict", "labels", "score", "n_words", "judged", "n_lines", "_host", "_text", "_said", "_prior", "_row", "_t", "_key", "confidence"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("clash") for c in CLASH})


def run(df):
    return [r.asDict() for r in df.collect()]


def test_language(docs):
    found = run(language_id.identify(docs))
    assert len(found) == len(ROWS) and set(found[0]) == set(docs.columns) and {r["_host"] for r in found} == {"clash"}
    assert {r["language"] for r in found if r["doc_id"] == 2} == {"und"} and not any(r["kept"] for r in found if r["doc_id"] == 2)
    assert run(language_id.identify(docs.limit(0))) == []
    assert not any(r["kept"] for r in run(language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))))


def test_licenses(docs):
    found = run(license_scan.scan_licenses(docs))
    assert len(found) == len(ROWS)
    assert [(r["n_words"], r["labels"], r["score"]) for r in found if r["doc_id"] == 2] == [(0, "", 0.0)]
    assert {r["base_labels"] for r in found if r["doc_id"] == 1} == {"mit"}
    assert run(license_scan.scan_licenses(docs.limit(0))) == []


def test_pii(docs):
    found = run(pii.find_pii(docs))
    assert len(found) == len(ROWS)
    assert [r["pii"]["n_email"] for r in found if r["doc_id"] == 1] == [1, 1]
    assert run(pii.find_pii(docs.limit(0))) == []
    assert {r["text"] for r in run(pii.mask_pii(docs)) if r["doc_id"] == 1} == {"The MIT license. mail <EMAIL> now and the of and to"}


def test_packing(docs, spark):
    found = run(packing.pack_documents(docs, packing.tokenizer_path()))
    assert sum(r["length"] for r in found if r["doc_id"] == 2) == 1
    places = {(r["sequence_id"], r["offset"]) for r in found}
    assert len(places) == len(found) and len([r for r in found if r["doc_id"] == 1]) == 2
    assert run(packing.pack_documents(docs.limit(0), packing.tokenizer_path())) == []


def test_near(docs):
    found = run(near_dup.near_duplicates(docs))
    assert len(found) == len(ROWS)
    assert all(r["kept"] for r in found)
    assert [r["n_shingles"] for r in found if r["doc_id"] in (2, 3, 5)] == [0, 0, 0]
    assert run(near_dup.near_duplicates(docs.limit(0))) == []


def test_lines(docs):
    found = run(line_dedup.dedup_lines(docs))
    assert len(found) == len(ROWS)
    assert {r["text"] for r in found if r["doc_id"] is None} == {"no id here at all, none"}
    assert run(line_dedup.dedup_lines(docs.limit(0))) == []


def test_suffix(docs):
    found = run(suffix_dedup.dedup_substrings(docs))
    assert len(found) == len(ROWS)
    long = next(r for r in found if r["doc_id"] == 4)
    assert long["n_removed"] == long["n_bytes"] and long["n_spans"] == 1  # it repeats within itself
    assert [r["n_bytes"] for r in found if r["doc_id"] == 2] == [0]
    assert run(suffix_dedup.dedup_substrings(docs.limit(0))) == []


def test_decontaminate(docs, spark):
    items = spark.createDataFrame([(1, "word sequence that goes on and on word sequence that goes"), (2, None), (3, ""), (None, "x y z")], "item_id long, text string")
    found = run(decontaminate.contaminated(docs, items))
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(4, 1)}
    assert run(decontaminate.contaminated(docs, items.limit(0))) == []
    assert run(decontaminate.contaminated(docs.limit(0), items)) == []
    assert len(run(decontaminate.drop_contaminated(docs, items))) == len(ROWS) - 1


def test_urls(docs, spark):
    urls = spark.createDataFrame([(1, "http://A.Net/x?q"), (1, "http://A.Net/x?q"), (2, None), (3, "no scheme"), (4, "http://"), (None, "https://b.org/fr/1"), (5, "http://a.net" + "/x" * 20000)], "page_id long, url string")
    found = run(url_filter.filter_urls(urls.withColumns({c: F.lit("clash") for c in CLASH})))
    assert [(r["page_id"], r["host"], r["rule"], r["verdict"]) for r in found] == [
        (1, "a.net", "net/", "block"), (1, "a.net", "net/", "block"), (2, "", None, "allow"), (3, "", None, "allow"), (4, "", None, "allow"), (None, "b.org", "org/fr/", "allow"), (5, "a.net", "net/", "block"),
    ]
    assert run(url_filter.filter_urls(urls.limit(0))) == []


def test_search(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [inf, 1.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, []), (8, [-1.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("v", "block", "square", "score")})
    found = run(topk_search.search(vectors, F.col("vec_id") % 20 == 0))
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 0] == [(1, 1, 4096), (2, 2, 4096), (3, 7, 0), (4, 20, 0), (5, 8, -4096)]
    assert run(topk_search.search(vectors.limit(0), F.col("vec_id") % 20 == 0)) == []
