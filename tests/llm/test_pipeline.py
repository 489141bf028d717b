"""The pipeline, stage by stage, against plain versions; and on nulls, repeated rows, clashing columns and empty tables."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import decontaminate, language_id, near_dup, packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """What each stage gets, and the result."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        stage(spark, docs, sf).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
    return [*out, docs]


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "packing"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_language_stage(stages):
    judged = by_id(language_id.identify(stages[0]))
    assert by_id(stages[1]) == {d: r for d, r in by_id(stages[0]).items() if judged[d].kept}
    assert 0.9 < stages[1].count() / stages[0].count() <= 1


def test_line_stage(stages):
    before, after, seen, want = by_id(stages[1]), by_id(stages[2]), [], {}
    for d in sorted(before):
        lines = (before[d].text or "").split("\n")
        stay = []
        for line in lines:
            words = frozenset(line.lower().encode().split())
            if words:
                stay.append(not any(5 * len(words & o) >= 4 * len(words | o) for o in seen))
                seen.append(words)
            else:
                stay.append(True)
        text = "\n".join(x for x, s in zip(lines, stay, strict=True) if s) if not all(stay) else before[d].text
        if all(stay) or (text or "").strip(" "):
            want[d] = text
    assert {d: r.text for d, r in after.items()} == want
    assert all(r.n_chars == (before[d].n_chars if r.text == before[d].text else len(r.text)) for d, r in after.items())


def test_near_stage(stages):
    sets = {d: set(near_dup.shingle_set(near_dup.words_of((r.text or "").encode()), 5).tolist()) for d, r in by_id(stages[2]).items()}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * max(len(x), len(y)) <= 5 * min(len(x), len(y)) and len(x & y) * 5 >= len(x | y) * 4:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert by_id(stages[3]) == {d: r for d, r in by_id(stages[2]).items() if find(d) == d}


def test_benchmark_stage(spark, sf, stages):
    plain = lambda t: f" {' '.join(w.decode() for w in decontaminate.words_of(t))} "
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before, after = by_id(stages[3]), by_id(stages[4])
    held = {d for d, r in before.items() if any(x in plain(r.text) for x in items)}
    assert held and not held & set(after) and all(after[d] == before[d] for d in after)
    assert len(before) - len(after) <= len(held) + 2


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    tokenizer, found = Tokenizer.from_file(packing.tokenizer_path()), stages[5].toPandas()
    tokens = {d: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for d, r in by_id(stages[4]).items()}
    assert found.groupby("doc_id")["length"].sum().to_dict() == tokens
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"] == ordered["offset"]).all()
    assert ordered.groupby("sequence_id")["length"].sum().max() <= 4096


def test_run_is_its_stages(spark, sf, stages):
    columns = ["doc_id", "start", "length"]
    assert collections.Counter(map(tuple, corpus_pipeline.run(spark, sf).select("doc_id", "doc_tokens").collect())).keys() == {tuple(r) for r in stages[5].select("doc_id", "doc_tokens").collect()}
    assert set(columns) <= set(stages[5].columns)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, tmp_path, empty):
    said = "the house and the garden of the old man stand near the river and the hill where a quiet road goes on"
    rows = [
        (1, said, "en", "a.org", 90), (1, said, "en", "a.org", 90), (2, None, "en", None, None), (3, "", None, "", 0), (None, said, "en", "a.org", 90), (None, None, None, None, None),
        (4, said.replace("garden", "yard") + "\n\n" + said, "en", "a.org", 90), (5, "und der die das haus am fluss und der alte mann " * 2000, "de", "b.de", 9), (6, "a secret question of the test that nobody should see in this text at all", "en", "a.org", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("own") for c in ("kept", "language", "judged", "n_lines", "h", "component", "words", "_row", "item_id")})
    spark.createDataFrame([(1, "secret question of the test that nobody should see"), (2, None), (None, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, columns = docs.limit(0) if empty else docs, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if name != "packing":
            assert docs.columns == columns and docs.where("kept <> 'own' OR _row <> 'own'").isEmpty()
    if empty:
        assert docs.isEmpty()
        return
    found = docs.toPandas()
    assert set(found["doc_id"].dropna().astype(int)) == {1, 2, 5} and not found["doc_id"].isna().all() and np.isfinite(found["length"]).all()
