"""What the corpus operators once left out."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.llm import decontaminate, language_id, license_scan, line_dedup, suffix_dedup


def example(parsed, pick):
    """A text that the parsed expression fits; pick chooses among branches and repeats."""
    out = ""
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            kind, value = arg[pick % len(arg)] if str(arg[0][0]) == "LITERAL" else arg[0]
            out += chr(value if str(kind) == "LITERAL" else value[0])
        elif op == "MAX_REPEAT":
            out += example(arg[2], pick) * max(arg[0], min(pick, arg[1], 1))
        elif op == "SUBPATTERN":
            out += example(arg[3], pick)
        elif op == "BRANCH":
            out += example(arg[1][pick % len(arg[1])], pick)
        elif op == "ANY":
            out += "x"
    return out


def test_every_license_rule_passes_the_gate(spark):
    rules, rows = license_scan.default_rules(), []
    for i, (_, _, _, _, expression, *_) in enumerate(rules):
        for pick in range(4):
            text = re.sub(" +", " ", example(re._parser.parse(expression[len("(?<= )") : -len("(?= )")]), pick)).strip()
            assert re.search(expression, f" {text} "), (expression, text)
            rows += [(i, text), (i, text.upper().replace(" ", "\n* "))]
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "rule int, text string")).collect()
    assert [r.text for r in found if not r.labels or r.score == 0] == []


def test_license_texts_without_the_word(spark):
    texts = {
        "All rights reserved.": "all-rights-reserved", "Released under MIT": "mit", "It is published under the Apache 2.0.": "apache,apache-2.0", "Placed in the public\ndomain": "public-domain",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee": "isc",
    }
    for r in license_scan.scan_licenses(spark.createDataFrame([(t,) for t in texts], "text string")).collect():
        assert set(r.labels.split(",")) & set(texts[r.text].split(",")), (r.text, r.labels)
    own = license_scan.scan_licenses(spark.createDataFrame([("On the BEER -ware terms",)], "text string"), phrases=[("b", "beer ware")], rules=[("beer", 0, 1.0, "beer ware", "(?<= )beer ware(?= )")]).first()
    assert (own.n_base, own.labels, own.score) == (1, "b,beer", 1.0)


def test_long_items_are_found(spark):
    rnd = random.Random(6)
    words = [f"{a}{b}{c}" for a in "bcdfghklmnprst" for b in ("alo", "eri", "omu", "ise", "ane", "uto") for c in ("nt", "st", "rm", "lk", "d", "n")]
    said = lambda n: rnd.choices(words, k=n)
    items = {1: said(3000), 2: said(700), 3: said(80), 4: said(30)}
    rows = [(10 * i + k, " ".join([*said(37 * k), *item, *said(11 * k)])) for i, item in items.items() for k in range(4)]
    changed = [w if rnd.random() > 0.12 else "other" for w in items[1]]
    rows += [(50, " ".join(said(500) + changed + said(90))), (60, " ".join(items[1][:1500])), (61, " ".join(said(4000)))]
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in items.items()], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.share for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), table).collect()}
    assert set(found) == {(10 * i + k, i) for i in items for k in range(4)} | {(50, 1)}
    assert all(share == 1.0 for (d, _), share in found.items() if d != 50) and found[50, 1] > 0.8


def test_words_in_punctuation_are_found(spark):
    rnd = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in ("alo", "eri", "omu", "ise") for c in ("nt", "st", "rm", "lk")]
    items = [(i, " ".join(rnd.sample(words, 25))) for i in range(12)]
    dress = ["({})", '"{}"', "**{}**", "${}$", "{}).", "{}?!", "- {}", "[{}]", "{}"]
    dressed = [(i, " ".join(dress[k % 8 if i < 8 else (i + k) % 9].format(w) for k, w in enumerate(t.split()))) for i, t in items]
    found = decontaminate.contaminated(spark.createDataFrame(dressed, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.share) for r in found} == {(i, i, 1.0) for i, _ in items}
    bench = decontaminate.Benchmark([(1, "alpha beta")])
    assert bench.sequence(b"(alpha) ** -- 'beta'?! gamma. Alpha").tolist() == [0, 1, -1, 0]


def test_suffixes_of_rows_without_or_with_shared_ids(spark):
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choices("abcdefghij klm", k=n))
    passage, copy, own = text(400), text(500), text(600)
    rows = [
        (None, text(300) + passage + text(50)), (1, text(70) + passage + text(300)), (None, copy), (2, copy), (None, text(350)), (3, own),
        (3, text(250) + passage), (4, own), (3, text(320)), (None, None), (None, passage), (5, passage[:250] + text(400)), (3, own[:150]), (3, own[:150]),
    ]
    seen, texts = {}, [t or "" for _, t in rows]
    for t in texts:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    want = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        want.append((str(d), len(t), "".join(c for c, g in zip(t, gone, strict=True) if not g)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(str(r.doc_id), r.n_bytes, bytes(r.data).decode()) for r in suffix_dedup.dedup_substrings(df).collect()]
    assert sorted(found) == sorted(want)


def test_short_lines_that_repeat_go(spark):
    rows = [(1, "All rights reserved.\n\nfirst line of five words\n \t\n end"), (2, "all  rights reserved. \n\nend of it\nEnd\r\n\r\n \t\nAll rights"), (3, "first line of five words\n***\n***"), (None, "end")]
    found = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (rows[0][1], 0), 2: ("\nend of it\n\r\n \t\nAll rights", 2), 3: ("***", 2), None: ("end", 0)}


def test_every_declared_language_counts(spark):
    rnd = random.Random(12)
    alphabets = [[chr(0x4E00 + 40 * i + k) for k in range(40)] for i in range(150)]
    text = lambda i: " ".join("".join(rnd.choices(alphabets[i], k=4)) for _ in range(40))
    code = lambda i: f"q{chr(97 + i // 26)}{chr(97 + i % 26)}"
    rows = [(1000 * k + i, text(i), code(i) if k < 4 + (i < 70) else None, f"h{i % 7}.site{i}.org") for i in range(150) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = language_id.identify(docs).collect()
    assert len(found) == len(rows) and all(r.kept and r.language == code(r.doc_id % 1000) for r in found)
    numbers = language_id.identify(docs.withColumn("lang", F.expr("CAST(doc_id % 1000 AS STRING)")), code=lambda c: F.concat(F.lit("number "), c)).collect()
    assert all(r.kept and r.language == f"number {r.doc_id % 1000}" for r in numbers)


def test_declared_tags(spark):
    tags = {"en": "en", "en-US": "en", " EN_us ": "en", "deu": "deu", "zh-Hant-TW": "zh", "fr-": "fr", "": None, "-": None, "e": None, "english": None, "en us": None, "en;q=0.8": None, "12": None, "und": None, "mul-Latn": None, None: None}
    found = spark.createDataFrame([(t,) for t in tags], "tag string").select("tag", language_id.code_of(F.col("tag")).alias("code")).collect()
    assert {r.tag: r.code for r in found} == tags


def test_spellings_of_a_language_are_one_and_junk_declares_nothing(spark):
    """More declared values than any table of models could hold."""
    words = {"en": "the quick brown foxes jump over lazy dogs while children watch", "de": "der schnelle braune fuchs springt hastig ueber faule hunde hinweg"}
    tags = {"en": ["en", "en-US", "EN_gb"], "de": ["de", "de-AT", "DE"]}
    rows = [(2 * i + k, words[x], tags[x][i % 3] if i < 30 else f"junk{i}", "h.org") for i in range(1500) for k, x in enumerate(words)]
    found = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(found) == len(rows) and all(r.kept and r.language == ("en", "de")[r.doc_id % 2] for r in found)


def test_a_benchmark_in_blocks(spark, monkeypatch):
    """Blocks of a few items find what one block of all items finds."""
    rnd = random.Random(21)
    words = [f"{a}{b}{c}" for a in "bcdfghjklmnprst" for b in ("alo", "eri", "omu", "ise") for c in ("nt", "st", "rm", "lk")]
    items = [(i, " ".join(rnd.sample(words, 30))) for i in range(24)] + [(3, " ".join(rnd.sample(words, 26))), (None, "x"), (50, None), (51, "")]
    docs = [(i, " ".join(rnd.choices(words, k=60)) + " " + items[i % 25][1] + " " + " ".join(rnd.choices(words, k=60))) for i in range(60)]
    docs += [(100 + i, " ".join(rnd.choices(words, k=150))) for i in range(40)] + [(200, items[2][1] + " " + items[20][1]), (201, None)]
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    pairs = lambda: sorted((r.doc_id, r.item_id, r.share, r.answer_share) for r in decontaminate.contaminated(docs, bench).collect())
    whole = pairs()
    assert {d for d, *_ in whole} == {*range(60), 200} and {i for d, i, *_ in whole if d == 200} == {2, 20}
    monkeypatch.setattr(decontaminate, "BLOCK", 1000)
    assert sum(1 for _ in decontaminate.blocks_of(bench)) > 4 and pairs() == whole
    monkeypatch.setattr(decontaminate, "BLOCK", 1)
    assert decontaminate.contaminated(docs, bench.where("item_id > 50")).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [20, 60, 180])
def test_lines_of_near_copies_against_brute_force(spark, monkeypatch, copies):
    """Groups of near copies that share words with each other; half of the lists are long."""
    rnd = random.Random(copies)
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in ("alo", "eri", "omu", "ise", "ane", "uto")]
    bases = [rnd.sample(words, n) for n in (3, 5, 9, 12, 20, 20, 40)]
    said = lambda w: [x if rnd.random() > 0.08 else rnd.choice(words) for x in w]
    texts = [" ".join(said(rnd.choice(bases))) for _ in range(copies * 7)]
    docs = [(i, "\n".join(texts[7 * i : 7 * i + 7])) for i in range(copies)]
    monkeypatch.setattr(line_dedup, "LONG_LIST", 10)
    sets, want = [set(t.split()) for t in texts], {i: [] for i, _ in docs}
    for i, x in enumerate(sets):
        if not any(5 * len(x & y) >= 4 * len(x | y) for y in sets[:i]):
            want[i // 7].append(i % 7)
    found = line_dedup.removed_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.kept for r in found} == want


def test_lines_keep_columns_and_say_what_went(spark):
    rows = [(1, "a b c\nd", "x", 5, "own"), (2, "d\nc b a", "y", 6, "own"), (None, "d", "z", 7, "own"), (3, None, "z", 8, "own")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_lines int, judged string")
    found = {r.doc_id: r.asDict() for r in line_dedup.dedup_lines(df).collect()}
    assert set(found[1]) == {"doc_id", "text", "kept", "n_lines", "judged", "n_removed"}
    assert {d: (r["text"], r["kept"], r["judged"], r["n_lines"], r["n_removed"]) for d, r in found.items()} == {
        1: ("a b c\nd", "x", "own", 2, 0), 2: ("", "y", "own", 2, 2), None: ("d", "z", "own", None, 0), 3: (None, "z", "own", None, 0),
    }
