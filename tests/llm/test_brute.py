"""Each operator's query against a plain version of its contract, or its SQL, on the smallest tables."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import decontaminate, language_id, license_scan, near_dup, packing, pii, registered, suffix_dedup, topk_search

TABLES = "documents embeddings pages benchmark labels conversations".split()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_sql(name, spark, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = registered.QUERIES[name](spark, sf)
    want = con.execute(registered.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(str(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(map(str, r)) for r in want.fetchall())


def test_licenses(spark, sf, docs):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in license_scan.op6_license_scan(spark, sf).collect():
        words = word.findall(docs[r.doc_id].translate(LOWER))
        starts, labels = [], set()
        for label, phrase in license_scan.PHRASES:
            p = phrase.split()
            for i in range(len(words) - len(p) + 1):
                if words[i : i + len(p)] == p:
                    starts.append(i)
                    labels.add(label)
        want = (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_contained_matches_of_equal_or_better_rules_are_suppressed(spark):
    df = spark.createDataFrame([("Licensed under the GNU General Public License v3.",), ("public domain",), ("All rights reserved, license",)], "text string")
    assert [r.labels for r in license_scan.scan_licenses(df).collect()] == ["gpl,gpl-3.0", "", "all-rights-reserved,unknown-license"]


def plain_licenses(text):
    """Labels and score: every match of every rule, less those inside a match of the same or a better priority."""
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall(text.translate(LOWER))
    norm, found = f" {' '.join(words)} ", []
    for label, priority, score, keyword, expression, *_ in license_scan.default_rules():
        if keyword in norm:
            found += [(m.start(), m.end(), priority, label, score) for m in re.finditer(expression, norm)]
    found.sort(key=lambda m: (m[0], -m[1], m[2]))
    stay = [m for i, m in enumerate(found) if not any(o[1] >= m[1] and o[2] <= m[2] for o in found[:i])]
    base = {label for label, phrase in license_scan.PHRASES if f" {phrase} " in norm}
    return ",".join(sorted(base | {m[3] for m in stay})), max([m[4] for m in stay] + [0.7 * bool(base)])


def test_license_labels(spark, docs):
    from .test_whole import example

    rnd, texts = random.Random(7), list(docs.values())
    parsed = [re._parser.parse(r[4][len("(?<= )") : -len("(?= )")]) for r in license_scan.default_rules()]
    signs = [example(p, k) for p in parsed for k in range(3)]
    texts += signs + [" ".join(rnd.choice(signs + ["license", "the mit license", "x, y", "copyright"]) for _ in range(rnd.randint(2, 9))) for _ in range(300)]
    texts.append("license copyright 2020 " * 3000)  # matches beyond what is added up at once
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = license_scan.scan_licenses(df).collect()
    assert len(found) == len(texts) and sum(r.labels != "" for r in found) > 800
    assert [(r.i, r.labels, r.score) for r in found if (r.labels, r.score) != plain_licenses(r.text)] == []


def plain_pii(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_pii_parsers():
    anchors, rnd = pii.automaton(), random.Random(4)
    for i in range(30_000):
        alphabet = "0123456789" if i % 3 else "12."
        t = "".join(rnd.choice(alphabet if rnd.random() < 0.6 else "@.+- ()ab%é:\n") for _ in range(rnd.randint(0, 60)))
        t += rnd.choice(["", "4111 1111 1111 1111", " 10.0.0.1", "a@b.c@d.e", "+1 (555) 010-9999"])
        assert [s for s in pii.find_spans(t, anchors) if s[0] in pii.BASE_KINDS] == plain_pii(t)
    assert pii.find_spans("see https://a.b/c SSN: 123-45-6789 IBAN GB82 WEST 1234 5698 7654 32 x", anchors) == [("url", 4, 17), ("ssn", 23, 34), ("iban", 40, 67)]


def test_pii(spark, sf, docs):
    for r in pii.op8_pii(spark, sf).collect():
        want = plain_pii(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in want) for k in pii.BASE_KINDS)


def test_packing(spark, sf, docs):
    from tokenizers import Tokenizer

    found = packing.op9_packing(spark, sf).toPandas()
    tokenizer, by_doc = Tokenizer.from_file(packing.tokenizer_path()), dict(tuple(found.groupby("doc_id")))
    assert set(by_doc) == set(docs)
    for doc, text in docs.items():
        ids, at = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], dtype="<u4"), 0
        for r in by_doc[doc].sort_values("start").itertuples():
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    totals = ordered.groupby("sequence_id").length.sum()
    assert totals.max() <= 4096 and totals.sum() / (len(totals) * 4096) > 0.98


def test_tokenizer_words_equal_whole_texts():
    tokenizer, rnd = packing.WordTokenizer(packing.tokenizer_path()), random.Random(2)
    alphabet = [*"ab'sté ́ \x1c\x85 İßﬁ1２\n\t’.-ÉZk,×÷", "<|endoftext|>", "<|startoftext|>", "'s", "'ll", "of", "the", "été"]
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30)))
        want = np.array(tokenizer.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert next(tokenizer.encode([text.encode()])) == want


def test_windows_are_filled():
    counts = {n: 3 for n in range(1, 400)}
    plan = packing.plan_windows(counts, 512)
    used = collections.Counter()
    for often, window in plan:
        assert sum(n * k for n, k in window.items()) <= 512
        used.update({n: often * k for n, k in window.items()})
    assert used == counts
    assert sum(o for o, _ in plan) <= -(-sum(n * k for n, k in counts.items()) // 512) + 1


@pytest.mark.parametrize("many", [1, 500])
def test_suffixes(spark, sf, docs, many, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", many)  # 1: every gram takes the way of the very frequent ones
    texts = {d: t.encode() for d, t in docs.items()}
    seen = collections.Counter(b[i : i + 200] for b in texts.values() for i in range(len(b) - 199))
    for r in suffix_dedup.op10_suffix_dedup(spark, sf).collect():
        b = texts[r.doc_id]
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())


def test_very_frequent_slices_by_digest(spark, sf, docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", 0)  # even single slices are matched by digests
    want = {r.doc_id: r.kept_sha256 for r in suffix_dedup.op10_suffix_dedup(spark, sf).collect()}
    monkeypatch.undo()
    assert want == {r.doc_id: r.kept_sha256 for r in suffix_dedup.op10_suffix_dedup(spark, sf).collect()}


def test_benchmark_passages_are_found(spark, sf, docs):
    plain = lambda t: f" {' '.join(w.decode() for w in decontaminate.words_of(t))} "
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    texts = {d: plain(t) for d, t in docs.items()}
    want = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    found = {(r.doc_id, r.item_id): r.share for r in decontaminate.op4_decontaminate(spark, sf).collect()}
    assert want <= set(found) and all(found[p] == 1.0 for p in want)
    assert len(found) <= len(want) + 2


def test_paraphrases_are_found(spark):
    rnd = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in ("alo", "eri", "omu", "ise") for c in ("nt", "st", "rm", "lk")]
    items = [(i, " ".join(rnd.choices(words, k=30))) for i in range(20)]
    said = lambda t: " ".join(w if rnd.random() > 0.2 else "other" for w in t.split())
    noise = lambda: " ".join(rnd.choices([w[::-1] for w in words], k=60))
    rows = [(i, f"{noise()} {said(t)} {noise()}") for i, t in items] + [(100 + i, noise()) for i in range(20)]
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len({r.doc_id for r in found if r.doc_id == r.item_id}) >= 18 and not any(r.doc_id >= 100 for r in found)


def test_language(spark, sf):
    """All evidence, added up in plain numpy."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    languages, model = language_id.fit(rows, "text", "lang", "doc_id")
    n, data = len(languages), rows.collect()
    place, model = {x: i for i, x in enumerate(languages)}, model.astype(np.float64)
    evidence, knows, hosts = [], [], [(r.source or "").lower() for r in data]
    for r in data:
        seen = language_id.trigrams(r.text.encode()) if r.text else np.zeros(0)
        evidence.append(model[seen].sum(axis=0) * min(len(seen), language_id.TRIGRAMS) / len(seen) if len(seen) else None)
        knows.append(evidence[-1] is not None and evidence[-1][:-1].max() > evidence[-1][-1])
    said = [int(e[:-1].argmax()) if k else None for e, k in zip(evidence, knows, strict=True)]
    parent = lambda h: h.split(".", 1)[1] if "." in h else ""

    def counts(chosen):
        return np.bincount([s for s, c in zip(said, chosen, strict=True) if c and s is not None], minlength=n)

    a, top = language_id.SMOOTHING, (counts([True] * len(data)) + 1) / (sum(s is not None for s in said) + n)
    prior = {}
    for h in set(hosts):
        own, up = counts([x == h for x in hosts]), counts([parent(x) == parent(h) for x in hosts])
        prior[h] = np.log((own + a * (up + a * top) / (up.sum() + a)) / (own.sum() + a))

    def speaks(lang, right):
        return np.where(np.arange(n) == place[lang], np.log(right), np.log((1 - right) / max(1, n - 1))) if lang in place else np.zeros(n)

    want = {}
    for r, e, k, h in zip(data, evidence, knows, hosts, strict=True):
        scores = (e[:-1] if k else 0) + prior[h] + speaks(r.lang, language_id.DECLARED) + speaks(language_id.SUFFIXES.get(h.rsplit(".", 1)[-1]), language_id.SUFFIX)
        kept = k if e is not None else r.lang in place
        want[r.doc_id] = (languages[int(scores.argmax())] if kept else "und", kept, 1 / np.exp(scores - scores.max()).sum() if kept else 0.0)
    found = {r.doc_id: (r.lang, r.kept, r.confidence) for r in language_id.op7_language_id(spark, sf).collect()}
    assert {d: x[:2] for d, x in found.items()} == {d: x[:2] for d, x in want.items()}
    assert max(abs(found[d][2] - want[d][2]) for d in want) < 1e-3


def test_held_out_language(spark, sf):
    """The text alone, without the declared language of the rows that are judged, tells it."""
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", F.lit(None).cast("string").alias("source"), F.col("lang").alias("truth"))
    held = df.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    judged = [r for r in language_id.identify(held).collect() if r.lang is None]
    assert sum(r.language == r.truth for r in judged) / len(judged) > 0.95


def test_links_across_components():
    rnd = np.random.default_rng(5)
    base = rnd.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[: 100 - k], rnd.integers(0, 2**63, k).astype(np.uint64)])) for k in rnd.integers(0, 30, 40)]
    links = near_dup.links_across(np.arange(40), np.arange(40), sets, 85)
    root = list(range(40))
    for a, b in links:
        ra, rb = root[a], root[b]
        root = [ra if r == rb else r for r in root]
    want = list(range(40))
    for a in range(40):
        for b in range(a):
            n = len(np.intersect1d(sets[a], sets[b]))
            if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                x, y = want[a], want[b]
                want = [x if r == y else r for r in want]
    assert len(set(zip(root, want, strict=True))) == len(set(root)) == len(set(want))


def test_pruned_search_is_exact():
    rnd = np.random.default_rng(3)
    p, q = rnd.integers(-60, 60, (500, 16)), rnd.integers(-60, 60, (20, 16))
    p[::7] = q[0] + rnd.integers(-3, 3, (len(p[::7]), 16))
    scores = q @ p.T
    least = np.sort(scores, axis=1)[:, -5].astype(float)
    found = list(topk_search.search_bucket(np.arange(20) + 1000, q, least, np.arange(500), p, 500))
    assert {(a, b) for a, b, _ in found} == {(i + 1000, j) for i, j in zip(*np.nonzero(scores >= least[:, None]), strict=True)}
