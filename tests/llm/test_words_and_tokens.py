"""Spelling variants, periodic runs and byte-level BPE against plain versions of their contracts, and on odd input."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import byte_bpe, periodic, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


# Spelling variants


def plain_variants(counts):
    """Rows by the definition: every word less each of its code points finds its partners."""
    holes = {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    near = {w: set() for w in counts}
    for hole, words in holes.items():
        for w in words | ({hole} & set(counts)):
            near[w] |= {o for o in words | ({hole} & set(counts)) if o != w and (len(o) != len(w) or sum(a != b for a, b in zip(o, w, strict=True)) == 1)}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows)


def collected(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_variants_of_the_documents(spark, sf, docs):
    counts = Counter()
    for doc, text in docs.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    want = plain_variants({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    assert len(want) > 500 and sum(r[1] is not None for r in want) > 10
    assert collected(spelling.op11_spelling_variants(spark, sf)) == want


@pytest.mark.parametrize("wide", [3, 2000])
def test_variants_of_crowded_words(spark, wide):
    rnd = random.Random(wide)
    words = {"".join(rnd.choices("abé", k=rnd.randint(6, 9))) for _ in range(900)} | {"z" * n for n in range(6, 12)} | {"abcabcabc"[:n] for n in range(6, 10)}
    counts = {w: 5 ** rnd.randint(1, 5) + rnd.randint(0, 3) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert collected(spelling.group_variants(df, wide=wide)) == plain_variants(counts)


def test_variants_of_short_and_endless_words(spark):
    long = "".join(random.Random(1).choices("abcdefghijkl", k=30_000))
    counts = {long: 500, long[:9000] + long[9001:]: 100, long[:20_000] + "z" + long[20_001:]: 7, "a": 1, "b": 5, "ab": 30, "": 9}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: (r.form and len(r.form), r.n_near) for r in spelling.group_variants(df).collect()}
    assert [found[w] for w in counts][:3] == [(None, 2), (30_000, 1), (30_000, 1)]
    assert found["b"] == (2, 2) and found["ab"] == (None, 2) and found["a"] == (2, 2)
    assert spelling.group_variants(df.limit(0)).collect() == []


def test_words_of_odd_texts(spark):
    rows = [(1, "Été-ÉTÉ été abcdef ABCDEF"), (None, "abcdef ×÷ "), (2, None), (3, ""), (1, "abcdef")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("word", "n", "h", "form", "root", "size")})
    assert Counter(r.word for r in spelling.letter_runs(df, "doc_id").collect()) == Counter({"abcdef": 4, "Été": 1, "ÉtÉ": 1, "été": 1, "×÷": 1})
    assert [tuple(r) for r in spelling.count_words(spelling.letter_runs(df), min_count=2).collect()] == [("abcdef", 4)]


# Periodic runs


def plain_runs(words):
    """Every maximal stretch of each period whose smallest period that is."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            run = words[i : j + q]
            if length >= max(6, 4 * q) and not any(all(run[k] == run[k + d] for k in range(length - d)) for d in range(1, q)):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_the_documents(spark, sf, docs):
    found = {r.doc_id: r for r in periodic.op12_periodic_runs(spark, sf).collect()}
    assert set(found) == set(docs)
    repeated = 0
    for doc, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            repeated += 1
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        want = (len(runs), *best, 1000 * best[1] // best[2] if runs else None)
        r = found[doc]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert repeated > 10 and sum(r.n_runs for r in found.values()) > 10


def test_runs_of_random_sequences():
    rnd, texts = random.Random(12), []
    for _ in range(2500):
        parts = ["".join(rnd.choices("abc"[: rnd.randint(1, 3)], k=rnd.randint(1, 12))) * rnd.choice([1, 1, 2, 3, 4, 5, 9]) for _ in range(rnd.randint(0, 5))]
        texts.append("".join(parts)[:300])
    numbers = np.array([ord(c) for t in texts for c in t], dtype=np.int64)
    firsts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    found = {i: [] for i in range(len(texts))}
    for i, *run in periodic.find_runs(numbers, firsts):
        found[i].append(tuple(run))
    assert [i for i, t in enumerate(texts) if found[i] != plain_runs(t)] == []
    assert max(q for runs in found.values() for _, _, q in runs) > 10


def test_runs_of_odd_texts(spark):
    rows = [(1, "a b " * 50_000), (1, "a b " * 50_000), (2, None), (3, ""), (None, " \t\n"), (4, "x\x0bx\x0cx x\tx\rx é é"), (5, "one two three")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("runs", "start", "period", "collapsed", "row")})
    found = [(r.doc_id, [tuple(x) for x in r.periodic.runs], r.periodic.collapsed) for r in periodic.periodic_runs(df).collect()]
    assert found == [(1, [(0, 100_000, 2)], "a b"), (1, [(0, 100_000, 2)], "a b"), (2, [], ""), (3, [], ""), (None, [], ""), (4, [(0, 6, 1)], "x é é"), (5, [], "one two three")]
    assert [(r.text, r.runs) for r in periodic.collapse_runs(df).collect()] == [(t, "clash") for t in ("a b", "a b", None, "", " \t\n", "x é é", "one two three")]
    assert periodic.periodic_runs(df.limit(0)).collect() == []


# Byte-level BPE


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    path, pattern = byte_bpe.ranks_path()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_tokens_of_the_documents(spark, sf, docs, reference):
    found = {r.doc_id: r for r in byte_bpe.op13_byte_bpe(spark, sf).collect()}
    assert set(found) == set(docs)
    for doc, text in docs.items():
        ids = reference.encode_ordinary(text)
        assert (found[doc].n_tokens, found[doc].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert found[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_tokens_of_random_pieces(reference):
    rnd, bpe = random.Random(13), byte_bpe.ByteBpe(*byte_bpe.ranks_path())
    tokens = [t for t in (b.decode("utf-8", "ignore") for b in bpe.tokens) if t.strip()]
    texts = ["".join(rnd.choices(tokens, k=rnd.randint(1, 12))) for _ in range(20_000)]
    texts += ["".join(rnd.choices(rnd.choice(["ab", "an", " -=", "\n \t", "éèo", "漢字かな", "aeiou .'s", "01 "]), k=rnd.randint(0, 90))) for _ in range(20_000)]
    texts += [chr(0x20 + 61 * i % 0xD000) + "a" for i in range(0xD000)]
    assert [t for t, ids in zip(texts, bpe.encode(texts), strict=True) if np.frombuffer(ids, dtype="<i4").tolist() != reference.encode_ordinary(t)] == []
    pieces = [p for t in texts[:4000] for p in bpe.pieces(t)]
    assert [p for p in pieces if bpe.by_rule(p.encode()) != reference.encode_ordinary(p) and len(bpe.pieces(p)) == 1] == []


def test_characters_split_alike_in_every_version_of_unicode(reference):
    bpe = byte_bpe.ByteBpe(*byte_bpe.ranks_path())
    known = re.compile(r"[\ud800-\udfff]")
    chars = [chr(i) for i in range(0x80, 0x110000, 7) if not known.match(chr(i))] + ["₏", "\U000323b0", "\U0003d000", "꟎"]
    texts = [f"a{c}1{c}!{c} {c}\n{c}" for c in chars]
    assert [t for t, ids in zip(texts, bpe.encode(texts), strict=True) if np.frombuffer(ids, dtype="<i4").tolist() != reference.encode_ordinary(t)] == []


def test_tokens_of_odd_texts(spark, reference):
    how = byte_bpe.ranks_path()
    rows = [(1, "naïve 漢字 🙂 don't"), (1, "naïve 漢字 🙂 don't"), (2, None), (3, ""), (None, "x" * 300_000), (4, "<|endoftext|> \u0000\n\n  ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("starts", "tokens", "decoded")})
    found = byte_bpe.encode(df, *how).select("*", "encoded.ids", F.col("encoded.starts").alias("begin"))
    found = byte_bpe.decode_tokens(byte_bpe.decode(found, *how, into="data"), *how, into="said").collect()
    assert [(r.doc_id, r.text) for r in found] == rows and {r.tokens for r in found} == {"clash"}
    for r in found:
        text = r.text or ""
        assert r.ids == reference.encode_ordinary(text) and bytes(r.data).decode() == text == "".join(r.said)
        assert all(text[a:].startswith(s) for a, s, part in zip(r.begin, r.said, map(reference.decode_single_token_bytes, r.ids), strict=True) if s and s.encode() == part)
        assert {text[a] for a, s in zip(r.begin, r.said, strict=True) if not s} <= set("漢字🙂")
    assert [text for text in found[0].said if text][2:] == [" ", "漢", "字", " ", "🙂", " don", "'t"] or found[0].said.count("") >= 2
    assert byte_bpe.encode(df.limit(0), *how).collect() == []
    odd = spark.createDataFrame([([31373, None, 99_999_999, -5],), (None,), ([],), ([220, 158],)], "ids array<int>")
    assert [r.decoded and bytes(r.decoded).decode("utf-8", "replace") for r in byte_bpe.decode(odd, *how).collect()][:3] == ["hello���", None, None or b""]
    assert byte_bpe.decode_tokens(odd, *how).first().tokens == ["hello", "�", "�", "�"]
