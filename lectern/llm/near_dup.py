"""MinHash near-dedup: universal hash minima with banding, signature verification, exact confirmation, components.

1. One pass turns each document into a digest of its words, the size of its shingle set, a signature (one byte of
   each minimum) and a key for each band. Documents with equal words fall to the one with the smallest id.
2. Documents that share a band key form a bucket. Each member meets the bucket's smallest id; pairs whose signatures
   agree often enough are confirmed on the full sets. Components of these links follow by alternating large-star and
   small-star.
3. Where a bucket still spans several components, all its pairs across components are compared on full sets, in blocks
   of bounded size, by matrix products; a block returns no more links than join its components. So no link between
   different texts is lost within a bucket, and groups of near copies aren't expanded into pairs.

A pair at the threshold shares no bucket with probability ``(1 - t**ROWS)**BANDS``: 2.6e-7 at 0.85, 6e-5 at 0.8.

Defined results: a text with fewer words than a shingle is one shingle; without words, or null, it has none and is
linked with nothing. Equal rows share a component; rows that share an id but not the text are documents of their own, told apart
by a further column ``own_id``, which is there only if there are any. Rows without an id are linked with nothing and stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix, own_ids, prefix_sums, small_batches, span_hashes, table

BANDS, ROWS = 32, 6
#: Standard deviations that a signature may fall short of the threshold before its pair is given up.
MARGIN = 5.0
#: Documents of a bucket that one task compares.
IN_BLOCK = 800
#: Ids are looked up by a broadcast up to so many, by a shuffle beyond.
BROADCAST_IDS = 500_000

_rng = np.random.default_rng(20240501)
MULTIPLY = _rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
ADD = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of neighbouring words."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    size = min(size, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    sums = prefix_sums(np.frombuffer(b" ".join(words), dtype=np.uint8))
    return np.unique(span_hashes(sums, (ends - lengths)[: len(words) - size + 1], ends[size - 1 :]))


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space."""
    return text.lower().split()


def minima(hashes: np.ndarray) -> np.ndarray:
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(BANDS * ROWS, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(x), 256):
        np.minimum(best, (x[i : i + 256, None] * MULTIPLY + ADD).min(axis=0), out=best)
    return best


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, digest, n_shingles, signature, bands."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text) if text else []
                if not words:
                    rows.append((doc, None, 0, None, None))
                    continue
                hashes = shingle_set(words, size)
                best = minima(hashes)
                keys = np.full(BANDS, 0x1234567, dtype=np.uint64) + band
                for column in best.reshape(BANDS, ROWS).T:
                    keys = mix(keys ^ column.astype(np.uint64)) + band
                rows.append((doc, hashlib.md5(b" ".join(words)).digest(), len(hashes), (best & np.uint32(255)).astype(np.uint8).tobytes(), keys.view(np.int64)))
            names = ["doc_id", "digest", "n_shingles", "signature", "bands"]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(made, "doc_id long, digest binary, n_shingles long, signature binary, bands array<long>")


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(words_of(t or b""), size).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(made, "doc_id long, shingles binary")


def with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is among the ids."""
    ids = ids.distinct()
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def signatures_agree(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures agree as often as sets at the threshold do, less a margin."""
    t, k = percent / 100, BANDS * ROWS
    least = (t - MARGIN * (t * (1 - t) / k) ** 0.5) * k

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x, y = (np.frombuffer(b"".join(b[c]), dtype=np.uint8).reshape(len(b), k) for c in ("a_signature", "b_signature"))
                yield b.loc[(x == y).sum(axis=1) >= least, ["a", "b"]]

    return pairs.mapInPandas(kept, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    both = both.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                n = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) else 0
                good.append(100 * n >= percent * (len(x) + len(y) - n))
            yield batch.loc[np.array(good, dtype=bool), ["a", "b"]]

    return both.select("a", "b", "x", "y").mapInPandas(kept, "a long, b long")


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node with an edge (a, b), by large-star and small-star."""
    edges = scratch.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v")).distinct()
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        star = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        star = scratch.write(star)
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        joined = star.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).union(joined.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        old, edges = edges, scratch.write(small)
        scratch.drop(old)
        scratch.drop(star)


def links_across(ids: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between documents of different components, as many as join components; every such pair is compared."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    names, group, counts = np.unique(labels, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return []
    order = np.argsort(group == counts.argmax(), kind="stable")  # the largest component comes last: no row of its own
    rest = int((group != counts.argmax()).sum())
    tokens = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(order)), sizes[order])
    _, code, often = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = often[code] > 1
    code, owner = code[shared], owner[shared]
    by = np.argsort(code, kind="stable")
    code, owner = np.unique(code[by], return_inverse=True)[1] if len(by) else code, owner[by]
    common = np.zeros((rest, len(order)), dtype=np.float32)
    width = 4096
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [start, start + width])
        dense = np.zeros((len(order), width), dtype=np.float32)
        dense[owner[a:b], code[a:b] - start] = 1
        common += dense[:rest] @ dense.T
    n = sizes[order]
    linked = 100 * common >= percent * (n[:rest, None] + n[None, :] - common)
    root = list(range(len(names)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        x, y = find(group[order[i]]), find(group[order[j]])
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((int(ids[order[i]]), int(ids[order[j]])))
    return out


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each document.

    Of rows that share an id but not the text each is a document of its own; one row of each component is kept.
    """
    spark = docs.sparkSession
    named, shared = own_ids(docs.select("doc_id", "text"), Scratch(spark, "near"))
    if not shared:
        return _near_duplicates(docs, size, percent)
    own = _near_duplicates(named.select(F.col("own_id").alias("doc_id"), "row.text"), size, percent)
    names = named.select(F.col("own_id").alias("name"), "row.doc_id").distinct()
    own = own.withColumnRenamed("doc_id", "own_id").join(names, F.col("own_id") == F.col("name"), "left")
    least = own.groupBy(F.col("component_id").alias("of")).agg(F.min("doc_id").alias("least"))
    return own.join(least, F.col("component_id") == F.col("of"), "left").select("doc_id", "n_shingles", F.col("least").alias("component_id"), "kept", "own_id")


def _near_duplicates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "near")
    base = scratch.write(sketch(docs, size))
    found = base.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    firsts = found.groupBy("digest").agg(F.min("doc_id").alias("first"))
    texts = found.join(firsts, [found["digest"] == firsts["digest"], F.col("doc_id") == F.col("first")], "left_semi").dropDuplicates(["doc_id"])
    texts = scratch.write(texts.select("doc_id", "signature", "bands"))

    members = texts.select("doc_id", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("members"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("all")).where("members > 1")
    buckets = scratch.write(buckets)  # apart, so that the join can split a large bucket
    members = scratch.write(members.join(buckets, "key"))
    signed = lambda c: texts.select(F.col("doc_id").alias(c), F.col("signature").alias(f"{c}_signature"))
    stars = members.where("doc_id <> pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct()
    likely = scratch.write(signatures_agree(stars.join(signed("a"), "a").join(signed("b"), "b").select("a", "b", "a_signature", "b_signature"), percent))
    wide = members.where("members > 2").select("doc_id")
    sets = scratch.write(sets_of(with_ids(docs, likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).union(wide)), size).dropDuplicates(["doc_id"]))
    linked = scratch.write(confirmed(likely, sets, percent))
    label = scratch.write(components(scratch, linked))

    # One of the buckets with the same members is enough; those within one component are done.
    labelled = members.where("members > 2").join(label, F.col("doc_id") == F.col("node"), "left").withColumn("label", F.coalesce("component", "doc_id"))
    spread = labelled.groupBy("key", "members", "all").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    spread = spread.groupBy("members", "all", "lo", "hi").agg(F.min("key").alias("key"))
    parts = F.ceil(F.col("members") / IN_BLOCK).cast("int")
    rows = labelled.join(spread.select("key"), "key").select("key", "doc_id", "label", parts.alias("parts"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    blocks = rows.withColumn("block", F.explode(pair)).join(sets, "doc_id").select("key", "block.i", "block.j", "doc_id", "label", "shingles")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        held = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
        return pd.DataFrame(links_across(group["doc_id"].to_numpy(), group["label"].to_numpy(), held, percent), columns=["a", "b"], dtype="int64")

    across = blocks.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()
    across = scratch.write(confirmed(across, sets, percent))
    label = scratch.write(components(scratch, label.select(F.col("node").alias("a"), F.col("component").alias("b")).union(across)))

    firsts = firsts.join(label, F.col("first") == F.col("node"), "left").select(F.col("digest").alias("d"), F.coalesce("component", "first").alias("component"))
    out = base.join(firsts, F.col("digest") == F.col("d"), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without the later ones of each group of near duplicates; those without an id stay."""
    named, _ = own_ids(docs, Scratch(docs.sparkSession, "near"))
    later = _near_duplicates(named.select(F.col("own_id").alias("doc_id"), "row.text"), size, percent).where("NOT kept")
    return named.join(later.select(F.col("doc_id").alias("own_id")).distinct(), "own_id", "left_anti").select("row.*")


def op2_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=3, percent=85)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+') if x <> ''] AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
rare AS (SELECT s, doc_id FROM sh),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM rare a JOIN rare b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least_ AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id LEFT JOIN least_ ON least_.a = w.doc_id"""

QUERIES = {"op2_near_dedup": op2_near_dedup}
ORACLES = {"op2_near_dedup": ORACLE}
