"""Suffix-array dedup: remove what a string of ``LENGTH`` bytes covers that also starts anywhere else.

Equal strings of that length hold the same content-chosen anchor: the gram of ``GRAM`` bytes with the least hash among
the ``LENGTH - GRAM + 1`` of them. So it is enough to look around anchors that occur more than once.

1. One pass writes each document's anchors. Texts are named by the digest of their bytes, whatever their ids. Of documents
   with equal bytes one stands for all: the others, and it too, repeat throughout.
2. Around each anchor that occurs again lies a window: all bytes of the strings that it is the anchor of. Windows with equal
   bytes repeat throughout; one of them stays as a partner for the others.
3. Different windows around the same gram go to one block. A block's suffix array gives its Burrows-Wheeler transform.
   Breadth-first backward extension from the empty string derives common-prefix lengths by increasing value, and stops
   at ``LENGTH``: rows whose length is then still open share at least that much with their neighbour.
4. A gram with very many different windows is split by where its strings start, a few starts at a time. Such a slice
   is grouped by the bytes that all of its strings share, equal slices fall together, and only what still differs at
   its ends goes to blocks; where even that is too much for one block, strings are matched by digests, salted nowhere
   as their counts are combined before the shuffle.

Every step shuffles rows that are bounded by the text, no group of copies meets in one task, nothing is capped.

Defined results: a null or empty text has no bytes. Matches never cross documents. Rows of equal bytes are
copies of each other, whether they share an id or not; rows without an id are judged with the others. Removal is judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix, powers, prefix_sums, small_batches, table

LENGTH, GRAM = 200, 64
#: Anchors are chosen in stretches of so many bytes, so that a position fits beside its hash.
STRETCH = 1 << 20
#: Windows that one block holds; different windows of one gram beyond which it is split, and starts in a slice.
IN_BLOCK, MANY, SLICE = 100, 500, 9
#: Rounds of extension after which closed rows are left out; closing one again changes nothing.
COMPACT = 8


def anchors(buf: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all strings of this length, and the first and last string that each is
    chosen for; the last of equal least hashes counts."""
    if len(buf) < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none, none
    found, hashes, heads, tails, window = [], [], [], [], length - gram + 1
    for start in range(0, len(buf) - length + 1, STRETCH - length):
        part = buf[start : start + STRETCH]
        if len(part) < length:
            break
        sums = prefix_sums(part)
        n = len(part) - gram + 1
        with np.errstate(over="ignore"):
            h = mix((sums[gram:] - sums[:-gram]) * powers(n)[1][:n])
        key = (h & ~np.uint64(STRETCH - 1)) | (np.uint64(STRETCH - 1) - np.arange(n, dtype=np.uint64))
        full = -(-n // window) * window  # least of each window of keys: running least from both ends of each chunk
        padded = np.full(full, 2**64 - 1, dtype=np.uint64)
        padded[:n] = key
        chunks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(chunks, axis=1).ravel()
        back = np.minimum.accumulate(chunks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[: n - window + 1], ahead[window - 1 : n])
        head = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        heads.append(head + start)
        tails.append(np.append(head[1:], len(least)) - 1 + start)
        least = least[head]
        at = (np.uint64(STRETCH - 1) - (least & np.uint64(STRETCH - 1))).astype(np.int64)
        found.append(at + start)
        hashes.append(h[at])
    at, hashes, heads, tails = map(np.concatenate, (found, hashes, heads, tails))
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))  # an anchor may go on in the next stretch
    return at[new], hashes[new], np.minimum.reduceat(heads, new), np.maximum.reduceat(tails, new)


def anchored(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_bytes, and for each anchor its position, hash, and first and last string before it."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, key, data in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("data").to_pylist(), strict=True):
                at, h, head, tail = anchors(np.frombuffer(data, dtype=np.uint8))
                rows.append((doc, key, len(data), at.astype(np.int32), h.view(np.int64), (at - head).astype(np.int32), (at - tail).astype(np.int32)))
            names = ["doc_id", "key", "n_bytes", "positions", "hashes", "heads", "tails"]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds, strict=True)], names)

    columns = "doc_id long, key binary, n_bytes long, positions array<int>, hashes array<long>, heads array<int>, tails array<int>"
    return docs.select("doc_id", "key", "data").mapInArrow(made, columns)


def windows(placed: DataFrame, with_data: bool) -> DataFrame:
    """A row for each of a text's anchors in the list x: its fields, and the window or its digest."""
    fields = ["at", "h", "head", "tail"] + ["copies", "different"] * with_data

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"key": pa.binary(), "at": pa.int32(), "h": pa.int64(), "head": pa.int32(), "tail": pa.int32(), "copies": pa.int64(), "different": pa.int64(), "window": pa.binary()}
        names = ["key", *fields, "window"]
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "data", *fields)]
            for k in range(0, len(cols[0]), 20):
                rows = []
                for doc, data, *found in zip(*(c[k : k + 20] for c in cols), strict=True):
                    for x in zip(*found, strict=True):
                        part = data[x[0] - x[2] : x[0] - x[3] + LENGTH]
                        rows.append((doc, *x, part if with_data else hashlib.md5(part + x[2].to_bytes(2, "little")).digest()))
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for c, n in zip(zip(*rows) if rows else [()] * len(names), names, strict=True)], names)

    schema = "key binary, at int, h long, head int, tail int, " + "copies long, different long, " * with_data + "window binary"
    return placed.select("key", "data", *[F.col(f"x.{c}").alias(c) for c in fields]).mapInArrow(made, schema)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling on ranks, of the suffixes that still tie; text holds small numbers and 0 at its end."""
    n = len(text)
    occurs = np.zeros(int(text.max()) + 1, dtype=np.uint64)
    occurs[text] = 1
    code = np.cumsum(occurs)[text]  # from 1, in as few bits as the symbols need
    bits = int(code.max()).bit_length()
    depth = 64 // bits
    key = np.zeros(n, dtype=np.uint64)
    for i in range(min(n, depth)):
        key[: n - i] |= code[i:] << np.uint64(bits * (depth - 1 - i))
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1], [True]])
    rank = np.full(n + 1, -1, dtype=np.int64)  # the first row of those that tie; what lies beyond the end is least
    rank[order] = np.maximum.accumulate(np.where(new[:-1], np.arange(n), 0))
    while len(tied := np.flatnonzero(~(new[:-1] & new[1:]))):
        own = order[tied]
        key = rank[own] << 32 | rank[np.minimum(own + depth, n)] + 1
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[tied] = own
        new[tied] = first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[own] = np.maximum.accumulate(np.where(first, tied, 0))
        depth *= 2
    return order


def long_common_prefixes(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each row of the suffix array, whether it shares at least this many symbols with the row before.

    The transform's rows with one symbol, in order, are the rows that extend them to the left by it. So a row parts
    from the row before it after v + 1 symbols if, of the rows between the two that they extend, some part after v and
    none earlier. Values grow by one in each round; rows still open after ``least - 1`` rounds share enough.
    """
    n = len(text)
    bwt = text[order - 1]
    extended = np.argsort(bwt, kind="stable")
    symbol = bwt[extended]
    closed = np.ones(n, dtype=bool)  # value 0: rows whose first symbol differs from the row before
    row = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
    closed[row] = False
    low, high = extended[row - 1], extended[row]
    count, before = np.empty(n, dtype=np.int32), -1
    for value in range(least - 1):
        np.cumsum(closed, dtype=np.int32, out=count)
        if count[-1] == before:
            break
        before = int(count[-1])
        hit = count.take(high) > count.take(low)
        closed[row[np.flatnonzero(hit)]] = True
        if value % COMPACT == 0:
            left = np.flatnonzero(~hit)
            row, low, high = row.take(left), low.take(left), high.take(left)
    return ~closed


def repeated_starts(parts: list[bytes], places: np.ndarray, again: np.ndarray) -> list[np.ndarray]:
    """For each part, the starts of its strings of ``LENGTH`` bytes that stand at another place too.

    places: a number for each part's first byte, so that the same byte of the same document has the same number in any
    part. again: whether the whole part stands elsewhere too.
    """
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    text = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8).astype(np.int16) + 1
    heads = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text[heads + sizes] = 0
    part_of = np.repeat(np.arange(len(parts)), sizes + 1)
    within = np.arange(len(text)) - heads[part_of]
    order = suffix_array(text)
    group = np.cumsum(~long_common_prefixes(text, order, LENGTH))
    good = within[order] + LENGTH <= sizes[part_of[order]]
    rows, group = order[good], group[good]
    place = places[part_of[rows]] + within[rows]
    n = int(group.max(initial=0)) + 1
    low, high, other = np.full(n, 2**62), np.full(n, -1), np.zeros(n, dtype=bool)
    np.minimum.at(low, group, place)
    np.maximum.at(high, group, place)
    np.logical_or.at(other, group, again[part_of[rows]])
    hit = (low[group] != high[group]) | other[group]
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(parts)
    rows = rows[hit]
    rows = rows[np.argsort(part_of[rows], kind="stable")]
    cut = np.searchsorted(part_of[rows], np.arange(len(parts) + 1))
    return [np.sort(within[rows[cut[i] : cut[i + 1]]]) if cut[i] < cut[i + 1] else out[i] for i in range(len(parts))]


def runs(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last of each run of neighbouring numbers."""
    if len(starts):
        cut = np.flatnonzero(np.diff(starts) > 1)
        yield from zip(starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.concatenate([cut, [len(starts) - 1]])].tolist(), strict=True)


def judge_block(block: pd.DataFrame) -> pd.DataFrame:
    """Spans [start, end) of texts; block: key, first (place of the part's first byte), part, copies."""
    docs, code = np.unique(block["key"].to_numpy(), return_inverse=True)
    first = block["first"].to_numpy(dtype=np.int64)
    found = repeated_starts(list(block["part"]), (code.astype(np.int64) << 34) + first, block["copies"].to_numpy() > 1)
    rows = [(d, f + a, f + b + LENGTH) for d, f, starts in zip(block["key"], first, found, strict=True) for a, b in runs(starts)]
    return pd.DataFrame(rows, columns=["key", "start", "end"]).astype({"start": "int64", "end": "int64"})


SPAN = "key binary, start long, end long"


def judged(parts: DataFrame, by: str, total: int) -> DataFrame:
    """Spans from parts (by, key, first, part, copies): parts with the same value of by meet in one block."""
    blocks = max(1, -(-total // IN_BLOCK))
    return parts.withColumn("_block", F.pmod(F.xxhash64(by), F.lit(blocks))).groupBy("_block").applyInPandas(lambda b: judge_block(b), SPAN)


def slices(rows: DataFrame) -> DataFrame:
    """A row for each few starts of a window: core (digest of what their strings share), first, part."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                left, last = r.head, len(r.window) - LENGTH
                for k in range(0, LENGTH - GRAM + 1, SLICE):  # starts k to k + SLICE - 1 bytes before the gram
                    low, high = left - k - SLICE + 1, left - k
                    a, b = max(0, low), min(high, last)
                    if a <= b:
                        core = hashlib.md5(r.window[high : low + LENGTH] + k.to_bytes(2, "little") + r.h.to_bytes(8, "little", signed=True))
                        out.append((core.digest(), r.key, r.at - left + a, r.window[a : b + LENGTH], r.copies))
            yield pd.DataFrame(out, columns=["core", "key", "first", "part", "copies"])

    return rows.select("key", "at", "h", "head", "window", "copies").mapInPandas(made, "core binary, key binary, first long, part binary, copies long")


def digests(rows: DataFrame) -> DataFrame:
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (hashlib.md5(r.part[i : i + LENGTH]).digest(), r.key, r.first + i, r.copies)
                for r in batch.itertuples()
                for i in range(len(r.part) - LENGTH + 1)
            ]
            yield pd.DataFrame(out, columns=["digest", "key", "start", "copies"])

    return rows.select("key", "first", "part", "copies").mapInPandas(made, "digest binary, key binary, start long, copies long")


def by_digest(parts: DataFrame) -> DataFrame:
    """Spans of the strings of parts that occur in more than one place."""
    strings = digests(parts)
    place = F.struct("key", "start")
    twice = strings.groupBy("digest").agg(F.max("copies").alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi")).where("n > 1 OR lo <> hi").select("digest")
    return strings.join(twice, "digest").select("key", "start", (F.col("start") + LENGTH).alias("end"))


def repeated_spans(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key) with copied set where other rows have the same bytes, and spans of the texts by key."""
    base = scratch.write(anchored(docs))
    texts = scratch.write(base.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")))
    firsts = base.dropDuplicates(["key"])
    grams = firsts.select("key", F.explode(F.arrays_zip("positions", "hashes", "heads", "tails")).alias("x"))
    grams = grams.select("key", F.col("x.positions").alias("at"), F.col("x.hashes").alias("h"), F.col("x.heads").alias("head"), F.col("x.tails").alias("tail"))
    twice = scratch.write(grams.groupBy("h").count().where("count > 1").select("h"))  # apart, so that the join can split a frequent gram
    held = scratch.write(grams.join(twice, "h"))

    def with_text(lists: DataFrame) -> DataFrame:
        """Lists of texts (d, x) beside the bytes of one row of each text: of its least id, so that copies don't meet."""
        chosen = lists.join(texts.select("key", "first"), F.col("d") == F.col("key")).drop("key")
        return docs.join(chosen, (F.col("key") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("first"))).dropDuplicates(["key"])

    placed = held.groupBy(F.col("key").alias("d")).agg(F.collect_list(F.struct("at", "h", "head", "tail")).alias("x"))  # at most the text's anchors
    seen = scratch.write(windows(with_text(placed), False))

    place = F.struct("key", "at", "head", "tail")
    kinds = scratch.write(seen.groupBy("h", "window").agg(F.min(place).alias("x"), F.count("*").alias("copies")))
    copied = seen.join(kinds.where("copies > 1").select("h", "window"), ["h", "window"], "left_semi")
    whole = copied.select("key", (F.col("at") - F.col("head")).cast("long").alias("start"), (F.col("at") - F.col("tail") + LENGTH).cast("long").alias("end"))

    different = kinds.groupBy("h").agg(F.count("*").alias("different")).where("different > 1")
    mixed = kinds.join(different, "h").groupBy(F.col("x.key").alias("d")).agg(F.collect_list(F.struct("x.at", "h", "x.head", "x.tail", "copies", "different")).alias("x"))
    rows = scratch.write(windows(with_text(mixed), True))
    total = rows.count()
    few = rows.where(F.col("different") <= MANY).select("h", "key", (F.col("at") - F.col("head")).cast("long").alias("first"), F.col("window").alias("part"), "copies")
    spans = whole.unionByName(judged(few, "h", total))

    many = rows.where(F.col("different") > MANY)
    if not many.isEmpty():
        sliced = scratch.write(slices(many))
        equal = scratch.write(sliced.groupBy("core", "part").agg(F.min(F.struct("key", "first")).alias("x"), F.sum("copies").alias("n")))
        same = sliced.join(equal.where("n > 1").select("core", "part"), ["core", "part"], "left_semi")
        spans = spans.unionByName(same.select("key", F.col("first").alias("start"), (F.col("first") + F.length("part")).alias("end")))
        left = equal.groupBy("core").agg(F.count("*").alias("different")).where("different > 1")
        left = scratch.write(equal.join(left, "core").select("core", "x.key", "x.first", "part", F.col("n").alias("copies"), "different"))
        small, large = left.where(F.col("different") <= MANY), left.where(F.col("different") > MANY)
        spans = spans.unionByName(judged(small, "core", left.count())).unionByName(by_digest(large))
    copies = texts.where("rows > 1").select(F.col("key").alias("c"))
    return base.select("doc_id", "key").join(copies, F.col("key") == F.col("c"), "left").withColumn("copied", F.col("c").isNotNull()).drop("c"), spans


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, data (the bytes that stay), n_bytes, n_removed, n_spans."""
    spark = docs.sparkSession
    small_batches(spark, 200)
    scratch = Scratch(spark, "suffix")
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("data"))
    docs = docs.withColumn("key", F.unhex(F.md5("data")))
    base, spans = repeated_spans(docs, scratch)
    spans = scratch.write(spans)
    merged = spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # at most the text's bytes
    state = base.distinct().join(merged, "key", "left").where("copied OR spans IS NOT NULL")  # copies go as a whole
    state = state.select(F.col("doc_id").alias("i"), F.col("key").alias("d"), "copied", F.when(~F.col("copied"), F.col("spans")).alias("spans"))
    joined = docs.join(state, (F.col("key") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                data, out, end, removed, n = r["data"], [], 0, 0, 0
                spans = [(0, len(data))] if r["copied"] and len(data) >= LENGTH else sorted((s["start"], s["end"]) for s in r["spans"] or ())
                joined: list[list[int]] = []
                for a, b in spans:
                    b = min(b, len(data))
                    if joined and a <= joined[-1][1]:
                        joined[-1][1] = max(b, joined[-1][1])
                    else:
                        joined.append([a, b])
                for a, b in joined:
                    out.append(data[end:a])
                    removed, n, end = removed + b - a, n + 1, b
                rows.append((r["doc_id"], b"".join([*out, data[end:]]), len(data), removed, n))
            names = ["doc_id", "data", "n_bytes", "n_removed", "n_spans"]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds, strict=True)], names)

    return joined.select("doc_id", "data", F.coalesce("copied", F.lit(False)).alias("copied"), "spans").mapInArrow(cut, "doc_id long, data binary, n_bytes long, n_removed long, n_spans long")


def op10_suffix_dedup(spark, sf_dir):
    found = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("data", 256).alias("kept_sha256"))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
ORACLES = {}
