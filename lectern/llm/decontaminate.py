"""Benchmark decontamination: latent semantic retrieval, then longest-common-subsequence and answer checks.

1. One pass over the texts turns words, without the punctuation at their ends, into numbers of the benchmark's vocabulary
   (other words become -1), written once. Words of punctuation alone are no words, in texts and items.
2. Passages are windows of ``PASSAGE`` words, half overlapping. How often each word stands, to the number of passages, gives
   its weight; words beyond ``COMMON``, and 200, weigh nothing, but for the rarest few of each item.
3. Randomised SVD of the passages' TF-IDF matrix: each task sums its share of ``A' A W`` for a random matrix W; the
   sums are combined by Spark, and the leading right singular vectors follow from them (Nystrom).
4. Passages and benchmark items are projected; an item longer than a passage is cut into windows of ``PASSAGE`` words,
   half overlapping, that stand beside it under its id. Items of which some vector is within ``COSINE`` of a passage are
   candidates, unless the cosine of the whole TF-IDF vectors is below ``CLOSE``.
5. A candidate is verified on the word sequence around its passage: the longest common subsequence with the item in a
   window little longer than the item, and with the item's answer, which is its last words. Paraphrases keep most of
   the words in order; they pass where the answer is there too.

The driver and each task hold ``BLOCK`` bytes of items: their vocabulary, and they and their windows times ``RANK`` numbers. A
larger benchmark is dealt into blocks by a hash of the item's id, and each block is searched for in turn, with a
vocabulary, weights and a decomposition of its own. Statistics, decomposition and search cover every passage.

Defined results: null or empty texts, and texts shorter than an item, are judged like others and match nothing they
don't hold; null or empty items, and items without an id, match nothing. Rows that share an id are judged as one. An empty benchmark or table
gives no rows. Columns beside the id and the text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, own_ids, small_batches, table

PASSAGE, COMMON, RANK, OVERSAMPLE, COSINE, CLOSE = 48, 0.003, 96, 16, 0.35, 0.3
#: Columns of the matrix; a larger vocabulary is hashed to so many.
FEATURES = 1 << 14
#: Bytes of items that are searched for at once.
BLOCK = 8 << 20
#: Words of an item that weigh something, however frequent.
KEPT = 5
#: Vectors of the benchmark that are multiplied at once.
SLICE = 4096
#: Shares of an item's words: enough alone; enough together with this share of its answer; the answer's share of it.
SURE, LIKELY, ANSWERED, ANSWER = 0.8, 0.6, 0.5, 0.25

_TRIM = re.compile(rb"^[^a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff]+$")


def words_of(text: str | None) -> list[bytes]:
    return [w for w in (_TRIM.sub(b"", w) for w in (text or "").encode(errors="replace").lower().split()) if w]


class Lookup(dict):
    """Numbers of words as they stand in texts: -1 for words of no item, -2 for punctuation alone. Words that are not
    in it are trimmed as those of items; up to KNOWN of them are remembered."""

    KNOWN = 1 << 18

    def __missing__(self, word: bytes) -> int:
        trimmed = _TRIM.sub(b"", word)
        found = self.get(trimmed, -1) if trimmed else -2
        if len(self) < self.KNOWN and len(word) < 32:
            self[word] = found
        return found


class Benchmark:
    """Vocabulary, items as number sequences, and the weights once they are known."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        self.ids, self.items, self.number = [], [], {}
        for item, text in rows:
            words = words_of(text)
            if words:
                self.ids.append(item)
                self.items.append(np.array([self.number.setdefault(w, len(self.number)) for w in words], dtype=np.int32))
        parts = [[x] if len(x) <= PASSAGE else [x, *(x[a : a + PASSAGE] for a in range(0, len(x) - PASSAGE // 2, PASSAGE // 2))] for x in self.items]
        self.windows, self.item_of = [w for x in parts for w in x], np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        self.columns = max(1, min(FEATURES, len(self.number)))
        self.lookup = Lookup(self.number)
        self.masks = [{int(w): sum(1 << int(p) for p in np.flatnonzero(item == w)) for w in np.unique(item)} for item in self.items]
        self.weights = self.vectors = self.basis = self.entries = None

    def sequence(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        found = np.fromiter(map(self.lookup.__getitem__, words), dtype=np.int32, count=len(words))
        return found[found != -2]


def passages(sequence: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """(passage, column) of each known word; passage j spans words j * PASSAGE / 2 up to PASSAGE more."""
    at = np.flatnonzero(sequence >= 0)
    column, half = sequence[at].astype(np.int64) % columns, at // (PASSAGE // 2)
    return np.concatenate([half, half[half > 0] - 1]), np.concatenate([column, column[half > 0]])


def weighted(passage: np.ndarray, column: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct passages, and row, column and value of their non-zero TF-IDF entries."""
    good = weights[column] > 0
    key, tf = np.unique(passage[good] * len(weights) + column[good], return_counts=True)
    names, row = np.unique(key // len(weights), return_inverse=True)
    column = key % len(weights)
    return names, row, column, (weights[column] * (1 + np.log(tf))).astype(np.float32)


def projected(n: int, row: np.ndarray, column: np.ndarray, value: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Rows of the sparse matrix times the basis; rows come in ascending order, none is empty."""
    out = np.zeros((n, basis.shape[1]), dtype=np.float32)
    for a in range(0, n, 4096):
        lo, hi = np.searchsorted(row, [a, min(n, a + 4096)])
        first = np.searchsorted(row[lo:hi], np.arange(a, min(n, a + 4096)))
        out[a : a + 4096] = np.add.reduceat(basis[column[lo:hi]] * value[lo:hi, None], first, axis=0)
    return out


def lcs(mask: dict[int, int], size: int, sequence: list[int]) -> int:
    """Length of the longest common subsequence; mask has the places of each word in the pattern as bits."""
    full = (1 << size) - 1
    v = full
    for w in sequence:
        if m := mask.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def holds(shares: tuple[float, float]) -> tuple[bool, float, float]:
    """Whether these shares of an item and of its answer stand for the item; and the shares, to rank by."""
    share, answer = shares
    return share >= SURE or share >= LIKELY and answer >= ANSWERED, share, answer


def verify(bench: Benchmark, i: int, sequence: np.ndarray, start: int, done: dict[int, tuple[float, float]]) -> tuple[float, float]:
    """Best shares of the item and of its answer in the windows around the passage that starts here, those of a window that
    holds the item before any other; done has those of windows that other passages of the same document met, for items
    longer than a passage."""
    item, mask = bench.items[i], bench.masks[i]
    m = len(item)
    span, step = m + m // 4 + 2, max(1, m // 4)
    low, high = max(0, start - m), min(len(sequence), start + PASSAGE + m)
    if m > PASSAGE:  # windows at multiples of the step, so that passages share them
        low, high = low - low % step, min(len(sequence), start + PASSAGE + span)
    part = sequence[low:high]
    known = np.isin(part, item)
    count = np.concatenate([[0], np.cumsum(known)])
    best = (0.0, 0.0)
    tail = max(3, round(m * ANSWER))
    cut = max(0, m - tail)
    for a in range(0, start + PASSAGE - low if m > PASSAGE else max(1, len(part) - span + step), step):
        b = min(len(part), a + span)
        if m > PASSAGE and low + a in done:
            best = max(best, done[low + a], key=holds)
            continue
        if a >= b or count[b] - count[a] < LIKELY * m:
            continue  # more words in common than there are can't be found
        window = part[a:b].tolist()
        share = lcs(mask, m, window) / m
        if share >= LIKELY:
            answer = lcs({w: x >> cut for w, x in mask.items()}, m - cut, window) / max(1, m - cut)
            best = max(best, (share, answer), key=holds)
            done[low + a] = (share, answer)
        else:
            done[low + a] = (0.0, 0.0)
    return best


def close(bench: Benchmark, row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Which pairs (row, item or window) have whole TF-IDF vectors with a cosine of at least CLOSE."""
    n = int(row[-1]) + 1
    first = np.searchsorted(row, np.arange(n + 1))
    lengths = np.sqrt(np.bincount(row, value.astype(np.float64) ** 2, n))
    counts = (first[1:] - first[:-1])[rows]
    pair = np.repeat(np.arange(len(rows)), counts)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts) + first[rows[pair]]
    key = items[pair] * np.int64(bench.columns) + column[at]
    place = np.minimum(np.searchsorted(bench.entries, key), len(bench.entries) - 1)
    both = np.where(bench.entries[place] == key, value[at] * bench.weights[column[at]], 0.0)
    own = np.sqrt(np.bincount(bench.entries // bench.columns, bench.weights[bench.entries % bench.columns].astype(np.float64) ** 2, len(bench.windows)))
    return np.bincount(pair, both, len(rows)) >= CLOSE * lengths[rows] * own[items]


def blocks_of(benchmark: DataFrame) -> Iterator[tuple[Benchmark, int]]:
    """Blocks of the items that have an id and a text, all rows of an id in one, and how many blocks there are."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "text").collect()  # about BLOCK bytes
        yield Benchmark([tuple(r) for r in rows]), n


SCHEMA = "doc_id long, item_id long, cosine double, share double, answer_share double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, share, answer_share: each document with each item that it holds."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "decontaminate")
    parts = []
    for bench, blocks in blocks_of(benchmark):
        if not bench.items:
            continue
        found, numbered = searched(docs, bench, scratch)
        if blocks == 1:
            return found
        parts.append(scratch.write(found).scratch_path)
        scratch.drop(numbered)
    return spark.read.schema(SCHEMA).parquet(*parts) if parts else spark.createDataFrame([], SCHEMA)


def searched(docs: DataFrame, bench: Benchmark, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The documents with the items of one block that they hold, and the written table that this is read from."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(bench)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = sent.value
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([b.sequence(t).tobytes() if t else b"" for t in texts], pa.binary())], ["doc_id", "words"])

    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(number, "doc_id long, words binary")
    numbered = scratch.write(numbered.where("length(words) > 0"))

    def entries(batch: pd.DataFrame, columns: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Passages of a batch of documents, numbered apart, and the documents' sequences."""
        sequences = [np.frombuffer(w, dtype=np.int32) for w in batch["words"]]
        found = [passages(s, columns) for s in sequences]
        shift = np.concatenate([[0], np.cumsum([len(s) // (PASSAGE // 2) + 1 for s in sequences])])
        return np.concatenate([p + x for (p, _), x in zip(found, shift[:-1], strict=True)]), np.concatenate([c for _, c in found]), sequences

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = sent.value.columns
        total, count = 0, np.zeros(columns, dtype=np.int64)
        for batch in batches:
            for w in batch["words"]:
                sequence = np.frombuffer(w, dtype=np.int32)
                count += np.bincount(sequence[sequence >= 0] % columns, minlength=columns)
                total += len(sequence) // (PASSAGE // 2) + 1
        at = np.flatnonzero(count)
        yield pd.DataFrame({"column": np.append(at, -1), "n": np.append(count[at], total)})

    counts = numbered.mapInPandas(frequencies, "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(bench.columns)
    known = counts[counts["column"] >= 0]
    df[known["column"].to_numpy(dtype=int)] = known["n"]
    total = max(1, int(counts.loc[counts["column"] < 0, "n"].sum()))
    rare = df <= max(200.0, COMMON * total)
    for item in bench.windows:  # an item of frequent words only keeps its rarest ones
        own = np.unique(item % bench.columns)
        if rare[own].sum() < KEPT:
            rare[own[np.argsort(df[own], kind="stable")[:KEPT]]] = True
    weights = np.where(rare, np.log(1 + total / np.maximum(df, 1)), 0.0).astype(np.float32)
    bench.weights = weights

    width = min(RANK + OVERSAMPLE, bench.columns)
    random = np.random.default_rng(7).standard_normal((bench.columns, width)).astype(np.float32)
    drawn = spark.sparkContext.broadcast((weights, random))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, random = drawn.value
        z = np.zeros(random.shape, dtype=np.float64)
        for batch in batches:
            p, c, _ = entries(batch, len(weights))
            names, row, column, value = weighted(p, c, weights)
            if len(names):
                y = projected(len(names), row, column, value, random)
                order = np.argsort(column, kind="stable")
                cols, first = np.unique(column[order], return_index=True)
                for a in range(0, len(cols), 256):
                    lo, hi = first[a], first[a + 256] if a + 256 < len(cols) else len(order)
                    o = order[lo:hi]
                    z[cols[a : a + 256]] += np.add.reduceat(y[row[o]] * value[o, None], first[a : a + 256] - lo, axis=0)
        if z.any():
            part = TaskContext.get().partitionId()
            blocks = range(0, len(z), 1024)
            yield pd.DataFrame({"block": list(blocks), "salt": part % 32, "z": [z[b : b + 1024].tobytes() for b in blocks]})

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        z = np.sum([np.frombuffer(x) for x in group["z"]], axis=0)
        return pd.DataFrame({"block": [group["block"].iloc[0]], "salt": [0], "z": [z.tobytes()]})

    parts = numbered.mapInPandas(sketch, "block long, salt int, z binary")
    for keys in (("block", "salt"), ("block",)):
        parts = parts.groupBy(*keys).applyInPandas(summed, "block long, salt int, z binary")
    z = np.zeros(random.shape)
    for r in parts.toPandas().itertuples():  # the whole sketch: at most FEATURES rows of RANK + OVERSAMPLE numbers
        own = np.frombuffer(r.z).reshape(-1, width)
        z[r.block : r.block + len(own)] = own
    core = random.T.astype(np.float64) @ z
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    good = values > max(1e-9, 1e-7 * values[-1]) if len(values) else values > 0
    left = np.linalg.svd(z @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)[0][:, :RANK] if good.any() else np.eye(bench.columns, width)
    bench.basis = left.astype(np.float32)
    vectors = np.zeros((len(bench.windows), bench.basis.shape[1]), dtype=np.float32)
    for i, item in enumerate(bench.windows):
        names, row, column, value = weighted(np.zeros(len(item), dtype=np.int64), item.astype(np.int64) % bench.columns, weights)
        if len(names):
            vectors[i] = projected(1, row, column, value, bench.basis)[0]
    bench.entries = np.concatenate([np.unique(i * bench.columns + item.astype(np.int64) % bench.columns) for i, item in enumerate(bench.windows)])
    bench.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    ready = spark.sparkContext.broadcast(bench)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = ready.value
        for batch in batches:
            out = []
            p, c, sequences = entries(batch, b.columns)
            shift = np.concatenate([[0], np.cumsum([len(s) // (PASSAGE // 2) + 1 for s in sequences])])
            names, row, column, value = weighted(p, c, b.weights)
            if not len(names):
                continue
            y = projected(len(names), row, column, value, b.basis)
            y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
            doc = np.searchsorted(shift, names, side="right") - 1
            done: dict[tuple[int, int], dict] = {}
            for a in range(0, len(y), 8192):
                near = []
                for v in range(0, len(b.vectors), SLICE):
                    cosines = y[a : a + 8192] @ b.vectors[v : v + SLICE].T
                    rows, items = np.nonzero(cosines >= COSINE)
                    good = close(b, row, column, value, rows + a, items + v)
                    near.append((rows[good], b.item_of[items[good] + v], cosines[rows[good], items[good]]))
                rows, items, cosine = map(np.concatenate, zip(*near, strict=True))
                best: dict[tuple[int, int], float] = {}
                for r, i, x in zip(rows.tolist(), items.tolist(), cosine.tolist(), strict=True):
                    best[r, i] = max(x, best.get((r, i), x))
                for (r, i), x in best.items():
                    d = int(doc[a + r])
                    share, answer = verify(b, i, sequences[d], int(names[a + r] - shift[d]) * (PASSAGE // 2), done.setdefault((d, i), {}) if len(b.items[i]) > PASSAGE else {})
                    if holds((share, answer))[0]:
                        out.append((batch["doc_id"].iloc[d], b.ids[i], x, share, answer))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SCHEMA.split(", ")])

    found = numbered.where("doc_id IS NOT NULL").mapInPandas(search, SCHEMA)
    found = found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max(F.struct("share", "answer_share")).alias("best")).select("doc_id", "item_id", "cosine", "best.share", "best.answer_share")
    return found, numbered


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; those without an id stay."""
    named, _ = own_ids(docs, Scratch(docs.sparkSession, "decontaminate"))
    return named.join(contaminated(named.select(F.col("own_id").alias("doc_id"), "row.text"), benchmark).select(F.col("doc_id").alias("own_id")).distinct(), "own_id", "left_anti").select("row.*")


def op4_decontaminate(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontaminate": op4_decontaminate}
ORACLES = {}
