"""Packing: minimum bin slack.

Documents become token ids and are cut where they pass the capacity; what is left of each is a piece shorter than the
capacity. Only the number of pieces of each length goes to the driver: at most ``capacity`` rows, whatever the input.
There, one window after the other takes the largest length left and the multiset of lengths that fills the rest of
the window closest, found by subset-sum dynamic programming over a bitset and read back as counts per length. The same
multiset is used again as often as the counts allow, so there are about as many different windows as lengths.
Spark then gives each piece its rank among the pieces of its length and looks its window up by length and rank.

Defined results: a null text counts as empty and is one piece, the closing id. Equal rows are packed as often as they
occur. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, small_batches, table

CAPACITY, CLOSING_ID = 4096, 2
#: Words whose ids a Python worker remembers; then it starts anew.
REMEMBERED = 600_000
#: Pieces that one task ranks, about.
RANKED = 500_000

_PLAIN = re.compile(rb"[a-z][.,]$")
#: Words of Latin letters only: one token group each, so many of them can be encoded as one text.
_LETTERS = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_TOGETHER = 256
_workers: dict = {}


class WordTokenizer:
    """Ids of whole texts by a tokenizer that never joins text across white space, so each word is encoded once.

    Texts that hold a special token's opening are encoded whole. ASCII is lower-cased first, as the tokenizer does.
    A full stop or comma after an ASCII letter is a token of its own, so such words share the ids of the bare word.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> Iterator[tuple[bytes, bytes]]:
        letters = [w for w in words if _LETTERS.fullmatch(w)]
        groups = [letters[i : i + _TOGETHER] for i in range(0, len(letters), _TOGETHER)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups]), strict=True):
            stops = (4 * (np.flatnonzero(self.ends[np.frombuffer(ids, dtype="<u4")]) + 1)).tolist()
            for word, start, stop in zip(group, [0, *stops], stops, strict=False):
                yield word.encode(), ids[start:stop]
        others = [w for w in words if not _LETTERS.fullmatch(w)]
        yield from zip([w.encode() for w in others], self._encode(others), strict=True)

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        if len(self.ids) > REMEMBERED:
            self.ids = {}
        split = [None if b"<|" in t else t.lower().split() for t in texts]
        seen: set[bytes] = set()
        for words in split:
            if words:
                seen.update(words)
        known = self.ids
        missing = [w for w in seen if w not in known]
        stopped = [w for w in missing if _PLAIN.search(w[-2:])]
        bare = {w[:-1] for w in stopped} | (set(missing) - set(stopped)) | {b".", b","}
        bare = [w for w in bare if w not in known]
        known.update(self._encode_words([w.decode() for w in bare]))
        for w in stopped:
            known[w] = known[w[:-1]] + known[w[-1:]]
        for text, words in zip(texts, split, strict=True):
            yield self._encode([text.decode()])[0] if words is None else b"".join(map(known.__getitem__, words))


def tokenizer_of(path: str) -> WordTokenizer:
    if path not in _workers:
        _workers[path] = WordTokenizer(path)
    return _workers[path]


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, closing_id: int = CLOSING_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, on request, the ids."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, closing = tokenizer_of(path), np.array([closing_id], dtype="<u4").tobytes()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts), strict=True):
                ids += closing
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total, part if with_ids else None))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            kinds = [pa.int64()] * 5 + [pa.binary()]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds, strict=True)]
            n = 5 + with_ids
            yield pa.RecordBatch.from_arrays(cols[:n], names[:n])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, schema)


def fill(target: int, counts: dict[int, int]) -> dict[int, int]:
    """Counts per length of the multiset, within counts, whose sum is closest to the target from below."""
    if not target:
        return {}
    reach, steps, mask = 1, [], (1 << (target + 1)) - 1
    for length in sorted((x for x in counts if x <= target and counts[x]), reverse=True):
        left, times = min(counts[length], target // length), 1
        while left:
            use = min(times, left)
            steps.append((length, use, reach))
            reach |= (reach << (length * use)) & mask
            left, times = left - use, times * 2
        if reach >> target & 1:
            break
    best, taken = reach.bit_length() - 1, {}
    for length, use, before in reversed(steps):
        if not before >> best & 1:
            taken[length] = taken.get(length, 0) + use
            best -= length * use
    return taken


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how often, counts per length) until every piece has its window."""
    left, plan = dict(counts), []
    for largest in sorted(left, reverse=True):
        while left[largest]:
            left[largest] -= 1
            window = fill(capacity - largest, left)
            left[largest] += 1
            window[largest] = window.get(largest, 0) + 1
            often = min(left[x] // n for x, n in window.items())
            for x, n in window.items():
                left[x] -= n * often
            plan.append((often, window))
    return plan


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, start, length, ...). The pieces are read three times: write them first."""
    counts = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    total = sum(r["count"] for r in counts)
    plan = plan_windows({r["length"]: r["count"] for r in counts}, capacity)
    segments, first, used = [], 0, {}
    for often, window in plan:
        offset = 0
        for length in sorted(window, reverse=True):
            n, rank = window[length], used.get(length, 0)
            segments.append((length, rank, rank + n * often, n, first, offset))
            used[length] = rank + n * often
            offset += n * length
        first += often
    names = "s_length long, s_from long, s_to long, s_n long, s_first long, s_offset long"
    looked_up = spark.createDataFrame(pd.DataFrame(segments, columns=[x.split()[0] for x in names.split(", ")], dtype="int64"), names)

    salts = max(8, -(-total // RANKED))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    before = (
        salted.groupBy("length", "_salt").count()
        .withColumn("_before", F.sum("count").over(W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)))
        .select(F.col("length").alias("b_length"), F.col("_salt").alias("b_salt"), F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    ranked = salted.withColumn("_rank", F.row_number().over(W.partitionBy("length", "_salt").orderBy("doc_id", "start")) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("b_length")) & (F.col("_salt") == F.col("b_salt"))).withColumn("_rank", F.col("_rank") + F.col("_before"))
    found = ranked.join(F.broadcast(looked_up), (F.col("length") == F.col("s_length")) & (F.col("_rank") >= F.col("s_from")) & (F.col("_rank") < F.col("s_to")))
    return found.select(
        *pieces.columns,
        F.expr("s_first + (_rank - s_from) div s_n").alias("sequence_id"),
        F.expr("s_offset + (_rank - s_from) % s_n * length").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    spark = docs.sparkSession
    return pack(spark, Scratch(spark, "packing").write(pieces_of(docs, path, capacity)), capacity)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


QUERIES = {"op9_packing": op9_packing}
ORACLES = {}
