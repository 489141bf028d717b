"""Periodic run detection: seed-and-extend on diagonals.

A run of period q and length at least max(6, 4 q) agrees with itself at lag q over a stretch of at least 5 words for
q = 1 and 3 q beyond. So an index of k-grams whose k is the least such stretch for lags from 2**j to 2**(j + 1) has an
occurrence pair of each run of these lags; k is at least q, so that inside a run the next occurrence of a k-gram is one period on, and
pairs of next occurrences are enough. Grams are named by rank: a gram of twice the size is a pair of ranks, and a gram that stands once
in its document drops out for all greater sizes, so that plain prose costs one sort of its words. Each seed is extended to
both sides along its lag; a table of how far each lag is covered passes over the seeds inside a stretch that has been extended.

Each text is judged alone: no shuffle, any row order; a batch of texts shares its arrays, and a very long text costs as its length.

Defined results: a null or empty text has no words, no runs and an empty collapsed text. Repeated rows are judged alike;
other columns are kept, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table, with_arrow_column

WORD = r"[^\x20\x09-\x0D]+"
LEAST_LENGTH, LEAST_EXPONENT = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def pair_ranks(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """Rank of (a[i], b[i + shift]) from 1 on, 0 where the pair stands once only or a part is 0."""
    out = np.zeros(len(a), dtype=np.int64)
    b = np.concatenate((b[shift:], np.zeros(min(shift, len(b)), dtype=np.int64)))
    at = np.flatnonzero((a > 0) & (b > 0))
    if len(at):
        _, inverse, counts = np.unique(a[at] * (b.max() + 1) + b[at], return_inverse=True, return_counts=True)
        again = counts > 1
        out[at] = np.where(again, np.cumsum(again), 0)[inverse]
    return out


def seeds(ranks: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lags, positions) of next occurrences at a lag from low to below high, by lag, then position."""
    at = np.flatnonzero(ranks)
    at = at[np.argsort(ranks[at], kind="stable")]
    lags = np.diff(at)
    fits = np.flatnonzero((ranks[at[:-1]] == ranks[at[1:]]) & (lags >= low) & (lags < high))
    lags, at = lags[fits], at[fits]
    order = np.lexsort((at, lags))
    return lags[order], at[order]


def agreeing(words: np.ndarray, start: int, lag: int, stop: int, step: int) -> int:
    """The first position from start on, going by step, at which a word and the one a lag on differ, or stop."""
    size = 16
    while start != stop:
        size = min(size, abs(stop - start))
        here = words[start : start + size] if step > 0 else words[start - size + 1 : start + 1][::-1]
        there = words[start + lag : start + lag + size] if step > 0 else words[start - size + 1 + lag : start + 1 + lag][::-1]
        differ = here != there
        if differ.any():
            return start + step * int(differ.argmax())
        start, size = start + step * size, size * 4
    return stop


def find_runs(words: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs; words are numbers, and text t has those from firsts[t] to firsts[t + 1]."""
    sizes, found = np.diff(firsts), []
    one = pair_ranks(np.repeat(np.arange(1, len(sizes) + 1), sizes), words + 1, 0)
    two = pair_ranks(one, one, 1)
    three = pair_ranks(two, one, 2)
    ranks, longest, q = three, int(sizes.max(initial=0)), 1
    while q * LEAST_EXPONENT <= longest and ranks.any():
        ranks = pair_ranks(three, two, 3) if q == 1 else pair_ranks(three, three, 3) if q == 2 else pair_ranks(ranks, ranks, 3 * q // 2)
        lags, at = seeds(ranks, q, 2 * q)
        bounds = [0, *(np.flatnonzero(np.diff(lags)) + 1).tolist(), len(lags)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            i = low
            while i < high:
                lag, seed = int(lags[low]), int(at[i])
                text = int(np.searchsorted(firsts, seed, "right")) - 1
                start = agreeing(words, seed, lag, int(firsts[text]) - 1, -1) + 1
                covered = agreeing(words, seed, lag, int(firsts[text + 1]) - lag, 1)
                length = covered - start + lag
                if length >= max(LEAST_LENGTH, LEAST_EXPONENT * lag):
                    found.append((text, start - int(firsts[text]), length, lag))
                i += int(np.searchsorted(at[i:high], covered))
        q *= 2
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


JUDGED = T.StructType().add("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))).add("collapsed", T.StringType())


def _judge(texts: pa.Array) -> pa.Array:
    split = [(t or b"").split() for t in texts.cast(pa.binary()).to_pylist()]  # splits where the words of the contract end
    firsts = np.concatenate(([0], np.cumsum([len(s) for s in split]))).astype(np.int64)
    everything = np.fromiter(chain.from_iterable(split), dtype=object, count=int(firsts[-1]))
    runs = find_runs(pd.factorize(everything)[0].astype(np.int64), firsts)
    edges = np.zeros(len(everything) + 1, dtype=np.int64)
    for text, start, length, period in runs:
        edges[firsts[text] + start + period] += 1
        edges[firsts[text] + start + length] -= 1
    stays = np.cumsum(edges[:-1]) == 0
    touched = {r[0] for r in runs}
    collapsed = [b" ".join(everything[firsts[t] : firsts[t + 1]][stays[firsts[t] : firsts[t + 1]]] if t in touched else s) for t, s in enumerate(split)]
    counts = np.bincount([r[0] for r in runs], minlength=len(split)) if runs else np.zeros(len(split), dtype=np.int64)
    columns = [pa.array([r[k] for r in runs], pa.int64()) for k in (1, 2, 3)]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.StructArray.from_arrays(columns, fields=list(RUN)))
    return pa.StructArray.from_arrays([lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def periodic_runs(df: DataFrame, text: str = "text", into: str = "periodic") -> DataFrame:
    """Add a struct: ``runs`` (start, length and period in words, by start, then period) and ``collapsed``, the words outside of all but the first period of each run, joined by spaces."""
    small_batches(df.sparkSession)
    return with_arrow_column(df, text, into, JUDGED, _judge)


def collapse_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace each text that has a run by its collapsed text; the others stay as they are."""
    found = periodic_runs(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).alias("text")))
    new = F.when(F.size("periodic.runs") > 0, F.col("periodic.collapsed")).otherwise(F.col("text"))
    return found.select(*[new.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in df.columns])


#: The contract's repetitions: by a hash h of its id, a tenth of the texts repeats a part of its own from some word on.
REPEATED = r"""
    CASE WHEN h % 10 = 0 AND rlike(text, '{word}') THEN
        transform(array(regexp_extract_all(text, '{word}', 0)), w -> array_join(transform(w, (said, i) ->
            IF(i < g % size(w), said, element_at(w, CAST(1 + g % size(w) + (i - g % size(w)) % (1 + (size(w) - g % size(w)) div (3 + g % 8)) AS INT)))
        ), ' '))[0]
    ELSE text END
""".format(word=WORD.replace("\\", "\\\\"))


def op12_periodic_runs(spark, sf_dir):
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g")).select("doc_id", F.expr(REPEATED).alias("text"))
    runs = F.col("periodic.runs")
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate(runs, nothing, lambda b, r: F.when(b.isNull() | (r.length * b.period > b.length * r.period), r).otherwise(b))
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), (r.period.cast("string")))), "\n")
    found = periodic_runs(docs).select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), F.col("periodic.collapsed").alias("collapsed"))
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat("lines", F.when(F.col("n_runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLES = {}
