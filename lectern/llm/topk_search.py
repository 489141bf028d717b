"""Exact top-k search: norm-bucketed retrieval.

Vectors are ranged by length, longest first, and cut into buckets of bounded size; queries form blocks. A few of the
longest vectors give each query a score that k vectors reach. With it, each bucket has a local cosine threshold for
each query: the cosine that a vector of the bucket's greatest length would need. Above 1 the bucket is skipped; where
it is high, the query's largest coordinates bound the same coordinates of what can reach it; where it is low, only the
vectors that are long enough are taken. What remains is verified by exact integer products.

Queries meet all vectors in blocks: a row of the join is a block of queries beside a bucket, never a pair of vectors.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do rows without an id.
Of rows that share an id, the largest vector in array order stands. A shorter vector counts as padded with zeros.
Ties go to the smaller id. With fewer than k others, all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, table

BUCKET, QUERIES_IN_BLOCK, SEEDS, FOCUS, HIGH = 2048, 256, 4096, 3, 0.5
BLOCK = "block long, n int, dim int, longest double, ids binary, data binary"


def usable(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """vec_id, v (components as integers) and their squared length."""
    good = F.col(key).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(good).groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.max(whole).alias("v"))
    return rows.withColumn("square", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))


def matrix(vectors) -> np.ndarray:
    dim = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), dim), dtype=np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows, as they lie in each partition, packed into blocks of bounded size."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, kept = 0, None

        def block(part: pd.DataFrame) -> pd.DataFrame:
            nonlocal made
            data, name = matrix(part["v"].tolist()), TaskContext.get().partitionId() << 32 | made
            made += 1
            longest = float(np.sqrt(part["square"].max()))
            most = int(np.abs(data).max(initial=0))
            data = data.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max or t is np.int64))  # blocks are sent
            return pd.DataFrame([(name, len(part), data.shape[1], longest, part["vec_id"].to_numpy(np.int64).tobytes(), data.tobytes())], columns=[x.split()[0] for x in BLOCK.split(", ")])

        for batch in batches:
            kept = batch if kept is None else pd.concat([kept, batch])
            while len(kept) >= size:
                yield block(kept[:size])
                kept = kept[size:]
        if kept is not None and len(kept):
            yield block(kept)

    return rows.select("vec_id", "v", "square").mapInPandas(pack, BLOCK)


def unpack(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, dtype=np.int64)
    size = len(data) // max(1, len(ids) * dim)
    return ids, np.frombuffer(data, dtype=f"<i{size or 8}").reshape(len(ids), dim).astype(np.int64)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point only where no sum can leave its exact range."""
    dim = min(q.shape[1], p.shape[1])
    q, p = q[:, :dim], p[:, :dim]
    if not q.size or not p.size:
        return np.zeros((len(q), len(p)), dtype=np.int64)
    if float(np.abs(q).max()) * float(np.abs(p).max()) * dim < 2**53:
        return np.rint(q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def reachable(q: np.ndarray, unit: np.ndarray, cosine: float, focus: int = FOCUS) -> np.ndarray:
    """Which unit vectors can have at least this cosine with the unit query, by bounds on its largest coordinates."""
    good = np.ones(len(unit), dtype=bool)
    for f in np.argsort(-np.abs(q))[:focus]:
        half = np.sqrt(max(0.0, (1 - cosine * cosine) * (1 - q[f] * q[f])))
        low = -1.0 if q[f] < -cosine else cosine * q[f] - half
        high = 1.0 if q[f] > cosine else cosine * q[f] + half
        good &= (unit[:, f] >= low - 1e-9) & (unit[:, f] <= high + 1e-9)
    return good


def search_bucket(qids, q, least, ids, p, k) -> Iterator[tuple[int, int, int]]:
    """(query, vector, score) of the bucket's vectors that reach the query's least score, k at most for each query."""
    qn, pn = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)), np.sqrt((p.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-pn, kind="stable")
    ids, p, pn = ids[order], p[order], pn[order]
    dim = max(q.shape[1], p.shape[1])
    unit = np.zeros((len(p), dim))
    unit[:, : p.shape[1]] = p / np.where(pn > 0, pn, 1)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(qn * pn[0] > 0, least / (qn * pn[0]), np.where(least > 0, np.inf, -np.inf))
    narrow = (cosine > HIGH) & (cosine <= 1 + 1e-9)

    def keep(i: int, at: np.ndarray, scores: np.ndarray):
        good = (scores >= least[i]) & (ids[at] != qids[i])
        at, scores = at[good], scores[good]
        for j in best_of(scores, ids[at], k):
            yield int(qids[i]), int(ids[at[j]]), int(scores[j])

    for i in np.flatnonzero(narrow):
        own = np.zeros(dim)
        own[: q.shape[1]] = q[i] / qn[i]
        at = np.flatnonzero(reachable(own, unit, min(1.0, float(cosine[i]))))
        if len(at):
            yield from keep(i, at, products(q[i : i + 1], p[at])[0])
    wide = np.flatnonzero(cosine <= HIGH)
    if len(wide):
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where((least[wide] > 0) & (qn[wide] > 0), least[wide] / qn[wide], 0.0)
        lengths = [int(np.searchsorted(-pn, -(x - 1e-9), side="right")) for x in needed]
        scores = products(q[wide], p[: max(lengths)])
        for i, n, row in zip(wide, lengths, scores, strict=True):
            yield from keep(i, np.arange(n), row[:n])


def fitting(rows: DataFrame) -> DataFrame:
    """The rows; refused if an inner product of two of them could leave 64 bits, as it would wrap silently."""
    most = rows.agg(F.max("square")).first()[0]
    if most is not None and float(most) >= 2.0**62:  # no inner product exceeds the product of two lengths
        raise ValueError("inner products of these vectors need more than 64 bits: use a smaller scale")
    return rows


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products among all other vectors."""
    spark: SparkSession = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    rows = fitting(scratch.write(usable(vectors, key, vector, scale)))
    total = rows.count()
    ranged = rows.repartitionByRange(max(1, -(-total // (4 * BUCKET))), F.col("square").desc(), "vec_id").sortWithinPartitions(F.col("square").desc(), "vec_id")
    buckets = scratch.write(blocks(ranged, BUCKET))
    queries = scratch.write(blocks(rows.where(is_query), QUERIES_IN_BLOCK))

    seeds = rows.orderBy(F.col("square").desc(), "vec_id").limit(SEEDS).toPandas()  # at most SEEDS vectors
    sent = spark.sparkContext.broadcast((seeds["vec_id"].to_numpy(np.int64), matrix(seeds["v"].tolist())))

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, p = sent.value
        for batch in batches:
            least = []
            for r in batch.itertuples():
                qids, q = unpack(r.ids, r.data, r.dim)
                scores = products(q, p).astype(np.float64)
                scores[qids[:, None] == ids[None, :]] = -np.inf
                least.append(np.partition(scores, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(qids), -np.inf))
            yield batch.assign(least=[x.tobytes() for x in least], lowest=[float(x.min()) for x in least])

    judged = scratch.write(queries.mapInPandas(first, BLOCK + ", least binary, lowest double"))
    parts = max(1, -(-buckets.count() // 8))
    left = judged.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), *[F.col(c).alias(f"q_{c}") for c in judged.columns])
    right = buckets.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    pairs = left.join(right, (left["part"] == right["part"]) & (F.col("q_lowest") <= F.col("q_longest") * F.col("longest") * (1 + 1e-9)))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                out += search_bucket(*unpack(r.q_ids, r.q_data, r.q_dim), np.frombuffer(r.q_least, dtype=np.float64), *unpack(r.ids, r.data, r.dim), k)
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    columns = ["q_ids", "q_data", "q_dim", "q_least", "ids", "data", "dim"]
    key, kept = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "8")  # a row here is a whole block
    try:
        found = scratch.write(pairs.select(*columns).mapInPandas(verify, "query_id long, vec_id long, score long"))
    finally:
        spark.conf.set(key, kept)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk_search(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, p.vec_id AS vec_id, CAST(list_inner_product(q.e, p.e) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id % 20 = 0 AND p.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""

QUERIES = {"op3_topk_search": op3_topk_search}
ORACLES = {"op3_topk_search": ORACLE}
