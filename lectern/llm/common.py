"""What the corpus operators share: reading tables, written intermediate tables, byte-level text helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none and all run on this machine."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Texts can be very long: keep the batches that go to Python small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(min(rows, int(spark.conf.get(key, "10000")))))


def with_arrow_column(df: DataFrame, source: str, into: str, kind: T.DataType, judge: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """Add, or replace, a column that a function of Arrow arrays makes of another. Unlike a UDF it runs once, whatever reads its fields."""
    names = [c for c in df.columns if c != into]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), judge(batch.column(source))], [*names, into])

    return df.mapInArrow(judged, T.StructType([df.schema[c] for c in names]).add(into, kind))


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Written tables of one operator call in the shared folder. A written table cuts lineage and outlives executors.

    They stay as long as the call's result may be read; who has written that result may ``discard`` them.
    """

    #: Folders of this process's calls, in order.
    folders: list[str] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        Scratch.folders.append(self.root)

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table of this call that nothing reads any more."""
        delete(self.spark, df.scratch_path)


def discard(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables of calls from the one of this number on; their results must not be read any more."""
    while len(Scratch.folders) > since:
        delete(spark, Scratch.folders.pop())


# 64-bit hashes of many byte spans at once: polynomial prefix sums modulo 2**64, then a finalising mix.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16) * 5 // 4
        with np.errstate(over="ignore"):
            for key, x in (("up", BASE), ("down", INVERSE)):
                p = np.full(size, x, dtype=np.uint64)
                p[0] = 1
                _powers[key] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xCA5A826395121157)
        return h ^ (h >> np.uint64(32))


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """P with P[i] the sum of (byte + 1) * BASE**position before i."""
    up, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end) of the buffer that the prefix sums are of; equal bytes have equal hashes."""
    _, down = powers(len(sums))
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def own_ids(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, bool]:
    """own_id and row of each document, and whether any own_id differs from doc_id. Where rows share an id but not the
    text, the text of smallest hash keeps the id and the others get ids of their own beyond 2**62, so that no text stands for another."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    shared = scratch.write(rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least <> most").select(F.col("doc_id").alias("shared_id"), "least"))
    if shared.isEmpty():
        return rows.select(F.col("doc_id").alias("own_id"), "row"), False
    own = F.pmod(F.xxhash64("doc_id", "h", "row.text"), F.lit(1 << 62)) + F.lit(1 << 62)
    joined = rows.join(shared, F.col("doc_id") == F.col("shared_id"), "left")
    return joined.select(F.when(F.col("h") != F.col("least"), own).otherwise(F.col("doc_id")).alias("own_id"), "row"), True
