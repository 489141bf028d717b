"""Corpus cleaning in five stages over the documents table; each works on all that its predecessor kept.

language_id drops documents without a recognisable language. line_dedup cuts lines that repeat earlier ones, and drops
a document only if nothing is left of it. near_dedup keeps one document, the smallest id, of each group of near
duplicates: five-word shingles, similarity 0.8. decontaminate drops documents that hold a benchmark item. packing
tokenises what is left and packs it into sequences. All but the last return the columns of the documents; n_chars
follows the text. Rows without an id pass through the stages that need one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import decontaminate, language_id, line_dedup, near_dup, packing
from lectern.llm.common import Scratch, discard


def beside(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns that an operator needs and the whole row, so that its results don't clash with other columns."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.identify(beside(docs, "doc_id", "text", "lang", "source")).where("kept").select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(beside(docs, "doc_id", "text"))
    something = (F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return cut.where(something).select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, packing.tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontaminate", drop_benchmark),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, calls = docs, len(Scratch.folders)
        docs = scratch.write(stage(spark, docs, sf_dir))
        discard(spark, calls)  # what the stage's operator wrote on its way
        if i:
            scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
