"""Language ID: Bayesian evidence fusion.

Four sources speak about each document's language, and their logarithms are added:

* the text: a naive Bayes model over byte trigrams, tempered to at most ``TRIGRAMS`` independent ones;
* the declared markup language, right with probability ``DECLARED``;
* the suffix of the address (``.de``), right with probability ``SUFFIX``;
* the host: how often the texts of that host speak each language, smoothed towards the counts of its parent domain,
  those towards the counts of the whole table. The counts are grouped aggregates over all rows.

The text model is fitted on a bounded sample of rows whose language is declared: about ``SAMPLE`` for each language,
chosen by a hash of their id. Everything else covers all rows. Declared values are read as language tags: ``en-US`` and
``EN_us`` declare ``en``. A value that doesn't start with a code of two or three letters, or with one that stands for no
language, declares nothing, so that whatever the web declares there are at most 26**2 + 26**3 languages. Driver and
tasks hold 64 kB for each that occurs. Tables that name languages otherwise pass a ``code`` of their own.

Defined results: a null, empty or letterless text has no text evidence; the other sources decide, or it is rejected.
A document is rejected (``kept`` false, ``lang`` 'und') if a model without any language explains its trigrams better
than every language does, or if nothing is known about it. Null hosts share one host. Repeated rows are judged alike.
With no declared language in the whole table nothing can be told, and only empty evidence is left: all are rejected.
Columns of the input are kept; those named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, small_batches, table

SAMPLE = 1500
TRIGRAMS, DECLARED, SUFFIX, SMOOTHING = 120, 0.9, 0.8, 20.0
#: Host priors are broadcast up to so many hosts (fewer, if there are more than 64 languages); beyond, they are joined by a shuffle, with large hosts broadcast.
MAX_HOSTS, LARGE = 100_000, 1000

#: Fixed by ISO 639: undetermined, several, none, not coded.
NO_LANGUAGE = ["und", "mul", "zxx", "mis"]

#: Country suffixes and the language that they speak for.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "uk": "en", "us": "en", "au": "en", "it": "it", "pt": "pt", "nl": "nl", "pl": "pl"}

BITS = 14
#: The driver reads the languages' counts in so many parts, one after the other.
MODEL_PARTS = 8
#: Letters in lower case, all bytes of other scripts as they are, anything else a space.
LETTERS = bytes(c if c >= 128 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def trigrams(text: bytes) -> np.ndarray:
    """Bucket of each byte trigram that holds a letter."""
    b = np.frombuffer(b" " + text.translate(LETTERS) + b" ", dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64)
    code = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    code = code[code != 0x202020]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def code_of(declared: Column) -> Column:
    """The language of a tag, in lower case; null where it names none."""
    code = F.regexp_extract(F.lower(declared.cast("string")), r"^\s*([a-z]{2,3})\s*(?:[-_][\s\S]*)?$", 1)
    return F.when((code != "") & ~code.isin(NO_LANGUAGE), code)


def languages_of(docs: DataFrame, said: Column) -> dict[str, int]:
    """Rows by language; as many entries as there are codes."""
    rows = docs.select(said.alias("said")).where("said IS NOT NULL").groupBy("said").count().collect()
    return {r["said"]: r["count"] for r in sorted(rows)}


def numbered(said: Column, values) -> Column:
    """The value beside this language; null for others."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), said)


def fit(docs: DataFrame, text: str, declared: str, key: str, sample: int = SAMPLE, code: Callable[[Column], Column] = code_of) -> tuple[list[str], np.ndarray]:
    """Languages, and log-likelihood of each bucket by language; the last column is the model without a language."""
    said = code(F.col(f"`{declared}`"))
    counts = languages_of(docs, said)
    languages = list(counts)
    if not languages:
        return [], np.zeros((1 << BITS, 1), dtype=np.float32)
    share = numbered(said, {x: min(1.0, sample / n) for x, n in counts.items()})
    chosen = docs.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < share * (1 << 30)).select(said.alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if t:
                    own = np.bincount(trigrams(t), minlength=1 << BITS)
                    sums[lang] = sums[lang] + own if lang in sums else own
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(own[at], pa.int64())], ["lang", "bucket", "n"])

    sums = chosen.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    model = np.full((1 << BITS, len(languages) + 1), np.log(1.0 / (1 << BITS)), dtype=np.float32)
    model[:, :-1] = np.log(0.05 / (0.05 * (1 << BITS)))  # a language of which no trigram was sampled
    place = {x: i for i, x in enumerate(languages)}
    listed = sums.groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
    for r in listed.coalesce(MODEL_PARTS).toLocalIterator():  # a job for each part; a row is of at most 2 ** BITS numbers
        seen = np.full(1 << BITS, 0.05)
        seen[r["at"]] += r["n"]
        model[:, place[r["lang"]]] = np.log(seen / seen.sum())
    return languages, model


def text_evidence(docs: DataFrame, text: str, model: np.ndarray) -> Column:
    """Tempered log-likelihoods by language, last without one; null where the text has no letter."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = sent.value

        def one(t: str | None):
            seen = trigrams(t.encode(errors="replace")) if t else ()
            if not len(seen):
                return None
            step = min(50_000, 50_000 * 64 // weights.shape[1])
            parts = [weights[seen[i : i + step]].sum(axis=0, dtype=np.float64) for i in range(0, len(seen), step)]
            return np.sum(parts, axis=0) * (min(len(seen), TRIGRAMS) / len(seen))

        for batch in texts:
            yield batch.map(one)

    return judge(F.col(text))


def best(scores: Column) -> Column:
    """Position from 0 of the largest; the first of equals."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def host_priors(judged: DataFrame, languages: list[str], smoothing: float = SMOOTHING) -> DataFrame:
    """_host, _rows, _prior: log-probabilities by language, from the texts of the host, its parent domain and all."""
    said = F.col("_said").isNotNull()
    parent = F.when(F.col("_host").contains("."), F.regexp_extract("_host", r"^[^.]*\.(.*)$", 1)).otherwise(F.lit(""))
    counts = judged.groupBy("_host", "_said").agg(F.count("*").alias("n")).withColumn("parent", parent)
    counts = Scratch(judged.sparkSession, "language").write(counts)

    def by_language(name: str) -> list[Column]:  # at most a number for each language
        return [F.map_from_entries(F.collect_list(F.when(said, F.struct("_said", "n")))).alias(name), F.coalesce(F.sum(F.when(said, F.col("n"))), F.lit(0)).alias(f"{name}_all")]

    hosts = counts.groupBy("_host", "parent").agg(F.sum("n").alias("_rows"), *by_language("h"))
    parents = counts.groupBy("parent", "_said").agg(F.sum("n").alias("n")).groupBy("parent").agg(*by_language("p"))
    root = {r["_said"]: r["n"] for r in counts.where(said).groupBy("_said").agg(F.sum("n").alias("n")).collect()}
    total = sum(root.values())
    top = F.array(*[F.lit((root.get(i, 0) + 1.0) / (total + len(languages))) for i in range(len(languages))])

    def smoothed(i: Column) -> Column:
        n, p = (F.coalesce(F.try_element_at(c, i), F.lit(0)) for c in ("h", "p"))
        return F.log((n + smoothing * ((p + smoothing * F.get(top, i)) / (F.col("p_all") + smoothing))) / (F.col("h_all") + smoothing))

    return hosts.join(parents, "parent").select("_host", "_rows", F.transform(places(languages), smoothed).alias("_prior"))


def places(languages: list[str]) -> Column:
    return F.sequence(F.lit(0), F.lit(len(languages) - 1))


def join_priors(judged: DataFrame, priors: DataFrame, languages: int) -> DataFrame:
    hosts, rows = priors.agg(F.count("*"), F.sum("_rows")).first()
    if hosts * max(1.0, languages / 64) <= MAX_HOSTS:
        return judged.join(F.broadcast(priors.drop("_rows")), "_host", "left")
    large = priors.where(F.col("_rows") * LARGE >= rows).select("_host", F.col("_prior").alias("_large"))  # at most LARGE hosts
    judged = judged.join(F.broadcast(large), "_host", "left")
    spread = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    judged = judged.withColumn("_key", F.when(F.col("_large").isNull(), F.col("_host")).otherwise(spread))
    small = priors.where(F.col("_rows") * LARGE < rows).select(F.col("_host").alias("_key"), "_prior")
    return judged.join(small, "_key", "left").withColumn("_prior", F.coalesce("_large", "_prior")).drop("_key", "_large")


def identify(docs: DataFrame, text: str = "text", declared: str = "lang", host: str = "source", key: str = "doc_id", code: Callable[[Column], Column] = code_of) -> DataFrame:
    """Add language, confidence and kept; ``code`` gives the language of a declared value, or null."""
    small_batches(docs.sparkSession)
    result = ["language", "confidence", "kept"]
    columns = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in result]
    languages, model = fit(docs, text, declared, key, code=code)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))  # so that no column clashes with those below
    if not languages:
        return rows.select(*columns, F.lit("und").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"))
    n = len(languages)
    rows = rows.select("_row", F.col(f"_row.`{text}`").alias("_t"), code(F.col(f"_row.`{declared}`")).alias("_declared"), F.lower(F.coalesce(F.col(f"_row.`{host}`").cast("string"), F.lit(""))).alias("_host"))
    judged = rows.withColumn("_text", text_evidence(rows, "_t", model)).drop("_t")
    spoken = F.slice("_text", 1, n)
    knows = F.col("_text").isNotNull() & (F.array_max(spoken) > F.element_at("_text", n + 1))
    counted = judged.select("_host", F.when(knows, best(spoken)).alias("_said"))
    judged = join_priors(judged, host_priors(counted, languages), n)

    zero = F.array_repeat(F.lit(0.0), n)

    def speaks(said: Column, right: float) -> Column:
        own, other = numbered(said, {x: i for i, x in enumerate(languages)}), F.lit(float(np.log((1 - right) / max(1, n - 1))))
        one = lambda k: F.transform(places(languages), lambda i: F.when(i == k, F.lit(float(np.log(right)))).otherwise(other))
        return F.get(F.transform(F.array(own), lambda k: F.when(k.isNotNull(), one(k)).otherwise(zero)), F.lit(0))

    suffix = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    scores = add(add(F.when(knows, spoken).otherwise(zero), F.coalesce("_prior", zero)), add(speaks(F.col("_declared"), DECLARED), speaks(F.try_element_at(suffix, F.substring_index("_host", ".", -1)), SUFFIX)))
    rejected = F.when(F.col("_text").isNotNull(), ~knows).otherwise(F.col("_declared").isNull())
    judged = judged.withColumn("_scores", scores).withColumn("_rejected", rejected)
    top = F.array_max("_scores")
    sure = F.aggregate("_scores", F.lit(0.0), lambda a, x: a + F.exp(x - top), lambda a: 1 / a)
    named = F.get(F.array(*[F.lit(x) for x in languages]), best(F.col("_scores")))
    return judged.select(
        *columns, F.when(F.col("_rejected"), F.lit("und")).otherwise(named).alias("language"), F.when(F.col("_rejected"), F.lit(0.0)).otherwise(sure).alias("confidence"), (~F.col("_rejected")).alias("kept"),
    )


def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return identify(docs).select("doc_id", F.col("language").alias("lang"), "confidence", "kept")


QUERIES = {"op7_language_id": op7_language_id}
ORACLES = {}
