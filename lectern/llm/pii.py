"""PII: anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs, schemes, plus signs, digits and
cues of identifiers and secrets. At each anchor a small deterministic parser expands to the left and right and validates what it
finds. A text without an anchor costs that one pass only. Each text is judged alone: no shuffle, any row order.

Defined results: a null text counts as empty and has no spans. Repeated rows are judged alike; other columns are kept,
but for one named ``pii``, which the result replaces. An empty table gives an empty result; a very long text or run of
digits costs as its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table

#: Kinds in the order of the contract, then the method's own.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("url", "ssn", "iban", "account", "secret")

#: Fixed by the contract.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

URL = re.compile(r"://[^\s<>\"'`|\\^{}]+")
SSN = re.compile(r"[\s:#]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")
IBAN = re.compile(r"[\s:#]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"[\s:#.]{0,4}([A-Z]{0,3}[0-9]{6,18})(?![A-Za-z0-9])")

#: What a cue for a secret is followed by: the value of a setting, at least 16 characters with letters and digits; or the rest of a key that names itself.
SECRET = re.compile(r"[\w-]{0,20}[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9+/_=.~-]{16,})|(?<=AKIA)[0-9A-Z]{16}(?![0-9A-Za-z])|(?<=gh[pousr]_)[A-Za-z0-9]{36,}")

CUES = {"ssn": ("SSN", "ssn", "social security number"), "iban": ("IBAN", "iban", "Iban"), "account": ("account number", "Account number", "account no", "passport number", "passport no"), "secret": ("token", "Token", "TOKEN", "api_key", "api-key", "apikey", "apiKey", "API_KEY", "secret", "Secret", "SECRET", "password", "Password", "PASSWORD", "access_key", "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def iban(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for kind, words in ({"at": ("@",), "plus": ("+",), "scheme": ("://",)} | CUES).items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def find_spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, base kinds first, each kind by start."""
    ends = dict.fromkeys(BASE_KINDS + MORE_KINDS, 0)
    found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in ends}

    def keep(kind: str, start: int, end: int, valid: bool = True) -> None:
        ends[kind] = end  # a match that fails its validation still uses up its characters
        if valid:
            found[kind].append((kind, start, end))

    for last, (kind, size) in anchors.iter(text):
        at = last + 1 - size
        if kind == "digit":
            if at and "0" <= text[at - 1] <= "9":
                continue  # inside a run that its first digit stands for
            if at >= ends["ip"] and (m := IP.match(text, at)):
                keep("ip", at, m.end(), all(len(p) < 4 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))))
            if at >= ends["card"] and (m := CARD.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                keep("card", at, m.end(), 13 <= len(digits) <= 19 and luhn(digits))
        elif kind == "at":
            start = at
            while start > ends["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, last + 1)):
                keep("email", start, m.end())
        elif kind == "plus":
            if at >= ends["phone"] and (m := PHONE.match(text, at)):
                keep("phone", at, m.end(), 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15)
        elif kind == "scheme":
            start = at
            while start > ends["url"] and text[start - 1].isascii() and text[start - 1].isalpha():
                start -= 1
            if start < at and (m := URL.match(text, at)) and m.end() - at > 3:
                keep("url", start, m.end())
        elif kind == "secret":
            if at >= ends[kind] and (m := SECRET.match(text, last + 1)):
                start, end = (m.start(1), m.end(1)) if m[1] else (at, m.end())
                keep(kind, start, end, any(c.isdigit() for c in text[start:end]) and any(c.isalpha() for c in text[start:end]))
        elif at >= ends[kind] and (m := {"ssn": SSN, "iban": IBAN, "account": ACCOUNT}[kind].match(text, last + 1)):
            keep(kind, m.start(1), m.end(1), kind != "iban" or iban(m[1]))
    return [s for k in found for s in found[k]]


def written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


JUDGED = T.StructType([*(T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS), T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())])


@F.pandas_udf(JUDGED)
def _judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    anchors = automaton()
    for batch in texts:
        rows = []
        for text in batch:
            spans = find_spans(text, anchors) if text else []
            base = [s for s in spans if s[0] in BASE_KINDS]
            rows.append((*(sum(s[0] == k for s in base) for k in BASE_KINDS), written(base), written(spans)))
        yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])


@F.pandas_udf(T.StringType())
def _mask(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    anchors = automaton()

    def masked(text: str | None) -> str | None:
        out, at = [], 0
        for kind, start, end in sorted(find_spans(text, anchors), key=lambda s: (s[1], -s[2])) if text else ():
            if start >= at:
                out += [text[at:start], f"<{kind.upper()}>"]
            at = max(at, end)
        return "".join([*out, text[at:]]) if out else text

    for batch in texts:
        yield batch.map(masked)


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the struct ``pii``: counts by base kind, base spans and all spans as ``kind:start:end`` joined by commas."""
    small_batches(df.sparkSession)
    return df.withColumn("pii", _judge(F.coalesce(F.col(text), F.lit(""))))


def mask_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace each span in the text by its kind in angle brackets; where spans overlap, the first stands for all."""
    small_batches(df.sparkSession)
    return df.withColumn(text, _mask(F.col(text)))


def op8_pii(spark, sf_dir):
    docs = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.col(f"pii.n_{k}").alias(f"n_{k}") for k in BASE_KINDS]
    return docs.select("doc_id", *counts, F.sha2(F.col("pii.base"), 256).alias("base_sha256"), F.col("pii.spans").alias("spans"))


QUERIES = {"op8_pii": op8_pii}
ORACLES = {}
