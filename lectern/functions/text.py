"""Scalar functions over text, time and ids, as column expressions."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .html import strip_html

BITS = 32
#: Fixed by the format of encoded ids: the symbols of five bits each.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def once(df: DataFrame) -> DataFrame:
    """The same rows; what comes after reads their columns and doesn't compute them again, as it may where it is laid over what makes them."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def bound(value: Column, of) -> Column:
    """``of`` the value, which is computed once however often it stands there; for use within lambdas, where nothing else saves that."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def event_time_string(time: Column) -> Column:
    """Time without its zone, with microseconds."""
    t = F.split_part(time, F.lit("+"), F.lit(1))
    return F.when(t.contains("."), t).otherwise(F.concat(t, F.lit(".000000")))


def event_time(time: Column) -> Column:
    return F.try_to_timestamp(event_time_string(time), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def datestamp(time: Column) -> Column:
    return F.split_part(time, F.lit("T"), F.lit(1))


def in_interval(date: Column, start: str, end: str) -> Column:
    return (date >= F.lit(start).cast("date")) & (date < F.lit(end).cast("date"))


def event_username(name: Column) -> Column:
    return F.nullif(F.trim(name), F.lit(""))


def backslash_encode(text: Column) -> Column:
    for plain, code in (("\\", "\\\\"), ("\r", "\\r"), ("\t", "\\t"), ("\n", "\\n")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def backslash_decode(text: Column) -> Column:
    text = F.replace(text, F.lit("\\\\"), F.lit("\x00"))
    for plain, code in (("\r", "\\r"), ("\t", "\\t"), ("\n", "\\n")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return F.replace(text, F.lit("\x00"), F.lit("\\"))


def needs_decoding(text: Column) -> Column:
    """Whether a text holds escaped line ends or tabs and no real ones."""
    return text.rlike(r"\\[rtn]") & ~text.rlike(r"[\r\t\n]")


def normalize_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))


def to_finite_float(text: Column) -> Column:
    x = text.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def clean_choice_text(text: Column, pattern: str = r"<label[^>]*>|</label>") -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, pattern, ""), r"\s+", " "))


def stringify(values: Column, contains_html: bool = False) -> Column:
    """A list of answers as [a|b], each without white space around it, or the text of its markup."""
    one = lambda x: strip_html(x) if contains_html else F.trim(x)
    return F.concat(F.lit("["), F.array_join(F.transform(values, one), "|"), F.lit("]"))


def add_microseconds(time: Column, n: int) -> Column:
    return time + F.expr(f"INTERVAL {n} MICROSECOND")


def mysql_datetime(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def mysql_datetime_to_iso(text: Column) -> Column:
    return F.date_format(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


#: The symbols that stand for the same numbers where a number is written to the base of 32.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32(data: Column) -> Column:
    """Bytes as symbols of five bits, five bytes at a time, filled up with equals signs."""
    symbols = F.ceil(F.length(data) * 8 / 5).cast("int")
    groups = F.ceil(F.length(data) / 5).cast("int")
    fives = F.regexp_extract_all(F.rpad(F.hex(data), groups * 10, F.lit("0")), F.lit(".{10}"), F.lit(0))
    text = F.translate(F.array_join(F.transform(fives, lambda five: F.lpad(F.conv(five, 16, 32), 8, "0")), ""), _DIGITS, BASE32)
    return F.when(F.length(data) == 0, "").otherwise(F.rpad(F.substring(text, F.lit(1), symbols), groups * 8, F.lit("=")))


def unbase32(code: Column) -> Column:
    """The bytes of such symbols; null where the text is none."""
    bare = F.rtrim(code, F.lit("="))
    groups = F.ceil(F.length(bare) / 8).cast("int")
    eights = F.regexp_extract_all(F.translate(F.rpad(bare, groups * 8, F.lit("A")), BASE32, _DIGITS), F.lit(".{8}"), F.lit(0))
    digits = F.array_join(F.transform(eights, lambda eight: F.lpad(F.conv(eight, 32, 16), 10, "0")), "")
    data = F.unhex(F.substring(digits, F.lit(1), F.floor(F.length(bare) * 5 / 8).cast("int") * 2))
    return F.when(~bare.rlike("^[A-Z2-7]*\\z"), None).when(F.length(bare) == 0, F.lit(b"")).otherwise(data)


def encode_id(scope: Column, kind: Column, value: Column) -> Column:
    return base32(F.concat_ws("|", scope, kind, value).cast("binary"))


def decode_id(code: Column) -> Column:
    return F.split(unbase32(code).cast("string"), r"\|")


def places(seed: int) -> tuple[int, ...]:
    """Where each of 32 bits goes, the highest first: a shuffle drawn from a secret seed."""
    draw, out = random.Random(seed), list(range(BITS))
    for last in range(BITS - 1, 0, -1):
        other = int(draw.random() * (last + 1))
        out[last], out[other] = out[other], out[last]
    return tuple(out)


def _moved(number: Column, moves: list[tuple[int, int]]) -> Column:
    """Bits, counted from the highest, go to other places; null for numbers beyond 32 bits."""
    number, out = number.cast("long"), F.lit(0).cast("long")
    for here, there in moves:
        bit = F.shiftright(number, BITS - 1 - here).bitwiseAND(F.lit(1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(bit, BITS - 1 - there))
    return F.when((number >= 0) & (number < 1 << BITS), out)


def remap_id(number: Column, seed: int) -> Column:
    """A permutation of the numbers below 2**32 that only who knows the seed can undo; null beyond."""
    return _moved(number, list(enumerate(places(seed))))


def restore_id(number: Column, seed: int) -> Column:
    return _moved(number, [(there, here) for here, there in enumerate(places(seed))])


def masked_username(number: Column, seed: int) -> Column:
    return F.concat(F.lit("username_"), remap_id(number, seed).cast("string"))


def answer_group_key(value: Column, variant: Column) -> Column:
    return F.concat_ws("_", value, F.when(variant == "", "1").otherwise(variant))


def hidden_answer(answer_id: Column) -> Column:
    return answer_id.endswith("_dynamath") | answer_id.endswith("_comment")


def correctness(text: Column) -> Column:
    return F.when(text == "correct", True).when(text == "incorrect", False)


def record_text(text: Column, size: int, truncate: bool = True) -> Column:
    """Text that fits the size: cut, or null where cutting isn't allowed."""
    return F.substring(text, 1, size) if truncate else F.when(F.length(text) <= size, text)
