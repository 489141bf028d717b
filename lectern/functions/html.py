"""Text of markup: a tokeniser of tags, texts, comments and raw elements, and what each token says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose content is text to the letter, without tags and references; and those whose content has references only.
RAW, LITERAL = ("script", "style", "xmp", "iframe", "noembed", "noframes"), ("textarea", "title")
#: What stands between a tag's name and its end: quoted values, or any other character. All loops are possessive, so that no text is too long.
_INSIDE = r"(?:=\s*+\"[^\"]*+(?:\"|\z)|=\s*+'[^']*+(?:'|\z)|[^>])*+(?:>|\z)"
_NAME_ENDS = r"(?=[\s/>]|\z)"
#: A comment (one may end at once, or never), a raw element to its end or the text's, another tag, a declaration or instruction, a run of text, a lone <.
TOKEN = (
    r"(?is)<!--(?:>|->|.*?(?:--!?>|\z))"
    rf"|<({'|'.join(RAW + LITERAL)}){_NAME_ENDS}{_INSIDE}.*?(?:</\1{_NAME_ENDS}{_INSIDE}|\z)"
    rf"|</?[a-z]{_INSIDE}|<[!?][^>]*+(?:>|\z)|</(?=[^a-z])[^>]*+(?:>|\z)|[^<]++|<"
)
#: Named characters that texts use most; numbers stand for all others.
NAMED = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "mdash": "—", "ndash": "–", "hellip": "…", "lsquo": "‘", "rsquo": "’",
    "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "euro": "€", "deg": "°", "times": "×", "middot": "·",
}
_REFERENCE = r"&(?:#[xX][0-9A-Fa-f]{1,6};?|#[0-9]{1,7};?|[A-Za-z]+;?)|[^&]++|&"
#: References that end with a semicolon only.
_CLOSED = r"&(?:#[xX][0-9A-Fa-f]{1,6}|#[0-9]{1,7}|[A-Za-z]+);|[^&]++|&"
#: Between the texts of different elements.
BREAK = "\x00"


def unescape(text: Column, open_ended: bool = True) -> Column:
    """Character references as their characters; unknown names stay, numbers of no character become U+FFFD. open_ended: they may lack their semicolon, as browsers have it."""
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def one(piece: Column) -> Column:
        number = F.when(piece.rlike("^&#[xX]"), F.conv(F.regexp_extract(piece, r"^&#[xX]([0-9A-Fa-f]+)", 1), 16, 10).try_cast("long")).otherwise(F.regexp_extract(piece, r"^&#([0-9]+)", 1).try_cast("long"))
        good = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        low = number - 0x10000  # beyond 16 bits, a pair of 16 bits each
        pair = F.concat(F.hex(F.shiftright(low, 10) + 0xD800), F.hex(low.bitwiseAND(F.lit(0x3FF).cast("long")) + 0xDC00))
        char = F.decode(F.unhex(F.when(number < 0x10000, F.lpad(F.hex(number), 4, "0")).otherwise(pair)), "UTF-16BE")
        named = F.try_element_at(names, F.regexp_extract(piece, "^&([A-Za-z]+)", 1))
        return F.when(piece.rlike("^&#[xX]?[0-9A-Fa-f]"), F.when(good, char).otherwise("�")).otherwise(F.coalesce(F.when(piece.startswith("&"), named), piece))

    pieces = F.regexp_extract_all(text, F.lit(_REFERENCE if open_ended else _CLOSED), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def squeezed(text: Column) -> Column:
    """White space of any kind as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\s \x1c-\x1f\x85  -     　]+", " "))


def strip_html(markup: Column, raw: bool = True, open_ended: bool = True) -> Column:
    """The texts of markup in their order, joined by one space, white space in them as one space; null for null.

    Comments, declarations and tags are no text. Scripts, styles and the like hold text to the letter, or none on request (raw). What is
    never closed reaches to the end, as a browser has it. The order is that of the markup: nothing is moved out of tables.
    open_ended: references may lack their semicolon.
    """
    tokens = F.regexp_extract_all(F.replace(markup, F.lit(BREAK), F.lit("�")), F.lit(TOKEN), F.lit(0))
    whole = lambda names: rf"(?is)^<({'|'.join(names)}){_NAME_ENDS}{_INSIDE}(.*?)(?:</\1{_NAME_ENDS}{_INSIDE})?\z"
    held = lambda token, names: F.regexp_extract(token, whole(names), 2)

    def said(token: Column) -> Column:
        apart = lambda text: F.concat(F.lit(BREAK), text, F.lit(BREAK))
        inside = apart(held(token, RAW)) if raw else F.lit(BREAK)
        element = F.when(token.rlike(rf"(?i)^<(?:{'|'.join(RAW)}){_NAME_ENDS}"), inside).when(token.rlike(rf"(?i)^<(?:{'|'.join(LITERAL)}){_NAME_ENDS}"), apart(unescape(held(token, LITERAL), open_ended)))
        return F.when(~token.startswith("<") | (token == "<"), unescape(token, open_ended)).otherwise(F.coalesce(element, F.lit(BREAK)))

    texts = F.array_join(F.transform(tokens, said), "")
    return F.when(markup.isNotNull(), squeezed(F.replace(texts, F.lit(BREAK), F.lit(" "))))
