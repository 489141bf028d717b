"""Byte-level BPE encoding and decoding by the tokenizers library, over Arrow batches.

The ranks of byte strings become a vocabulary of characters by the usual mapping: printable bytes stand for themselves, the
others for the code points from 256 on. Each token has a merge for each way in which two tokens make it up, in the
order of ranks, and a piece that is a token itself is taken whole. Texts are split by the pattern; each worker has the library encode
each distinct piece once and remembers its ids.

The rule is: join the pair whose token has the lowest rank, the leftmost of several. The library orders merges, not tokens, so it could go another
way only where one token could be made up in two ways at once. Such a token has three bytes at least and stands twice in
the piece; pieces in which no three bytes stand twice are safe, and the others are checked by following the rule itself.

Each text is judged alone: no shuffle, any row order, and a very long text costs as its length.

Defined results: a null text counts as empty and has no ids; null ids decode to null, and ids that the table lacks to
U+FFFD. Repeated rows are judged alike; other columns are kept, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import codecs
import heapq
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table, with_arrow_column

#: Distinct pieces that a worker remembers, and their greatest length; then it starts anew.
REMEMBERED, SHORT = 1_000_000, 64
AGAIN = re.compile(rb"(?s)(?=(...)).(?=.*?\1)")
UNKNOWN = "�".encode()
_workers: dict[tuple, ByteBpe] = {}


def byte_characters() -> list[str]:
    """The character of each byte: itself where it is printable and no space, else the next code point from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        chars = byte_characters()
        name = lambda token: "".join(map(chars.__getitem__, token))
        order = sorted(self.ranks, key=self.ranks.__getitem__)
        merges = [(name(t[:i]), name(t[i:])) for t in order for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.tokenizer = Tokenizer(models.BPE({name(t): r for t, r in self.ranks.items()}, merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern, self.library_split = regex.compile(pattern), pre_tokenizers.Split(Regex(pattern), "isolated")
        self.assigned: dict[str, bool] = {}
        self.known: dict[str, bytes] = {}
        table = {r: t for t, r in self.ranks.items()}
        self.tokens = [table.get(i, UNKNOWN) for i in range(max(table) + 1)] + [UNKNOWN]
        self.sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.firsts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)

    def pieces(self, text: str) -> list[str]:
        """Matches of the pattern. Versions of Unicode differ in what is a letter; texts with characters that one may not know are split by the library."""
        if not text.isascii():
            for c in set(text):
                if c not in self.assigned:
                    self.assigned[c] = unicodedata.category(c) != "Cn"
                if not self.assigned[c]:
                    return [piece for piece, _ in self.library_split.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def by_rule(self, piece: bytes) -> list[int]:
        """Ids of one piece by the rule itself: a heap of pairs by rank, then place."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        end, before, n = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1)), len(piece)
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and end[at] < n and (rank := self.ranks.get(piece[at : end[end[at]]])) is not None:
                heapq.heappush(heap, (rank, at, end[end[at]]))

        for at in range(n):
            offer(at)
        while heap:
            _, at, stop = heapq.heappop(heap)
            if end[at] and end[at] < n and end[end[at]] == stop and end[at] != stop:
                gone = end[at]
                end[at], end[gone] = stop, 0
                if stop < n:
                    before[stop] = at
                offer(before[at])
                offer(at)
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        encoded = [p.encode() for p in pieces]
        safe = [len(b) <= SHORT and not AGAIN.search(b) for b in encoded]
        library = iter(self.tokenizer.encode_batch_fast([p for p, s in zip(pieces, safe, strict=True) if s], add_special_tokens=False))
        return {p: np.array(next(library).ids if s else self.by_rule(b), dtype="<i4").tobytes() for p, b, s in zip(pieces, encoded, safe, strict=True)}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        split = [self.pieces(t) for t in texts]
        missing = list(set().union(*split) - self.known.keys())
        known, learnt = self.known, self.learn(missing)
        long = {p: learnt.pop(p) for p in missing if len(p) > SHORT}
        known.update(learnt)
        get = (lambda p: long.get(p) or known[p]) if long else known.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]

    def starts(self, ids: np.ndarray, text: bytes) -> np.ndarray:
        """The code point in which each token begins; a token that begins inside a character has that character's."""
        code_points = np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80) - 1
        return code_points[np.cumsum(self.sizes[ids]) - self.sizes[ids]].astype(np.int32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids one after the other, and how many of each."""
        ids = np.where((ids < 0) | (ids >= len(self.tokens)), len(self.tokens) - 1, ids)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.firsts[ids] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], sizes

    def texts(self, ids: list[int]) -> list[str]:
        """The text of each id; a character that several ids share comes with the last of them, and bytes that are no character as U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        out = [decoder.decode(self.tokens[i if 0 <= i < len(self.tokens) else -1]) for i in ids]
        if out:
            out[-1] += decoder.decode(b"", final=True)
        return out


def bpe_of(path: str, pattern: str) -> ByteBpe:
    if (path, pattern) not in _workers:
        _workers[path, pattern] = ByteBpe(path, pattern)
    return _workers[path, pattern]


def _lists(flat: np.ndarray, sizes: np.ndarray, missing: np.ndarray | None = None) -> pa.ListArray:
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32(), mask=None if missing is None else np.append(missing, False))
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "encoded", offsets: bool = True) -> DataFrame:
    """Add a struct of arrays: ``ids`` and, unless not asked for, ``starts``, the code point of the text at which each token begins."""
    small_batches(df.sparkSession)

    kind = T.StructType([T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("ids", "starts")[: 1 + offsets]])

    def encoded(texts: pa.Array) -> pa.Array:
        bpe, data = bpe_of(path, pattern), texts.cast(pa.binary()).to_pylist()
        said = [(b or b"").decode("utf-8", "replace") for b in data]
        found = bpe.encode(said)
        sizes, flat = np.array([len(x) // 4 for x in found], dtype=np.int64), np.frombuffer(b"".join(found), dtype="<i4")
        columns = [_lists(flat, sizes)]
        if offsets:
            starts = [bpe.starts(np.frombuffer(x, dtype="<i4"), t.encode()) for x, t in zip(found, said, strict=True)]
            columns.append(_lists(np.concatenate([np.zeros(0, dtype=np.int32), *starts]), sizes))
        return pa.StructArray.from_arrays(columns, ["ids", "starts"][: len(columns)])

    return with_arrow_column(df, text, into, kind, encoded)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes of the ids; ``decode_tokens`` gives their text token by token."""

    def decoded(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
        lengths = lists.value_lengths()
        data, sizes = bpe_of(path, pattern).decode(flat)
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)]
        data = data.tobytes()
        return pa.array([data[a:b] if ok else None for a, b, ok in zip(ends, ends[1:], lists.is_valid().to_pylist(), strict=False)], pa.binary())

    return with_arrow_column(df, ids, into, T.BinaryType(), decoded)


def decode_tokens(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "tokens") -> DataFrame:
    """Add the text of each token; where tokens split a character, the last of them has it and the others are empty."""

    def said(lists: pa.Array) -> pa.Array:
        bpe = bpe_of(path, pattern)
        return pa.array([None if x is None else bpe.texts([-1 if i is None else i for i in x]) for x in lists.to_pylist()], pa.list_(pa.string()))

    return with_arrow_column(df, ids, into, T.ArrayType(T.StringType()), said)


def ranks_path() -> tuple[str, str]:
    """The ranks and the pattern of the contract."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op13_byte_bpe(spark, sf_dir):
    how = ranks_path()
    docs = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), *how, offsets=False)
    decoded = decode(docs.select("doc_id", "encoded.ids"), *how)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op13_byte_bpe": op13_byte_bpe}
ORACLES = {}
