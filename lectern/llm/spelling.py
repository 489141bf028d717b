"""Spelling variant grouping: finite-state composition.

Words at one edit from each other agree in all but one stretch. So each word stands twice for its own length and twice
for the length below: once with its first half open and keyed by the rest, once with its second half open and keyed by
the beginning. A key is an initial state of the vocabulary acceptor, read forwards or backwards, and what is open
are the strings that are accepted from it. For each key, a task builds the minimised acceptor of the open strings and composes it
with the one-edit transducer and the acceptor again: from a pair of states reached by one string it replaces or inserts
a code point, and then follows the strings that both states accept. Work follows the arcs that states share, not the pairs of
words. A pair is found under one key only, the one whose open stretch holds the first place at which the words differ.

A key with over ``WIDE`` words is dealt anew with one code point open at a time: then a key has at most as many
words as the alphabet allows, and no group grows with the vocabulary. Words are counted by Spark; forms are the best of a grouped
aggregate; roots double their reach at each join, and a chain of forms is short because counts grow fivefold.

Defined results: a null text has no words; a null id counts as the empty string in the query's hash. Repeated rows count as often as they stand. Other
columns play no part. An empty table, or one without frequent words, gives an empty result. Words may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii, table

LETTERS = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, STRONGER = 6, 5, 5
#: Words under one key from which on its open stretch is dealt one code point at a time.
WIDE = 2_000

State = tuple[bool, dict[str, int]]


class Acceptors:
    """Minimised acceptors that share their states: equal right languages are one state."""

    def __init__(self) -> None:
        self.states: list[State] = []
        self.register: dict[tuple, int] = {}

    def _close(self, open_states: list[list], word: str, keep: int) -> None:
        while len(open_states) > keep + 1:
            final, arcs = open_states.pop()
            open_states[-1][1][word[len(open_states) - 1]] = self._state(final, arcs)

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        found = self.register.setdefault((final, *arcs.items()), len(self.states))
        if found == len(self.states):
            self.states.append((final, arcs))
        return found

    def build(self, words: list[str]) -> int:
        """The initial state of the acceptor of sorted distinct words."""
        last, open_states = "", [[False, {}]]
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self._close(open_states, last, same)
            open_states += [[False, {}] for _ in word[same:]]
            open_states[-1][0] = True
            last = word
        self._close(open_states, last, 0)
        return self._state(*open_states[0])

    def both(self, p: int, q: int) -> Iterator[str]:
        """Strings accepted from both states."""
        todo = [(p, q, "")]
        while todo:
            p, q, said = todo.pop()
            (end_p, arcs_p), (end_q, arcs_q) = self.states[p], self.states[q]
            if end_p and end_q:
                yield said
            few, many = (arcs_p, arcs_q) if len(arcs_p) <= len(arcs_q) else (arcs_q, arcs_p)
            todo += [(arcs_p[c], arcs_q[c], said + c) for c in few if c in many]

    def replaced(self, start: int) -> Iterator[tuple[str, str]]:
        """Pairs of accepted strings of which one becomes the other by one replaced code point."""
        todo = [(start, "")]
        while todo:
            p, said = todo.pop()
            arcs = list(self.states[p][1].items())
            for i, (c, to) in enumerate(arcs):
                for other, to_other in arcs[:i]:
                    for rest in self.both(to, to_other):
                        yield said + c + rest, said + other + rest
                todo.append((to, said + c))

    def inserted(self, start: int, longer: int) -> Iterator[tuple[str, str]]:
        """Pairs of a string accepted from start and one accepted from longer that has one code point more, inserted as late as possible."""
        todo = [(start, longer, "")]
        while todo:
            p, q, said = todo.pop()
            arcs_p, arcs_q = self.states[p][1], self.states[q][1]
            for c, to in arcs_q.items():
                for rest in self.both(p, to):
                    if rest[:1] != c:
                        yield said + rest, said + c + rest
                if c in arcs_p:
                    todo.append((arcs_p[c], to, said + c))


PAIR = "word string, n long, other string, other_n long"


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs, both ways round, among the words of each key."""
    for batch in batches:
        rows = []
        for shorter, members, last in zip(*(batch.column(c).to_pylist() for c in ("shorter", "members", "last")), strict=True):
            same, longer = ({m["open"]: (m["word"], m["n"]) for m in members if (m["size"] > shorter) == more} for more in (False, True))
            acceptors = Acceptors()
            start = acceptors.build(sorted(same))
            pairs = [(same[x], same[y]) for x, y in acceptors.replaced(start)]
            if longer:
                for x, y in acceptors.inserted(start, acceptors.build(sorted(longer))):
                    if last or not y.startswith(x):  # otherwise the first difference stands beyond what is open
                        pairs.append((same[x], longer[y]))
            rows += [(*a, *b) for x, y in pairs for a, b in ((x, y), (y, x))]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64()) * 2, strict=True)], ["word", "n", "other", "other_n"])


def _slot(shorter: Column, first: Column, last: Column) -> Column:
    """The word under the key that leaves [first, last) open, one code point more for a word longer than shorter."""
    beyond = last + F.col("size") - shorter
    return F.struct(
        shorter.alias("shorter"), first.alias("first"), last.alias("last"),
        F.substring("word", F.lit(1), first).alias("before"), F.substring("word", beyond + 1, F.col("size")).alias("after"),
        F.substring("word", first + 1, beyond - first).alias("open"),
    )


def _dealt(rows: DataFrame, slots: Column) -> DataFrame:
    return rows.select("word", "n", "size", F.explode(slots).alias("slot")).select("word", "n", "size", "slot.*")


KEY = ["shorter", "first", "last", "before", "after"]


def near_pairs(words: DataFrame, wide: int = WIDE) -> DataFrame:
    """Each pair of distinct words at one inserted, deleted or replaced code point, both ways round: word, n, other, other_n.

    ``words`` has distinct words and their counts ``n``; it is read twice, so write it first.
    """
    sized = words.select("word", "n", F.char_length("word").alias("size")).where("size > 0")
    coarse = _dealt(sized, F.array(*[_slot(s, a, b) for s in (F.col("size"), F.col("size") - 1) for half in (F.floor(s / 2).cast("int"),) for a, b in ((F.lit(0), half), (half, s))])).where("shorter > 0 AND (first < last OR last = shorter)")
    hot = coarse.groupBy(*KEY).count().where(F.col("count") > wide).drop("count")
    hot = Scratch(words.sparkSession, "spelling").write(hot)
    hot_keys = hot.count()  # one number
    if hot_keys:
        listed = F.broadcast(hot) if hot_keys <= 20_000 else hot
        fine = F.transform(F.sequence(F.col("from"), F.col("to") - 1), lambda m: _slot(F.col("length"), m, m + 1))
        anew = coarse.join(listed, KEY).select("word", "n", "size", F.col("shorter").alias("length"), F.col("first").alias("from"), F.col("last").alias("to")).where("from < to")
        coarse = coarse.join(listed, KEY, "left_anti").unionByName(_dealt(anew, fine))
    grouped = coarse.groupBy(*KEY).agg(F.collect_list(F.struct("word", "n", "size", "open")).alias("members")).where(F.size("members") > 1)
    return grouped.select("shorter", (F.col("last") == F.col("shorter")).alias("last"), "members").mapInArrow(_compose, PAIR)


def group_variants(words: DataFrame, stronger: int = STRONGER, wide: int = WIDE) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct words with counts: the near word of largest count, if that is ``stronger`` times the word's own, and where such forms lead."""
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.write(words.select("word", "n"))
    best = near_pairs(words, wide).groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("own"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    formed = -F.col("best.less") >= stronger * F.col("own")
    best = scratch.write(best.select("word", "n_near", F.when(formed, F.col("best.other")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")))
    roots = scratch.write(best.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while roots.join(roots.select(F.col("word").alias("root")), "root", "left_semi").limit(1).count():  # ends soon: counts grow at each step
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = scratch.write(roots.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def count_words(runs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Words of at least so many code points and occurrences, with their counts, from rows of one ``word`` each."""
    return runs.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def letter_runs(docs: DataFrame, *columns: str) -> DataFrame:
    """Maximal runs of letters of whole texts as ``word``, A-Z in lower case, beside the named columns."""
    return docs.select(*columns, F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(LETTERS), F.lit(0))).alias("word"))


def op11_spelling_variants(spark, sf_dir):
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    at = (F.col("h") % F.char_length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
    runs = letter_runs(table(spark, sf_dir, "documents"), "doc_id").select("word", h.alias("h"))
    return group_variants(count_words(runs.select(F.when(F.col("h") % 199 == 0, shorter).otherwise(F.col("word")).alias("word"))))


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
ORACLES = {}
