"""Line dedup: exact set-similarity join of lines by their words, built-in functions only.

A line's tokens are its distinct words, in lower case. A line is removed if an earlier line, by document id and line
number, has Jaccard similarity 0.8 or more with it, be that line removed itself or not.

1. One scan turns each line into 64-bit ids of its words, ordered by length, as long words are rare, then by hash. The
   ids choose candidates only, and their order decides the cost only, never the result.
2. Equal lines become one set that stands at its first line; only that line can stay.
3. Each set goes to the neighbouring pairs of its prefix: the first word alone, and each of the next ``0.4 n`` words
   with the one before it. Similar sets share such a pair: each word that only one of them has parts one pair of
   neighbours among their common words, and where there are x such words in a and y in b, one of the first x + y + 1
   pairs is whole; it ends at a's word 2 x + y at most (from 0), which is ``2 a + b - 3 * overlap <= 0.4 a``. Few sets
   that are not similar share one, so lists stay short while single words would have lists that grow with the input.
4. In a list a set meets all earlier ones under the length and positional filters and 64 parity bits (the parity bits of
   two sets differ in no more places than the sets in words); in a long list it looks at the earliest and the two just before.
5. The likeliest candidate of each line, the one met in most lists, is verified by Jaccard on the words themselves, then
   the other candidates of lines still open. What is open then meets, in blocks and with more parity bits, the long lists
   in which it has met only some sets, so nothing is lost, yet a group of near copies is not expanded into pairs.

Defined results: null text has no lines. Lines without words are not judged and stay. Equal rows count as one
document; rows that share an id but not the text are documents of their own in ``dedup_lines``, the later ones after all
other ids (the query, which reports by id, expects distinct ids); rows without an id are not judged and keep all lines. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, own_ids, table

BLANKS = " \t\r\f\x0B"
#: The threshold as a fraction.
NUM, DEN = 4, 5
#: Counters of ``tiers``.
COUNTERS = 1 << 18
#: Lists of more sets are met in full only by lines that stay open, in blocks of so many sets.
LONG_LIST, BLOCK = 64, 1024
#: Words of a line beyond which its parity bits are 128 instead of 64.
NARROW = 64
#: Places before a set, in the order of a list, whose sets it looks at besides the earliest.
NEIGHBOURS = (1, 2)
#: Lines to verify, and lists to meet in full, are looked up by a broadcast up to so many, by a shuffle beyond.
BROADCAST_ROWS = 500_000


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(Column.__or__, tests)


def trimmed(line: Column) -> Column:
    """The line without blanks at its ends; most have none, which is told faster than they are trimmed."""
    return F.when(any_of(end(F.lit(x)) for x in BLANKS for end in (line.startswith, line.endswith)), F.btrim(line, F.lit(BLANKS))).otherwise(line)


def words_of(line: Column) -> Column:
    """Words of a plain line; where single spaces alone part them, by the faster of two ways."""
    others = any_of(line.contains(F.lit(x)) for x in (*BLANKS[1:], "  "))
    return F.when(others, F.split(line, r"[ \t\r\f\x0B]+")).otherwise(F.split(line, " "))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_words(line: Column) -> Column:
    return (line != "") & (~any_of(line.startswith(F.lit(x)) for x in BLANKS) | (F.btrim(line, F.lit(BLANKS)) != ""))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line (from 0), text of each line with words, in lower case and without blanks at its ends."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    # The generator reads no column, or Spark would add a filter that splits all texts twice more.
    lines = rows.select("doc_id", F.posexplode(F.split(F.lower("text"), "\n")).alias("line", "text")).where(has_words(F.col("text")))
    return lines.select("doc_id", "line", trimmed(F.col("text")).alias("text"))


def parity(ids: Column, mask: int) -> Column:
    """64 parity bits of the ids in which all bits of the mask, none of the lowest six, are set."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    bit = lambda x: F.call_function("shiftleft", one, x.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    held = lambda x: bit(x) if not mask else F.when(x.bitwiseAND(F.lit(mask).cast("long")) == mask, bit(x)).otherwise(zero)
    return F.aggregate(ids, zero, lambda acc, x: acc.bitwiseXOR(held(x)))


def tiers(sets: DataFrame) -> DataFrame:
    """One row of fixed size: for each counter, twice the logarithm of how many lines its tokens stand in."""
    slot = F.col("id").bitwiseAND(F.lit(COUNTERS - 1).cast("long")).alias("slot")
    stand = sets.select(F.explode("ids").alias("id")).select(slot, F.lit(1).alias("n"))
    every = sets.sparkSession.range(COUNTERS).select(F.col("id").alias("slot"), F.lit(0).alias("n"))
    tier = F.least(F.coalesce(F.log2(F.sum("n")) * 2, F.lit(0)).cast("int"), F.lit(63))
    counted = stand.union(every).groupBy("slot").agg(tier.alias("tier"))
    listed = counted.agg(F.sort_array(F.collect_list(F.struct("slot", "tier"))).alias("x"))
    return listed.select(F.col("x.tier").cast("array<tinyint>").alias("tiers"))


def tiers_of(sets: DataFrame) -> str:
    """The tiers as one text, to look at."""
    return tiers(sets).select(F.array_join(F.col("tiers").cast("array<string>"), ",")).collect()[0][0]


SET = ["doc_id", "line", "n", "p0"]
#: Conditions on two sets of a list: a comes later than b and they may be similar. _NEEDED is the least overlap; pos
#: words of the prefix come before a pair's second word, so no more common ones.
_NEEDED = f"(({NUM} * (a.n + b.n) + {NUM + DEN - 1}) div {NUM + DEN})"
EARLIER = "(b.doc_id < a.doc_id OR b.doc_id = a.doc_id AND b.line < a.line)"
LIKELY = (
    f"a.n * {DEN} >= b.n * {NUM} AND b.n * {DEN} >= a.n * {NUM} "
    f"AND least(a.pos, b.pos) + least(a.n - a.pos, b.n - b.pos) >= {_NEEDED} AND bit_count(a.p0 ^ b.p0) <= a.n + b.n - 2 * {_NEEDED}"
)


def checked(rows: DataFrame) -> DataFrame:
    """The rows, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def word_id(word: Column) -> Column:
    """A 63-bit id, smaller for longer words, of which the upper 31 bits are a shorter one in the same order."""
    short = (F.lit(31) - F.least(F.octet_length(word), F.lit(31))).cast("long")
    return F.call_function("shiftleft", short, F.lit(58)).bitwiseOR(F.shiftrightunsigned(F.xxhash64(word), 6))


def first_lines(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Distinct lines, each at its first place: the fields of SET and the short ids of its prefix in order (where two
    words share one, it stands twice). And doc_id, n_lines, judged (how many lines have words)."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.split("text", "\n").alias("pieces"))
    at = F.filter(F.transform("pieces", lambda x, i: F.when(has_words(x), i)), lambda i: i.isNotNull())
    counts = rows.select("doc_id", F.size("pieces").alias("n_lines"), at.alias("at")).groupBy("doc_id")
    counts = counts.agg(F.max("n_lines").cast("long").alias("n_lines"), F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("judged"))
    lines = lines_of(docs)
    ids = F.sort_array(F.array_distinct(F.transform(words_of(F.col("text")), word_id)))
    sets = lines.select("doc_id", "line", F.xxhash64("text").alias("h0"), F.xxhash64(F.lit(1), "text").alias("h1"), ids.alias("ids"))
    # 2 a + b - 3 * overlap is 2 / 5 of a at most, for b of 4 / 5 of it
    prefix = F.transform(F.slice("ids", F.lit(1), F.expr(f"size(ids) * {2 * (DEN - NUM)} div {DEN} + 1")), lambda x: F.shiftrightunsigned(x, 32).cast("int"))
    n = F.size("ids")
    bits = [parity(F.col("ids"), 0).alias("p0"), F.when(n > NARROW, parity(F.col("ids"), 64)).otherwise(F.lit(0).cast("long")).alias("p1")]
    sets = sets.select("h0", "h1", "doc_id", "line", n.alias("n"), *bits, prefix.alias("prefix"))
    firsts = sets.groupBy("h0", "h1").agg(F.min(F.struct(*SET, "p1", "prefix")).alias("x"))
    return scratch.write(firsts.select("x.*")), counts


def posted_in(distinct: DataFrame) -> DataFrame:
    """pair, doc_id, line, p0, and n and pos in one number: each set in the list of each pair of its prefix, by pair."""
    rows = distinct.select(*SET, "prefix", F.posexplode("prefix").alias("pos", "id"))
    before = F.when(F.col("pos") == 0, F.lit(-1)).otherwise(F.get("prefix", F.col("pos") - 1)).cast("long")
    pair = F.call_function("shiftleft", before, F.lit(32)).bitwiseOR(F.col("id").cast("long"))
    sizes = F.call_function("shiftleft", F.col("n").cast("long"), F.lit(32)).bitwiseOR(F.col("pos").cast("long"))
    rows = rows.select(pair.alias("pair"), "doc_id", "line", "p0", sizes.alias("sizes"))
    return rows.select(*[F.coalesce(c, F.lit(0).cast(kind)).alias(c) for c, kind in rows.dtypes]).repartition("pair")


def lists(posted: DataFrame) -> DataFrame:
    """doc_id, line, o_doc_id, o_line: each set of a list of up to LONG_LIST sets beside all likely earlier ones; and the
    rows of longer lists, with their pair, n, pos and p0. Most lists have one set and give nothing."""
    # No column can be null and sizes are counted from all of them, so no reader adds a filter or drops a column, and all read one exchange.
    size = posted.groupBy("pair").agg(F.count("*").alias("size"), F.bit_xor(F.expr("doc_id ^ line ^ p0 ^ sizes")).alias("all")).where("all IS NOT NULL")
    rows = posted.select("pair", "doc_id", "line", "p0", F.expr("int(shiftright(sizes, 32))").alias("n"), F.expr("int(sizes & 2147483647)").alias("pos"))
    of = lambda sizes: rows.join(size.where(sizes).select("pair").hint("shuffle_hash"), "pair", "left_semi")
    short = rows.alias("a").join(of(F.col("size").between(2, LONG_LIST)).alias("b").hint("shuffle_hash"), F.expr(f"a.pair = b.pair AND {EARLIER} AND {LIKELY}"))
    short = short.select("a.doc_id", "a.line", F.col("b.doc_id").alias("o_doc_id"), F.col("b.line").alias("o_line"))
    return short.unionByName(of(F.col("size") > LONG_LIST), allowMissingColumns=True)


def meetings(listed: DataFrame) -> DataFrame:
    """doc_id, line, pair, place (of the set in the list, from 0), o_doc_id, o_line (a likely earlier set or null), more
    (whether there are earlier sets in the list that were not looked at)."""
    by = W.partitionBy("pair").orderBy("doc_id", "line")
    own = F.struct(*SET, "pos")
    seen = {"first": F.first(own).over(by.rowsBetween(W.unboundedPreceding, W.currentRow))} | {f"near{k}": F.lag(own, k).over(by) for k in NEIGHBOURS}
    rows = listed.select("*", (F.row_number().over(by) - 1).alias("place"), *[c.alias(name) for name, c in seen.items()]).where("place > 0")

    def likely(name: str) -> Column:
        good = F.expr(f"{EARLIER} AND {LIKELY}".replace("a.", "").replace("b.", f"{name}."))
        return F.when(good, F.struct(F.col(f"{name}.doc_id").alias("doc_id"), F.col(f"{name}.line").alias("line")))

    rows = rows.withColumn("near", F.least(*[likely(name) for name in seen]))
    more = F.col("place") > F.when(F.col("near").isNull(), len(seen)).otherwise(1)
    met = rows.select("doc_id", "line", "pair", "place", F.col("near.doc_id").alias("o_doc_id"), F.col("near.line").alias("o_line"), more.alias("more"))
    return met.where("more OR o_doc_id IS NOT NULL")


def in_full(scratch: Scratch, docs: DataFrame, long: DataFrame, still: DataFrame) -> DataFrame:
    """doc_id, line, o_doc_id, o_line: open sets (doc_id, line, pair, place) beside all earlier ones of their lists that
    may be similar. A list is met in blocks, so no task has a whole long one."""
    size = F.lit(BLOCK)
    by = W.partitionBy("pair").orderBy("doc_id", "line")
    listed = long.join(checked(still.select("pair").distinct()), "pair", "left_semi")
    listed = scratch.write(listed.withColumn("block", F.floor((F.row_number().over(by) - 1) / size).cast("int")))
    listed = scratch.write(with_more_bits(scratch, docs, listed))
    open_ = still.join(listed.drop("block"), ["doc_id", "line", "pair"])
    open_ = open_.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor(F.col("place") / size).cast("int"))))
    differ = " + ".join(f"bit_count(a.q{k} ^ b.q{k})" for k in range(4))
    met = open_.alias("a").join(listed.alias("b"), F.expr(f"a.pair = b.pair AND a.block = b.block AND {EARLIER} AND {LIKELY} AND {differ} <= a.n + b.n - 2 * {_NEEDED}"))
    return met.select("a.doc_id", "a.line", F.col("b.doc_id").alias("o_doc_id"), F.col("b.line").alias("o_line")).distinct()


def likelier(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The pairs that may be similar by 128 parity bits, where both lines have more than NARROW words."""
    bits = distinct.select("doc_id", "line", "n", "p0", "p1")
    both = pairs.join(bits.withColumnsRenamed({"n": "a_n", "p0": "a0", "p1": "a1"}), ["doc_id", "line"])
    both = both.join(bits.withColumnsRenamed({"doc_id": "o_doc_id", "line": "o_line", "n": "b_n", "p0": "b0", "p1": "b1"}), ["o_doc_id", "o_line"])
    least = _NEEDED.replace("a.", "a_").replace("b.", "b_")
    fits = f"least(a_n, b_n) <= {NARROW} OR bit_count(a1 ^ b1) + bit_count(a0 ^ b0 ^ a1 ^ b1) <= a_n + b_n - 2 * {least}"
    return both.where(fits).select(*pairs.columns)


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, judged (lines with words), kept (numbers of the judged lines that stay)."""
    scratch = Scratch(docs.sparkSession, "lines")
    distinct, counts = first_lines(docs, scratch)
    listed = scratch.write(lists(posted_in(distinct)))
    short, long = listed.where("pair IS NULL"), listed.where("pair IS NOT NULL").select("pair", *SET, "pos")
    met = scratch.write(meetings(long))
    place, pair = ["doc_id", "line"], ["doc_id", "line", "o_doc_id", "o_line"]
    found = short.select(*pair).union(met.where("o_doc_id IS NOT NULL").select(*pair))
    found = scratch.write(found.groupBy(*pair).agg(F.count("*").alias("lists")))
    found = scratch.write(likelier(found, distinct))

    texts = texts_of(scratch, docs, found)
    best = found.groupBy(*place).agg(F.max(F.struct("lists", "o_doc_id", "o_line")).alias("x")).select(*place, "x.o_doc_id", "x.o_line")
    best = scratch.write(best)
    matched = scratch.write(verified(texts, best))
    others = scratch.write(found.select(*pair).join(checked(matched), place, "left_anti").join(best, pair, "left_anti"))
    matched = scratch.write(matched.unionByName(verified(texts, others)).distinct())
    still = scratch.write(met.where("more").select(*place, "pair", "place").join(checked(matched), place, "left_anti"))
    rest = in_full(scratch, docs, long, still)
    rest = scratch.write(rest.join(found.select(*pair), pair, "left_anti"))
    matched = matched.unionByName(verified(texts_of(scratch, docs, rest), rest)).distinct()

    stay = distinct.select(*place).join(matched, place, "left_anti")
    kept = stay.groupBy("doc_id").agg(F.sort_array(F.collect_list("line")).alias("kept"))  # at most the document's lines
    none = F.array().cast("array<int>")
    return counts.join(kept, "doc_id", "left").withColumn("kept", F.coalesce("kept", none))


def lines_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """doc_id, line, text of the lines at these distinct places, plain."""
    sent = F.broadcast if places.count() <= BROADCAST_ROWS else lambda rows: rows  # there are no more documents than places
    near = docs.join(sent(places.select("doc_id").distinct()), "doc_id", "left_semi")
    found = lines_of(near).join(sent(places), ["doc_id", "line"], "left_semi")
    return found.groupBy("doc_id", "line").agg(F.min("text").alias("text"))


def with_more_bits(scratch: Scratch, docs: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows with 256 more parity bits, independent of the others, from the words of their lines."""
    lines = lines_at(docs, scratch.write(listed.select("doc_id", "line").distinct()))
    ids = scratch.write(lines.select("doc_id", "line", F.array_distinct(F.transform(words_of(F.col("text")), lambda w: F.xxhash64(F.lit(2), w))).alias("ids")))

    def quarter(k: int) -> Column:
        return F.filter("ids", lambda x: x.bitwiseAND(F.lit(192).cast("long")) == 64 * k)

    return listed.join(ids.select("doc_id", "line", *[parity(quarter(k), 0).alias(f"q{k}") for k in range(4)]), ["doc_id", "line"])


def texts_of(scratch: Scratch, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """doc_id, line, text of all lines of the pairs."""
    return scratch.write(lines_at(docs, scratch.write(pairs.select("doc_id", "line").union(pairs.select("o_doc_id", "o_line")).distinct())))


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """doc_id, line of the pairs whose Jaccard similarity, on the words themselves, reaches the threshold."""
    place = ["doc_id", "line"]
    both = pairs.join(texts.withColumnRenamed("text", "a"), place)
    both = both.join(texts.select(F.col("doc_id").alias("o_doc_id"), F.col("line").alias("o_line"), F.col("text").alias("b")), ["o_doc_id", "o_line"])

    def similar(a: Column, b: Column) -> Column:
        common = F.size(F.array_intersect(a, b))
        return common * DEN >= (F.size(a) + F.size(b) - common) * NUM

    words = F.struct(*[F.array_distinct(words_of(F.col(c))).alias(c) for c in "ab"])
    return both.where(once(words, lambda w: similar(w["a"], w["b"]))).select(*place).distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without the removed lines. Other columns are kept; those named ``n_lines`` and ``n_removed`` are
    replaced by how many lines the document had and how many of them went."""
    docs = docs.drop("n_lines", "n_removed")
    named, _ = own_ids(docs, Scratch(docs.sparkSession, "lines"))
    found = removed_lines(named.select(F.col("own_id").alias("doc_id"), "row.text")).select(F.struct("n_lines", "judged", "kept").alias("_lines"), F.col("doc_id").alias("_lines_of"))
    joined = named.join(found, F.col("own_id") == F.col("_lines_of"), "left").select("row.*", "_lines", "_lines_of")
    pieces, kept, judged = F.split("text", "\n"), F.col("_lines.kept"), F.col("_lines.judged")
    text = F.when(F.col("_lines").isNull() | (F.size(kept) == judged), F.col("text")).otherwise(
        F.array_join(F.filter(pieces, lambda line, i: ~has_words(line) | F.array_contains(kept, i)), "\n")
    )
    joined = joined.withColumn("n_lines", F.col("_lines.n_lines")).withColumn("n_removed", F.coalesce(judged - F.size(kept), F.lit(0).cast("long")))
    return joined.withColumn("text", text).drop("_lines", "_lines_of")


def op5_line_dedup(spark, sf_dir):
    """One row per document: its lines, how many were judged, how many removed, and the numbers of the judged that stay."""
    found = removed_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_lines", F.col("judged").alias("n_judged"), (F.col("judged") - F.size("kept")).alias("n_removed"),
        F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept_lines"),
    )


_WORDS = "string_split_regex(regexp_replace(lower(l), '^[ \\t\\r\\f\\x0B]+|[ \\t\\r\\f\\x0B]+$', '', 'g'), '[ \\t\\r\\f\\x0B]+')"
ORACLE = f"""
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS l FROM cut),
w AS (SELECT doc_id, line, doc_id * 1000000 + line AS place, list_sort(list_distinct({_WORDS})) AS w FROM numbered),
judged AS (SELECT * FROM w WHERE w <> ['']),
sets AS (SELECT w, len(w) AS n, min(place) AS place FROM judged GROUP BY w),
gone AS (SELECT DISTINCT a.place FROM sets a JOIN sets b ON b.place < a.place AND b.n * 5 >= a.n * 4 AND a.n * 5 >= b.n * 4
  WHERE 9 * len(list_intersect(a.w, b.w)) >= 4 * (a.n + b.n)),
stay AS (SELECT place FROM sets WHERE place NOT IN (SELECT place FROM gone))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (w <> ['']) AS n_judged, count(*) FILTER (w <> [''] AND s.place IS NULL) AS n_removed,
  coalesce(string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) FILTER (s.place IS NOT NULL), '') AS kept_lines
FROM w LEFT JOIN stay s ON s.place = w.place GROUP BY doc_id"""

QUERIES = {"op5_line_dedup": op5_line_dedup}
ORACLES = {"op5_line_dedup": ORACLE}
