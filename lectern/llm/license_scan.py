"""License scans: ordered signature rules gated by keywords, overlaps resolved by priority and containment.

Texts become word sequences: A-Z lower-cased, ASCII letters, digits and all non-ASCII characters kept, one space
between words. A text that holds none of the gate words skips the rules. In the others, a rule runs its expression
only where its keyword occurs. Every match is an interval; one that lies inside an interval of the same or a better
priority is suppressed. One scan, no shuffle, built-in functions only; the work for a text depends on that text alone.

Defined results: a null or empty text has no words, labels '' and score 0. Repeated rows are judged alike, other
columns are kept (those named like a result column are replaced).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, table

#: Fixed by the contract: label and phrase.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between the words of a text that is not lower-cased yet.
RAW_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Hand-written names: label, expression over normalised words, a literal that every match holds.
FAMILIES = [
    ("mit", "mit", "mit"),
    ("mit", "expat", "expat"),
    ("x11", "x11", "x11"),
    ("apache", "apache(?: software)?", "apache"),
    ("apache-1.1", "apache(?: software)?(?: license)? version 1 1", "apache"),
    ("apache-2.0", "apache(?: software)?(?: license)?(?: version)? 2 0", "apache"),
    ("bsd", "bsd", "bsd"),
    ("bsd-2-clause", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)", "bsd"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)", "bsd"),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd"),
    ("gpl", "(?:gnu )?general public", "general public"),
    ("gpl", "(?:gnu )?gpl", "gpl"),
    ("gpl-2.0", "(?:gnu )?(?:gpl|general public license)(?: version)? (?:v2|2)(?: 0)?", "2"),
    ("gpl-3.0", "(?:gnu )?(?:gpl|general public license)(?: version)? (?:v3|3)(?: 0)?", "3"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", "general public"),
    ("lgpl", "(?:gnu )?lgpl", "lgpl"),
    ("agpl", "(?:gnu )?affero general public", "affero"),
    ("agpl", "(?:gnu )?agpl", "agpl"),
    ("gfdl", "(?:gnu )?free documentation", "free documentation"),
    ("mpl", "mozilla public", "mozilla"),
    ("mpl-2.0", "(?:mpl|mozilla public license)(?: version)? (?:v2|2)(?: 0)?", "2"),
    ("epl", "eclipse public", "eclipse"),
    ("epl-2.0", "(?:epl|eclipse public license)(?: version)? (?:v2|2)(?: 0)?", "2"),
    ("cddl", "common development and distribution", "common development"),
    ("eupl", "european union public", "european union"),
    ("artistic", "artistic", "artistic"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("boost", "boost software", "boost"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("python", "python software foundation", "python"),
    ("php", "php", "php"),
    ("ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl"),
    ("ofl", "sil open font", "open font"),
    ("cc0", "(?:cc0|creative commons zero)", "c"),
    ("cc-by", "creative commons attribution", "attribution"),
    ("cc-by-sa", "creative commons attribution share ?alike", "attribution"),
    ("cc-by-nc", "creative commons attribution non ?commercial", "attribution"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s?", "attribution"),
    ("odbl", "open (?:data commons open )?database", "database"),
    ("msr", "microsoft (?:public|reciprocal)", "microsoft"),
    ("ibm", "ibm public", "ibm"),
]

#: Hand-written forms around a name: priority (0 is best), score, expression, and the gate, which every match holds;
#: {} is the name.
FORMS = [
    (0, 1.0, "(?:is |are )?(?:released|licensed|distributed|published) under (?:the )?(?:terms of the |terms of )?{}(?: licen[cs]e)?", "(?:released|licensed|distributed|published) under"),
    (0, 1.0, "permission .{{0,80}}under (?:the )?{} licen[cs]e", "licen"),
    (1, 0.95, "spdx license identifier {}", "licen"),
    (1, 0.9, "(?:the )?{} (?:public )?licen[cs]e(?: version [0-9]+(?: [0-9]+)?)?", "licen"),
    (1, 0.85, "licen[cs]e {}", "licen"),
]

#: Hand-written signatures of license texts: label, priority, score, literal, expression.
SIGNATURES = [
    ("mit", 0, 1.0, "permission is hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 0, 1.0, "with or without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", 0, 1.0, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("apache-2.0", 0, 1.0, "apache", "you may not use this file except in compliance with the license .{0,80}apache"),
    ("gpl", 0, 1.0, "free software", "this program is free software you can redistribute it and or modify"),
    ("unlicense", 0, 1.0, "public domain", "this is free and unencumbered software released into the public domain"),
    ("public-domain", 1, 0.8, "public domain", "(?:released |placed )?(?:in|into|to) the public domain"),
    ("warranty-disclaimer", 2, 0.4, "warrant", "without warranty of any kind"),
    ("copyright", 2, 0.3, "copyright", "copyright (?:c )?(?:[0-9]{4} ?)+"),
    ("all-rights-reserved", 2, 0.3, "all rights", "all rights reserved"),
    ("unknown-license", 3, 0.2, "licen", "licen[cs](?:e|ed|es|ing)"),
]


def default_rules() -> list[tuple[str, int, float, str, str]]:
    """(label, priority, score, keyword, expression, gate), in order: each form around each name, then the signatures."""
    made = [(label, p, s, kw, form.format(name), gate) for label, name, kw in FAMILIES for p, s, form, gate in FORMS]
    signatures = [(label, p, s, kw, x, kw) for label, p, s, kw, x in SIGNATURES]
    return [(label, p, s, kw, f"(?<= ){x}(?= )", gate) for label, p, s, kw, x, gate in made + signatures]


def gate_of(rules, phrases) -> str:
    """Expression over raw texts that fits wherever a rule or phrase can; a rule without a gate has its keyword."""
    gates = [r[5] if len(r) > 5 else re.escape(r[3]).replace("\\ ", " ") for r in rules] + [phrase for _, phrase in phrases]
    least = [g for g in dict.fromkeys(gates) if not any(other != g and other in g for other in gates if re.fullmatch("[a-z0-9 ]+", g + other))]
    return "(?i)" + "|".join(g.replace(" ", RAW_BETWEEN) for g in least)


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


#: Matches whose places are added up at once; so many matches cost little more than the text is long.
TOGETHER = 256


def matches(text: Column, rule: Column) -> Column:
    """Intervals of the rule's matches in the text, as structs that sort by start, then longest, then best priority."""
    parts = F.zip_with(
        F.call_function("split", text, rule["pattern"]),
        F.call_function("regexp_extract_all", text, rule["pattern"], F.lit(0)),
        lambda a, m: F.struct(F.length(a).alias("a"), F.length(m).alias("m")),
    )

    def places(parts: Column) -> Column:
        """start and end of each match, counted from the first of the parts."""

        def add(acc: Column, z: Column) -> Column:
            end = acc["at"] + z["a"] + z["m"]
            return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct((acc["at"] + z["a"]).alias("start"), end.alias("end"))).alias("out"))

        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")), add, lambda acc: acc["out"])

    def whole(parts: Column) -> Column:
        groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / TOGETHER).cast("int")), lambda i: places(F.slice(parts, i * TOGETHER + 1, F.lit(TOGETHER))))
        sizes = F.transform(groups, lambda g: F.element_at(g, -1)["end"])
        first = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))

        def one(g: Column, at: Column) -> Column:
            return F.transform(g, lambda x: F.struct((at + x["start"]).alias("start"), (-(at + x["end"])).alias("minus_end"), rule["priority"].alias("priority"), rule["rule"].alias("rule")))

        return F.flatten(F.zip_with(groups, F.slice(first, F.lit(1), F.size(groups)), one))

    return F.get(F.transform(F.array(F.filter(parts, lambda z: z["m"].isNotNull())), whole), F.lit(0))


def detect(norm: Column, rules) -> Column:
    """struct(labels, score) of the matches that no match of the same or a better priority contains."""
    table_ = F.array(*[
        F.struct(F.lit(i).alias("rule"), F.lit(p).alias("priority"), F.lit(kw).alias("keyword"), F.lit(x).alias("pattern"))
        for i, (_, p, _, kw, x, *_) in enumerate(rules)
    ])
    labels, scores = F.array(*[F.lit(r[0]) for r in rules]), F.array(*[F.lit(float(r[2])) for r in rules])
    levels = sorted({r[1] for r in rules})

    def whole(text: Column) -> Column:
        runs = F.filter(table_, lambda r: F.contains(text, r["keyword"]) & F.call_function("rlike", text, r["pattern"]))
        found = F.array_sort(F.flatten(F.transform(runs, lambda r: matches(text, r))))

        def step(acc: Column, d: Column) -> Column:
            end = -d["minus_end"]
            reach = F.greatest(*[F.when(d["priority"] >= p, acc[f"m{p}"]).otherwise(F.lit(-1)) for p in levels], F.lit(-1))
            stays = reach < end
            ends = [F.when(d["priority"] == p, F.greatest(acc[f"m{p}"], end)).otherwise(acc[f"m{p}"]).alias(f"m{p}") for p in levels]
            label = F.when(stays, F.array_union(acc["labels"], F.array(F.get(labels, d["rule"])))).otherwise(acc["labels"])
            best = F.when(stays, F.greatest(acc["score"], F.get(scores, d["rule"]))).otherwise(acc["score"])
            return F.struct(*ends, label.alias("labels"), best.alias("score"))

        start = F.struct(*[F.lit(-1).alias(f"m{p}") for p in levels], F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))
        return F.aggregate(found, start, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["score"].alias("score")))

    return F.get(F.transform(F.array(norm), whole), F.lit(0))  # the lambda's variable keeps the text from being made again


def base_places(norm: Column, phrases) -> Column:
    """struct(n, first, last, labels) of the places where a phrase's words stand consecutively."""

    def whole(text: Column) -> Column:
        def one(label: str, phrase: str) -> Column:
            def places(parts: Column) -> Column:
                n = F.size(parts) - 1
                last = spaces(text) - 1 - (spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())
                return F.when(n > 0, F.struct(n.cast("long").alias("n"), (spaces(F.get(parts, F.lit(0))) - 1).cast("long").alias("first"), last.cast("long").alias("last"), F.lit(label).alias("label")))

            return F.get(F.transform(F.array(F.split(text, f"(?<= ){phrase}(?= )", -1)), places), F.lit(0))

        return F.array_compact(F.array(*[one(*x) for x in phrases]))

    found = F.get(F.transform(F.array(norm), whole), F.lit(0))
    return F.get(
        F.transform(
            F.array(found),
            lambda f: F.struct(
                F.aggregate(f, F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n"),
                F.array_min(F.transform(f, lambda x: x["first"])).alias("first"),
                F.array_max(F.transform(f, lambda x: x["last"])).alias("last"),
                F.transform(f, lambda x: x["label"]).alias("labels"),
            ),
        ),
        F.lit(0),
    )


def scan_licenses(df: DataFrame, text: str = "text", phrases=None, rules=None) -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, labels and score."""
    phrases, rules = phrases or PHRASES, rules or default_rules()
    raw = F.coalesce(F.col(text), F.lit(""))
    norm = F.when(raw.rlike(gate_of(rules, phrases)), F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_ascii(raw), BETWEEN, " ")), F.lit(" ")))
    judged = F.transform(F.array(norm), lambda t: F.when(t.isNotNull(), F.struct(base_places(t, phrases).alias("base"), detect(t, rules).alias("rules"))))
    none = F.array().cast("array<string>")
    df = df.withColumn("_n", F.regexp_count(raw, F.lit(WORD)).cast("long")).withColumn("_j", F.get(judged, F.lit(0)))
    base, more = F.coalesce("_j.base.labels", none), F.coalesce("_j.rules.labels", none)
    return (
        df.withColumn("n_words", F.col("_n"))
        .withColumn("n_base", F.coalesce("_j.base.n", F.lit(0).cast("long")))
        .withColumn("first_word", F.col("_j.base.first"))
        .withColumn("last_word", F.col("_j.base.last"))
        .withColumn("base_labels", F.array_join(F.array_sort(F.array_distinct(base)), ","))
        .withColumn("labels", F.array_join(F.array_sort(F.array_union(base, more)), ","))
        .withColumn("score", F.greatest(F.when(F.size(base) > 0, 0.7).otherwise(0.0), F.coalesce("_j.rules.score", F.lit(0.0))))
        .drop("_n", "_j")
    )


def op6_license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs).drop("text")


QUERIES = {"op6_license_scan": op6_license_scan}
ORACLES = {}
