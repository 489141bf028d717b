"""URL filters: pattern rules indexed by their rarest literal token.

A rule has a regular expression and the literal tokens that any URL it fits must hold as whole tokens. Each rule is
filed under that of its tokens which is rarest in the URLs at hand. A URL's tokens fetch the rules filed under them,
and only those run their expressions. Everything runs inside one scan of the URLs, without a shuffle.

Defined results: a null URL, or one without ``://``, has an empty host and path, no rule, and the default verdict.
Rows, repeated ones included, keep their other columns; columns named like a result column are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, lower_ascii, table

#: Rule tables live on the driver and travel in the plan; more rules than this are refused, not dropped.
MAX_RULES = 5000

#: Fixed by the contract: (verdict, rule). A rule is a host and the path that follows it.
SITE_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

#: The method's rules, in order; the first that fits decides: (verdict, expression over lower-case host and path, tokens).
PATTERN_RULES = [
    ("allow", r"(^|[.])museum[.]", ("museum",)),
    ("allow", r"/robots[.]txt$", ("robots", "txt")),
    ("block", r"^([^/]*[.])?spam-farm[.]", ("spam", "farm")),
    ("block", r"^([^/]*[.])?adult-x[.]", ("adult", "x")),
    ("block", r"^ads?[0-9]*[.]doubleclick[.]", ("doubleclick",)),
    ("block", r"/wp-login[.]php$", ("wp", "login", "php")),
    ("block", r"/cgi-bin/redirect(/|$)", ("cgi", "bin", "redirect")),
]
#: Words that name what is blocked, and the forms in which they do: {} is the word. Each word makes a rule of each form.
WORDS = [
    "casino", "betting", "poker", "roulette", "jackpot", "slots", "blackjack", "bookmaker", "gambling", "porn", "porno", "xxx", "hentai", "camgirls", "escorts", "milf", "nsfw",
    "warez", "keygen", "cracked", "nulled", "serialz", "torrentz", "rapidleech", "payday", "viagra", "cialis", "levitra", "tramadol", "xanax", "malware",
    "clickbait", "linkfarm", "autosurf", "getrich", "forexsignals", "cryptodoubler", "adserver", "adclick", "popunder", "trackpixel",
]
FORMS = [r"^([^/]*[.])?{}(-[a-z0-9]+)?[.]", r"^([^/]*[.])?[a-z0-9]+-{}[.]", r"^[^/]*[.]{}(/|$)", r"/{}/", r"/{}[.](html?|php|aspx?)$", r"/(best|free|online|cheap|live)-{}(-|/|[.]|$)"]


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool


def site_rule(verdict: str, rule: str) -> Rule:
    """Fits the rule's host and all its subdomains where the path starts with the rule's path."""
    host = rule.split("/", 1)[0]
    tokens = re.findall(r"[a-z0-9]+", host)
    tokens += re.findall(r"(?<=/)[a-z0-9]+(?=/)", rule[len(host) :].lower())  # only whole tokens can be looked up
    return Rule(rule, verdict, rf"^([^/]*[.])?{re.escape(rule)}", tuple(tokens), True)


def default_rules() -> list[Rule]:
    """The site rules, then the method's in order: those written out, then each form of each word."""
    return [site_rule(v, r) for v, r in SITE_RULES] + [Rule(p, v, p, t, False) for v, p, t in pattern_rules()]


def pattern_rules() -> list[tuple[str, str, tuple[str, ...]]]:
    return PATTERN_RULES + [("block", form.format(w), (w,)) for w in WORDS for form in FORMS]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: then up to ``?``, ``#`` or the end."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, whole, 1)), F.regexp_extract(url, whole, 2)


def tokens_of(subject: Column) -> Column:
    return F.array_distinct(F.split(lower_ascii(subject), "[^a-z0-9]+"))


def token_counts(urls: DataFrame, url: str, rules: list[Rule]) -> dict[str, int]:
    """In how many URLs each rule token stands; as many rows as the rules have tokens reach the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    host, path = host_and_path(F.col(url))
    rows = (
        urls.select(F.explode(tokens_of(F.concat(host, F.lit(" "), path))).alias("token"))
        .where(F.col("token").isin(wanted))
        .groupBy("token")
        .count()
        .collect()
    )
    return {r["token"]: r["count"] for r in rows}


def index_rules(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule positions under the rarest of each rule's tokens."""
    index: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
    return index


def filter_urls(df: DataFrame, url: str = "url", rules: list[Rule] | None = None, default: str = "allow") -> DataFrame:
    """Add host, path, rule (the longest site rule that fits), verdict and method_rule (the first pattern rule)."""
    rules = default_rules() if rules is None else rules
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit in a plan")
    if any(not r.tokens for r in rules):
        raise ValueError("each rule needs a literal token")
    index = index_rules(rules, token_counts(df, url, rules))
    filed = F.create_map(*[x for t, ids in sorted(index.items()) for x in (F.lit(t), F.array(*map(F.lit, ids)))])
    patterns = F.array(*[F.lit(r.pattern) for r in rules])
    host, path = host_and_path(F.col(url))
    df = df.withColumn("host", host).withColumn("path", path)
    keys = F.filter(tokens_of(F.concat("host", F.lit(" "), "path")), lambda t: t.isin(sorted(index)))
    candidates = F.flatten(F.transform(keys, lambda t: F.element_at(filed, t)))
    sites = F.array(*[F.lit(r.site) for r in rules])
    subject = F.concat("host", "path")

    def fits(i: Column) -> Column:
        text = F.when(F.get(sites, i), subject).otherwise(lower_ascii(subject))
        return F.call_function("rlike", text, F.get(patterns, i))

    df = df.withColumn("_fits", F.when(F.size(candidates) > 0, F.filter(candidates, fits)))
    names, verdicts = F.array(*[F.lit(r.name) for r in rules]), F.array(*[F.lit(r.verdict) for r in rules])
    site = F.array_max(
        F.transform(F.filter("_fits", lambda i: F.get(sites, i)), lambda i: F.struct(F.length(F.get(names, i)).alias("n"), i.alias("i")))
    )["i"]
    pattern = F.array_min(F.filter("_fits", lambda i: ~F.get(sites, i)))
    return (
        df.withColumn("_site", site)
        .withColumn("_pattern", pattern)
        .withColumn("rule", F.get(names, F.col("_site")))
        .withColumn("method_rule", F.get(names, F.col("_pattern")))
        .withColumn("verdict", F.coalesce(F.get(verdicts, F.col("_site")), F.get(verdicts, F.col("_pattern")), F.lit(default)))
        .drop("_fits", "_site", "_pattern")
    )


def op1_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    fits = lambda r: "(host = '{0}' OR host LIKE '%.{0}') AND starts_with(path, '{1}')".format(*re.match("([^/]*)(.*)", r).groups())
    ordered = sorted(SITE_RULES, key=lambda x: -len(x[1]))
    rule = " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in ordered)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{v}'" for v, r in ordered)
    method = " ".join(f"WHEN regexp_matches({lower('host || path')}, '{p}') THEN '{v}'" for v, p, _ in pattern_rules())
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
raw AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
parts AS (SELECT page_id, {lower('h')} AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM raw)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} {method} ELSE 'allow' END AS verdict FROM parts"""


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLES = {"op1_url_filter": _oracle()}
