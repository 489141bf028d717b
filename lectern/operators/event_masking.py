"""Masked export of a course's tracking events, and of all its tables.

Payloads are trees without a type. Rules name the places of a tree: drop it, or put a value in its place; what no rule
names stays. They compile to one nested expression over maps of variants, so an event is rewritten where it lies. Texts
at the leaves are masked with all that is known of the people whom the event names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound, datestamp, masked_username, once, remap_id
from ..sources.readers import parse_lines
from . import events as X
from . import privacy as M
from .activity import locate

Rules = dict[str, "Rules | Callable[[Column], Column] | None"]
REDACTED = "REDACTED_USERNAME"
#: Fixed by the format: keys of the envelope and of the payload that may tell who someone is, and go; the keys that name people.
ENVELOPE = ("host", "ip", "page", "referer")
CONTEXT = ("host", "ip", "path")
CLIENT = ("device", "ip")
PAYLOAD = ("certificate_id", "certificate_url", "source_url", "fileName", "GET", "POST", "requesting_student_id", "report_url", "url", "url_name")
UPLOADS = ("answer", "saved_response")
NAMES = ("username", "instructor", "student", "user")


def rewrite(tree: Column, rules: Rules) -> Column:
    """A variant object by rules of its keys: None drops the key, a function makes its new value of the old, further rules go on
    inside it. Keys without a rule stay, and so does what is no object."""
    gone = [k for k, rule in rules.items() if rule is None]
    kept = F.map_filter(F.try_variant_get(tree, "$", "map<string,variant>"), lambda k, _: ~k.isin(gone)) if gone else F.try_variant_get(tree, "$", "map<string,variant>")

    def changed(key: Column, value: Column) -> Column:
        out = value
        for name, rule in rules.items():
            if rule is not None:
                out = F.when(key == name, rewrite(value, rule) if isinstance(rule, dict) else rule(value)).otherwise(out)
        return out

    if any(rule is not None for rule in rules.values()):
        kept = F.transform_values(kept, changed)
    return F.when(is_object(tree), F.to_variant_object(kept)).otherwise(tree)


def is_object(tree: Column) -> Column:
    return X.is_object(tree)


def variant(value: Column) -> Column:
    """A string or number as a variant."""
    return F.try_variant_get(F.to_variant_object(F.struct(value.alias("x"))), "$.x", "variant")


def text_of(tree: Column, path: str) -> Column:
    return F.nullif(F.trim(F.try_variant_get(tree, f"$.{path}", "string")), F.lit(""))


def number_of(tree: Column, path: str) -> Column:
    return text_of(tree, path).try_cast("long")


def with_people(events: DataFrame, directory: DataFrame) -> DataFrame:
    """Add ``people``, a map of the persons whom an event names, by ``n:`` and name or ``i:`` and id, and ``ids``, all ids in it.

    directory: user_id, username, name. The names of an event are looked up by one join; equal lines share what is found.
    """
    places = [("event", "username"), ("event", "context.username"), *[("payload", k) for k in NAMES]]
    names = F.array_compact(F.array(*[text_of(F.col(tree), path) for tree, path in places]))
    ids = F.array_distinct(F.array_compact(F.array(number_of(F.col("event"), "context.user_id"), number_of(F.col("payload"), "user_id"))))
    keys = F.array_distinct(F.concat(F.transform(names, lambda n: F.concat(F.lit("n:"), n)), F.transform(ids, lambda i: F.concat(F.lit("i:"), i.cast("string")))))
    events = events.withColumns({"ids": ids, "line_key": F.sha2("line", 256)})
    named = events.select("line_key", F.explode(keys).alias("person_key")).distinct()
    person = F.struct("user_id", "username", "name").alias("person")
    known = directory.select(F.explode(F.array(F.concat(F.lit("n:"), "username"), F.concat(F.lit("i:"), F.col("user_id").cast("string")))).alias("person_key"), person).where("person_key IS NOT NULL").dropDuplicates(["person_key"])
    found = named.join(known, "person_key").groupBy("line_key").agg(F.map_from_entries(F.collect_list(F.struct("person_key", "person"))).alias("people"))  # at most as many as an event names
    nobody = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<user_id:bigint,username:string,name:string>>"))
    return events.join(found, "line_key", "left").withColumn("people", F.coalesce("people", nobody)).drop("line_key")


def masked_events(lines: DataFrame, directory: DataFrame, whitelist: DataFrame, ranges: DataFrame, seed: int) -> DataFrame:
    """The columns of the lines but ``value``, with date and the masked line, of the events that may be released.

    lines: value and any other columns, such as course. directory: user_id, username, name. whitelist: event_source, event_type of explicit
    events. ranges: lo, hi, country_code, country_name of addresses. Names outside the directory are redacted, ids permuted by the seed; an id
    that is no number becomes null. A payload that came as text leaves as text; one that can't be read stays, as does an empty one.
    """
    beside = [c for c in lines.columns if c != "value"]
    kept = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in beside]).alias("beside")
    events = parse_lines(lines.select("value", kept).withColumn("line", F.trim("value")), "value", ("beside", "line"))
    events = once(X.releasable(events, whitelist).withColumn("payload", X.payload()))
    events = once(with_people(events, directory))
    persons = F.map_values("people")
    get = lambda field: F.array_distinct(F.filter(F.transform(persons, lambda p: p[field]), lambda x: F.coalesce(x != "", F.lit(False))))
    address = X.field("ip")
    events = events.withColumns({
        "usernames": get("username"), "names": get("name"), "user_ids": F.array_distinct(F.concat(F.transform(persons, lambda p: p["user_id"]), "ids")),
        "_address": F.when(F.coalesce(address != "", F.lit(False)) & ~address.contains(":"), address),
    })
    events = locate(events, ranges, "_address").drop("country_name")

    def named(value: Column) -> Column:
        said = F.nullif(F.trim(F.try_variant_get(value, "$", "string")), F.lit(""))
        found = lambda name: F.try_element_at(F.col("masked"), F.concat(F.lit("n:"), name))
        return bound(said, lambda name: F.when(name.isNull(), value).otherwise(variant(F.coalesce(found(name), F.lit(REDACTED)))))

    def remapped(value: Column) -> Column:
        said = F.struct(F.trim(F.try_variant_get(value, "$", "string")).alias("text"), F.trim(F.try_variant_get(value, "$", "string")).try_cast("long").alias("number"))
        return bound(said, lambda x: F.when(x["text"] == "", value).otherwise(variant(remap_id(x["number"], seed))))

    drop = dict.fromkeys
    body_rules = drop(PAYLOAD) | {k: {"file_upload_key": None} for k in UPLOADS} | dict.fromkeys(NAMES, named) | {"user_id": remapped}
    masked = F.transform_values("people", lambda _, p: masked_username(p["user_id"], seed))
    events = once(events.withColumns({"masked": masked, "patterns": M.known_patterns(F.col("usernames"), F.col("user_ids"), F.col("names"))}).drop("people", "usernames", "user_ids", "names", "ids"))
    filled = F.col("payload").isNotNull() & (F.to_json("payload") != "{}")  # an object, or null
    events = once(events.withColumn("body", F.when(filled, F.to_json(rewrite(F.col("payload"), body_rules)))))
    events = once(events.withColumn("body", F.when(F.col("body").isNotNull(), M.mask_leaves(F.col("body"), lambda text: M.mask_known(text, F.col("patterns"))))))
    was_text = ~X.is_object(F.col("event"), "$.event")
    new_body = lambda old: F.when(F.col("body").isNull(), old).when(was_text, variant(F.col("body"))).otherwise(F.try_parse_json("body"))
    rules = drop(ENVELOPE) | {"username": named, "event": new_body, "context": drop(CONTEXT) | {"client": drop(CLIENT), "user_id": remapped, "username": named}}
    # An event with an address says its country in its place; others keep what they had.
    tree = F.try_variant_get(rewrite(F.col("event"), rules), "$", "map<string,variant>")
    country = F.create_map(F.lit("augmented"), F.to_variant_object(F.struct("country_code")))
    tree = F.when(F.col("_address").isNotNull(), F.map_concat(F.map_filter(tree, lambda k, _: k != "augmented"), country)).otherwise(tree)
    return events.select(*[F.col(f"beside.`{c}`").alias(c) for c in beside], datestamp(X.field("time")).alias("date"), F.to_json(F.to_variant_object(tree)).alias("line"))


def mask_course_tables(tables: dict[str, DataFrame], directory: DataFrame, seed: int, allowed: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """All tables of a course's data by name, masked by the rules of each; ``allowed`` names what a course structure keeps.

    A name that no rule knows is an error, so that nothing leaves unmasked.
    """
    own = {
        "auth_user": lambda df: M.mask_user_table(df, seed), "courseware_studentmodule": lambda df: M.mask_student_module(df, directory, seed), "wiki_articlerevision": lambda df: M.mask_wiki_revision(df, directory, seed),
        "forum_posts": lambda df: M.mask_forum_posts(df, directory, seed), "course_structure": lambda df: M.mask_course_structure(df, allowed or {}),
    }
    unknown = sorted(set(tables) - set(own) - set(M.ID_COLUMNS))
    if unknown:
        raise ValueError(f"no rules to mask {', '.join(unknown)}")
    return {name: own[name](df) if name in own else M.mask_table(df, name, seed) for name, df in tables.items()}
