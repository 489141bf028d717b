"""Records with a declared schema: rows checked against it, and trees without a schema flattened into it.

A schema is a list of fields. It compiles to one pass of column expressions that yields the clean record and what is
wrong with it, field by field, so that good rows and violations come from the same scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import backslash_encode, once

SQL_TYPES = {"string": "string", "integer": "int", "boolean": "boolean", "float": "double", "date": "date", "timestamp": "timestamp"}
#: Times before this year are refused, as their texts can't be written alike everywhere.
FIRST_YEAR = 1900
VIOLATIONS = "array<struct<field:string,rule:string,value:string>>"


@dataclass(frozen=True)
class Field:
    """A field of a record: its kind, whether it may be null, how long its text may be, and whether longer texts are cut
    and runs of white space become one space. ``path`` says where a tree has it, from ``root`` on."""

    name: str
    kind: str = "string"
    nullable: bool = True
    length: int | None = None
    truncate: bool = False
    squeeze: bool = False
    path: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in SQL_TYPES:
            raise ValueError(f"{self.name}: no kind of field is named {self.kind}")
        if self.length == 0 or self.truncate and self.length is None:
            raise ValueError(f"{self.name}: a length must be greater than 0")


def _typed(value: Column, given: str, field: Field) -> Column:
    """The value as the field's type; null where it is none."""
    if given == SQL_TYPES[field.kind] or field.kind == "string":
        return value if given == "string" or field.kind != "string" else F.lit(None).cast("string")
    if given == "string":
        if field.kind == "boolean":
            return F.when(value.isNotNull(), value == "1")
        if field.kind == "date":
            return F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), value.try_cast("date"))
        if field.kind == "timestamp":
            parts = F.regexp_extract_all(value, F.lit(r"(\d+)"))
            part = lambda i, default="0": F.coalesce(F.get(parts, F.lit(i)), F.lit(default))
            day = F.concat_ws("-", part(0), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0"))
            clock = F.concat_ws(":", *[F.lpad(part(i), 2, "0") for i in (3, 4, 5)])
            return F.when(F.size(parts).between(3, 7), F.concat(day, F.lit(" "), clock, F.lit("."), F.lpad(part(6), 6, "0")).try_cast("timestamp"))
        return value.try_cast(SQL_TYPES[field.kind])
    number = {"tinyint", "smallint", "int", "bigint"}
    if field.kind == "integer" and given in number or field.kind == "float" and (given in number | {"float", "double"} or given.startswith("decimal")):
        return value.try_cast(SQL_TYPES[field.kind])
    return F.lit(None).cast(SQL_TYPES[field.kind])


def _broken(field: Field, value: Column, typed: Column, given: str) -> list[Column]:
    """A rule's name where the value breaks it, one column for each rule."""
    rules = [F.when(value.isNotNull() & typed.isNull(), "type")]
    if not field.nullable:
        rules.append(F.when(value.isNull(), "null"))
    if field.kind == "string" and field.length and not field.truncate and given == "string":
        rules.append(F.when(F.char_length(value) > field.length, "length"))
    if field.kind == "timestamp":
        rules.append(F.when(F.year(typed) < FIRST_YEAR, "range"))
    return rules


def _shown(field: Field, typed: Column) -> Column:
    if field.kind != "string":
        return typed
    if field.truncate:
        typed = F.substring(typed, 1, field.length)
    return F.regexp_replace(typed, r"\s+", " ") if field.squeeze else typed


def enforce_schema(df: DataFrame, schema: list[Field], keep: tuple[str, ...] = (), sparse: bool = False, squeeze: bool = False) -> DataFrame:
    """The kept columns, ``record`` (a struct of the schema's fields) and ``violations`` (field, rule, value).

    Rules: null, type, length, and range of times. Texts of other kinds are read as such. Columns that the schema lacks
    are an error, as are fields without a column, which are null in sparse records.
    """
    given, names = dict(df.dtypes), [f.name for f in schema]
    unknown = sorted(set(given) - set(names) - set(keep))
    missing = [n for n in names if n not in given]
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    if missing and not sparse:
        raise ValueError(f"required fields are missing: {', '.join(missing)}")
    record, broken = [], []
    for f in schema:
        value, kind = (F.col(f"`{f.name}`"), given[f.name]) if f.name in given else (F.lit(None).cast("string"), "string")
        typed = _typed(value, kind, f)
        field = Field(**{**f.__dict__, "squeeze": f.squeeze or squeeze})
        record.append(_shown(field, typed).cast(SQL_TYPES[f.kind]).alias(f.name))
        broken += [F.when(rule.isNotNull(), F.struct(F.lit(f.name).alias("field"), rule.alias("rule"), value.cast("string").alias("value"))) for rule in _broken(f, value, typed, kind)]
    return df.select(*[F.col(f"`{c}`") for c in keep], F.struct(*record).alias("record"), F.array_compact(F.array(*broken)).cast(VIOLATIONS).alias("violations"))


def clean_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0).select("record.*")


def violations(checked: DataFrame, *keep: str) -> DataFrame:
    return checked.select(*keep, F.explode("violations").alias("v")).select(*keep, "v.*")


def strict_rows(checked: DataFrame) -> DataFrame:
    """The records; the first row that breaks a rule ends the job with its name."""
    v = F.get("violations", F.lit(0))
    said = F.concat(F.lit("Unable to assign the value "), F.coalesce(v["value"], F.lit("null")), F.lit(" to the field "), v["field"], F.lit(": "), v["rule"])
    good = F.when(F.size("violations") > 0, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))
    return checked.where(good).select("record.*")


def _member(members: Column, name: str) -> Column:
    """The value of an object's key, whatever the case of its letters. members: the object's entries."""
    return F.try_element_at(F.filter(members, lambda e: F.lower(e["key"]) == name), F.lit(-1))["value"]


def _leaves(df: DataFrame, tree: str, paths: list[list[str]]) -> tuple[DataFrame, dict[tuple[str, ...], str]]:
    """The rows with a column for the value at each path (keys in small letters), and the columns' names.

    Trees are opened level by level: each object on a path is read into its entries once, whatever number of paths lead through it.
    """
    names, prefix = {(): tree}, "_tree"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    for depth in range(max(map(len, paths), default=0)):
        wanted = sorted({tuple(p[: depth + 1]) for p in paths if len(p) > depth})
        opened = {p: f"{prefix}{depth}_{i}" for i, p in enumerate(sorted({p[:-1] for p in wanted}))}
        df = once(df.select("*", *[F.map_entries(F.try_variant_get(F.col(f"`{names[p]}`"), "$", "map<string,variant>")).alias(c) for p, c in opened.items()]))
        found = {p: f"{prefix}{depth}_{i}_value" for i, p in enumerate(wanted)}
        df = once(df.select(*[F.col(f"`{c}`") for c in df.columns if c not in opened.values()], *[_member(F.col(opened[p[:-1]]), p[-1]).alias(c) for p, c in found.items()]))
        names |= found
    return df, names


def _flat(field: Field, leaf: Column, kind: Column, text: Column) -> tuple[Column, Column]:
    """The leaf, of a kind and with a text, as the field's type, and whether it can't be read as such."""
    single = leaf.isNotNull() & ~kind.startswith("OBJECT") & ~kind.startswith("ARRAY") & (kind != "VOID")
    truth = kind == "BOOLEAN"
    if field.kind == "string":
        said = F.replace(backslash_encode(F.when(truth, F.initcap(text)).otherwise(text)), F.lit("\0"), F.lit("\\0"))
        if field.length:
            said = F.when(F.char_length(said) > field.length, F.concat(F.substring(said, 1, field.length - 4), F.lit("..."))).otherwise(said)
        return F.when(single, said), F.lit(False)
    if field.kind == "boolean":  # what is empty or zero is false
        value = F.when(truth, text == "true").when(kind == "STRING", text != "").otherwise(text.try_cast("double") != 0)
    elif field.kind in ("integer", "float"):
        number = F.when(truth, (text == "true").cast("int").cast("string")).otherwise(F.trim(text))
        value = number.try_cast("double")
        if field.kind == "integer":  # numbers lose their fraction, texts must have none
            value = F.when((kind != "STRING") | number.rlike(r"^[+-]?\d+\z"), number.try_cast("decimal(38,6)").try_cast("int"))
    elif field.kind == "timestamp":  # with its zone: a time without one could be any
        zoned = text.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:?\d\d)\z")
        value = F.when(zoned, F.regexp_replace(text, r"([+-]\d\d)(\d\d)\z", "$1:$2").try_cast("timestamp"))
        value = F.when(F.year(value) >= FIRST_YEAR, value)
    else:
        value = text.try_cast(SQL_TYPES[field.kind])
    value = F.when(single, value.cast(SQL_TYPES[field.kind]))
    return value, single & value.isNull()


def flatten_by_mapping(df: DataFrame, tree: str, schema: list[Field], keep: tuple[str, ...] = (), calculated: dict[str, Column] | None = None) -> DataFrame:
    """The kept columns, ``record`` and ``rejected`` (field, path, value) of the trees (VARIANT) in a column.

    Each field takes the single value at its path; keys are found whatever their case, and objects, lists and nulls
    give none. Texts are escaped, and longer ones cut and marked. A value that the field's type can't hold is rejected:
    the field is null, and the value stands in ``rejected``. calculated: further fields from columns, held to the same types.
    """
    fields, paths = {f.name: f for f in schema}, {}
    for f in schema:
        if f.path is not None:
            steps = f.path.lower().split(".")
            if steps[0] != "root" or len(steps) < 2:
                raise ValueError(f"{f.name}: a path goes from root to a key")
            paths[f.name] = steps[1:]
    calculated = calculated or {}
    given = [F.try_variant_get(F.to_variant_object(F.struct(c.alias("x"))), "$.x", "variant").alias(f"_given_{name}") for name, c in calculated.items()]
    df, at = _leaves(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, tree])], *given), tree, list(paths.values()))
    leaves = [(fields[n], fields[n].path, F.col(at[tuple(p)])) for n, p in paths.items()] + [(fields[n], n, F.col(f"`_given_{n}`")) for n in calculated]
    kept = [F.col(f"`{c}`") for c in keep]
    read = once(df.select(*kept, *[F.struct(leaf.alias("leaf"), F.schema_of_variant(leaf).alias("kind"), F.try_variant_get(leaf, "$", "string").alias("text")).alias(f"_leaf{i}") for i, (_, _, leaf) in enumerate(leaves)]))
    typed = []
    for i, (f, _, _) in enumerate(leaves):
        value, bad = _flat(f, *[F.col(f"_leaf{i}.{c}") for c in ("leaf", "kind", "text")])
        typed.append(F.struct(value.alias("value"), bad.alias("bad"), F.col(f"_leaf{i}.leaf").alias("leaf")).alias(f"_typed{i}"))
    flat = once(read.select(*kept, *typed))
    record = [F.col(f"_typed{i}.value").alias(f.name) for i, (f, _, _) in enumerate(leaves)]
    rejected = [F.when(F.col(f"_typed{i}.bad"), F.struct(F.lit(f.name).alias("field"), F.lit(path).alias("path"), F.to_json(F.col(f"_typed{i}.leaf")).alias("value"))) for i, (f, path, _) in enumerate(leaves)]
    return flat.select(*kept, F.struct(*record).alias("record"), F.array_compact(F.array(*rejected)).alias("rejected"))


def rejected_values(flat: DataFrame, *keep: str) -> DataFrame:
    return flat.select(*keep, F.explode("rejected").alias("r")).select(*keep, "r.*")


def prune_columns(df: DataFrame, table: str, patterns: list[str]) -> DataFrame:
    """The table without the columns whose ``table.column`` a pattern fits from its beginning."""
    import re

    return df.select(*[F.col(f"`{c}`") for c in df.columns if not any(re.match(p, f"{table}.{c}") for p in patterns)])


def keep_tables(names: list[str], include: list[str], exclude: list[str]) -> list[str]:
    """Names that a pattern of include fits from its beginning; without any, those that no pattern of exclude fits."""
    import re

    fits = lambda name, patterns: any(re.match(p, name) for p in patterns)
    return [n for n in names if (fits(n, include) if include else not fits(n, exclude))]
