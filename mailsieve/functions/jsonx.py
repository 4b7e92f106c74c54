"""JSON handling: tolerant parsing, redaction, compaction, repair, retrieval responses."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve.functions.text import blank, strip

# fixed values: keys whose values never leave
SECRET_KEYS = (
    "access_token", "authorization", "api_key", "apiKey", "bearer", "token", "id_token", "refresh_token",
    "client_secret", "private_key",
)
CONTEXT_KEYS = ("text", "chunkText", "chunkId", "sourceUri")
ANY_MAP, ANY_LIST = "map<string,variant>", "array<variant>"


def model_json_text(c: Column) -> Column:
    """The JSON object inside a model reply: code fences and leading prose go, ``=>`` hashes are refused."""
    body = F.regexp_replace(blank(c), r"(?is)```(json)?", "")
    found = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    return F.when((found != "") & ~found.contains("=>"), found)


def parse_model_json(c: Column, schema: T.StructType) -> Column:
    """Struct (value, error): the declared fields of a reply.

    The reply is parsed once; an object inside wrappers is taken out.  ``invalid_json`` is no JSON object at all,
    ``no_known_field`` one without any declared field; both have no value.
    """
    parsed = F.try_parse_json(model_json_text(c))
    inner = _unwrapped(parsed, schema.names)
    typed = F.transform(F.array(inner), lambda v: F.when(_known(v, schema.names), F.struct(*[
        _typed(v, f).alias(f.name) for f in schema.fields])))
    value = F.get(typed, F.lit(0))
    error = F.when(parsed.isNull(), "invalid_json").when(value.isNull(), "no_known_field")
    return F.struct(value.alias("value"), error.alias("error"))


# fixed values: objects around a reply
WRAPPERS = ("data", "result", "results", "items", "categories")


def _known(v: Column, names: Sequence[str]) -> Column:
    """Whether an object has any of the fields."""
    return F.exists(F.array(*[F.try_variant_get(v, f"$.{n}", "variant") for n in names]), lambda x: x.isNotNull())


def _unwrapped(v: Column, names: Sequence[str], depth: int = 3) -> Column:
    """The object inside up to ``depth`` wrappers that has any of the fields; ``v`` is named once a level."""

    def inner(x: Column) -> Column:
        parts = [F.when(F.try_variant_get(x, f"$.{w}", ANY_MAP).isNotNull(), F.try_variant_get(x, f"$.{w}", "variant"))
                 for w in WRAPPERS]
        return F.when(_known(x, names), x).otherwise(F.coalesce(*parts, x))

    for _ in range(depth):
        v = F.get(F.transform(F.array(v), inner), F.lit(0))
    return v


def _typed(v: Column, field: T.StructField) -> Column:
    """A field in its declared type; one value where a list is declared becomes a list of it."""
    path, kind = f"$.{field.name}", field.dataType.simpleString()
    if not isinstance(field.dataType, T.ArrayType):
        return F.try_variant_get(v, path, kind)
    one = F.try_variant_get(v, path, field.dataType.elementType.simpleString())
    return F.coalesce(F.try_variant_get(v, path, kind), F.when(one.isNotNull(), F.array(one)))


def redact_json(c: Column) -> Column:
    """Top-level secrets become a marker; text that is no object stays as it is."""
    top = F.try_variant_get(F.try_parse_json(c), "$", ANY_MAP)
    hidden = F.parse_json(F.lit('"[REDACTED]"'))
    cleaned = F.transform_values(top, lambda k, v: F.when(k.isin(list(SECRET_KEYS)), hidden).otherwise(v))
    return F.when(top.isNull(), c).otherwise(F.to_json(cleaned))


def _compact(o):
    if isinstance(o, dict):
        kept = {k: _compact(v) for k, v in o.items() if v is not None}
        return {k: v for k, v in kept.items() if v not in ("", [], {})}
    if isinstance(o, list):
        return [v for v in (_compact(x) for x in o) if v not in ("", [], {})]
    return o


def _compact_text(t):
    try:
        return json.dumps(_compact(json.loads(t)), separators=(",", ":"), ensure_ascii=False)
    except (TypeError, ValueError):
        return t


def json_compact(c: Column) -> Column:
    """Open JSON without nulls and empty strings, lists and objects; false and 0 stay."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(_compact_text)

    return F.pandas_udf(run, T.StringType())(c)


def dig(c: Column, path: str) -> Column:
    return F.get_json_object(c, "$." + path)


def coerce(c: Column, kind: str) -> Column:
    s = strip(c.cast("string"))
    if kind == "integer":
        return s.try_cast("double").cast("long")
    if kind == "float":
        return s.try_cast("double")
    if kind == "boolean":
        return F.lower(s).isin("true", "1", "yes", "on")
    if kind == "date":
        return F.date_format(s.try_cast("date"), "yyyy-MM-dd")
    if kind == "date_time":
        return F.date_format(s.try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if kind == "json":
        return F.try_parse_json(s)
    return c.cast("string")


def repair(value: Column, spec: Mapping[str, Mapping]) -> Column:
    """Struct with every declared field made valid.

    ``spec`` maps a field to its rules: ``enum`` (the first is the default), ``minimum``/``maximum``,
    ``max_items``; a null record becomes the fallback record.
    """
    out = []
    for name, rule in spec.items():
        f = value[name]
        if "enum" in rule:
            f = F.when(f.isin(list(rule["enum"])), f).otherwise(rule["enum"][0])
        if "minimum" in rule:
            f = F.greatest(F.coalesce(f, F.lit(float(rule.get("default", 0.0)))), F.lit(float(rule["minimum"])))
        if "maximum" in rule:
            f = F.least(f, F.lit(float(rule["maximum"])))
        if "max_items" in rule:
            f = F.slice(F.coalesce(f, F.array().cast("array<string>")), 1, rule["max_items"])
        if rule.get("type") == "string" and "enum" not in rule:
            f = blank(f)
        out.append(f.alias(name))
    return F.struct(*out, value.isNull().alias("is_fallback"))


def repair_errors(value: Column, spec: Mapping[str, Mapping]) -> Column:
    issues = []
    for name, rule in spec.items():
        issues.append(F.when(value[name].isNull(), f"Missing required field: {name}"))
        if "enum" in rule:
            issues.append(F.when(~value[name].isin(list(rule["enum"])), f"Invalid enum value for {name}, using default"))
    return F.array_compact(F.array(*issues))


# --- retrieval responses ----------------------------------------------------------------------


def _is_context_list(items: Column) -> Column:
    first = F.try_element_at(items, F.lit(1))
    named = F.lit(False)
    for k in CONTEXT_KEYS:
        named = named | F.try_variant_get(first, f"$.{k}", "string").isNotNull()
    return (F.size(items) > 0) & named


def context_items(c: Column, depth: int = 3) -> Column:
    """Contexts of a response: the standard places first, then any nested list of contexts, shallowest first."""
    v = F.try_parse_json(c)
    found = [F.try_variant_get(v, "$.contexts.contexts", ANY_LIST), F.try_variant_get(v, "$.contexts", ANY_LIST)]
    level = F.array(v)
    for _ in range(depth):
        lists = F.transform(level, lambda x: F.try_variant_get(x, "$.contexts", ANY_LIST))
        found.append(F.try_element_at(F.filter(lists, lambda l: l.isNotNull() & _is_context_list(l)), F.lit(1)))
        level = F.flatten(
            F.transform(
                level,
                lambda x: F.coalesce(
                    F.map_values(F.try_variant_get(x, "$", ANY_MAP)), F.try_variant_get(x, "$", ANY_LIST),
                    F.array().cast(ANY_LIST),
                ),
            )
        )
    return F.coalesce(*found, F.array().cast(ANY_LIST))


def context_fields(item: Column, pos: Column) -> Column:
    """Context struct from any of the accepted field spellings; ids default to their position."""

    def pick(kind: str, *names: str) -> Column:
        return F.coalesce(*[F.try_variant_get(item, f"$.{n}", kind) for n in names])

    return F.struct(
        F.coalesce(pick("string", "chunkId", "id"), F.concat(F.lit("ctx-"), (pos + 1).cast("string"))).alias("id"),
        blank(pick("string", "chunkText", "text", "content")).alias("text"),
        pick("double", "score", "relevanceScore", "similarity").alias("score"),
        pick("string", "source", "sourceDisplayName", "displayName").alias("source"),
        pick("string", "sourceUri", "uri", "url").alias("uri"),
    )


def parse_contexts(df, json_col: str, key: str, limit: int | None = None):
    """One row per context of each reply; ``limit`` keeps the first ones only."""
    items = context_items(F.col(json_col))
    items = items if limit is None else F.slice(items, 1, limit)
    d = df.select(key, F.posexplode(items).alias("pos", "item"))
    return d.select(key, "pos", context_fields(F.col("item"), F.col("pos")).alias("c")).select(key, "pos", "c.*")


# --- errors and contracts ---------------------------------------------------------------------

ERROR_DDL = (
    "struct<error:struct<code:bigint,message:string,details:array<struct<`@type`:string,"
    "fieldViolations:array<struct<field:string,description:string>>>>>,message:string>"
)


def extract_error(c: Column) -> Column:
    """Struct (code, message, violations) of a service error body or of plain error text."""
    j = F.from_json(c, ERROR_DDL)
    flat = F.flatten(F.transform(j["error"]["details"], lambda d: F.coalesce(
        d["fieldViolations"], F.array().cast("array<struct<field:string,description:string>>"))))
    listed = F.transform(flat, lambda v: F.concat_ws(": ", v["field"], v["description"]))
    in_text = F.regexp_extract(c, r"\b(\d{3})\b", 1).try_cast("long")
    return F.struct(
        F.coalesce(j["error"]["code"], in_text).alias("code"),
        F.coalesce(j["error"]["message"], j["message"]).alias("message"),
        F.coalesce(listed, F.array().cast("array<string>")).alias("violations"),
    )


_KINDS = {
    "string": (T.StringType,), "integer": (T.LongType, T.IntegerType, T.ShortType),
    "float": (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.DecimalType),
    "array": (T.ArrayType,), "object": (T.StructType, T.MapType),
}
_ARTICLE = {"string": "a string", "integer": "an integer", "float": "a float", "object": "a hash/object", "array": "an array"}


def contract_violations(schema: T.StructType, required: Sequence[str], types: Mapping[str, str]) -> Column:
    """Messages per row: absent columns and wrong types follow from the schema, nulls from the row."""
    parts: list[Column] = []
    for f in required:
        if f not in schema.names:
            parts.append(F.lit(f"missing {f}"))
    for f, kind in types.items():
        if f in schema.names:
            message = f"{f} must be {_ARTICLE[kind]}"
            fits = isinstance(schema[f].dataType, _KINDS[kind])
            parts.append(F.when(F.col(f).isNull(), message) if fits else F.lit(message))
    return F.array_compact(F.array(*parts).cast("array<string>"))


def validate_contract(df, contract: str, out: str = "violations"):
    from mailsieve.schemas import CONTRACTS

    if contract not in CONTRACTS:
        raise ValueError(f"unknown contract {contract}")
    return df.withColumn(out, contract_violations(df.schema, *CONTRACTS[contract]))
