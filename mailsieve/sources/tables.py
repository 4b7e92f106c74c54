"""Configuration and log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve.functions.text import strip
from mailsieve.schemas import LOG_ROW


def resolve_template(
    templates: DataFrame, selections: DataFrame, pick: str, value_field: str | None = None, record_id: str = "record_id",
) -> DataFrame:
    """Template per selection, by a value field (its first record wins) or by record id."""
    key = value_field or record_id
    rest = [c for c in templates.columns if c != key]
    firsts = templates.groupBy(F.col(key).alias("__key")).agg(F.min_by(F.struct(*rest), F.col(record_id)).alias("__t"))
    joined = selections.join(firsts, selections[pick] == firsts["__key"], "left")
    return joined.select(*selections.columns, F.col("__key").alias(key), *[F.col(f"__t.{c}").alias(c) for c in rest])


def template_options(templates: DataFrame, display: str = "display", active: str = "active") -> DataFrame:
    """Active templates ordered by display name, ignoring case."""
    return templates.where(F.col(active)).orderBy(F.lower(display))


def load_categories(spark: SparkSession, path: str) -> DataFrame:
    """Category file: an array, or an object holding it under categories, items, data or results.

    Items may be plain names.  Blank names are dropped; fewer than two categories is an error.
    """
    text = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    kind = "array<variant>"
    items = F.coalesce(
        F.try_variant_get("v", "$", kind),
        *[F.try_variant_get("v", f"$.{k}", kind) for k in ("categories", "items", "data", "results")],
    )
    one = text.select(F.posexplode(items).alias("pos", "c"))
    cats = one.select(
        "pos",
        F.coalesce(
            F.try_variant_get("c", "$.name", "string"),
            F.when(F.schema_of_variant("c") == "STRING", F.try_variant_get("c", "$", "string")),
        ).alias("name"),
        F.try_variant_get("c", "$.description", "string").alias("description"),
        F.coalesce(F.try_variant_get("c", "$.examples", "array<string>"), F.array().cast("array<string>")).alias("examples"),
    ).where(strip(F.coalesce("name", F.lit(""))) != "")
    if len(cats.limit(2).collect()) < 2:
        raise ValueError("at least two categories are needed")
    return cats


def load_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log export with its 23 typed columns; whole numbers may be written with a decimal point."""
    raw = spark.read.option("header", True).csv(path)
    cols = []
    for f in LOG_ROW.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.LongType, T.IntegerType)):
            c = c.try_cast("double").cast(f.dataType)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.try_to_timestamp(c)
        else:
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)
