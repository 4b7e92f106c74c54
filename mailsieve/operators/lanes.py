"""Set operations over result lanes and keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_lanes(**lanes: DataFrame) -> DataFrame:
    """Union by name, with the lane kept as a column."""
    tagged = [d.withColumn("lane", F.lit(name)) for name, d in lanes.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def set_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


ID_PATTERN = r"^[A-Za-z0-9_-]{8,}$"


def clean_ids(c: Column) -> Column:
    """Distinct non-blank trimmed ids in first-seen order."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def ids_valid(c: Column) -> Column:
    return F.forall(clean_ids(c), lambda x: x.rlike(ID_PATTERN))


def to_list(c: Column) -> Column:
    """Comma text to a distinct trimmed list."""
    return clean_ids(F.split(c, ","))
