"""Joins by a key that may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key counts as hot if it holds over one of so many shares of the rows, so there are no more hot keys than that.
SHARES = 1024


def join_spread(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame | None = None) -> DataFrame:
    """``rows`` left-joined with ``table``, which has at most one row for each ``key``.

    Rows of a hot key stay in their tasks: at most SHARES rows of ``table`` are sent to them.  The other rows meet
    ``table`` by a shuffle in which no key holds more than one of SHARES shares; rows with a null key match nothing
    and are not shuffled.  ``counts`` (key, n) is counted from ``rows`` if not given.  ``rows`` is read
    several times, so it should be a written table or cheap.
    """
    if counts is None:
        counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where((F.col("n") > total / SHARES) & F.col(key).isNotNull()).select(key)
    known = F.broadcast(hot.join(table, key, "left"))
    rest = rows.join(F.broadcast(hot), key, "left_anti")
    more = [c for c in table.columns if c != key]
    none = rest.where(F.col(key).isNull()).select(
        *rows.columns, *[F.lit(None).cast(table.schema[c].dataType).alias(c) for c in more])
    met = rest.where(F.col(key).isNotNull()).join(table, key, "left")
    return rows.join(known, key).unionByName(met).unionByName(none)
