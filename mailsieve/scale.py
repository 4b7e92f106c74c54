"""Skew-safe building blocks.

A plain window over a hot key sends every row of that key to one task.  The helpers below split
each key into ordered buckets (a deterministic, monotone function of the ordering column), do the
row-level work per (key, bucket), and combine through a per-bucket summary table whose size is the
number of buckets, not the number of rows.  Bucket functions are pure expressions, so re-computed
tasks always agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "__bucket"


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; right-hand key copies are dropped."""
    if not keys:
        return left.crossJoin(right)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def value_bucket(value: Column, per_unit: int = 128) -> Column:
    """Monotone logarithmic bucket of a number (under 1 % wide away from zero, a few thousand in all)."""
    return F.floor(F.asinh(value.cast("double")) * per_unit)


def time_bucket(ts: Column, unit: str = "hour") -> Column:
    return F.date_trunc(unit, ts)


def range_bucket(value: Column, width: int) -> Column:
    return F.floor(value / F.lit(width))


def value_cells(
    df: DataFrame, keys: Sequence[str], value: str, bucket: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sorted-order skeleton of a value column per key.

    Cells hold the distinct values of a bucket with their counts (equal values collapse before the
    shuffle); the histogram holds, per bucket, its ranks ``[__start, __stop)``, the group size and the sum
    of all values below it.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    b = value_bucket(v) if bucket is None else bucket
    cells = df.where(v.isNotNull()).groupBy(*keys, b.alias(_B), v.alias("__v")).agg(F.count("*").alias("__c"))
    hist = cells.groupBy(*keys, _B).agg(F.sum("__c").alias("__n"), F.sum(F.col("__c") * F.col("__v")).alias("__s"))
    ordered = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    n, s = F.sum("__n"), F.sum("__s")
    hist = hist.select(
        *keys, _B, (n.over(ordered) - F.col("__n")).alias("__start"), n.over(ordered).alias("__stop"),
        n.over(whole).alias("__tot"), (s.over(ordered) - F.col("__s")).alias("__below"), s.over(whole).alias("__sum"),
    )
    return cells, hist


def ranked_cells(cells: DataFrame, hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of the given buckets with the ranks ``[__lo, __hi)`` each value covers."""
    picked = join_null_safe(cells, hist, [*keys, _B])
    inner = Window.partitionBy(*keys, _B).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    picked = picked.withColumn("__hi", F.col("__start") + F.sum("__c").over(inner))
    return picked.withColumn("__lo", F.col("__hi") - F.col("__c"))


def _holds(rank: Column, lo: str, hi: str) -> Column:
    return (rank >= F.col(lo)) & (rank < F.col(hi))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], bucket: Column | None = None,
    halves: bool = False,
) -> DataFrame:
    """Exact linearly interpolated quantiles per key, without gathering a key in one task.

    A histogram per key locates the two ranks each quantile needs, and only the buckets that hold such a
    rank are ordered.  ``halves`` adds the means of the lower and upper half of the sorted values.
    """
    keys = list(keys)
    cells, hist = value_cells(df, keys, value, bucket)
    pos = {name: F.lit(float(p)) * (F.col("__tot") - 1) for name, p in probs.items()}
    half = F.floor(F.col("__tot") / 2)
    ranks = [f(pos[n]) for n in pos for f in (F.floor, F.ceil)] + ([half] if halves else [])
    picked = ranked_cells(
        cells, hist.where(reduce(lambda x, y: x | y, [_holds(r, "__start", "__stop") for r in ranks])), keys
    )
    aggs = [F.max("__tot").alias("__tot")]
    for n in pos:
        for tag, f in (("l", F.floor), ("h", F.ceil)):
            aggs.append(F.max(F.when(_holds(f(pos[n]), "__lo", "__hi"), F.col("__v"))).alias(f"__{n}_{tag}"))
    if halves:
        split = _holds(half, "__start", "__stop")
        taken = F.greatest(F.least(F.col("__c"), half - F.col("__lo")), F.lit(0))
        aggs += [
            F.max(F.when(split, F.col("__below"))).alias("__below"), F.max("__sum").alias("__sum"),
            F.sum(F.when(split, taken * F.col("__v")).otherwise(0.0)).alias("__part"),
        ]
    out = picked.groupBy(*keys).agg(*aggs)
    cols = [
        (F.col(f"__{n}_l") + (F.col(f"__{n}_h") - F.col(f"__{n}_l")) * (pos[n] - F.floor(pos[n]))).alias(n) for n in pos
    ]
    if halves:
        low = F.col("__below") + F.col("__part")
        cols += [
            F.when(half > 0, F.try_divide(low, half)).otherwise(F.col("__sum") / F.col("__tot")).alias("lower_mean"),
            ((F.col("__sum") - low) / (F.col("__tot") - half)).alias("upper_mean"),
        ]
    return out.select(*keys, *cols)


#: Buckets whose totals one window adds up.
FAN = 1024


def _sums_before(totals: DataFrame, keys: list[str], levels: int) -> DataFrame:
    """(keys, bucket, __o): total of all earlier buckets of the key, through a tree of FAN buckets a node."""
    place = F.col(_B)
    if totals.schema[_B].dataType.typeName() in ("timestamp", "timestamp_ntz", "date"):
        place = F.floor(F.unix_seconds(place.cast("timestamp")) / 3600)
    up = totals.withColumn("__up", F.floor(place / FAN))
    own = Window.partitionBy(*keys, "__up").orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    inner = up.withColumn("__in", F.coalesce(F.sum("__t").over(own), F.lit(0)))
    above = up.groupBy(*keys, F.col("__up").alias(_B)).agg(F.sum("__t").alias("__t"))
    if levels:
        outer = _sums_before(above, keys, levels - 1)
    else:
        last = Window.partitionBy(*keys, F.lit(0)).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
        outer = above.select(*keys, _B, F.coalesce(F.sum("__t").over(last), F.lit(0)).alias("__o"))
    outer = outer.withColumnRenamed(_B, "__up")
    return join_null_safe(inner, outer, [*keys, "__up"]).select(*keys, _B, (F.col("__o") + F.col("__in")).alias("__o"))


def cumulative_sum(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], value: Column, out: str, levels: int = 1,
) -> DataFrame:
    """Running sum within each key, split over buckets; ``bucket`` is a number or a
    time and monotone in ``order``.

    Bucket totals are added up through a tree: a node has FAN children, so with ``levels`` inner levels the top
    window sees one row for FAN ** (levels + 1) buckets.
    """
    keys = list(keys)
    d = df.withColumn(_B, bucket).withColumn("__x", value)
    totals = d.groupBy(*keys, _B).agg(F.sum("__x").alias("__t"))
    offsets = _sums_before(totals, keys, levels)
    inner = Window.partitionBy(*keys, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__in", F.sum("__x").over(inner))
    return join_null_safe(d, offsets, [*keys, _B]).withColumn(out, F.col("__o") + F.col("__in")).drop(
        _B, "__x", "__in", "__o"
    )


def number_rows(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], out: str) -> DataFrame:
    """1-based dense position within each key (or over the whole table when ``keys`` is empty)."""
    return cumulative_sum(df, keys, bucket, order, F.lit(1).cast("long"), out)


def previous_row(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], cols: Mapping[str, str]
) -> DataFrame:
    """``lag`` of several columns within each key, carrying the last row of the previous bucket over."""
    keys = list(keys)
    packed = F.struct(*[F.col(c).alias(o) for o, c in cols.items()])
    d = df.withColumn(_B, bucket)
    last = d.groupBy(*keys, _B).agg(F.max_by(packed, F.struct(*order)).alias("__last"))
    carry = last.select(
        *keys, _B, F.lag("__last").over(Window.partitionBy(*keys).orderBy(_B)).alias("__carry")
    )
    w = Window.partitionBy(*keys, _B).orderBy(*order)
    d = d.withColumn("__rn", F.row_number().over(w)).withColumn("__lag", F.lag(packed).over(w))
    d = join_null_safe(d, carry, [*keys, _B])
    d = d.withColumn("__p", F.when(F.col("__rn") == 1, F.col("__carry")).otherwise(F.col("__lag")))
    for o in cols:
        d = d.withColumn(o, F.col(f"__p.{o}"))
    return d.drop(_B, "__rn", "__lag", "__carry", "__p")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key.  Spark limits each map task to ``k`` rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def with_totals(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Group aggregates joined back to the rows: partial aggregation plus a join AQE can split, where a
    whole-partition window would hold a hot key in one task."""
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return join_null_safe(df, totals, list(keys))


def ordered_fold(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], start: Callable[[], Callable], schema
) -> DataFrame:
    """Order-dependent pass over each key with constant memory.

    Rows arrive sorted; ``start()`` returns a fresh step function per key, called with consecutive slices
    of that key's rows (a slice never spans keys, a key may span slices), returning output rows.  A hot
    key is streamed, never collected.  Pass only the columns the step needs.
    """
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, step = None, None
        for batch in batches:
            if not len(batch):
                continue
            change = (batch[keys] != batch[keys].shift()).any(axis=1).cumsum()
            for _, part in batch.groupby(change, sort=False):
                key = tuple(part[keys].iloc[0])
                if key != current:
                    current, step = key, start()
                out = step(part)
                if out is not None and len(out):
                    yield out

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)
