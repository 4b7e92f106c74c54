"""Metric summaries, trends, anomalies, spikes and batch-size advice."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve import scale


def trend_label(first: Column, second: Column) -> Column:
    return F.when(second > first * 1.1, "increasing").when(second < first * 0.9, "decreasing").otherwise("stable")


def compute_metrics(
    df: DataFrame, by: Sequence[str], value: str = "value", ts: str = "ts", period: str | None = None,
    places: int = 2,
) -> DataFrame:
    """Mean, median, range, population deviation, P95/P99, count, trend and number of 2-sigma anomalies.

    ``period`` (minute, hour, day, week) adds the truncated time to the keys.  The trend compares the
    halves of the value-sorted list; ``trend(order='time')`` compares halves in time.
    """
    keys = list(by)
    d = df
    if period:
        d = d.withColumn("period", F.date_trunc(period, ts))
        keys.append("period")
    v = F.col(value)
    base = d.groupBy(*keys).agg(
        F.avg(v).alias("__avg"), F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_pop(v).alias("__std"),
        F.count(v).alias("total_count"),
    )
    q = scale.exact_quantiles(d, keys, value, {"__med": 0.5, "__p95": 0.95, "__p99": 0.99}, halves=True)
    odd = scale.join_null_safe(d.select(*keys, v.alias("__v")), base.select(*keys, "__avg", "__std"), keys)
    odd = odd.groupBy(*keys).agg(
        F.count_if(F.abs(F.col("__v") - F.col("__avg")) > 2 * F.col("__std")).alias("anomalies")
    )
    out = scale.join_null_safe(scale.join_null_safe(base, q, keys), odd, keys)
    return out.select(
        *keys, F.round("__avg", places).alias("average"), F.round("__med", places).alias("median"), "min", "max",
        F.round("__std", places).alias("std_deviation"), F.round("__p95", places).alias("percentile_95"),
        F.round("__p99", places).alias("percentile_99"), "total_count",
        trend_label(F.col("lower_mean"), F.col("upper_mean")).alias("trend"), "anomalies",
    )


def trend(df: DataFrame, by: Sequence[str], value: str = "value", order: str = "value", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """First-half and second-half means with their label, over value order or time order."""
    keys = list(by)
    if order == "value":
        halves = scale.exact_quantiles(df, keys, value, {"__med": 0.5}, halves=True)
        halves = halves.select(*keys, F.col("lower_mean").alias("first_half"), F.col("upper_mean").alias("second_half"))
    else:
        d = scale.number_rows(df, keys, scale.time_bucket(F.col(ts)), [ts, tie], "__pos")
        d = scale.with_totals(d, keys, __n=F.count("*"))
        early = F.col("__pos") <= F.floor(F.col("__n") / 2)
        halves = d.groupBy(*keys).agg(
            F.avg(F.when(early, F.col(value))).alias("first_half"), F.avg(F.when(~early, F.col(value))).alias("second_half")
        ).withColumn("first_half", F.coalesce("first_half", "second_half"))
    return halves.withColumn("trend", trend_label(F.col("first_half"), F.col("second_half")))


def anomalies(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Rows further than two population deviations from their group mean."""
    d = scale.with_totals(df, list(by), __avg=F.avg(value), __std=F.stddev_pop(value))
    return d.where(F.abs(F.col(value) - F.col("__avg")) > 2 * F.col("__std")).drop("__avg", "__std")


def spikes(df: DataFrame, by: str, ts: str = "ts", unit: str = "minute", alpha: float = 0.3, k: float = 3.0) -> DataFrame:
    """Counts per time unit against their exponentially weighted mean so far.

    Events collapse to counts before the shuffle; the fold streams one row per (key, unit).
    """
    counts = df.groupBy(by, F.date_trunc(unit, ts).alias("bucket")).agg(F.count("*").alias("n"))
    schema = T.StructType(counts.schema.fields + [T.StructField("ewma", T.DoubleType()), T.StructField("is_spike", T.BooleanType())])

    def start():
        last = [None]

        def step(part: pd.DataFrame) -> pd.DataFrame:
            means, flags = np.empty(len(part)), np.zeros(len(part), dtype=bool)
            for i, n in enumerate(part["n"].to_numpy(dtype=float)):
                before = last[0]
                flags[i] = before is not None and n > k * before
                last[0] = n if before is None else alpha * n + (1 - alpha) * before
                means[i] = last[0]
            return part.assign(ewma=means, is_spike=flags)

        return step

    return scale.ordered_fold(counts, [by], ["bucket"], start, schema)


def optimize_batch(history: DataFrame, total_items: int, target: str = "throughput", lo: int = 10, hi: int = 100, tie: str = "user_id") -> DataFrame:
    """Advice from (batch_size, processing_time, success_rate, memory_usage) rows: one row, also when empty."""
    size, time = F.col("batch_size").cast("double"), F.col("processing_time").cast("double")
    rate = size / F.greatest(time, F.lit(0.0001))
    score = {
        "throughput": rate,
        "latency": -(time / F.greatest(size, F.lit(1.0))),
        "cost": -(F.col("memory_usage") * 0.7 - rate * 0.3),
        "accuracy": F.col("success_rate") * 1000 + rate,
    }.get(target)
    if score is None:
        best = F.floor(F.sum("batch_size") / F.count("*"))
    else:
        best = F.max_by(F.col("batch_size"), F.struct(score, -F.col(tie)))
    d = history.agg(best.alias("__best"), F.avg("processing_time").alias("__time"), F.count("*").alias("__n"))
    known = F.col("__n") > 0
    raw = F.when(known, F.col("__best")).otherwise(F.lit(-(-total_items // 10)))
    d = d.withColumn("optimal_batch_size", F.greatest(F.least(raw.cast("long"), F.lit(hi)), F.lit(lo)))
    batches = F.ceil(F.lit(float(total_items)) / F.col("optimal_batch_size"))
    d = d.withColumn("estimated_batches", batches)
    est = F.when(known, F.col("__time") * F.col("estimated_batches")).otherwise(0.0)
    return d.select(
        F.lit(target).alias("target"), "optimal_batch_size", "estimated_batches",
        F.round(est, 2).alias("estimated_processing_time"),
        F.round(F.when(est > 0, F.try_divide(F.lit(float(total_items)), est)).otherwise(0.0), 2).alias("throughput_estimate"),
        F.when(known, 0.8).otherwise(0.5).alias("confidence_score"),
    )
