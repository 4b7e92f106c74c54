"""Schedule monitoring: missed and overlong runs, trend rollup, alert de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve import scale
from mailsieve.operators.jumps import fire_with_pause

GRACE_MINUTES = 15
DAY_MINUTES = 1440


def overdue_minutes(diff: Column) -> Column:
    """Differences below 1 are days, others minutes."""
    return F.when(diff < 1, diff * DAY_MINUTES).otherwise(diff)


def schedule_alerts(obs: DataFrame) -> DataFrame:
    late = overdue_minutes(F.col("now_diff"))
    return (
        obs.withColumn("overdue_min", F.round(late, 2))
        .withColumn("missed", F.col("critical_armed") & (late >= GRACE_MINUTES))
        .withColumn("extended", F.col("extended_armed") & (F.col("current_duration") > F.col("max_run_hours") * 60))
    )


def alert_rows(obs: DataFrame) -> DataFrame:
    """One row per raised alert with its notification type."""
    kinds = F.array_compact(
        F.array(F.when(F.col("missed"), "MissedScheduleNotification"), F.when(F.col("extended"), "ExtendedExecutionNotification"))
    )
    return schedule_alerts(obs).withColumn("alert", F.explode(kinds))


def schedule_trends(obs: DataFrame, ts: str = "ts") -> DataFrame:
    d = schedule_alerts(obs).withColumn("Day", F.date_format(ts, "yyyy-MM-dd"))
    keys = ["Day", "schedule", "machine"]
    base = d.groupBy(*keys).agg(
        F.count("*").alias("Samples"), F.count_if("missed").alias("Missed"), F.count_if("extended").alias("Extended"),
        F.round(F.avg("overdue_min"), 6).alias("AvgOverdueMin"), F.max("current_duration").alias("MaxDurationMin"),
    )
    p95 = scale.exact_quantiles(d, keys, "overdue_min", {"__p": 0.95})
    return scale.join_null_safe(base, p95, keys).select(
        "Day", F.col("schedule").alias("Schedule"), F.col("machine").alias("Machine"), "Samples", "Missed", "Extended",
        "AvgOverdueMin", F.round("__p", 6).alias("P95OverdueMin"), "MaxDurationMin",
    )


def dedupe_alerts(df: DataFrame, key: str, ttl_seconds: int, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Alerts that fire: the first of a key, then the first at least ``ttl`` after the last one that fired.

    A key's time line is cut into stretches that are worked on apart, see ``fire_with_pause``.
    """
    return fire_with_pause(df, key, ttl_seconds * 1_000_000, F.unix_micros(F.col(ts).cast("timestamp")), tie)
