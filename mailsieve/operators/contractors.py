"""Contractor risk: recent interactions, cadence and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLIENT_FEEDBACK = ("client_stakeholder_meeting", "client_escalation", "client_kudos")


def recent_interactions(interactions: DataFrame, asof: Column, days: int = 30) -> DataFrame:
    """Interactions dated within ``days`` before the as-of date (inclusive)."""
    d = F.col("interaction_date")
    return interactions.where((d <= asof) & (d >= F.date_sub(asof, days)))


def contractor_metrics(contractors: DataFrame, interactions: DataFrame, asof: Column, days: int = 30) -> DataFrame:
    """Derived fields per contractor.  Interactions are aggregated before the join, so a contractor with a
    third of them costs one row."""
    kind, d = F.col("interaction_type"), F.col("interaction_date")
    past = d <= asof
    recent = past & (d >= F.date_sub(asof, days))
    per = interactions.groupBy("contractor_id").agg(
        F.max(F.when(past & (kind == "1x1_manager_contractor"), d)).alias("last_1x1_date"),
        F.max(F.when(past & kind.isin(list(CLIENT_FEEDBACK)), d)).alias("last_client_feedback_date"),
        F.count_if(recent & (kind == "client_escalation")).alias("escalations_30d"),
        F.count_if(recent & (kind == "client_kudos")).alias("kudos_30d"),
    )
    out = contractors.join(per, "contractor_id", "left")
    for c in ("escalations_30d", "kudos_30d"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    active = F.col("status") == "Active"
    risky = (
        F.col("pip_status").isin("Formal PIP", "Final PIP") | (F.col("risk_flag") == "At risk")
        | ((F.col("escalations_30d") >= 1) & (F.col("kudos_30d") == 0))
    )
    overdue = F.col("last_1x1_date").isNull() | (F.datediff(asof, F.col("last_1x1_date")) > days)
    return out.withColumn("at_risk", active & risky).withColumn("out_of_cadence", active & overdue)


def rollup(metrics: DataFrame, by: str) -> DataFrame:
    """Active, at-risk and cadence counts with the escalation to kudos ratio, per engagement, client or manager."""
    active = F.col("status") == "Active"
    esc, kudos = F.sum("escalations_30d"), F.sum("kudos_30d")
    covered = F.count_if(active & ~F.col("out_of_cadence"))
    return metrics.groupBy(by).agg(
        F.count_if(active).alias("active"), F.count_if("at_risk").alias("at_risk"),
        F.round(F.try_divide(covered, F.count_if(active)), 6).alias("coverage_1x1"),
        esc.alias("escalations"), kudos.alias("kudos"), F.round(F.try_divide(esc, kudos), 6).alias("escalation_ratio"),
    )


def engagement_health(metrics: DataFrame) -> DataFrame:
    return rollup(metrics, "engagement_id")


def manager_coverage(metrics: DataFrame) -> DataFrame:
    return rollup(metrics, "manager_id")


def client_health(metrics: DataFrame) -> DataFrame:
    return rollup(metrics, "client")
