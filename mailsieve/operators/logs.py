"""Log analytics: reliability, traffic, retrieval, ranking, generation, cost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve import scale
from mailsieve.operators.quality import share
from mailsieve.functions.text import strip

RETRIEVE, RANK, ANSWER, GENERATE = (
    "rag_retrieve_contexts", "rank_texts_with_ranking_api", "rag_answer", "gen_generate",
)
UNKNOWN_ANSWER = r"(?i)\A(i\s+don['’]?t\s+know|cannot\s+answer|no\s+context|not\s+enough\s+context)"
# fixed values: service objectives
SLO_TARGETS = {
    "availability": 0.995, "p95_retrieve": 1500.0, "p95_rank": 800.0, "p95_generate": 2500.0, "zero_hit": 0.02,
    "median_contexts": 8.0, "truncation": 0.03, "confidence_share": 0.6,
}
SEVERITIES = ("DEFAULT", "DEBUG", "INFO", "NOTICE", "WARNING", "ERROR", "CRITICAL", "ALERT", "EMERGENCY")


def answered_unknown(answer: Column) -> Column:
    return F.coalesce(strip(answer).rlike(UNKNOWN_ANSWER), F.lit(False))


def latency_percentiles(logs: DataFrame, by: Sequence[str] = ("action",)) -> DataFrame:
    return scale.exact_quantiles(logs, by, "latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def error_rate(logs: DataFrame) -> DataFrame:
    """Errors per action and status code, with the share of the action's calls."""
    counts = logs.groupBy("action", "status", "http_status").agg(F.count("*").alias("n"))
    total = counts.groupBy("action").agg(F.sum("n").alias("total"))
    return counts.where(F.col("status") == "error").join(total, "action").select(
        "action", F.col("http_status").alias("code"), "n", F.round(F.col("n") / F.col("total"), 6).alias("rate")
    )


def zero_hit_rate(logs: DataFrame) -> DataFrame:
    hit = F.col("contexts_returned") == 0
    return logs.where(F.col("action").isin(RETRIEVE, ANSWER)).groupBy("action").agg(
        F.count_if(hit).alias("zero_hits"), F.count("*").alias("total"),
        F.round(100.0 * F.count_if(hit) / F.count("*"), 4).alias("pct_zero"),
    )


def generation_outcomes(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("action").isin(ANSWER, GENERATE)).groupBy("action").agg(
        share(F.col("gen_finish_reason") == "MAX_TOKENS").alias("truncation_rate"),
        share(F.col("safety_blocked")).alias("safety_block_rate"),
        share(F.col("answered_unknown")).alias("unknown_rate"),
    )


def confidence_hist(logs: DataFrame, width: float = 0.1) -> DataFrame:
    parts = round(1 / width)
    bin_ = F.floor(F.round(F.col("confidence") * parts, 6)) / parts
    return logs.where(F.col("confidence").isNotNull()).groupBy(F.round(bin_, 6).alias("bin")).agg(F.count("*").alias("n"))


def rank_mode_mix(logs: DataFrame) -> DataFrame:
    counts = logs.where(F.col("action").isin(RETRIEVE, ANSWER)).groupBy("rank_mode").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / counts.agg(F.sum("n")).scalar(), 6))


def token_spend(logs: DataFrame) -> DataFrame:
    keys = ["recipe_id", "action"]
    sums = logs.groupBy(*keys).agg(F.sum("tokens_total").alias("tokens"), F.count("*").alias("calls"))
    return sums.join(scale.exact_quantiles(logs, keys, "tokens_total", {"tokens_p95": 0.95}), keys)


def hot_paths(logs: DataFrame) -> DataFrame:
    """Share of wall time per action within its recipe."""
    sums = logs.groupBy("recipe_id", "action").agg(F.sum("latency_ms").alias("wall_ms"))
    total = sums.groupBy("recipe_id").agg(F.sum("wall_ms").alias("__t"))
    return sums.join(total, "recipe_id").select(
        "recipe_id", "action", "wall_ms", F.round(F.col("wall_ms") / F.col("__t"), 6).alias("share")
    )


def volume(logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return logs.groupBy(*keys).agg(F.count("*").alias("calls"))


def region_anomalies(logs: DataFrame) -> DataFrame:
    """Error share per region and its ratio to the overall share."""
    err = (F.col("status") == "error").cast("int")
    per = logs.groupBy("region").agg(F.sum(err).alias("errors"), F.count("*").alias("calls"))
    overall = per.agg(F.sum("errors") / F.sum("calls")).scalar()
    rate = F.col("errors") / F.col("calls")
    return per.select("region", "calls", F.round(rate, 6).alias("error_rate"), F.round(rate / overall, 4).alias("ratio"))


def hygiene(logs: DataFrame) -> DataFrame:
    return logs.groupBy("recipe_id").agg(
        F.count_if(~F.col("severity").isin(list(SEVERITIES))).alias("nonstandard_severity"),
        F.count_if((F.col("status") == "error") & F.col("http_status").isNull()).alias("silent_failures"),
    )


def richness(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("action") == RETRIEVE).groupBy("retrieval_top_k", "contexts_returned").agg(F.count("*").alias("n"))


def threshold_effect(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("action") == RETRIEVE).groupBy("retrieval_filter", "retrieval_filter_val").agg(
        F.count("*").alias("calls"), F.round(F.avg("latency_ms"), 4).alias("avg_latency"),
        share(F.col("status") == "ok").alias("success_rate"),
    )


def length_conf_matrix(df: DataFrame, length: str, confidence: str, edges: Sequence[int] = (200, 500, 1000)) -> DataFrame:
    """Answers per length band, one column per confidence band."""
    band = F.lit(str(len(edges)))
    for i, e in reversed(list(enumerate(edges))):
        band = F.when(F.col(length) < e, str(i)).otherwise(band)
    c = F.col(confidence)
    return df.where(c.isNotNull()).groupBy(band.alias("length_band")).agg(
        F.count_if(c < 0.4).alias("low"), F.count_if((c >= 0.4) & (c < 0.7)).alias("medium"), F.count_if(c >= 0.7).alias("high")
    )


def slo_report(logs: DataFrame, targets: Mapping[str, float] = SLO_TARGETS) -> DataFrame:
    """One row per objective: measured value, target, pass."""
    ok = (F.col("status") == "ok") & F.col("http_status").between(200, 399)
    act = F.col("action")

    def part(on: Column, cond: Column) -> Column:
        return F.avg(F.when(on, F.coalesce(cond, F.lit(False)).cast("int")))

    one = logs.agg(
        part(F.lit(True), ok).alias("availability"),
        part(act.isin(RETRIEVE, ANSWER), F.col("contexts_returned") == 0).alias("zero_hit"),
        part(act == ANSWER, F.col("gen_finish_reason") == "MAX_TOKENS").alias("truncation"),
        part(act == GENERATE, F.col("confidence") >= 0.7).alias("confidence_share"),
    )
    shares = one.select(F.expr("stack(4, 'availability', availability, 'zero_hit', zero_hit, 'truncation', truncation, "
                               "'confidence_share', confidence_share) AS (objective, value)"))
    names = F.create_map(*[F.lit(x) for p in ((RETRIEVE, "p95_retrieve"), (RANK, "p95_rank"), (GENERATE, "p95_generate")) for x in p])
    p95 = scale.exact_quantiles(logs.where(act.isin(RETRIEVE, RANK, GENERATE)), ["action"], "latency_ms", {"value": 0.95})
    p95 = p95.select(names[F.col("action")].alias("objective"), "value")
    med = scale.exact_quantiles(
        logs.where((act == RETRIEVE) & (F.col("retrieval_top_k") == 20)), ["action"], "contexts_returned", {"value": 0.5}
    ).select(F.lit("median_contexts").alias("objective"), "value")
    limit = F.create_map(*[F.lit(x) for p in targets.items() for x in p])[F.col("objective")]
    at_least = F.col("objective").isin("availability", "median_contexts", "confidence_share")
    d = shares.unionByName(p95).unionByName(med).withColumn("target", limit)
    met = F.when(at_least, F.col("value") >= F.col("target")).otherwise(F.col("value") < F.col("target"))
    return d.select("objective", F.round("value", 6).alias("value"), "target", met.alias("passed"))


# fixed values: facets kept per action
FACETS = {
    RETRIEVE: ("retrieval_top_k", "contexts_returned", "retrieval_filter", "retrieval_filter_val", "rank_mode"),
    RANK: ("rank_mode", "contexts_returned"),
    ANSWER: ("contexts_returned", "tokens_total", "gen_finish_reason", "safety_blocked", "confidence", "answered_unknown"),
    GENERATE: ("tokens_total", "gen_finish_reason", "safety_blocked", "confidence", "answered_unknown"),
}


def facets(action: str = "action") -> Column:
    """Map of the facets an action reports; nulls and blanks are left out."""
    names = list(dict.fromkeys(n for ns in FACETS.values() for n in ns))
    keep = F.create_map(*[x for a, ns in FACETS.items() for x in (F.lit(a), F.array(*[F.lit(n) for n in ns]))])[F.col(action)]
    every = F.create_map(*[x for n in [*names, "correlation_id"] for x in (F.lit(n), F.col(n).cast("string"))])
    return F.map_filter(
        every,
        lambda k, v: (F.array_contains(keep, k) | (k == "correlation_id")) & v.isNotNull() & (v != ""),
    )


def facet_alerts(errors: str, confidence: str, contexts: str) -> Column:
    e, c, n = F.col(errors), F.col(confidence), F.col(contexts)
    return F.array_compact(
        F.array(
            F.when(e > 0, F.concat(F.lit("Partial failure: "), e.cast("string"), F.lit(" contexts failed"))),
            F.when(c < 0.5, F.concat(F.lit("Low confidence: "), c.cast("string"))),
            F.when(n == 0, F.lit("No contexts retrieved")),
        )
    )


def trace_steps(logs: DataFrame, key: str = "correlation_id", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Time since the previous stage of the trace and wall time so far; hot traces split by minute."""
    minute = scale.time_bucket(F.col(ts), "minute")
    d = scale.previous_row(logs, [key], minute, [ts, tie], {"previous_action": "action", "__before": ts})
    d = scale.cumulative_sum(d, [key], minute, [ts, tie], F.col("latency_ms"), "running_ms")
    micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("__before").cast("timestamp"))
    return d.withColumn("delta_s", F.round(micros / 1e6, 3)).drop("__before")


def thread_signals(stage_a: DataFrame, stage_b: DataFrame, key: str = "correlation_id") -> DataFrame:
    """Signals of an earlier stage carried to the rows of a later one."""
    return stage_b.join(stage_a, key, "left")


def budget_gate(logs: DataFrame, cap: int, day: Column, ts: str = "ts", tie: str = "event_id", cost: str = "tokens_total") -> DataFrame:
    """Cumulative spend per day in time order; what exceeds the cap waits for the next day."""
    d = scale.cumulative_sum(logs.withColumn("day", day), ["day"], scale.time_bucket(F.col(ts), "minute"), [ts, tie], F.col(cost), "spent")
    return d.withColumn("queued", F.col("spent") > cap)


# fixed values: dollars per e-mail of each integration pattern (filter only, classification, full answer)
PATTERN_PRICES = {"filter": 0.001, "classify": 0.05, "answer": 0.15}


def cost_report(df: DataFrame, prices: Mapping[str, float], pattern: Column, day: Column) -> DataFrame:
    price = F.create_map(*[F.lit(x) for p in prices.items() for x in p])
    d = df.select(day.alias("day"), pattern.alias("pattern")).groupBy("day", "pattern").agg(F.count("*").alias("emails"))
    return d.withColumn("cost", F.round(F.col("emails") * price[F.col("pattern")], 4))
