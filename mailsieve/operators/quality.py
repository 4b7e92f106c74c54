"""Outcome funnels, calibration, tiers, scorecards and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve import scale


def share(cond: Column, places: int = 6) -> Column:
    return F.round(F.avg(F.coalesce(cond, F.lit(False)).cast("int")), places)


def filter_rates(df: DataFrame, by: str, decision: str = "decision") -> DataFrame:
    d = F.col(decision)
    return df.groupBy(by).agg(
        F.count("*").alias("total"), share(d == "KEEP").alias("accept_rate"), share(d == "HUMAN").alias("triage_rate"),
        share(d == "IRRELEVANT").alias("drop_rate"),
    )


def index_report(chunks: DataFrame, vectors: DataFrame, expected: DataFrame, dim: int, min_tokens: int = 10) -> DataFrame:
    """Vector dimensions, malformed chunk share, and document count against the source (one row)."""
    short = F.col("token_count") < min_tokens
    lanes = [
        chunks.groupBy("doc_id").agg(
            F.lit("doc").alias("k"), F.count("*").alias("a"), F.count_if(short).alias("b")).select("k", "a", "b"),
        vectors.groupBy(F.coalesce(F.size("embedding") != dim, F.lit(True)).alias("bad")).agg(F.count("*").alias("a")).select(
            F.lit("vec").alias("k"), "a", F.when(F.col("bad"), F.col("a")).otherwise(0).alias("b")),
        expected.agg(F.count("*").alias("a")).select(F.lit("expected").alias("k"), "a", F.lit(0).cast("long").alias("b")),
    ]
    k = F.col("k")
    d = lanes[0].unionAll(lanes[1]).unionAll(lanes[2]).agg(
        F.sum(F.when(k == "vec", F.col("a"))).alias("vectors"), F.sum(F.when(k == "vec", F.col("b"))).alias("bad_dim"),
        F.sum(F.when(k == "doc", F.col("a"))).alias("chunks"), F.sum(F.when(k == "doc", F.col("b"))).alias("__short"),
        F.count_if(k == "doc").alias("docs"), F.max(F.when(k == "expected", F.col("a"))).alias("__want"),
    )
    bad = F.col("__short") / F.col("chunks")
    return d.select(
        "vectors", "bad_dim", "chunks", F.round(bad, 6).alias("malformed_share"), (bad <= 0.01).alias("malformed_ok"), "docs",
        (F.abs(F.col("docs") - F.col("__want")) <= 0.02 * F.col("__want")).alias("count_ok"),
        (F.col("docs") >= 0.99 * F.col("__want")).alias("ingest_ok"),
    )


# --- outcomes ---------------------------------------------------------------------------------


def outcome(rating: Column, blocked: Column) -> Column:
    return (
        F.when(blocked, "blocked").when(rating >= 4, "accepted").when(rating == 3, "edited").otherwise("rejected")
    )


def with_outcome(df: DataFrame) -> DataFrame:
    return df.withColumn("outcome", outcome(F.col("rating"), F.col("blocked"))).withColumn(
        "cohort", F.when(F.col("confidence").isNull(), "legacy").otherwise("modern")
    )


def outcome_funnel(df: DataFrame, by: str = "cohort") -> DataFrame:
    o = F.col("outcome")
    return with_outcome(df).groupBy(by).agg(
        F.count("*").alias("inbound"), F.count_if(o != "blocked").alias("generated"), F.count_if(o == "accepted").alias("accepted"),
        F.count_if(o == "edited").alias("edited"), F.count_if(o == "rejected").alias("rejected"),
        F.count_if(o == "blocked").alias("blocked"),
    )


def calibration(df: DataFrame, width: float = 0.2, confident: float = 0.8) -> DataFrame:
    """Actual acceptance per confidence bucket, with the bad-but-confident count."""
    parts = round(1 / width)
    b = F.least(F.floor(F.round(F.col("confidence") * parts, 6)), F.lit(parts - 1)) / parts
    o = F.col("outcome")
    return with_outcome(df).where(F.col("confidence").isNotNull()).groupBy(F.round(b, 6).alias("bucket")).agg(
        F.count("*").alias("n"), share(o == "accepted").alias("accept_rate"), F.round(F.avg("confidence"), 6).alias("avg_confidence"),
        F.count_if((o == "rejected") & (F.col("confidence") >= confident)).alias("bad_but_confident"),
    )


def tier(df: DataFrame) -> Column:
    """A: confident, grounded, unblocked, lightly edited; C: weak, ungrounded or blocked; B: the rest."""
    c = F.coalesce(F.col("confidence"), F.lit(0.0))
    weak = F.col("blocked") | (F.col("grounded") == 0) | (c < 0.4)
    return F.when(weak, "C").when((c >= 0.8) & (F.col("edit_share") <= 0.2), "A").otherwise("B")


def quality_tiers(df: DataFrame, by: str = "week") -> DataFrame:
    t = F.col("tier")
    return df.withColumn("tier", tier(df)).groupBy(by).agg(
        F.count("*").alias("n"), share(t == "A").alias("tier_a"), share(t == "B").alias("tier_b"), share(t == "C").alias("tier_c")
    )


def scorecard(df: DataFrame, by: Sequence[str] = ("week", "cohort"), threshold: float = 0.7) -> DataFrame:
    """Acceptance, edits, blocks, acceptance above the confidence threshold, ratings and median latency."""
    d, keys, o = with_outcome(df), list(by), F.col("outcome")
    sure = F.col("confidence") >= threshold
    base = d.groupBy(*keys).agg(
        F.count("*").alias("emails"), share(o == "accepted").alias("acceptance_rate"), share(o == "edited").alias("edit_rate"),
        share(o == "blocked").alias("block_rate"), F.round(F.avg("rating"), 6).alias("avg_rating"),
        F.round(F.avg(F.when(sure, (o == "accepted").cast("int"))), 6).alias("acceptance_at_threshold"),
    )
    med = scale.exact_quantiles(d, keys, "latency_ms", {"__m": 0.5})
    return scale.join_null_safe(base, med, keys).withColumnRenamed("__m", "median_latency")


def failure_drivers(df: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent causes among rejected or blocked outcomes."""
    causes = F.array_compact(
        F.array(
            F.when(F.col("blocked"), "policy_block"), F.when(F.col("grounded") == 0, "missing_context"),
            F.when(F.col("confidence") < 0.4, "low_confidence"), F.when(F.col("edit_share") > 0.5, "heavy_edits"),
            F.concat(F.lit("category:"), F.col("category")),
        )
    )
    bad = with_outcome(df).where(F.col("outcome").isin("rejected", "blocked"))
    counts = bad.select(F.explode(causes).alias("driver")).groupBy("driver").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "driver").limit(n)


def stratified_sample(df: DataFrame, keys: Sequence[str], key: str, n: int) -> DataFrame:
    """The ``n`` rows of each stratum with the smallest hash of their key."""
    return scale.top_per_key(df.withColumn("__h", F.md5(F.col(key).cast("string"))), list(keys), [F.col("__h"), F.col(key)], n).drop("__h")


# fixed values: quality gates (metric, target, at least or at most)
GATES = {
    "grounding": (0.95, "min"), "coverage": (0.85, "min"), "hallucination": (0.05, "max"), "p90_ms": (6000.0, "max"),
    "p99_ms": (10000.0, "max"), "edit_median": (0.20, "max"), "satisfaction": (4.0, "min"),
}


def gate_report(df: DataFrame, gates: Mapping[str, tuple[float, str]] = GATES) -> DataFrame:
    """One row per gate: value, target, passed."""
    o = F.col("outcome")
    one = with_outcome(df).agg(
        F.avg(F.col("grounded")).alias("grounding"), F.avg((o != "blocked").cast("int")).alias("coverage"),
        F.avg((o == "rejected").cast("int")).alias("hallucination"), F.avg("rating").alias("satisfaction"),
    )
    d = one.select(F.expr("stack(4, 'grounding', grounding, 'coverage', coverage, 'hallucination', hallucination, "
                          "'satisfaction', satisfaction) AS (gate, value)"))
    lat = scale.exact_quantiles(df.withColumn("__k", F.lit(1)), ["__k"], "latency_ms", {"p90_ms": 0.9, "p99_ms": 0.99})
    d = d.unionByName(lat.select(F.expr("stack(2, 'p90_ms', p90_ms, 'p99_ms', p99_ms) AS (gate, value)")))
    edit = scale.exact_quantiles(df.withColumn("__k", F.lit(1)), ["__k"], "edit_share", {"value": 0.5})
    d = d.unionByName(edit.select(F.lit("edit_median").alias("gate"), "value"))
    target = F.create_map(*[F.lit(x) for g, (t, _) in gates.items() for x in (g, t)])[F.col("gate")]
    floor = F.col("gate").isin([g for g, (_, side) in gates.items() if side == "min"])
    met = F.when(floor, F.col("value") >= target).otherwise(F.col("value") <= target)
    return d.select("gate", F.round("value", 6).alias("value"), target.alias("target"), met.alias("passed"))
