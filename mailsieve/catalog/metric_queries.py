"""Metric summaries and log analytics over all events."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsieve.operators import logs as L
from mailsieve.operators import metrics as M
from mailsieve.registry import query


def summary_sql(keys: str, src: str = "events", places: int = 2) -> str:
    return f"""
b AS (SELECT {keys}, value, avg(value) OVER w AS av, stddev_pop(value) OVER w AS sd, row_number() OVER (PARTITION BY {keys} ORDER BY value, event_id) AS rn, count(*) OVER w AS n
  FROM {src} WINDOW w AS (PARTITION BY {keys})),
h AS (SELECT {keys}, avg(value) FILTER (rn <= n // 2) AS lo, avg(value) FILTER (rn > n // 2) AS hi, count(*) FILTER (abs(value - av) > 2 * sd) AS anomalies,
  round(avg(value), {places}) AS average, round(quantile_cont(value, 0.5), {places}) AS median, min(value) AS min, max(value) AS max, round(stddev_pop(value), {places}) AS std_deviation,
  round(quantile_cont(value, 0.95), {places}) AS percentile_95, round(quantile_cont(value, 0.99), {places}) AS percentile_99, count(*) AS total_count FROM b GROUP BY {keys})"""


TREND = "CASE WHEN hi > coalesce(lo, hi) * 1.1 THEN 'increasing' WHEN hi < coalesce(lo, hi) * 0.9 THEN 'decreasing' ELSE 'stable' END"
COLS = "average, median, min, max, std_deviation, percentile_95, percentile_99, total_count"


@query("a1_compute_metrics", sql="WITH " + summary_sql("event_type") + f" SELECT event_type, {COLS}, {TREND} AS trend, anomalies FROM h")
def _(v):
    return M.compute_metrics(v.t("events"), ["event_type"])


@query("a2_trend", sql="WITH " + summary_sql("user_id") + f""",
t AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events),
u AS (SELECT user_id, avg(value) FILTER (rn <= n // 2) AS lo, avg(value) FILTER (rn > n // 2) AS hi FROM t GROUP BY 1)
SELECT h.user_id, {TREND.replace('hi', 'h.hi').replace('lo,', 'h.lo,')} AS by_value, {TREND.replace('hi', 'u.hi').replace('lo,', 'u.lo,')} AS by_time, round(coalesce(u.lo, u.hi), 6) AS first_half FROM h JOIN u ON h.user_id = u.user_id""")
def _(v):
    e = v.t("events")
    a = M.trend(e, ["user_id"]).select("user_id", F.col("trend").alias("by_value"))
    b = M.trend(e, ["user_id"], order="time").select("user_id", F.col("trend").alias("by_time"), F.round("first_half", 6).alias("first_half"))
    return a.join(b, "user_id")


@query("a3_metrics_per_period", sql="WITH " + summary_sql("event_type, period", "(SELECT *, strftime(date_trunc('day', ts), '%Y-%m-%d') AS period FROM events)", 5) + f"""
SELECT event_type, period, {COLS}, {TREND} AS trend, anomalies FROM h""")
def _(v):
    return M.compute_metrics(v.t("events"), ["event_type"], period="day", places=5).withColumn("period", F.date_format("period", "yyyy-MM-dd"))


def advice_sql(target: str, order: str | None) -> str:
    best = f"(SELECT batch_size FROM H ORDER BY {order}, user_id LIMIT 1)" if order else "(SELECT sum(batch_size) // count(*) FROM H)"
    return f"""SELECT '{target}' AS target, opt AS optimal_batch_size, cast(ceil(100000.0 / opt) AS BIGINT) AS estimated_batches,
  round(tm * ceil(100000.0 / opt), 2) AS estimated_processing_time, round(100000.0 / (tm * ceil(100000.0 / opt)), 2) AS throughput_estimate, 0.8::DOUBLE AS confidence_score
  FROM (SELECT greatest(least(cast({best} AS BIGINT), 60), 10) AS opt, (SELECT avg(processing_time) FROM H) AS tm) x"""


RATE = "(batch_size / greatest(processing_time, 0.0001))"


@query("a4_optimize_batch", "H", sql=" UNION ALL ".join([
    advice_sql("throughput", f"{RATE} DESC"), advice_sql("latency", "processing_time / greatest(batch_size, 1)"),
    advice_sql("cost", f"memory_usage * 0.7 - {RATE} * 0.3"), advice_sql("accuracy", f"success_rate * 1000 + {RATE} DESC"), advice_sql("balanced", None)]))
def _(v):
    parts = [M.optimize_batch(v.H, 100000, t, 10, 60) for t in ("throughput", "latency", "cost", "accuracy", "balanced")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("w5_spikes", sql="""WITH RECURSIVE
c AS (SELECT event_type, date_trunc('hour', ts) AS b, count(*) AS n, row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('hour', ts)) AS rn FROM events GROUP BY 1, 2),
r AS (SELECT event_type, b, n, rn, n::DOUBLE AS ewma, false AS is_spike FROM c WHERE rn = 1
  UNION ALL SELECT c.event_type, c.b, c.n, c.rn, 0.3 * c.n + 0.7 * r.ewma, c.n > 3.0 * r.ewma FROM r JOIN c ON c.event_type = r.event_type AND c.rn = r.rn + 1)
SELECT event_type, strftime(b, '%Y-%m-%d %H') AS bucket, n, round(ewma, 6) AS ewma, is_spike FROM r""")
def _(v):
    d = M.spikes(v.t("events"), "event_type", unit="hour")
    return d.select("event_type", F.date_format("bucket", "yyyy-MM-dd HH").alias("bucket"), "n", F.round("ewma", 6).alias("ewma"), "is_spike")


@query("w6_anomalies", sql="""
SELECT event_id, event_type, value FROM (SELECT *, avg(value) OVER w AS av, stddev_pop(value) OVER w AS sd FROM events WINDOW w AS (PARTITION BY event_type)) x WHERE abs(value - av) > 2 * sd""")
def _(v):
    return M.anomalies(v.t("events"), ["event_type"]).select("event_id", "event_type", "value")


# --- logs -------------------------------------------------------------------------------------


@query("a13_latency_percentiles", "L", sql="""
SELECT action, round(quantile_cont(latency_ms, 0.5), 4) AS p50, round(quantile_cont(latency_ms, 0.95), 4) AS p95, round(quantile_cont(latency_ms, 0.99), 4) AS p99 FROM L GROUP BY 1""")
def _(v):
    d = L.latency_percentiles(v.L)
    return d.select("action", *[F.round(c, 4).alias(c) for c in ("p50", "p95", "p99")])


@query("a14_error_rate", "L", sql="""
SELECT action, http_status AS code, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM L t WHERE t.action = L.action), 6) AS rate FROM L WHERE status = 'error' GROUP BY 1, 2""")
def _(v):
    return L.error_rate(v.L)


@query("a15_zero_hit_rate", "L", sql="""
SELECT action, count(*) FILTER (contexts_returned = 0) AS zero_hits, count(*) AS total, round(100.0 * count(*) FILTER (contexts_returned = 0) / count(*), 4)::DOUBLE AS pct_zero
FROM L WHERE action IN ('rag_retrieve_contexts', 'rag_answer') GROUP BY 1""")
def _(v):
    return L.zero_hit_rate(v.L)


@query("a16_generation_outcomes", "L", sql="""
SELECT action, round(avg((gen_finish_reason = 'MAX_TOKENS')::INT), 6) AS truncation_rate, round(avg(safety_blocked::INT), 6) AS safety_block_rate, round(avg(answered_unknown::INT), 6) AS unknown_rate
FROM L WHERE action IN ('rag_answer', 'gen_generate') GROUP BY 1""")
def _(v):
    return L.generation_outcomes(v.L)


@query("a17_confidence_hist", "L", sql="SELECT round(floor(round(confidence * 10, 6)) / 10, 6) AS bin, count(*) AS n FROM L GROUP BY 1")
def _(v):
    return L.confidence_hist(v.L)


@query("a18_rank_mode_mix", "L", sql="""
SELECT rank_mode, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6)::DOUBLE AS share FROM L WHERE action IN ('rag_retrieve_contexts', 'rag_answer') GROUP BY 1""")
def _(v):
    return L.rank_mode_mix(v.L)


@query("a19_token_spend", "L", sql="""
SELECT recipe_id, action, sum(tokens_total)::BIGINT AS tokens, count(*) AS calls, round(quantile_cont(tokens_total, 0.95), 4) AS tokens_p95 FROM L GROUP BY 1, 2""")
def _(v):
    return L.token_spend(v.L).withColumn("tokens_p95", F.round("tokens_p95", 4))


@query("a20_hot_paths", "L", sql="""
SELECT recipe_id, action, sum(latency_ms)::BIGINT AS wall_ms, round(sum(latency_ms) / sum(sum(latency_ms)) OVER (PARTITION BY recipe_id), 6)::DOUBLE AS share FROM L GROUP BY 1, 2""")
def _(v):
    return L.hot_paths(v.L)


@query("a21_volume", "L", sql="SELECT action, env, recipe_id, job_id, count(*) AS calls FROM L GROUP BY ALL")
def _(v):
    return L.volume(v.L, ["action", "env", "recipe_id", "job_id"])


@query("a21_region_anomalies", "L", sql="""
SELECT region, count(*) AS calls, round(avg((status = 'error')::INT), 6) AS error_rate, round(avg((status = 'error')::INT) / (SELECT avg((status = 'error')::INT) FROM L), 4) AS ratio FROM L GROUP BY 1""")
def _(v):
    return L.region_anomalies(v.L)


@query("a22_hygiene", "L", sql="""
SELECT recipe_id, count(*) FILTER (severity LIKE 'NONSTANDARD%') AS nonstandard_severity, count(*) FILTER (status = 'error' AND http_status IS NULL) AS silent_failures FROM L GROUP BY 1""")
def _(v):
    return L.hygiene(v.L)


@query("a23_richness", "L", sql="SELECT retrieval_top_k, contexts_returned, count(*) AS n FROM L WHERE action = 'rag_retrieve_contexts' GROUP BY 1, 2")
def _(v):
    return L.richness(v.L)


@query("a23_threshold_effect", "L", sql="""
SELECT retrieval_filter, retrieval_filter_val::DOUBLE AS retrieval_filter_val, count(*) AS calls, round(avg(latency_ms), 4) AS avg_latency, round(avg((status = 'ok')::INT), 6) AS success_rate FROM L WHERE action = 'rag_retrieve_contexts' GROUP BY 1, 2""")
def _(v):
    return L.threshold_effect(v.L).withColumn("retrieval_filter_val", F.col("retrieval_filter_val").cast("double"))


@query("a24_length_conf_matrix", "L", sql="""
SELECT CASE WHEN tokens_total < 300 THEN '0' WHEN tokens_total < 400 THEN '1' WHEN tokens_total < 500 THEN '2' ELSE '3' END AS length_band,
  count(*) FILTER (confidence < 0.4) AS low, count(*) FILTER (confidence >= 0.4 AND confidence < 0.7) AS medium, count(*) FILTER (confidence >= 0.7) AS high FROM L GROUP BY 1""")
def _(v):
    return L.length_conf_matrix(v.L, "tokens_total", "confidence", (300, 400, 500))


@query("a25_slo_report", "L", sql="""
m AS (SELECT 'availability' AS objective, avg((status = 'ok' AND http_status BETWEEN 200 AND 399)::INT) AS value, 0.995::DOUBLE AS target, true AS floor FROM L
UNION ALL SELECT 'zero_hit', avg((contexts_returned = 0)::INT), 0.02, false FROM L WHERE action IN ('rag_retrieve_contexts', 'rag_answer')
UNION ALL SELECT 'truncation', avg((gen_finish_reason = 'MAX_TOKENS')::INT), 0.03, false FROM L WHERE action = 'rag_answer'
UNION ALL SELECT 'confidence_share', avg((confidence >= 0.7)::INT), 0.6, true FROM L WHERE action = 'gen_generate'
UNION ALL SELECT 'p95_retrieve', quantile_cont(latency_ms, 0.95), 1500, false FROM L WHERE action = 'rag_retrieve_contexts'
UNION ALL SELECT 'p95_rank', quantile_cont(latency_ms, 0.95), 800, false FROM L WHERE action = 'rank_texts_with_ranking_api'
UNION ALL SELECT 'p95_generate', quantile_cont(latency_ms, 0.95), 2500, false FROM L WHERE action = 'gen_generate'
UNION ALL SELECT 'median_contexts', quantile_cont(contexts_returned, 0.5), 8, true FROM L WHERE action = 'rag_retrieve_contexts' AND retrieval_top_k = 20)
SELECT objective, round(value, 6) AS value, target, CASE WHEN floor THEN value >= target ELSE value < target END AS passed FROM m""")
def _(v):
    return L.slo_report(v.L)


@query("a12_facets", "L", sql="""
SELECT event_id, concat_ws(';',
  CASE WHEN action = 'rag_answer' THEN 'confidence=' || CAST(confidence AS VARCHAR) END, CASE WHEN action = 'rag_answer' THEN 'contexts_returned=' || contexts_returned
    WHEN action IN ('rag_retrieve_contexts', 'rank_texts_with_ranking_api') THEN 'contexts_returned=' || contexts_returned END,
  'correlation_id=' || correlation_id, CASE WHEN action = 'rag_retrieve_contexts' THEN 'filter=' || retrieval_filter END,
  CASE WHEN action IN ('rag_answer', 'gen_generate') THEN 'tokens_total=' || tokens_total END) AS facets FROM L""")
def _(v):
    d = v.L.withColumn("f", L.facets())
    f = F.col("f")
    return d.select("event_id", F.concat_ws(
        ";", F.when(F.col("action") != "gen_generate", F.concat(F.lit("confidence="), f["confidence"])),
        F.concat(F.lit("contexts_returned="), f["contexts_returned"]), F.concat(F.lit("correlation_id="), f["correlation_id"]),
        F.concat(F.lit("filter="), f["retrieval_filter"]), F.concat(F.lit("tokens_total="), f["tokens_total"]),
    ).alias("facets"))


@query("p25_facet_alerts", "L", sql="""
SELECT event_id, concat_ws('; ', CASE WHEN status = 'error' THEN 'Partial failure: 1 contexts failed' END,
  CASE WHEN confidence < 0.5 THEN 'Low confidence: ' || CAST(confidence AS VARCHAR) END, CASE WHEN contexts_returned = 0 THEN 'No contexts retrieved' END) AS alerts FROM L""")
def _(v):
    d = v.L.withColumn("error_count", (F.col("status") == "error").cast("int"))
    return d.select("event_id", F.array_join(L.facet_alerts("error_count", "confidence", "contexts_returned"), "; ").alias("alerts"))


@query("w9_trace_steps", "L", sql="""
SELECT event_id, lag(action) OVER w AS previous_action, round((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6, 3) AS delta_s,
  sum(latency_ms) OVER w::BIGINT AS running_ms FROM L WINDOW w AS (PARTITION BY correlation_id ORDER BY ts, event_id)""".replace("OVER w::BIGINT", "OVER (PARTITION BY correlation_id ORDER BY ts, event_id)::BIGINT"))
def _(v):
    return L.trace_steps(v.L).select("event_id", "previous_action", "delta_s", "running_ms")


@query("j14_thread_signals", "L", sql="""
s AS (SELECT correlation_id, max(confidence) AS signals_confidence, count(*) AS retrievals FROM L WHERE action = 'rag_retrieve_contexts' GROUP BY 1)
SELECT l.event_id, s.signals_confidence, s.retrievals FROM L l LEFT JOIN s ON l.correlation_id = s.correlation_id WHERE l.action = 'rag_answer'""")
def _(v):
    a = v.L.where(F.col("action") == L.RETRIEVE).groupBy("correlation_id").agg(F.max("confidence").alias("signals_confidence"), F.count("*").alias("retrievals"))
    return L.thread_signals(a, v.L.where(F.col("action") == L.ANSWER)).select("event_id", "signals_confidence", "retrievals")


@query("w7_budget_gate", "L", sql="""
SELECT event_id, spent, spent > 50000 AS queued FROM (SELECT event_id, sum(tokens_total) OVER (PARTITION BY ts::DATE ORDER BY ts, event_id)::BIGINT AS spent FROM L) x""")
def _(v):
    return L.budget_gate(v.L, 50000, F.col("ts").cast("date")).select("event_id", "spent", "queued")


@query("a42_cost_report", "L", sql="""
SELECT CAST(ts::DATE AS VARCHAR) AS day, p AS pattern, count(*) AS emails, round(count(*) * CASE p WHEN 'filter' THEN 0.001 WHEN 'classify' THEN 0.05 ELSE 0.15 END::DOUBLE, 4) AS cost
FROM (SELECT *, CASE action WHEN 'rag_answer' THEN 'answer' WHEN 'gen_generate' THEN 'answer' WHEN 'rank_texts_with_ranking_api' THEN 'classify' ELSE 'filter' END AS p FROM L) x GROUP BY 1, 2""")
def _(v):
    a = F.col("action")
    pattern = F.when(a.isin(L.ANSWER, L.GENERATE), "answer").when(a == L.RANK, "classify").otherwise("filter")
    return L.cost_report(v.L, L.PATTERN_PRICES, pattern, F.col("ts").cast("date").cast("string"))


@query("s12_load_logs", "L", sql="""
SELECT action, count(*) AS n, sum(latency_ms)::BIGINT AS latency, round(sum(confidence), 4) AS confidence, count(http_status) AS codes, count(*) FILTER (safety_blocked) AS blocked FROM L GROUP BY 1""")
def _(v):
    import uuid

    from mailsieve.schemas import LOG_ROW
    from mailsieve.session import scratch_dir
    from mailsieve.sources.tables import load_logs

    path = f"{scratch_dir(v.spark)}/logs-{uuid.uuid4().hex}"
    d = v.L.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    d = d.select(*[F.col(f.name).cast("string") if f.name in d.columns else F.lit(None).cast("string").alias(f.name) for f in LOG_ROW.fields])
    d.write.option("header", True).csv(path)
    return load_logs(v.spark, path).groupBy("action").agg(
        F.count("*").alias("n"), F.sum("latency_ms").alias("latency"), F.round(F.sum("confidence"), 4).alias("confidence"),
        F.count("http_status").alias("codes"), F.count_if("safety_blocked").alias("blocked"),
    )


@query("f53_ensure_correlation_id", "L", sql="SELECT event_id, true AS present FROM L")
def _(v):
    from mailsieve.functions.ids import ensure_correlation_id

    own = F.when(F.col("status") == "ok", F.concat(F.lit(" "), F.col("correlation_id"))).otherwise(" ")
    return v.L.select("event_id", (F.length(ensure_correlation_id(own)) > 0).alias("present"))
