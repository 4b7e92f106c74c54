"""Streaming operators, run to the end of the available input and compared with batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mailsieve.catalog.rules_queries import QUICK, filter_sql
from mailsieve.operators.rules import quick_rules
from mailsieve.registry import query
from mailsieve.session import scratch_dir
from mailsieve.streaming import flows


def events(v, name="events", schema=None):
    """The given table as a stream, with a zoned event time."""
    s = flows.stream_source(v.spark, v.dir, schema or v.t(name).schema, f"{name}.parquet")
    return s.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in s.columns else s


def staged(v, df):
    """A derived view written once and read as a stream."""
    path = f"{scratch_dir(v.spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return flows.stream_source(v.spark, path, df.schema)


def closed(v, df, key):
    """``df`` as a stream that ends with one row far ahead of all others, so that every window closes."""
    last = df.agg(F.max_by(F.struct(*df.columns), "ts").alias("r")).select("r.*")
    end = last.withColumns({"ts": F.col("ts") + F.expr("INTERVAL 30 DAYS"), key: F.lit("end")})
    return staged(v, df.union(end.select(df.columns)))


def all_events(v):
    d = v.t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return closed(v, d, "event_type")


STAMP = "yyyy-MM-dd HH:mm:ss"


@query("r1_stream_triage", "E", sql=filter_sql(quick_rules(QUICK)) + " SELECT email_id, decision, email_type, soft_score FROM f")
def _(v):
    out = flows.stream_triage(staged(v, v.E), quick_rules(QUICK)).select("email_id", "decision", "email_type", "soft_score")
    return flows.run_available(out)


@query("r2_stream_volume", sql="""
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def _(v):
    d = flows.run_available(flows.stream_volume(all_events(v)))
    return d.withColumn("start", F.date_format("start", STAMP))


@query("r3_stream_sliding_avg", sql="""
w AS (SELECT event_type, value, unnest([0, 15, 30, 45]) AS back, ts FROM events),
s AS (SELECT event_type, value, time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(back) AS start FROM w)
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, event_type, round(avg(value), 5) AS average, count(*) AS n FROM s GROUP BY s.start, event_type""".replace("\nw AS", "WITH w AS", 1))
def _(v):
    d = flows.run_available(flows.stream_sliding_avg(all_events(v)))
    return d.withColumn("start", F.date_format("start", STAMP)).withColumn("average", F.round("average", 5))


TTL_SQL = """WITH RECURSIVE
e AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events {where}),
r AS (SELECT event_id, user_id, rn, ts AS fired, true AS fire FROM e WHERE rn = 1
  UNION ALL SELECT e.event_id, e.user_id, e.rn, CASE WHEN e.ts - r.fired >= INTERVAL {hours} HOUR THEN e.ts ELSE r.fired END, e.ts - r.fired >= INTERVAL {hours} HOUR FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1)
SELECT event_id, user_id FROM r WHERE fire"""


@query("r4_stream_dedupe", sql=TTL_SQL.format(where="WHERE event_type = 'error'", hours=48))
def _(v):
    return flows.run_available(flows.stream_dedupe(events(v).where(F.col("event_type") == "error"), "user_id", 48 * 3600)).select("event_id", "user_id")


@query("r5_stream_debounce", sql=TTL_SQL.format(where="", hours=12))
def _(v):
    return flows.run_available(flows.stream_debounce(events(v), "user_id", 12 * 3600)).select("event_id", "user_id")


@query("r6_stream_traces", "L", sql="""
a AS (SELECT correlation_id, ts, latency_ms, CASE WHEN ts - lag(ts) OVER w < INTERVAL 120 MINUTE THEN 0 ELSE 1 END AS fresh FROM L WINDOW w AS (PARTITION BY correlation_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY correlation_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM a)
SELECT correlation_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS stages, sum(latency_ms)::BIGINT AS total_ms FROM s GROUP BY correlation_id, sid""")
def _(v):
    logs = v.L.select("correlation_id", F.col("ts").cast("timestamp").alias("ts"), "latency_ms")
    d = flows.run_available(flows.stream_traces(closed(v, logs, "correlation_id"), "correlation_id", "120 minutes"))
    return d.select("correlation_id", F.date_format("start", STAMP).alias("start"), "stages", "total_ms")


@query("r7_stream_reindex", "CUR PREV", sql="""
SELECT c.doc_id, CASE WHEN p.doc_id IS NULL THEN 'added' ELSE 'kept' END AS status FROM CUR c LEFT JOIN PREV p ON c.doc_id = p.doc_id WHERE p.doc_id IS NULL OR p.text <> c.text""")
def _(v):
    base = f"{scratch_dir(v.spark)}/reindex-{uuid.uuid4().hex}"
    flows.create_store(v.PREV, base + "/store")
    return flows.stream_reindex(staged(v, v.CUR), base + "/store", base + "/out").select("doc_id", "status")


@query("r8_stream_spikes", sql="""WITH RECURSIVE
c AS (SELECT event_type, date_trunc('hour', ts) AS b, count(*) AS n, row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('hour', ts)) AS rn FROM events GROUP BY 1, 2),
r AS (SELECT event_type, b, n, rn, n::DOUBLE AS ewma, false AS is_spike FROM c WHERE rn = 1
  UNION ALL SELECT c.event_type, c.b, c.n, c.rn, 0.3 * c.n + 0.7 * r.ewma, c.n > 3.0 * r.ewma FROM r JOIN c ON c.event_type = r.event_type AND c.rn = r.rn + 1)
SELECT r.event_type, strftime(r.b, '%Y-%m-%d %H') AS bucket, r.n, round(ewma, 6) AS ewma, is_spike FROM r""")
def _(v):
    d = flows.run_available(flows.stream_spikes(all_events(v), "event_type"))
    return d.select("event_type", F.date_format(F.timestamp_micros("bucket"), "yyyy-MM-dd HH").alias("bucket"), "n", F.round("ewma", 6).alias("ewma"), "is_spike")


@query("s15_stream_source", sql="SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(v):
    return flows.run_available(events(v)).groupBy("event_type").agg(F.count("*").alias("n"))
