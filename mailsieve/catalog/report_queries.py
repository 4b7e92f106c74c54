"""Outcome reports, schedules, contractors and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsieve.operators import contractors as CR
from mailsieve.operators import graph as G
from mailsieve.operators import lanes
from mailsieve.operators import quality as Q
from mailsieve.operators import schedule as S
from mailsieve.registry import query

OUT = """x AS (SELECT *, CASE WHEN blocked THEN 'blocked' WHEN rating >= 4 THEN 'accepted' WHEN rating = 3 THEN 'edited' ELSE 'rejected' END AS outcome,
  CASE WHEN confidence IS NULL THEN 'legacy' ELSE 'modern' END AS cohort FROM O)"""


@query("a27_outcome_funnel", "O", sql=OUT + """
SELECT cohort, count(*) AS inbound, count(*) FILTER (outcome <> 'blocked') AS generated, count(*) FILTER (outcome = 'accepted') AS accepted,
  count(*) FILTER (outcome = 'edited') AS edited, count(*) FILTER (outcome = 'rejected') AS rejected, count(*) FILTER (outcome = 'blocked') AS blocked FROM x GROUP BY 1""")
def _(v):
    return Q.outcome_funnel(v.O)


@query("a28_calibration", "O", sql=OUT + """
SELECT round(least(floor(round(confidence * 5, 6)), 4) / 5, 6) AS bucket, count(*) AS n, round(avg((outcome = 'accepted')::INT), 6) AS accept_rate,
  round(avg(confidence), 6) AS avg_confidence, count(*) FILTER (outcome = 'rejected' AND confidence >= 0.8) AS bad_but_confident FROM x WHERE confidence IS NOT NULL GROUP BY 1""")
def _(v):
    return Q.calibration(v.O)


@query("a29_quality_tiers", "O", sql="""
t AS (SELECT week, CASE WHEN blocked OR grounded = 0 OR coalesce(confidence, 0) < 0.4 THEN 'C' WHEN confidence >= 0.8 AND edit_share <= 0.2 THEN 'A' ELSE 'B' END AS tier FROM O)
SELECT week, count(*) AS n, round(avg((tier = 'A')::INT), 6) AS tier_a, round(avg((tier = 'B')::INT), 6) AS tier_b, round(avg((tier = 'C')::INT), 6) AS tier_c FROM t GROUP BY 1""")
def _(v):
    return Q.quality_tiers(v.O)


@query("a30_scorecard", "O", sql=OUT + """
SELECT week, cohort, count(*) AS emails, round(avg((outcome = 'accepted')::INT), 6) AS acceptance_rate, round(avg((outcome = 'edited')::INT), 6) AS edit_rate,
  round(avg((outcome = 'blocked')::INT), 6) AS block_rate, round(avg(rating), 6) AS avg_rating, round(avg((outcome = 'accepted')::INT) FILTER (confidence >= 0.7), 6) AS acceptance_at_threshold,
  quantile_cont(latency_ms, 0.5)::DOUBLE AS median_latency FROM x GROUP BY 1, 2""")
def _(v):
    return Q.scorecard(v.O)


@query("a30_failure_drivers", "O", sql=OUT + """
SELECT driver, count(*) AS n FROM (SELECT unnest([CASE WHEN blocked THEN 'policy_block' END, CASE WHEN grounded = 0 THEN 'missing_context' END,
  CASE WHEN confidence < 0.4 THEN 'low_confidence' END, CASE WHEN edit_share > 0.5 THEN 'heavy_edits' END, 'category:' || category]) AS driver FROM x WHERE outcome IN ('rejected', 'blocked')) d
WHERE driver IS NOT NULL GROUP BY 1 ORDER BY n DESC, driver LIMIT 5""")
def _(v):
    return Q.failure_drivers(v.O)


@query("a31_stratified_sample", "O", sql="""
SELECT doc_id, category, week FROM (SELECT *, row_number() OVER (PARTITION BY category, week ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS rk FROM O) x WHERE rk <= 3""")
def _(v):
    return Q.stratified_sample(v.O, ["category", "week"], "doc_id", 3).select("doc_id", "category", "week")


@query("a33_gate_report", "O", sql=OUT + """,
m AS (SELECT 'grounding' AS gate, avg(grounded)::DOUBLE AS value, 0.95::DOUBLE AS target, true AS floor FROM x
UNION ALL SELECT 'coverage', avg((outcome <> 'blocked')::INT), 0.85, true FROM x UNION ALL SELECT 'hallucination', avg((outcome = 'rejected')::INT), 0.05, false FROM x
UNION ALL SELECT 'satisfaction', avg(rating), 4, true FROM x UNION ALL SELECT 'p90_ms', quantile_cont(latency_ms, 0.9), 6000, false FROM x
UNION ALL SELECT 'p99_ms', quantile_cont(latency_ms, 0.99), 10000, false FROM x UNION ALL SELECT 'edit_median', quantile_cont(edit_share, 0.5), 0.2, false FROM x)
SELECT gate, round(value, 6) AS value, target, CASE WHEN floor THEN value >= target ELSE value <= target END AS passed FROM m""")
def _(v):
    return Q.gate_report(v.O)


DIFF = "CASE WHEN now_diff < 1 THEN now_diff * 1440 ELSE now_diff END"
AL = f"a AS (SELECT *, round({DIFF}, 2) AS overdue_min, (critical_armed AND {DIFF} >= 15) AS missed, (extended_armed AND current_duration > max_run_hours * 60) AS extended FROM M)"


@query("a37_schedule_alerts", "M", sql=AL + " SELECT event_id, overdue_min, missed, extended FROM a")
def _(v):
    return S.schedule_alerts(v.M).select("event_id", "overdue_min", "missed", "extended")


@query("f52_overdue_minutes", "M", sql=f"SELECT event_id, round({DIFF}, 2) AS minutes FROM M")
def _(v):
    return v.M.select("event_id", F.round(S.overdue_minutes(F.col("now_diff")), 2).alias("minutes"))


@query("a36_schedule_trends", "M", sql=AL + """
SELECT CAST(ts::DATE AS VARCHAR) AS "Day", schedule AS "Schedule", machine AS "Machine", count(*) AS "Samples", count(*) FILTER (missed) AS "Missed", count(*) FILTER (extended) AS "Extended",
  round(avg(overdue_min), 6) AS "AvgOverdueMin", round(quantile_cont(overdue_min, 0.95), 6) AS "P95OverdueMin", max(current_duration) AS "MaxDurationMin" FROM a GROUP BY 1, 2, 3""")
def _(v):
    return S.schedule_trends(v.M)


@query("w8_dedupe_alerts", "M", sql=f"""--recursive
{AL}, e AS (SELECT event_id, schedule, ts, row_number() OVER (PARTITION BY schedule ORDER BY ts, event_id) AS rn FROM a WHERE missed),
r AS (SELECT event_id, schedule, rn, ts AS fired, true AS fire FROM e WHERE rn = 1
  UNION ALL SELECT e.event_id, e.schedule, e.rn, CASE WHEN e.ts - r.fired >= INTERVAL 6 HOUR THEN e.ts ELSE r.fired END, e.ts - r.fired >= INTERVAL 6 HOUR FROM r JOIN e ON e.schedule = r.schedule AND e.rn = r.rn + 1)
SELECT event_id, schedule FROM r WHERE fire""")
def _(v):
    return S.dedupe_alerts(S.schedule_alerts(v.M).where("missed"), "schedule", 6 * 3600)


ASOF = "(SELECT max(interaction_date) FROM INTER)"
METR = f"""p AS (SELECT contractor_id, max(CASE WHEN interaction_type = '1x1_manager_contractor' THEN interaction_date END) AS last_1x1_date,
  max(CASE WHEN interaction_type IN ('client_stakeholder_meeting', 'client_escalation', 'client_kudos') THEN interaction_date END) AS last_client_feedback_date,
  count(*) FILTER (interaction_type = 'client_escalation' AND interaction_date >= {ASOF} - 30) AS escalations_30d, count(*) FILTER (interaction_type = 'client_kudos' AND interaction_date >= {ASOF} - 30) AS kudos_30d FROM INTER GROUP BY 1),
m AS (SELECT c.*, last_1x1_date, last_client_feedback_date, coalesce(escalations_30d, 0) AS escalations_30d, coalesce(kudos_30d, 0) AS kudos_30d,
  status = 'Active' AND (pip_status = 'Formal PIP' OR risk_flag = 'At risk' OR (coalesce(escalations_30d, 0) >= 1 AND coalesce(kudos_30d, 0) = 0)) AS at_risk,
  status = 'Active' AND (last_1x1_date IS NULL OR {ASOF} - last_1x1_date > 30) AS out_of_cadence FROM CONTR c LEFT JOIN p ON c.contractor_id = p.contractor_id)"""


def metrics(v):
    i = v.INTER
    asof = i.agg(F.max("interaction_date")).scalar()
    return CR.contractor_metrics(v.CONTR, i, asof)


@query("j12_recent_interactions", "CONTR INTER", sql=f"""
SELECT c.contractor_id, c.manager_id, i.interaction_id, i.interaction_type FROM CONTR c LEFT JOIN INTER i ON c.contractor_id = i.contractor_id AND i.interaction_date BETWEEN {ASOF} - 30 AND {ASOF}""")
def _(v):
    i = v.INTER
    recent = CR.recent_interactions(i, i.agg(F.max("interaction_date")).scalar())
    return v.CONTR.join(recent, "contractor_id", "left").select("contractor_id", "manager_id", "interaction_id", "interaction_type")


@query("a38_contractor_metrics", "CONTR INTER", sql=METR + """
SELECT contractor_id, CAST(last_1x1_date AS VARCHAR) AS last_1x1_date, CAST(last_client_feedback_date AS VARCHAR) AS last_client_feedback_date, escalations_30d, kudos_30d, at_risk, out_of_cadence FROM m""")
def _(v):
    return metrics(v).select(
        "contractor_id", F.col("last_1x1_date").cast("string").alias("last_1x1_date"),
        F.col("last_client_feedback_date").cast("string").alias("last_client_feedback_date"), "escalations_30d", "kudos_30d", "at_risk", "out_of_cadence",
    )


ROLL = """SELECT {k}, count(*) FILTER (status = 'Active') AS active, count(*) FILTER (at_risk) AS at_risk,
  round(count(*) FILTER (status = 'Active' AND NOT out_of_cadence)::DOUBLE / nullif(count(*) FILTER (status = 'Active'), 0), 6) AS coverage_1x1,
  sum(escalations_30d)::BIGINT AS escalations, sum(kudos_30d)::BIGINT AS kudos, round(sum(escalations_30d) / nullif(sum(kudos_30d), 0), 6)::DOUBLE AS escalation_ratio FROM m GROUP BY 1"""


@query("a39_engagement_health", "CONTR INTER", sql=METR + " " + ROLL.format(k="engagement_id"))
def _(v):
    return CR.engagement_health(metrics(v))


@query("a39_client_health", "CONTR INTER", sql=METR + " " + ROLL.format(k="client"))
def _(v):
    return CR.client_health(metrics(v))


@query("a39_manager_coverage", "CONTR INTER", sql=METR + " " + ROLL.format(k="manager_id"))
def _(v):
    return CR.manager_coverage(metrics(v))


# --- graphs -----------------------------------------------------------------------------------


def defined(v):
    return v.t("nation").select(F.col("n_nationkey").alias("id"))


@query("j9_undefined_calls", "G", sql="SELECT dst, count(*) AS call_sites, min(src) AS first_caller FROM G WHERE dst NOT IN (SELECT n_nationkey FROM nation) GROUP BY 1")
def _(v):
    return G.undefined_calls(v.G, defined(v))


@query("j9_unused", "G", sql="SELECT n_nationkey + 100 AS id FROM nation WHERE n_nationkey + 100 NOT IN (SELECT dst FROM G) UNION ALL SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT dst FROM G)")
def _(v):
    more = defined(v).unionByName(defined(v).select((F.col("id") + 100).alias("id")))
    return G.unused(more, v.G)


@query("x2_set_diff", "G", sql="""
SELECT 'called_not_defined' AS side, dst AS id FROM (SELECT DISTINCT dst FROM G) x WHERE dst NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'caller_not_called', src FROM (SELECT DISTINCT src FROM G) y WHERE src NOT IN (SELECT dst FROM G WHERE kind <> 'call')""")
def _(v):
    called = v.G.select(F.col("dst").alias("id"))
    a = lanes.set_diff(called, defined(v), "id").select(F.lit("called_not_defined").alias("side"), "id")
    other = v.G.where("kind <> 'call'").select(F.col("dst").alias("id"))
    b = lanes.set_diff(v.G.select(F.col("src").alias("id")), other, "id").select(F.lit("caller_not_called").alias("side"), "id")
    return a.unionByName(b)


@query("a40_graph_stats", "G", sql="""
SELECT kind, count(*) AS edges, count(DISTINCT src) AS callers, count(DISTINCT dst) AS callees,
  (SELECT count(DISTINCT x) FROM (SELECT src AS x, kind AS k FROM G UNION ALL SELECT dst, kind FROM G) n WHERE n.k = G.kind) AS nodes FROM G GROUP BY 1""")
def _(v):
    return G.graph_stats(v.G)


@query("a40_owner_surface", "L", sql="SELECT job_id, count(DISTINCT action) AS endpoints, count(DISTINCT event_type) AS verbs, count(*) AS calls FROM L GROUP BY 1")
def _(v):
    return G.owner_surface(v.L, "job_id", "action", "event_type")


@query("a40_issue_counts", "L", sql="SELECT severity, http_status, count(*) AS issues, count(DISTINCT job_id) AS owners FROM L WHERE severity <> 'INFO' GROUP BY 1, 2")
def _(v):
    return G.issue_counts(v.L.where("severity != 'INFO'"), "severity", "http_status", "job_id")


@query("a41_call_cycles", "G", sql="""--recursive
p(src, dst) AS (SELECT src, dst FROM G UNION SELECT p.src, g.dst FROM p JOIN G g ON p.dst = g.src),
c AS (SELECT a.src AS node, min(a.dst) AS component, count(DISTINCT a.dst) AS size FROM p a JOIN p b ON a.src = b.dst AND a.dst = b.src GROUP BY 1)
SELECT node, component, size FROM c""")
def _(v):
    return G.call_cycles(v.G).select("node", "component", F.col("size").cast("long").alias("size"))


@query("s3_list_tree", "FILES", sql="""--recursive
t(folder, depth) AS (SELECT 0::BIGINT, 1 UNION ALL SELECT f.folder_id, t.depth + 1 FROM t JOIN FILES f ON f.parent_id = t.folder )
SELECT t.depth, f.page_id AS id, f.parent_id, f.mime FROM t JOIN FILES f ON f.parent_id = t.folder WHERE f.mime <> 'image/png'""")
def _(v):
    f = v.FILES
    folders = f.select(F.col("folder_id").alias("id"), "parent_id")
    files = f.select(F.col("page_id").alias("id"), "parent_id", "mime")
    return G.list_tree(folders, files, 0, keep=F.col("mime") != "image/png").select("depth", "id", "parent_id", "mime")
