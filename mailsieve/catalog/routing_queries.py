"""Confidence routing, gates, prompts and intents over predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsieve.catalog.sqlkit import q
from mailsieve.operators import intents as I
from mailsieve.operators import triage as T
from mailsieve.registry import query


@query("p14_route_triage", "PRED", sql="""
SELECT doc_id, decision, ((decision = 'KEEP' AND confidence >= 0.6) OR decision = 'HUMAN') AS should_continue,
  (decision = 'IRRELEVANT' AND confidence >= 0.85) AS short_circuit, decision IN ('KEEP', 'IRRELEVANT') AS custom_continue,
  ((decision = 'KEEP' AND confidence >= 0.75) OR decision = 'HUMAN') AS strict_continue FROM PRED""")
def _(v):
    d = T.route_triage(v.PRED).withColumnRenamed("should_continue", "c0")
    d = T.route_triage(d, decisions={"KEEP": True, "HUMAN": False, "IRRELEVANT": True}).withColumnRenamed("should_continue", "custom_continue")
    d = T.route_triage(d, "conservative").withColumnRenamed("should_continue", "strict_continue")
    d = T.route_triage(d)
    return d.select("doc_id", "decision", F.col("c0").alias("should_continue"), "short_circuit", "custom_continue", "strict_continue")


@query("p15_route_intent", "PRED", sql="""
i AS (SELECT doc_id, CASE WHEN confidence < 0.7 THEN 'unknown' ELSE intent END AS signals_intent FROM PRED)
SELECT doc_id, signals_intent, signals_intent IN ('information_request', 'action_request', 'status_inquiry') AS is_actionable FROM i""")
def _(v):
    return T.route_intent(v.PRED, I.actionable_intents("hr_intents")).select("doc_id", "signals_intent", "is_actionable")


@query("p16_referee_gate", "PRED", sql="""
SELECT doc_id, CASE WHEN confidence < 0.25 THEN 'Other' WHEN category IN ('cat_0', 'cat_1', 'cat_2', 'cat_3') THEN category ELSE 'Other' END AS chosen,
  CASE WHEN category IN ('cat_0', 'cat_1', 'cat_2', 'cat_3') THEN category ELSE 'Other' END AS chosen_low,
  confidence >= 0.25 AS pass_to_responder, CASE WHEN confidence < 0.25 THEN 'low_confidence' END AS gate_reason,
  CASE WHEN confidence < 0.25 THEN 'check_fallback' ELSE 'proceed' END AS gate_hint FROM PRED""")
def _(v):
    cats = ["cat_0", "cat_1", "cat_2", "cat_3"]
    d = T.referee_gate(v.PRED, cats, behavior="return_low").withColumnRenamed("chosen", "chosen_low")
    return T.referee_gate(d, cats).select("doc_id", "chosen", "chosen_low", "pass_to_responder", "gate_reason", "gate_hint")


@query("p17_generator_gate", "PRED", sql="""
SELECT doc_id, (email_type = 'direct_request' AND intent = 'information_request' AND confidence >= 0.6 AND NOT safety_blocked) AS pass_to_responder,
  CASE WHEN safety_blocked THEN 'safety_blocked' WHEN email_type <> 'direct_request' THEN 'not_direct_request'
    WHEN intent <> 'information_request' THEN 'intent_not_eligible' WHEN confidence < 0.6 THEN 'low_confidence' END AS block_reason,
  CASE WHEN confidence >= 0.6 THEN 'proceed' ELSE 'check_fallback' END AS generator_hint FROM PRED""")
def _(v):
    return T.generator_gate(v.PRED).select("doc_id", "pass_to_responder", "block_reason", "generator_hint")


@query("p18_route_confidence", "PRED", sql="""
SELECT doc_id, CASE WHEN confidence >= 0.8 THEN 'automate' WHEN confidence >= 0.6 THEN 'draft' ELSE 'human' END AS route,
  CASE WHEN confidence >= 0.8 THEN 'import' WHEN confidence >= 0.6 THEN 'review_flag' ELSE 'human_review' END AS tier FROM PRED""")
def _(v):
    d = T.route_confidence(v.PRED)
    return T.route_confidence(d, T.IMPORT_BANDS, out="tier").select("doc_id", "route", "tier")


DEFAULT = "Answer in JSON."
TONE = "CASE doc_id % 4 " + " ".join(
    f"WHEN {n} THEN {q(I.SYSTEM_TEMPLATES[k].rstrip() + chr(10) * 2 + DEFAULT)}" for n, k in enumerate(I.SYSTEM_TEMPLATES)
) + " ELSE 'Own prompt ' || doc_id END"
STYLE = "CASE intent " + " ".join(f"WHEN {q(k)} THEN {q(chr(10) + 'Response style: ' + s)}" for k, s in I.INTENT_STYLE.items()) + " ELSE '' END"


@query("f35_resolve_prompts", "PRED", sql=f"""
SELECT doc_id, {TONE} || chr(10) || chr(10) || 'Domain context: This is a ' || category || ' inquiry.' || {STYLE} AS prompt,
  CASE WHEN confidence > 0.8 THEN 0.0 WHEN confidence > 0.6 THEN 0.3 ELSE 0.5 END::DOUBLE AS temperature FROM PRED""")
def _(v):
    names = list(I.SYSTEM_TEMPLATES)
    t = F.lit("custom")
    for n, k in enumerate(names):
        t = F.when(F.col("doc_id") % 4 == n, k).otherwise(t)
    own = F.concat(F.lit("Own prompt "), F.col("doc_id").cast("string"))
    prompt = I.enrich_prompt(I.system_prompt(t, DEFAULT, own), F.col("category"), F.col("intent"))
    return v.PRED.select("doc_id", prompt.alias("prompt"), I.temperature(F.col("confidence")).alias("temperature"))


LINES = {r["intent"]: f"- {r['intent']}: {r['description']} {'(actionable)' if r['actionable'] else '(requires human)'}" for r in I.preset("hr_intents")}


@query("f36_intent_prompt", "PRED", sql=f"""
SELECT intent, CASE intent {' '.join(f'WHEN {q(k)} THEN {q(x)}' for k, x in LINES.items())} END AS line, count(*) AS n FROM PRED GROUP BY 1, 2""")
def _(v):
    rows = v.spark.createDataFrame(
        [(line[2:].split(":")[0], line) for line in I.intent_prompt(I.preset("hr_intents")).splitlines() if line.startswith("- ")],
        "intent string, line string",
    )
    return v.PRED.join(F.broadcast(rows), "intent").groupBy("intent", "line").agg(F.count("*").alias("n"))


TEMPLATE_ROWS = [("t1", "greeting", "Welcome", "Hello {{query}}", True), ("t2", "Closing", "bye", "Bye", True), ("t3", "apology", "Sorry", "Sorry", False)]


@query("s10_resolve_template", "PRED", sql="""
t AS (SELECT * FROM (VALUES ('t1', 'greeting', 'Welcome', 'Hello {{query}}', true), ('t2', 'Closing', 'bye', 'Bye', true), ('t3', 'apology', 'Sorry', 'Sorry', false)) x(record_id, value, display, content, active)),
s AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'greeting' WHEN 1 THEN 'Closing' WHEN 2 THEN 'apology' ELSE 'nothing' END AS pick FROM PRED)
SELECT s.doc_id, s.pick, t.record_id, t.display, t.content FROM s LEFT JOIN t ON s.pick = t.value""")
def _(v):
    from mailsieve.sources.tables import resolve_template

    t = v.spark.createDataFrame(TEMPLATE_ROWS, "record_id string, value string, display string, content string, active boolean")
    k = F.col("doc_id") % 4
    s = v.PRED.select("doc_id", F.when(k == 0, "greeting").when(k == 1, "Closing").when(k == 2, "apology").otherwise("nothing").alias("pick"))
    return resolve_template(t, s, "pick", value_field="value").select("doc_id", "pick", "record_id", "display", "content")
