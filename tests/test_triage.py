"""Worked rule examples and routing."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mailsieve.functions import jsonx as J
from mailsieve.functions import mime as H
from mailsieve.operators import intents, rules, triage
from mailsieve.operators import schedule as S
from mailsieve.operators.responses import validate_responses
from mailsieve.schemas import EMAIL_ENVELOPE


def mail(spark, **fields):
    base = dict(message_id="m", from_email="ann@company.com", from_name="Ann", subject="", body="", headers={}, attachments=[], auth={})
    return spark.createDataFrame([tuple({**base, **fields}[n] for n in EMAIL_ENVELOPE.names)], EMAIL_ENVELOPE)


def decide(spark, pack, **fields):
    return triage.deterministic_filter(mail(spark, **fields), pack, labels=rules.DEFAULT_LABELS, block_unmapped=True).first()


def test_keep_scores_nine(spark):
    r = decide(spark, rules.default_rulepack(), subject="Address change request",
               body="Hi HR, I moved to 42 Cedar Ave on Nov 12. Can you update my records?")
    assert (r["soft_score"], r["decision"]) == (9, "HR-REQUEST")
    assert r["matched_signals"] == ["direct_request", "hr_employment_data", "subject_request"]


def test_leave_question_scores_five(spark):
    r = decide(spark, rules.default_rulepack(), subject="Question about leave", body="How many sick days do I have left?")
    assert (r["soft_score"], r["decision"]) == (5, "REVIEW")


def test_mailing_list_is_dropped(spark):
    r = decide(spark, rules.default_rulepack(), subject="Webinar: Future of Benefits Platforms - Exclusive Offer",
               headers={"List-Unsubscribe": "<x>"})
    assert r["hard_block"] and r["decision"] == "IRRELEVANT" and r["email_type"] == "mailing_list"


def test_unmapped_hit_sets_reason_only(spark):
    pack = rules.RulePack(hard=(rules.HardRule("subject", "contains", "stop", "custom"),), thresholds=rules.BALANCED)
    r = triage.deterministic_filter(mail(spark, subject="Please STOP"), pack).first()
    assert not r["hard_block"] and r["hard_reason"] == "subject:contains" and r["decision"] == "IRRELEVANT"


def test_reversed_band_is_swapped(spark):
    c = triage.R.decide(F.col("s"), {"keep": 9, "triage_min": 5, "triage_max": 4}, triage.LABELS)
    d = spark.createDataFrame([(3,), (4,), (5,), (9,)], "s int").select(c.alias("d"))
    assert [r["d"] for r in d.collect()] == ["IRRELEVANT", "HUMAN", "HUMAN", "KEEP"]


def test_caps_per_signal_name(spark):
    signals = [rules.Signal("a", "any", "contains", "x", 2, 1), rules.Signal("a", "any", "contains", "y", 2, 1), rules.Signal("b", "any", "regex", "z", 1)]
    r = rules.eval_soft(mail(spark, subject="x y z"), signals).first()["soft"]
    assert (r["score"], r["matched"]) == (3, ["a", "b"])


def test_header_prefix_and_extension(spark):
    auto = rules.HardRule("headers", "equals", "Auto-Submitted:auto", "auto_reply")
    exe = rules.HardRule("attachments", "ext_in", "exe, bat", "safety_block")
    d = mail(spark, subject="s", headers={"Auto-Submitted": "Auto-Replied"}, attachments=["Run.EXE"])
    r = d.select(rules.hard_condition(auto).alias("a"), rules.hard_condition(exe).alias("b")).first()
    assert r["a"] and r["b"]


def test_literal_rules_are_escaped(spark):
    d = rules.apply_rules(mail(spark, subject="cost (net) $5"), [dict(rule_id="1", rule_type="subject", rule_pattern="(NET) $5", action="x", priority=1)])
    assert d.first()["custom"]["matches"][0]["sample"] == "(net) $5"


def test_blank_mail_leaves(spark):
    assert triage.normalize_email(mail(spark, subject=" ", body="\n")).count() == 0


def test_missing_rule_columns(spark):
    with pytest.raises(ValueError, match="rule_pattern"):
        rules.load_rules(spark.createDataFrame([("a",)], "type string"))


def test_referee_error_mode(spark):
    d = spark.createDataFrame([("a", 0.1)], "category string, confidence double")
    with pytest.raises(PySparkException):
        triage.referee_gate(d, ["a"], behavior="error").collect()


def test_intent_presets():
    assert intents.actionable_intents("hr_intents") == ["information_request", "action_request", "status_inquiry"]
    assert len(intents.preset("customer_intents")) == 9 and len(intents.preset("nothing")) == 4
    assert "- request: General request or inquiry (actionable)" in intents.intent_prompt(intents.preset("minimal_intents"))


def test_schedule_rows(spark):
    rows = [("Nightly ETL", 0.5, 0, 2, True, False), ("BigJob", 0.2, 200, 2, False, True), ("QuickJob", 2.0, 5, 1, False, False)]
    d = spark.createDataFrame(rows, "schedule string, now_diff double, current_duration long, max_run_hours int, critical_armed boolean, extended_armed boolean")
    got = {(r["schedule"], r["alert"]) for r in S.alert_rows(d).collect()}
    assert got == {("Nightly ETL", "MissedScheduleNotification"), ("BigJob", "ExtendedExecutionNotification")}
    assert S.schedule_alerts(d).first()["overdue_min"] == 720.0


def test_response_checks(spark):
    d = spark.createDataFrame([("", "what is this"), ("this is what it is", "what is this")], "a string, q string")
    bad, good = validate_responses(d, "a", "q").collect()
    assert bad["confidence_score"] == 0.1 and bad["issues"] == ["Response is empty", "Response may not address the query"]
    assert good["confidence_score"] == 1.0 and good["is_valid"]


def test_json_csv_sample(spark):
    from mailsieve.sources.json_csv import json_to_csv

    text = '[{"id": 1, "user": {"name": "A, B"}, "tags": ["x"]}, {"id": 2, "user": {}, "z": "q\\"r"}, 5]'
    t = json_to_csv(spark.createDataFrame([(0, text)], "k int, j string"), "k", "j")
    assert t.header == ["id", "user.name", "tags[0]", "user", "z"]
    assert [r["line"] for r in t.lines.orderBy("pos").collect()] == ['1,"A, B",x,,', '2,,,,"q""r"']
    assert [(r["key"], r["pos"], r["error"]) for r in t.errors.collect()] == [(0, 2, "element is not an object")]


def test_context_shapes(spark):
    rows = [(1, '{"contexts": {"contexts": [{"text": "a"}]}}'), (2, '{"contexts": [{"text": "b"}]}'), (3, '{"x": [{"contexts": [{"chunkText": "c"}]}]}'),
            (4, '{"contexts": []}'), (5, "broken"), (6, '{"x": {"contexts": [{"other": 1}]}}')]
    d = J.parse_contexts(spark.createDataFrame(rows, "k int, j string"), "j", "k")
    assert sorted((r["k"], r["id"], r["text"]) for r in d.collect()) == [(1, "ctx-1", "a"), (2, "ctx-1", "b"), (3, "ctx-1", "c")]


def test_url_escaping(spark):
    d = spark.createDataFrame([("a b*~+é/",)], "c string")
    assert d.select(H.url_component(F.col("c")).alias("u")).first()["u"] == "a%20b%2A~%2B%C3%A9%2F"
