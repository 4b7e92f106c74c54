"""Envelope normalisation, the deterministic filter, and confidence routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.functions.text import blank, strip
from mailsieve.operators import rules as R

LABELS = {"keep": "KEEP", "review": "HUMAN", "drop": "IRRELEVANT"}
# fixed values: hard reason -> (e-mail type, decision, name of the configurable override)
REASON_TYPES = {
    "forwarded_chain": ("forwarded_chain", "HUMAN", "forwarded_action"),
    "email_chains": ("forwarded_chain", "HUMAN", "forwarded_action"),
    "automated": ("automated", "IRRELEVANT", "automated_action"),
    "auto_reply": ("automated", "IRRELEVANT", "automated_action"),
    "noreply": ("automated", "IRRELEVANT", "automated_action"),
    "newsletter": ("newsletter", "IRRELEVANT", "newsletter_action"),
    "marketing": ("newsletter", "IRRELEVANT", "newsletter_action"),
    "system": ("system_notification", "IRRELEVANT", None),
    "notification": ("system_notification", "IRRELEVANT", None),
    "automated_report": ("system_notification", "IRRELEVANT", None),
    "calendar": ("calendar_invite", "IRRELEVANT", None),
    "ticket_update": ("support_ticket", "HUMAN", None),
    "bounce": ("bounce", "IRRELEVANT", None),
    "mailing_list": ("mailing_list", "IRRELEVANT", None),
    "safety_block": ("blocked", "HUMAN", None),
    "internal_discussion": ("internal_discussion", "HUMAN", None),
}
# fixed values: confidence presets (minimum to keep, minimum to short-circuit, referee minimum)
CONFIDENCE_PRESETS = {
    "conservative": (0.75, 0.90, 0.40),
    "balanced": (0.60, 0.85, 0.25),
    "aggressive": (0.45, 0.75, 0.15),
}
REFEREE_MINIMUM = {"strict": 0.40, "balanced": 0.25, "permissive": 0.10}
INTENT_THRESHOLD = 0.70


def normalize_email(df: DataFrame) -> DataFrame:
    """Null-free envelope with the combined text; messages with neither subject nor body leave (see
    ``blank_messages``)."""
    s, b = blank(F.col("subject")), blank(F.col("body"))
    parts = F.array_compact(
        F.array(
            F.when(strip(s) != "", F.concat(F.lit("Subject: "), strip(s))),
            F.when(strip(b) != "", F.concat(F.lit("Body:\n"), strip(b))),
        )
    )
    d = df.withColumn("subject", s).withColumn("body", b)
    return d.where((strip(s) != "") | (strip(b) != "")).withColumn("email_text", F.array_join(parts, "\n\n"))


def blank_messages(df: DataFrame) -> DataFrame:
    """The reject lane of ``normalize_email``: messages with neither subject nor body."""
    s, b = blank(F.col("subject")), blank(F.col("body"))
    return df.where((strip(s) == "") & (strip(b) == "")).withColumn("reason", F.lit("blank_message"))


def deterministic_filter(
    emails: DataFrame, pack: R.RulePack | None = None, thresholds: Mapping[str, int] | str = "balanced",
    type_mapping: Mapping[str, str] | None = None, labels: Mapping[str, str] | None = None,
    block_unmapped: bool = False,
) -> DataFrame:
    """Hard rules, then weighted signals, then a decision.  One scan stage; nothing shuffles.

    Thresholds of the pack win over the preset.  A hard hit whose action has no mapped type sets the
    reason without blocking, unless ``block_unmapped``.
    """
    lab = {**LABELS, **(labels or {})}
    d = normalize_email(emails)
    if pack is None:
        return _gate(
            d.withColumn("email_type", F.lit("direct_request")).withColumn("hard_block", F.lit(False))
            .withColumn("hard_reason", F.lit(None).cast("string")).withColumn("excluded_pattern", F.lit(None).cast("string"))
            .withColumn("soft_score", F.lit(0)).withColumn("matched_signals", F.array().cast("array<string>"))
            .withColumn("decision", F.lit("KEEP"))
        )
    base = R.THRESHOLD_PRESETS[thresholds] if isinstance(thresholds, str) else thresholds
    limits = {**base, **pack.thresholds}
    d = d.withColumn("__hard", R.eval_hard(pack))
    reason = F.when(
        F.col("__hard.action").isin([a for a in REASON_TYPES if a not in R.ACTION_LANE]) & F.lit(block_unmapped),
        F.col("__hard.action"),
    ).otherwise(F.col("__hard.reason"))
    d = d.withColumn("hard_reason", reason).withColumn("excluded_pattern", F.col("__hard.action"))
    etype = verdict = F.lit(None).cast("string")
    for name, (kind, decision, override) in REASON_TYPES.items():
        lane = (type_mapping or {}).get(override, decision) if override else decision
        hit = F.col("hard_reason") == name
        etype, verdict = F.when(hit, kind).otherwise(etype), F.when(hit, lane).otherwise(verdict)
    d = d.withColumn("__type", etype).withColumn("__verdict", verdict)
    d = d.withColumn("hard_block", F.col("__type").isNotNull()).withColumn(
        "email_type", F.coalesce("__type", F.lit("direct_request"))
    )
    d = R.eval_soft(d, pack.soft, "__soft")
    score = F.when(F.col("hard_block"), 0).otherwise(F.col("__soft.score"))
    d = d.withColumn("soft_score", score).withColumn(
        "matched_signals",
        F.when(F.col("hard_block"), F.array().cast("array<string>")).otherwise(F.col("__soft.matched")),
    )
    d = d.withColumn("decision", F.coalesce("__verdict", R.decide(F.col("soft_score"), limits, lab)))
    return _gate(d.drop("__hard", "__type", "__verdict", "__soft"))


def _gate(d: DataFrame) -> DataFrame:
    return (
        d.withColumn("prelim_pass", ~F.col("hard_block") & (F.col("email_type") == "direct_request"))
        .withColumn("generator_hint", F.when(F.col("hard_block"), "blocked").otherwise("check_policy"))
        .withColumn("passed", ~F.col("hard_block"))
    )


# --- routing ----------------------------------------------------------------------------------


def clamp01(c: Column) -> Column:
    return F.least(F.greatest(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def route_triage(
    df: DataFrame, preset: str = "balanced", decisions: Mapping[str, bool] | None = None, decision: str = "decision",
    confidence: str = "confidence",
) -> DataFrame:
    """Continue and short-circuit flags; ``decisions`` replaces the standard continue rule."""
    keep, short, _ = CONFIDENCE_PRESETS[preset]
    dec, conf = F.coalesce(F.col(decision), F.lit("HUMAN")), clamp01(F.col(confidence))
    if decisions is None:
        go = ((dec == "KEEP") & (conf >= keep)) | (dec == "HUMAN")
    else:
        go = dec.isin([k for k, v in decisions.items() if v])
    return (
        df.withColumn("signals_triage", dec).withColumn("signals_confidence", conf)
        .withColumn("should_continue", go)
        .withColumn("short_circuit", (dec == "IRRELEVANT") & (conf >= short))
    )


def route_intent(
    df: DataFrame, actionable: Sequence[str], threshold: float = INTENT_THRESHOLD, intent: str = "intent",
    confidence: str = "confidence",
) -> DataFrame:
    conf = clamp01(F.col(confidence))
    final = F.when(conf < threshold, "unknown").otherwise(F.coalesce(F.col(intent), F.lit("unknown")))
    return df.withColumn("signals_intent", final).withColumn("is_actionable", F.col("signals_intent").isin(list(actionable)))


def referee_gate(
    df: DataFrame, allowed: Sequence[str], preset: str | float = "balanced", fallback: str = "Other",
    behavior: str = "use_fallback", category: str = "category", confidence: str = "confidence",
) -> DataFrame:
    """Invalid categories fall back; low confidence falls back, stays, or raises."""
    minimum = REFEREE_MINIMUM[preset] if isinstance(preset, str) else float(preset)
    conf = clamp01(F.col(confidence))
    valid = F.when(F.col(category).isin(list(allowed)), F.col(category)).otherwise(fallback)
    low = conf < minimum
    chosen = F.when(low & F.lit(behavior == "use_fallback" and bool(fallback)), fallback).otherwise(valid)
    d = df.withColumn("chosen", chosen).withColumn("pass_to_responder", ~low)
    d = d.withColumn("gate_reason", F.when(low, "low_confidence")).withColumn(
        "gate_hint", F.when(low, "check_fallback").otherwise("proceed")
    )
    if behavior == "error":
        d = d.withColumn(
            "chosen", F.when(low, F.raise_error(F.concat(F.lit("confidence below threshold: "), conf.cast("string")))
                             .cast("string")).otherwise(F.col("chosen"))
        )
    return d


def generator_gate(df: DataFrame, minimum: float = 0.60) -> DataFrame:
    """Only unblocked, direct information requests with enough confidence may be answered."""
    conf = clamp01(F.col("confidence"))
    reason = (
        F.when(F.col("safety_blocked"), "safety_blocked").when(F.col("email_type") != "direct_request", "not_direct_request")
        .when(F.col("intent") != "information_request", "intent_not_eligible").when(conf < minimum, "low_confidence")
    )
    return (
        df.withColumn("block_reason", reason).withColumn("pass_to_responder", F.col("block_reason").isNull())
        .withColumn("generator_hint", F.when(conf >= minimum, "proceed").otherwise("check_fallback"))
    )


# fixed values: confidence bands, highest first
REPLY_BANDS = ((0.80, "automate"), (0.60, "draft"), (0.0, "human"))
IMPORT_BANDS = ((0.80, "import"), (0.60, "review_flag"), (0.0, "human_review"))


def route_confidence(df: DataFrame, bands=REPLY_BANDS, confidence: str = "confidence", out: str = "route") -> DataFrame:
    c = F.lit(None).cast("string")
    for floor, label in sorted(bands):
        c = F.when(clamp01(F.col(confidence)) >= floor, label).otherwise(c)
    return df.withColumn(out, c)


def category_guardrails(df: DataFrame, allowed_domains: Sequence[str] = ("company.com",)) -> DataFrame:
    """Minimal checks per topic before an automatic reply."""
    text = F.concat_ws(" ", blank(F.col("subject")), blank(F.col("body")))

    def has(p: str) -> Column:
        return text.rlike(p)

    # fixed values: topic and evidence patterns
    date = has(r"\b20\d{2}-\d{2}-\d{2}\b") | has(
        r"(?i)\b(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sep(tember)?|oct(ober)?"
        r"|nov(ember)?|dec(ember)?) \d{1,2}(\s*[-–]\s*\d{1,2})?\b"
    )
    leave_type = has(r"(?i)\b(vacation|sick|bereavement|parental)\b")
    ssn = has(r"\b\d{3}-\d{2}-\d{4}\b")
    benefit = has(r"(?i)\b(benefits?|medical|dental|vision|401k|hsa|fsa|open enrollment|dependent)\b")
    cue = has(r"(?i)(how do i|am i eligible|can i|do i have)")
    payroll = has(r"(?i)\b(address|name change|withholding|pay stub)\b")
    letter = has(r"(?i)\b(employment verification|proof of employment|verification letter)\b")
    domain = F.lower(F.substring_index("from_email", "@", -1))
    topic = (
        F.when(letter, "verification").when(has(r"(?i)\b(pto|leave|time off|sick days?)\b"), "leave")
        .when(payroll, "payroll").when(benefit, "benefits").otherwise("none")
    )
    d = df.withColumn("topic", topic)
    t = F.col("topic")
    verdict = (
        F.when(ssn, "escalate")
        .when(t == "leave", F.when(date & leave_type, "reply").when(date | leave_type, "follow_up").otherwise("triage"))
        .when(t == "benefits", F.when(cue, "reply").otherwise("triage"))
        .when(t == "verification", F.when(domain.isin(list(allowed_domains)), "reply").otherwise("triage"))
        .when(t == "payroll", "reply")
        .otherwise("none")
    )
    return d.withColumn("guardrail", verdict)
