"""Rule packs compiled to column expressions.

Rules are configuration (more than ``MAX_RULES`` rows are an error), so they become literal predicates evaluated in
the scan stage: no join, no shuffle, and every pattern is compiled once per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.functions.text import blank, strip

MAX_RULES = 10_000
DEFAULT_PRIORITY = 1000


@dataclass(frozen=True)
class HardRule:
    field: str
    operator: str
    pattern: str
    action: str = "exclude"


@dataclass(frozen=True)
class Signal:
    name: str
    field: str
    kind: str
    pattern: str
    weight: int
    cap: int | None = None


@dataclass(frozen=True)
class Guard:
    required: tuple[str, ...] = ()
    forbidden: tuple[str, ...] = ()


@dataclass(frozen=True)
class RulePack:
    hard: tuple[HardRule, ...] = ()
    soft: tuple[Signal, ...] = ()
    thresholds: Mapping[str, int] = field(default_factory=dict)
    guards: Mapping[str, Guard] = field(default_factory=dict)

    def hard_in_order(self) -> list[HardRule]:
        """Fields in first-seen order, rules of a field in row order."""
        seen = list(dict.fromkeys(r.field for r in self.hard))
        return [r for f in seen for r in self.hard if r.field == f]


# --- packs ------------------------------------------------------------------------------------

# fixed values: quick exclusion families (field, operator, pattern, action)
QUICK_FAMILIES: dict[str, tuple[HardRule, ...]] = {
    "email_chains": (
        HardRule("subject", "regex", r"^\s*(RE|Re|FW|Fw|Fwd|FWD):\s*", "forwarded_chain"),
        HardRule("body", "regex", "(---- Original Message ----|---- Forwarded message ----)", "forwarded_chain"),
    ),
    "noreply_addresses": (
        HardRule(
            "from", "regex",
            "(noreply|no-reply|donotreply|do-not-reply|notification|automated|system|mailer-daemon)@", "automated",
        ),
    ),
    "auto_replies": (
        HardRule("subject", "regex", "(Out of Office|Auto.?Reply|Automatic reply|OOO|Away from office)", "auto_reply"),
        HardRule(
            "body", "regex",
            "(currently out of office|will be out of the office|limited access to email)", "auto_reply",
        ),
    ),
    "newsletters": (
        HardRule("body", "regex", "(unsubscribe|opt.?out|email preferences|manage subscriptions)", "newsletter"),
        HardRule(
            "from", "regex",
            "(newsletter|marketing|promo|campaign|mailchimp|constantcontact|news@|updates@)@", "newsletter",
        ),
    ),
    "system_notifications": (
        HardRule("from", "regex", "(system|admin|notification|alert|service|daemon|postmaster)@", "system"),
        HardRule("subject", "regex", r"^\[ALERT\]|\[SYSTEM\]|\[NOTIFICATION\]", "system"),
    ),
    "bounce_messages": (
        HardRule(
            "subject", "regex",
            "(Undelivered Mail|Delivery Status Notification|Mail Delivery Failed|Returned mail)", "bounce",
        ),
        HardRule("from", "regex", "(mailer-daemon|postmaster)@", "bounce"),
    ),
    "calendar_invites": (
        HardRule("subject", "regex", "(Invitation:|Accepted:|Declined:|Tentative:|Canceled:)", "calendar"),
        HardRule("body", "contains", "has invited you to", "calendar"),
    ),
    "automated_reports": (
        HardRule(
            "subject", "regex",
            r"(Daily Report|Weekly Report|Monthly Report|Automated Report|\[Report\])", "automated_report",
        ),
    ),
    "ticket_updates": (
        HardRule("subject", "regex", r"(\[Ticket #|\[Support\]|\[Case #|Ticket ID:|Request #)", "ticket_update"),
        HardRule("from", "regex", "(support|helpdesk|servicedesk|tickets?)@", "ticket_update"),
    ),
}
BALANCED = {"keep": 6, "triage_min": 4, "triage_max": 5}
# fixed values: threshold presets
THRESHOLD_PRESETS = {
    "conservative": {"keep": 8, "triage_min": 6, "triage_max": 7},
    "balanced": BALANCED,
    "permissive": {"keep": 4, "triage_min": 2, "triage_max": 3},
}


def quick_rules(patterns: Iterable[str]) -> RulePack:
    """Named families to hard rules; always carries the balanced thresholds."""
    return RulePack(hard=tuple(r for p in patterns for r in QUICK_FAMILIES.get(p, ())), thresholds=BALANCED)


def split_list(text: str) -> list[str]:
    parts = text.replace("|", ",").split(",")
    return [p.strip().lower() for p in parts if p.strip()]


def _int(v, default: int) -> int:
    try:
        return int(v)
    except (TypeError, ValueError):
        return default


def compile_rules(rows: Iterable[Mapping]) -> RulePack:
    """Rule rows (HARD, SOFT, THRESHOLD, GUARD families) to a pack."""
    live = [r for r in rows if str(r.get("enabled", "")).strip().lower() != "false"]
    live.sort(key=lambda r: _int(r.get("priority"), 999))

    def family(name: str) -> list[Mapping]:
        return [r for r in live if r.get("family") == name]

    hard = tuple(
        HardRule(r.get("field") or "", r.get("operator") or "", r.get("pattern") or "", r.get("action") or "exclude")
        for r in family("HARD")
    )
    soft = tuple(
        Signal(
            r.get("rule_id") or r.get("notes") or "signal", r.get("field") or "any", r.get("operator") or "",
            r.get("pattern") or "", _int(r.get("weight"), 0),
            None if r.get("cap_per_email") in (None, "") else _int(r.get("cap_per_email"), 0),
        )
        for r in family("SOFT")
    )
    thresholds = {r["pattern"]: _int(r.get("weight"), 0) for r in family("THRESHOLD") if r.get("pattern")}
    guards: dict[str, Guard] = {}
    for r in family("GUARD"):
        cat = r.get("category")
        if not cat:
            continue
        g = guards.get(cat, Guard())
        if r.get("operator") == "required":
            g = Guard((*g.required, r["pattern"]), g.forbidden)
        elif r.get("operator") == "forbidden":
            g = Guard(g.required, (*g.forbidden, r["pattern"]))
        guards[cat] = g
    return RulePack(hard, soft, thresholds, guards)


def default_rulepack() -> RulePack:
    """Rules for an HR mailbox: hard filters, weighted signals and bands."""
    # fixed values: patterns and weights of the default pack
    hard = (
        HardRule("from", "contains", "no-reply", "automated"),
        HardRule("from", "contains", "noreply", "automated"),
        HardRule("from", "contains", "donotreply", "automated"),
        HardRule("from", "contains", "bounce", "bounce"),
        HardRule("headers", "header_present", "List-Unsubscribe", "mailing_list"),
        HardRule("headers", "equals", "Auto-Submitted:auto-replied", "auto_reply"),
        HardRule("headers", "equals", "Content-Type:text/calendar", "calendar"),
        HardRule("subject", "regex", "(?i)out of office|ooo|vacation auto-reply", "auto_reply"),
        HardRule("auth", "is_true", "spf_fail", "safety_block"),
    )
    soft = (
        Signal("direct_request", "any", "regex", r"(?i)\b(i need|please|can you|could you|i'm requesting)\b", 4),
        Signal("hr_pto", "any", "regex", r"(?i)\bpto|vacation|leave|sick|fmla\b", 3),
        Signal("hr_benefits", "any", "regex", r"(?i)\bbenefits?|medical|dental|401k|hsa|fsa|enrollment\b", 3),
        Signal("hr_payroll", "any", "regex", r"(?i)\bpayroll|paycheck|withholding|overtime|bonus\b", 3),
        Signal("hr_employment_data", "any", "regex", r"(?i)\baddress change|name change|w-4|i-9\b", 3),
        Signal("verification", "any", "regex",
               r"(?i)\bemployment verification|verification letter|proof of employment\b", 3),
        Signal("subject_request", "subject", "regex",
               r"(?i)\brequest|change|update|question|verification|enrollment\b", 2),
        Signal("attachment_hr", "attachments", "ext_in", "pdf,png,jpg,jpeg", 2, 1),
        Signal("employee_id", "any", "regex", r"\bEID-\d{6}\b", 2),
        Signal("marketing_language", "any", "regex", r"(?i)\bwebinar|promotion|exclusive offer|discount\b", -3),
        Signal("vendor_pitch", "any", "regex", r"(?i)\bschedule a demo|pilot program\b", -2),
    )
    return RulePack(hard, soft, BALANCED)


DEFAULT_LABELS = {"keep": "HR-REQUEST", "review": "REVIEW", "drop": "IRRELEVANT"}


def safety_rules() -> RulePack:
    """Chains and forwards, safety topics (to a human) and signals of talk about somebody else."""
    # fixed values: chain patterns, safety topics and negative signals
    hard = (
        HardRule("subject", "regex", r"^\s*(FW|Fw|Fwd|FWD):\s*", "forwarded_chain"),
        HardRule("subject", "regex", r"^\s*(RE|Re):\s*", "reply_chain"),
        HardRule("body", "regex", "---- Original Message ----", "forwarded_chain"),
        HardRule("body", "regex", "---- Forwarded message ----", "forwarded_chain"),
        HardRule("body", "regex", "From:.*From:", "forwarded_chain"),
        HardRule("body", "regex", "(?m)^>>>", "forwarded_chain"),
        HardRule("body", "regex", r"(?i)\b(lawsuit|attorney|discrimination)\b", "safety_block"),
        HardRule("body", "regex", r"(?i)\b(suicidal|self-harm|harassment)\b", "safety_block"),
        HardRule("body", "regex", r"(?i)\b(diagnosis|medical records|disability)\b", "safety_block"),
        HardRule("body", "regex", r"(?i)\b(hopeless|desperate|breakdown)\b", "safety_block"),
    )
    soft = (
        Signal("third_person", "any", "regex", r"(?i)\b(this employee|they need)\b", -3),
        Signal("internal_routing", "any", "regex", r"(?i)\b(please handle|fyi)\b", -2),
        Signal("named_request", "any", "regex", r"\b[A-Z][a-z]+'s request\b", -2),
        Signal("many_addresses", "body", "regex", r"(?s)\S+@\S+.*\S+@\S+", -1),
    )
    return RulePack(hard, soft, BALANCED)


# --- evaluation -------------------------------------------------------------------------------


def _text_of(name: str) -> Column:
    if name == "from":
        return blank(F.col("from_email"))
    if name == "headers":
        return F.to_json("headers")
    if name == "attachments":
        return F.lower(F.array_join("attachments", " "))
    if name in ("subject", "body"):
        return blank(F.col(name))
    return F.lit("")


def _has_extension(pattern: str) -> Column:
    exts = split_list(pattern)
    return F.exists(
        "attachments", lambda a: reduce(lambda x, y: x | y, [F.lower(a).endswith("." + e) for e in exts], F.lit(False))
    )


def hard_condition(rule: HardRule) -> Column:
    """Regexes are case-sensitive here; ``equals`` without a colon compares the whole pattern."""
    text = _text_of(rule.field)
    if rule.operator == "equals":
        if rule.field == "headers":
            key, _, value = rule.pattern.partition(":")
            got = F.lower(blank(F.try_element_at("headers", F.lit(key))))
            return F.map_contains_key("headers", key) & got.startswith(value.lower())
        return F.lower(text) == rule.pattern.lower()
    if rule.operator == "contains":
        return F.lower(text).contains(rule.pattern.lower())
    if rule.operator == "regex":
        return text.rlike(rule.pattern)
    if rule.operator == "header_present":
        return F.map_contains_key("headers", rule.pattern)
    if rule.operator == "ext_in":
        return _has_extension(rule.pattern)
    if rule.operator == "is_true":
        return F.coalesce(F.try_element_at("auth", F.lit(rule.pattern)), F.lit(False))
    return F.lit(False)


# fixed values: actions that name their own reason, and the lane each belongs to
ACTION_LANE = {
    "automated": "IRRELEVANT", "auto_reply": "IRRELEVANT", "system": "IRRELEVANT", "newsletter": "IRRELEVANT",
    "automated_report": "IRRELEVANT", "forwarded_chain": "HUMAN", "ticket_update": "HUMAN", "calendar": "IRRELEVANT",
    "bounce": "IRRELEVANT",
}


def eval_hard(pack: RulePack) -> Column:
    """Struct (action, reason, category) of the first rule that hits, else null."""
    hits = [
        F.when(
            hard_condition(r),
            F.struct(
                F.lit(r.action).alias("action"),
                F.lit(r.action if r.action in ACTION_LANE else f"{r.field}:{r.operator}").alias("reason"),
                F.lit(ACTION_LANE.get(r.action, "HUMAN")).alias("category"),
            ),
        )
        for r in pack.hard_in_order()
    ]
    empty = F.lit(None).cast("struct<action:string,reason:string,category:string>")
    return F.coalesce(*hits, empty)


def signal_condition(s: Signal) -> Column:
    if s.kind == "ext_in":
        return _has_extension(s.pattern)
    if s.kind == "header_present":
        return F.map_contains_key("headers", s.pattern)
    fields = [s.field] if s.field in ("subject", "body", "from", "headers", "attachments") else ["subject", "body"]
    texts = [_text_of(f) for f in fields]
    if s.kind == "regex":
        tests = [t.rlike(s.pattern) for t in texts]
    elif s.kind == "contains":
        tests = [F.lower(t).contains(n) for t in texts for n in split_list(s.pattern)]
    else:
        tests = []
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def eval_soft(df: DataFrame, signals: Sequence[Signal], out: str = "soft") -> DataFrame:
    """Struct (score, matched): weights of matching signals, at most ``cap`` per signal name."""
    if not signals:
        return df.withColumn(out, F.struct(F.lit(0).alias("score"), F.array().cast("array<string>").alias("matched")))
    # the tests run once into an array; caps then only look at earlier entries of the same name
    d = df.withColumn("__hit", F.array(*[signal_condition(s).cast("int") for s in signals]))
    counted = []
    for i, s in enumerate(signals):
        hit = F.col("__hit")[i] == 1
        if s.cap is not None:
            earlier = [F.col("__hit")[j] for j in range(i) if signals[j].name == s.name]
            hit = hit & (reduce(lambda a, b: a + b, earlier, F.lit(0)) < s.cap)
        counted.append(hit)
    score = reduce(lambda a, b: a + b, [F.when(h, s.weight).otherwise(0) for h, s in zip(counted, signals)])
    matched = F.array_compact(F.array(*[F.when(h, s.name) for h, s in zip(counted, signals)]))
    return d.withColumn(out, F.struct(score.alias("score"), matched.alias("matched"))).drop("__hit")


def decide(score: Column, thresholds: Mapping[str, int], labels: Mapping[str, str]) -> Column:
    keep = int(thresholds.get("keep", thresholds.get("keep_threshold", 6)))
    lo, hi = sorted((int(thresholds.get("triage_min", 4)), int(thresholds.get("triage_max", 5))))
    return (
        F.when(score >= keep, labels["keep"]).when(score.between(lo, hi), labels["review"]).otherwise(labels["drop"])
    )


def guards_ok(guard: Guard) -> Column:
    def hit(p: str) -> Column:
        return blank(F.col("subject")).rlike(p) | blank(F.col("body")).rlike(p)

    ok = F.lit(True)
    for p in guard.required:
        ok = ok & hit(p)
    for p in guard.forbidden:
        ok = ok & ~hit(p)
    return ok


# --- classification rules ---------------------------------------------------------------------

# fixed values: standard patterns per field, all case-insensitive
STANDARD_PATTERNS: dict[str, tuple[str, ...]] = {
    "sender": (
        r"\bno[-_.]?reply\b", r"\bdo[-_.]?not[-_.]?reply\b", r"\bdonotreply\b", r"\bnewsletter\b", r"\bmailer\b",
        r"\bautomated\b",
    ),
    "subject": (
        r"\border\s*(no\.|#)?\s*\d+", r"\b(order|purchase)\s+confirmation\b", r"\bconfirmation\b", r"\breceipt\b",
        r"\binvoice\b", r"\b(password\s*reset|verification\s*code|two[-\s]?factor)\b",
    ),
    "body": (
        r"\bunsubscribe\b", r"\bmanage (your )?preferences\b", r"\bautomated (message|email)\b", r"\bdo not reply\b",
        r"\bview (this|in) browser\b",
    ),
}
# fixed values: column names accepted for each rule field
COLUMN_SYNONYMS = {
    "rule_id": ("rule_id", "id", "key"),
    "rule_type": ("rule_type", "type", "field", "target", "applies_to", "scope"),
    "rule_pattern": ("rule_pattern", "pattern", "regex", "regexp", "matcher", "match", "expression", "expr", "contains"),
    "action": ("action", "category", "label", "outcome", "route", "bucket", "folder"),
    "priority": ("priority", "prio", "rank", "order", "weight", "score"),
    "active": ("active", "enabled", "is_active", "status", "state"),
}


def haystack(field_name: str) -> Column:
    if field_name == "sender":
        return F.concat(blank(F.col("from_name")), F.lit(" <"), blank(F.col("from_email")), F.lit(">"))
    return blank(F.col(field_name))


MATCH_TYPE = "struct<priority:int,rule_id:string,rule_type:string,rule_pattern:string,action:string,sample:string>"


def _match(rule_id: str, rtype: str, pattern: str, action: str | None, priority: int, rx: str) -> Column:
    text = haystack(rtype)
    return F.when(
        text.rlike(rx),
        F.struct(
            F.lit(priority).alias("priority"), F.lit(rule_id).alias("rule_id"), F.lit(rtype).alias("rule_type"),
            F.lit(pattern).alias("rule_pattern"), F.lit(action).cast("string").alias("action"),
            F.regexp_extract(text, rx, 0).alias("sample"),
        ),
    )


def standard_signals() -> Column:
    """Array of matches of the standard patterns, in sender, subject, body order."""
    return F.array_compact(F.array(*[
        _match(f"std:{f}:{p}", f, p, None, DEFAULT_PRIORITY, f"(?i){p}")
        for f, ps in STANDARD_PATTERNS.items() for p in ps
    ]))


def signal_flags(signals: Column) -> Column:
    """Patterns that matched, by field, of ``standard_signals``."""
    def of(name: str) -> Column:
        own = F.filter(signals, lambda m: m["rule_type"] == name)
        return F.transform(own, lambda m: m["rule_pattern"]).alias(f"{name}_flags")

    return F.struct(*[of(name) for name in STANDARD_PATTERNS])


def rule_regex(pattern: str) -> str:
    """``/re/`` and ``re:`` are expressions, anything else is literal; always case-insensitive."""
    p = pattern.strip()
    if len(p) >= 2 and p.startswith("/") and p.endswith("/"):
        return "(?i)" + p[1:-1]
    if p.startswith("re:"):
        return "(?i)" + p[3:]
    return "(?i)" + r"\Q" + p.replace(r"\E", r"\E\\E\Q") + r"\E"


def usable(rules: Iterable[Mapping]) -> list[Mapping]:
    return [
        r for r in rules
        if r.get("rule_type") in ("sender", "subject", "body") and str(r.get("rule_pattern") or "").strip()
    ]


def apply_rules(df: DataFrame, rules: Sequence[Mapping], stop_on_first: bool = True, out: str = "custom") -> DataFrame:
    """Struct (matches, evaluated_count); rules come in evaluation order, matches leave in priority order."""
    live = usable(rules)
    none = F.array().cast(f"array<{MATCH_TYPE}>")
    if not live:
        return df.withColumn(out, F.struct(none.alias("matches"), F.lit(0).alias("evaluated_count")))
    found = [
        _match(str(r.get("rule_id") or ""), r["rule_type"], r["rule_pattern"], r.get("action"),
               _int(r.get("priority"), DEFAULT_PRIORITY), rule_regex(r["rule_pattern"]))
        for r in live
    ]
    if stop_on_first:
        numbered = [F.when(m.isNotNull(), F.struct(F.lit(i + 1).alias("n"), m.alias("m"))) for i, m in enumerate(found)]
        first = F.coalesce(*numbered)
        d = df.withColumn("__f", first)
        return d.withColumn(
            out,
            F.struct(
                F.when(F.col("__f").isNull(), none).otherwise(F.array(F.col("__f.m"))).alias("matches"),
                F.coalesce(F.col("__f.n"), F.lit(len(live))).alias("evaluated_count"),
            ),
        ).drop("__f")
    return df.withColumn(
        out, F.struct(F.sort_array(F.array_compact(F.array(*found))).alias("matches"),
                      F.lit(len(live)).alias("evaluated_count"))
    )


def classify_by_pattern(
    df: DataFrame, rules: Sequence[Mapping] | None = None, stop_on_first: bool = True, fallback: bool = True,
) -> DataFrame:
    """Custom rules (all of them), else standard patterns, else none."""
    d = apply_rules(df, rules or [], stop_on_first).withColumn("standard", standard_signals())
    own, std = F.size("custom.matches") > 0, F.size("standard") > 0
    use_std = std if rules is None or fallback else F.lit(False)
    d = d.withColumn("rule_source", F.when(own, "custom").when(use_std, "standard").otherwise("none"))
    d = d.withColumn(
        "matches",
        F.when(own, F.col("custom.matches")).when(use_std, F.col("standard")).otherwise(
            F.array().cast(f"array<{MATCH_TYPE}>")
        ),
    )
    return (
        d.withColumn("pattern_match", F.size("matches") > 0)
        .withColumn("top_match", F.try_element_at("matches", F.lit(1)))
        .withColumn("selected_action", F.when(own, F.col("custom.matches")[0]["action"]))
        .withColumn("evaluated_count", F.col("custom.evaluated_count"))
    )


def infer_mapping(columns: Sequence[str], explicit: Mapping[str, str] | None = None) -> dict[str, str]:
    mapping = {k: v for k, v in (explicit or {}).items() if str(v).strip()}
    for key, alts in COLUMN_SYNONYMS.items():
        if key not in mapping:
            found = next((c for c in columns if c.lower() in alts), None)
            if found:
                mapping[key] = found
    return mapping


def coerce_flag(c: Column) -> Column:
    s = F.lower(strip(c.cast("string")))
    return F.when(s.isin("true", "1"), True).when(s.isin("false", "0"), False).otherwise(c.isNotNull())


def load_rules(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical rule rows from a table under any accepted column names: active only, best priority first."""
    m = infer_mapping(df.columns, mapping)
    missing = [k for k in ("rule_type", "rule_pattern") if m.get(k) not in df.columns]
    if missing:
        raise ValueError(f"rules table lacks {', '.join(missing)}; it has {', '.join(df.columns)}")

    def text(key: str) -> Column:
        return blank(F.col(m[key]).cast("string")) if key in m else F.lit("")

    priority = F.col(m["priority"]).cast("string").try_cast("int") if "priority" in m else F.lit(None).cast("int")
    active = coerce_flag(F.col(m["active"])) if "active" in m else F.lit(True)
    return (
        df.select(
            text("rule_id").alias("rule_id"), F.lower(text("rule_type")).alias("rule_type"),
            text("rule_pattern").alias("rule_pattern"), text("action").alias("action"),
            F.coalesce(priority, F.lit(DEFAULT_PRIORITY)).alias("priority"), active.alias("active"),
        )
        .where("active").orderBy("priority", "rule_id")
    )


def rule_rows(rules: DataFrame) -> list[dict]:
    """The rule table on the driver, best priority first; more than ``MAX_RULES`` rows are an error, never a cut."""
    rows = rules.orderBy("priority", "rule_id").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return [r.asDict() for r in rows]
