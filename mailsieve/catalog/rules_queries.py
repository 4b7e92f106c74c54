"""Rule evaluation, classification and the deterministic filter over all e-mails."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsieve.catalog.sqlkit import has, q, strip
from mailsieve.operators import rules as R
from mailsieve.operators import triage as T
from mailsieve.registry import query

QUICK = list(R.QUICK_FAMILIES)

# rule rows in two column spellings (fixtures for the table readers)
RULE_ROWS = [
    ("r1", "sender", "re:no[-.]?reply", "archive", 10, True), ("r2", "subject", "/^re:\\s/", "thread", 20, True),
    ("r3", "body", "unsubscribe", "newsletter", 20, True), ("r4", "subject", "[Ticket #", "support", 30, True),
    ("r5", "body", "/sick|vacation/", "leave", 5, True), ("r6", "subject", "invitation", "calendar", 40, False),
    ("r7", "phase", "whatever", "ignored", 1, True), ("r8", "body", "re:\\d{3}-\\d{3}-\\d{4}", "phone", 20, True),
    ("r9", "sender", "Person 1", "vip", None, True),
]
ALT_ROWS = [(a, b.upper(), c, d, e, "1" if f else "0") for a, b, c, d, e, f in RULE_ROWS]
RULE_DDL = "rule_id string, rule_type string, rule_pattern string, action string, priority int, active boolean"
ALT_DDL = "id string, field string, regex string, label string, rank int, enabled string"
PACK_ROWS = [
    dict(family="HARD", field="subject", operator="regex", pattern=r"^\[Ticket", action="ticket_update", priority=5, enabled="true"),
    dict(family="HARD", field="body", operator="contains", pattern="UNSUBSCRIBE", action="newsletter", priority=1, enabled=""),
    dict(family="HARD", field="subject", operator="regex", pattern="^Invitation", action="custom_stop", priority=2, enabled="true"),
    dict(family="HARD", field="attachments", operator="ext_in", pattern="exe|bat", action="safety_block", priority=9, enabled="true"),
    dict(family="HARD", field="subject", operator="regex", pattern=".", action="bounce", priority=0, enabled="False"),
    dict(family="SOFT", rule_id="req", field="any", operator="contains", pattern="request, question", weight="3", cap_per_email="1", priority=1, enabled="true"),
    dict(family="SOFT", rule_id="req", field="body", operator="regex", pattern="Can you", weight="4", cap_per_email="1", priority=2, enabled="true"),
    dict(family="SOFT", rule_id="many", field="body", operator="contains", pattern="hr|sick|the", weight=2, cap_per_email="", priority=3, enabled="true"),
    dict(family="SOFT", rule_id="pdf", field="attachments", operator="ext_in", pattern="pdf,png", weight=2, cap_per_email="", priority=3, enabled="true"),
    dict(family="THRESHOLD", pattern="keep", weight="5", priority=1, enabled="true"),
    dict(family="THRESHOLD", pattern="triage_min", weight="4", priority=1, enabled="true"),
    dict(family="THRESHOLD", pattern="triage_max", weight="2", priority=1, enabled="true"),
    dict(family="GUARD", category="address", operator="required", pattern="(?i)address", priority=1, enabled="true"),
    dict(family="GUARD", category="address", operator="forbidden", pattern="(?i)ticket", priority=1, enabled="true"),
    dict(family="GUARD", category="leave", operator="required", pattern="(?i)leave|sick", priority=1, enabled="true"),
]
PACK = R.compile_rules(PACK_ROWS)

COL = {"from": "from_email", "subject": "subject", "body": "body"}


def hard_sql(r: R.HardRule) -> str:
    c = COL.get(r.field, "''")
    return {
        "regex": lambda: has(c, r.pattern),
        "contains": lambda: f"contains(lower({c}), {q(r.pattern.lower())})",
        "header_present": lambda: "has_unsub" if r.pattern == "List-Unsubscribe" else "false",
        "equals": lambda: "false",
        "is_true": lambda: "spf_fail",
        "ext_in": lambda: ext_sql(r.pattern),
    }[r.operator]()


def ext_sql(pattern: str) -> str:
    return "(" + " OR ".join(f"' ' || attach || ' ' LIKE {q('%.' + e + ' %')}" for e in R.split_list(pattern)) + ")"


def signal_sql(s: R.Signal) -> str:
    if s.kind == "ext_in":
        return ext_sql(s.pattern)
    cols = [COL[s.field]] if s.field in COL else ["subject", "body"]
    if s.kind == "regex":
        tests = [has(c, s.pattern) for c in cols]
    else:
        tests = [f"contains(lower({c}), {q(n)})" for c in cols for n in R.split_list(s.pattern)]
    return "(" + " OR ".join(tests) + ")"


def first_sql(pack: R.RulePack, value) -> str:
    whens = " ".join(f"WHEN {hard_sql(r)} THEN {q(value(r))}" for r in pack.hard_in_order())
    return f"CASE {whens} END" if whens else "NULL"


def reason(r: R.HardRule) -> str:
    return r.action if r.action in R.ACTION_LANE else f"{r.field}:{r.operator}"


def soft_sql(pack: R.RulePack) -> str:
    """Score by summing every signal, each name limited by its cap (signals of one name in row order)."""
    terms = []
    for i, s in enumerate(pack.soft):
        cond = signal_sql(s)
        if s.cap is not None:
            earlier = [f"{signal_sql(p)}::INT" for p in pack.soft[:i] if p.name == s.name]
            if earlier:
                cond = f"({cond} AND {' + '.join(earlier)} < {s.cap})"
        terms.append(f"(CASE WHEN {cond} THEN {s.weight} ELSE 0 END)")
    return " + ".join(terms) or "0"


def hits_sql(pack: R.RulePack) -> str:
    parts = []
    for i, s in enumerate(pack.soft):
        cond = signal_sql(s)
        if s.cap is not None:
            earlier = [f"{signal_sql(p)}::INT" for p in pack.soft[:i] if p.name == s.name]
            if earlier:
                cond = f"({cond} AND {' + '.join(earlier)} < {s.cap})"
        parts.append(f"CASE WHEN {cond} THEN {q(s.name)} END")
    return f"concat_ws(',', {', '.join(parts)})"


def filter_sql(pack: R.RulePack, labels=None, block_unmapped: bool = False, preset: str = "balanced") -> str:
    lab = {**T.LABELS, **(labels or {})}
    thr = {**R.THRESHOLD_PRESETS[preset], **pack.thresholds}
    lo, hi = sorted((thr["triage_min"], thr["triage_max"]))

    def final_reason(r):
        if block_unmapped and r.action in T.REASON_TYPES:
            return r.action
        return reason(r)

    kinds = " ".join(f"WHEN {q(k)} THEN {q(v[0])}" for k, v in T.REASON_TYPES.items())
    lanes = " ".join(f"WHEN {q(k)} THEN {q(v[1])}" for k, v in T.REASON_TYPES.items())
    return f"""
h AS (SELECT *, {first_sql(pack, final_reason)} AS hard_reason, {first_sql(pack, lambda r: r.action)} AS excluded_pattern FROM E),
k AS (SELECT *, CASE hard_reason {kinds} END AS kind, CASE hard_reason {lanes} END AS lane FROM h),
s AS (SELECT *, CASE WHEN kind IS NOT NULL THEN 0 ELSE {soft_sql(pack)} END AS soft_score FROM k),
f AS (SELECT email_id, kind IS NOT NULL AS hard_block, hard_reason, excluded_pattern, coalesce(kind, 'direct_request') AS email_type,
  soft_score::INT AS soft_score, coalesce(lane, CASE WHEN soft_score >= {thr['keep']} THEN {q(lab['keep'])}
    WHEN soft_score BETWEEN {lo} AND {hi} THEN {q(lab['review'])} ELSE {q(lab['drop'])} END) AS decision FROM s)"""


FILTER_COLS = ["email_id", "hard_block", "hard_reason", "excluded_pattern", "email_type", "soft_score", "decision"]


@query("p1_normalize_email", "E", sql=f"""
SELECT email_id, concat_ws(chr(10) || chr(10), CASE WHEN {strip('subject')} <> '' THEN 'Subject: ' || {strip('subject')} END,
  CASE WHEN {strip('body')} <> '' THEN 'Body:' || chr(10) || {strip('body')} END) AS email_text
FROM E WHERE {strip('subject')} <> '' OR {strip('body')} <> ''""")
def _(v):
    return T.normalize_email(v.E).select("email_id", "email_text")


@query("p1_blank_messages", "E", sql=f"""
SELECT email_id, 'blank_message' AS reason FROM (SELECT email_id, '' AS subject, CASE WHEN email_id % 3 = 0 THEN ' ' ELSE body END AS body FROM E) x
WHERE {strip('subject')} = '' AND {strip('body')} = ''""")
def _(v):
    d = v.E.withColumn("subject", F.lit("")).withColumn("body", F.when(F.col("email_id") % 3 == 0, " ").otherwise(F.col("body")))
    return T.blank_messages(d).select("email_id", "reason")


@query("p2_quick_rules", "E", sql=f"""
SELECT coalesce({first_sql(R.quick_rules(QUICK), lambda r: r.action)}, 'none') AS action, count(*) AS n FROM E GROUP BY 1""")
def _(v):
    hit = R.eval_hard(R.quick_rules(QUICK))
    return v.E.select(F.coalesce(hit["action"], F.lit("none")).alias("action")).groupBy("action").agg(F.count("*").alias("n"))


@query("p3_compiled_rules", "E", sql=filter_sql(PACK) + " SELECT * FROM f")
def _(v):
    return T.deterministic_filter(v.E, PACK).select(*FILTER_COLS)


@query("p4_eval_hard", "E", sql=f"""
SELECT email_id, {first_sql(R.quick_rules(QUICK), lambda r: r.action)} AS action, {first_sql(R.quick_rules(QUICK), reason)} AS reason,
  {first_sql(R.quick_rules(QUICK), lambda r: R.ACTION_LANE.get(r.action, 'HUMAN'))} AS category FROM E""")
def _(v):
    d = v.E.withColumn("h", R.eval_hard(R.quick_rules(QUICK)))
    return d.select("email_id", "h.action", "h.reason", "h.category")


@query("p5_eval_soft", "E", sql=f"""
SELECT email_id, ({soft_sql(PACK)})::INT AS score, {hits_sql(PACK)} AS matched FROM E""")
def _(v):
    d = R.eval_soft(v.E, PACK.soft)
    return d.select("email_id", F.col("soft.score").alias("score"), F.array_join("soft.matched", ",").alias("matched"))


@query("p6_decide", "E", sql=f"""
s AS (SELECT email_id, {soft_sql(R.default_rulepack())} AS score FROM E)
SELECT email_id, CASE WHEN score >= 8 THEN 'KEEP' WHEN score BETWEEN 6 AND 7 THEN 'HUMAN' ELSE 'IRRELEVANT' END AS conservative,
  CASE WHEN score >= 6 THEN 'KEEP' WHEN score BETWEEN 4 AND 5 THEN 'HUMAN' ELSE 'IRRELEVANT' END AS balanced,
  CASE WHEN score >= 4 THEN 'KEEP' WHEN score BETWEEN 2 AND 3 THEN 'HUMAN' ELSE 'IRRELEVANT' END AS permissive FROM s""")
def _(v):
    d = R.eval_soft(v.E, R.default_rulepack().soft)
    return d.select("email_id", *[R.decide(F.col("soft.score"), t, T.LABELS).alias(n) for n, t in R.THRESHOLD_PRESETS.items()])


@query("p7_deterministic_filter", "E", sql=filter_sql(R.quick_rules(QUICK)) + " SELECT * FROM f")
def _(v):
    return T.deterministic_filter(v.E, R.quick_rules(QUICK)).select(*FILTER_COLS)


@query("p7_deterministic_filter_counts", "E", sql=filter_sql(R.quick_rules(QUICK)) + """
SELECT decision, email_type, count(*) AS n FROM f GROUP BY 1, 2""")
def _(v):
    return T.deterministic_filter(v.E, R.quick_rules(QUICK)).groupBy("decision", "email_type").agg(F.count("*").alias("n"))


def guard_sql(g: R.Guard) -> str:
    def hit(p):
        return f"({has('subject', p)} OR {has('body', p)})"

    return " AND ".join([hit(p) for p in g.required] + [f"NOT {hit(p)}" for p in g.forbidden])


@query("p8_category_guards", "E", sql=f"""
SELECT email_id, {guard_sql(PACK.guards['address'])} AS address_ok, {guard_sql(PACK.guards['leave'])} AS leave_ok FROM E""")
def _(v):
    return v.E.select(
        "email_id", R.guards_ok(PACK.guards["address"]).alias("address_ok"), R.guards_ok(PACK.guards["leave"]).alias("leave_ok")
    )


HAY = {"sender": "from_name || ' <' || from_email || '>'", "subject": "subject", "body": "body"}
STD = [(f, p) for f, ps in R.STANDARD_PATTERNS.items() for p in ps]


def std_list(value) -> str:
    items = ", ".join(f"CASE WHEN {has(HAY[f], p, 'i')} THEN {value(f, p)} END" for f, p in STD)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


STD_IDS = std_list(lambda f, p: q(f"std:{f}:{p}"))
STD_SAMPLES = std_list(lambda f, p: f"regexp_extract({HAY[f]}, {q(p)}, 0, 'i')")


@query("p9_standard_signals", "E", sql=f"""
SELECT email_id, array_to_string({STD_IDS}, '; ') AS rules, array_to_string({STD_SAMPLES}, '; ') AS samples FROM E""")
def _(v):
    d = v.E.withColumn("m", R.standard_signals())
    return d.select("email_id", F.array_join("m.rule_id", "; ").alias("rules"), F.array_join("m.sample", "; ").alias("samples"))


@query("p9_signal_flags", "E", sql=f"""
SELECT email_id, array_to_string(list_transform(list_filter({STD_IDS}, lambda x: x LIKE 'std:sender:%'), lambda x: substr(x, 12)), '; ') AS sender,
  array_to_string(list_transform(list_filter({STD_IDS}, lambda x: x LIKE 'std:subject:%'), lambda x: substr(x, 13)), '; ') AS subject,
  array_to_string(list_transform(list_filter({STD_IDS}, lambda x: x LIKE 'std:body:%'), lambda x: substr(x, 10)), '; ') AS body FROM E""")
def _(v):
    d = v.E.withColumn("f", R.signal_flags(R.standard_signals()))
    return d.select("email_id", *[F.array_join(f"f.{n}_flags", "; ").alias(n) for n in ("sender", "subject", "body")])


LIVE = [dict(zip(("rule_id", "rule_type", "rule_pattern", "action", "priority", "active"), r)) for r in RULE_ROWS]
LIVE = sorted((r | {"priority": 1000 if r["priority"] is None else r["priority"]} for r in LIVE if r["active"]),
              key=lambda r: (r["priority"], r["rule_id"]))


def rx_sql(pattern: str) -> str:
    if pattern.startswith("/"):
        return pattern[1:-1]
    return pattern[3:] if pattern.startswith("re:") else r"\Q" + pattern + r"\E"


def rule_hit(r) -> str:
    return has(HAY[r["rule_type"]], rx_sql(r["rule_pattern"]), "i")


USABLE = R.usable(LIVE)
ALL_HITS = "list_filter([" + ", ".join(f"CASE WHEN {rule_hit(r)} THEN {q(r['rule_id'])} END" for r in USABLE) + "], lambda x: x IS NOT NULL)"
FIRST_POS = "CASE " + " ".join(f"WHEN {rule_hit(r)} THEN {i + 1}" for i, r in enumerate(USABLE)) + f" ELSE {len(USABLE)} END"


@query("p10_apply_rules", "E", sql=f"""
SELECT email_id, array_to_string({ALL_HITS}, ',') AS all_hits, coalesce({ALL_HITS}[1], '') AS first_hit, {FIRST_POS} AS evaluated FROM E""")
def _(v):
    d = R.apply_rules(v.E, LIVE, stop_on_first=False, out="a")
    d = R.apply_rules(d, LIVE, stop_on_first=True, out="b")
    return d.select(
        "email_id", F.array_join("a.matches.rule_id", ",").alias("all_hits"),
        F.array_join("b.matches.rule_id", ",").alias("first_hit"), F.col("b.evaluated_count").alias("evaluated"),
    )


@query("p10_rule_table", "E", sql=f"""
SELECT email_id, array_to_string({ALL_HITS}, ',') AS all_hits, coalesce({ALL_HITS}[1], '') AS first_hit, {FIRST_POS} AS evaluated FROM E""")
def _(v):
    from mailsieve.operators.rulepacks import apply_rule_table

    schema = "rule_id string, rule_type string, rule_pattern string, action string, priority int, active boolean"
    table = R.load_rules(v.spark.createDataFrame([tuple(r.values()) for r in LIVE], schema))
    d = apply_rule_table(v.E, table, stop_on_first=False, out="a")
    d = apply_rule_table(d, table, stop_on_first=True, out="b")
    return d.select(
        "email_id", F.array_join("a.matches.rule_id", ",").alias("all_hits"),
        F.array_join("b.matches.rule_id", ",").alias("first_hit"), F.col("b.evaluated_count").alias("evaluated"),
    )


ACTION_OF = "CASE " + " ".join(f"WHEN {rule_hit(r)} THEN {q(r['action'])}" for r in USABLE) + " END"


@query("p11_classify_by_pattern", "E", sql=f"""
SELECT email_id, CASE WHEN len({ALL_HITS}) > 0 THEN 'custom' WHEN len({STD_IDS}) > 0 THEN 'standard' ELSE 'none' END AS rule_source,
  {ACTION_OF} AS selected_action, coalesce({ALL_HITS}[1], {STD_IDS}[1]) AS top_rule,
  (len({ALL_HITS}) > 0 OR len({STD_IDS}) > 0) AS pattern_match FROM E""")
def _(v):
    return R.classify_by_pattern(v.E, LIVE).select(
        "email_id", "rule_source", "selected_action", F.col("top_match.rule_id").alias("top_rule"), "pattern_match"
    )


@query("p12_default_rulepack", "E", sql=filter_sql(R.default_rulepack(), R.DEFAULT_LABELS, True) + " SELECT * FROM f")
def _(v):
    return T.deterministic_filter(v.E, R.default_rulepack(), labels=R.DEFAULT_LABELS, block_unmapped=True).select(*FILTER_COLS)


@query("p13_safety_rules", "E", sql=filter_sql(R.safety_rules(), None, True) + " SELECT * FROM f")
def _(v):
    return T.deterministic_filter(v.E, R.safety_rules(), block_unmapped=True).select(*FILTER_COLS)


TEXT = "(subject || ' ' || body)"
DATE_SQL = f"({has(TEXT, chr(92) + 'b20' + chr(92) + 'd{2}-' + chr(92) + 'd{2}-' + chr(92) + 'd{2}' + chr(92) + 'b')} OR " + has(TEXT, (
    r"(?i)\b(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sep(tember)?|oct(ober)?"
    r"|nov(ember)?|dec(ember)?) \d{1,2}(\s*[-–]\s*\d{1,2})?\b")) + ")"
TYPE_SQL = has(TEXT, r"(?i)\b(vacation|sick|bereavement|parental)\b")


@query("p26_category_guardrails", "E", sql=f"""
t AS (SELECT email_id, subject, body, from_email, CASE WHEN {has(TEXT, r"(?i)\b(employment verification|proof of employment|verification letter)\b")} THEN 'verification'
  WHEN {has(TEXT, r"(?i)\b(pto|leave|time off|sick days?)\b")} THEN 'leave'
  WHEN {has(TEXT, r"(?i)\b(address|name change|withholding|pay stub)\b")} THEN 'payroll'
  WHEN {has(TEXT, r"(?i)\b(benefits?|medical|dental|vision|401k|hsa|fsa|open enrollment|dependent)\b")} THEN 'benefits' ELSE 'none' END AS topic FROM E)
SELECT email_id, topic, CASE WHEN {has(TEXT, r"\b\d{3}-\d{2}-\d{4}\b")} THEN 'escalate'
  WHEN topic = 'leave' THEN CASE WHEN {DATE_SQL} AND {TYPE_SQL} THEN 'reply' WHEN {DATE_SQL} OR {TYPE_SQL} THEN 'follow_up' ELSE 'triage' END
  WHEN topic = 'benefits' THEN CASE WHEN {has(TEXT, r"(?i)(how do i|am i eligible|can i|do i have)")} THEN 'reply' ELSE 'triage' END
  WHEN topic = 'verification' THEN CASE WHEN from_email LIKE '%@company.com' THEN 'reply' ELSE 'triage' END
  WHEN topic = 'payroll' THEN 'reply' ELSE 'none' END AS guardrail FROM t""")
def _(v):
    return T.category_guardrails(v.E).select("email_id", "topic", "guardrail")


RULES_CTE = "R AS (SELECT * FROM (VALUES " + ", ".join(
    f"({q(a)}, {q(b)}, {q(rx_sql(c))}, {q(d)}, {1000 if e is None else e})" for a, b, c, d, e, f in RULE_ROWS if f
) + ") x(rule_id, rule_type, rx, action, priority))"
COUNT_HITS = """SELECT r.rule_id, r.rule_type, r.action, r.priority, count(e.email_id) AS hits
FROM {src} r LEFT JOIN E e ON regexp_matches(CASE r.rule_type WHEN 'sender' THEN e.from_name || ' <' || e.from_email || '>'
  WHEN 'subject' THEN e.subject WHEN 'body' THEN e.body END, r.rx, 'i') GROUP BY ALL"""


def hit_counts(v, rules):
    """Matches per loaded rule over all e-mails; rules without a match stay with 0."""
    d = R.apply_rules(v.E, R.rule_rows(rules), stop_on_first=False)
    n = d.select(F.explode_outer("custom.matches.rule_id").alias("rule_id")).where("rule_id IS NOT NULL").groupBy("rule_id").agg(F.count("*").alias("hits"))
    return rules.join(n, "rule_id", "left").select(
        "rule_id", "rule_type", "action", "priority", F.coalesce("hits", F.lit(0)).alias("hits")
    )


@query("s9_load_rules", "E", sql=RULES_CTE + " " + COUNT_HITS.format(src="R"))
def _(v):
    return hit_counts(v, R.load_rules(v.spark.createDataFrame(ALT_ROWS, ALT_DDL)))


@query("t6_limited_rules", "E", sql=RULES_CTE + " " + COUNT_HITS.format(src="(SELECT * FROM R ORDER BY priority, rule_id LIMIT 4)"))
def _(v):
    return hit_counts(v, R.load_rules(v.spark.createDataFrame(RULE_ROWS, RULE_DDL)).limit(4))


@query("j4_rule_matches", "E", sql=RULES_CTE + """
SELECT e.email_id, r.rule_id FROM E e JOIN R r ON regexp_matches(CASE r.rule_type WHEN 'sender' THEN e.from_name || ' <' || e.from_email || '>'
  WHEN 'subject' THEN e.subject WHEN 'body' THEN e.body END, r.rx, 'i')""")
def _(v):
    d = R.apply_rules(v.E, LIVE, stop_on_first=False)
    return d.select("email_id", F.explode_outer("custom.matches.rule_id").alias("rule_id")).where("rule_id IS NOT NULL")


@query("x1_union_lanes", "E", sql=RULES_CTE + f"""
SELECT 'custom' AS lane, e.email_id, r.rule_id FROM E e JOIN R r ON regexp_matches(CASE r.rule_type WHEN 'sender' THEN e.from_name || ' <' || e.from_email || '>'
  WHEN 'subject' THEN e.subject WHEN 'body' THEN e.body END, r.rx, 'i')
UNION ALL SELECT 'standard', email_id, unnest({STD_IDS}) FROM E""")
def _(v):
    from mailsieve.operators.lanes import union_lanes

    custom = R.apply_rules(v.E, LIVE, stop_on_first=False).select("email_id", F.explode_outer("custom.matches.rule_id").alias("rule_id")).where("rule_id IS NOT NULL")
    std = v.E.select("email_id", F.explode_outer(R.standard_signals()["rule_id"]).alias("rule_id")).where("rule_id IS NOT NULL")
    return union_lanes(custom=custom, standard=std)


@query("a35_filter_rates", "E", sql=filter_sql(R.quick_rules(QUICK)) + """
SELECT cast(floor(email_id / 100) AS BIGINT) AS week, count(*) AS total, round(avg((decision = 'KEEP')::INT), 6) AS accept_rate,
  round(avg((decision = 'HUMAN')::INT), 6) AS triage_rate, round(avg((decision = 'IRRELEVANT')::INT), 6) AS drop_rate FROM f GROUP BY 1""")
def _(v):
    from mailsieve.operators.quality import filter_rates

    d = T.deterministic_filter(v.E, R.quick_rules(QUICK)).withColumn("week", F.floor(F.col("email_id") / 100))
    return filter_rates(d, "week")
