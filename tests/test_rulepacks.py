"""Rule tables through the automaton against the literal form."""

from __future__ import annotations

import random
import re

import pytest

from mailsieve.operators import rules
from mailsieve.operators.rulepacks import Gate, apply_rule_table, required_literals

SCHEMA = "rule_id string, rule_type string, rule_pattern string, action string, priority int, active boolean"


@pytest.mark.parametrize(("pattern", "literals"), [
    ("Cost (net) $5", {"cost (net) $5"}), ("/abc|defg/", {"abc", "defg"}), ("/x(foo|ba+r)?yes/", {"yes"}), ("re:^Inv\\w+ice$", {"inv"}),
    ("/a|/", set()), ("/[ab]c*/", set()), ("/(?=x)abc/", set()), ("/\\Qab\\E/", set()), ("/[a&&[b]]foo/", set()), ("/(broken/", set()),
    ("Ünïcode word", {"code word"}), ("/colou?r scheme/", {"r scheme"}), ("/(ab){2,3}c/", {"ab"}), ("/a(?:bc|de)f/", {"bc", "de"}),
])
def test_required_literals(pattern, literals):
    assert required_literals(pattern) == literals


def test_gate_misses_nothing():
    rnd = random.Random(5)
    patterns = ["".join(rnd.choice(["a", "b", "c", "(a|bc)", "[ab]", "c?", "(?:ab)+", ".", "B"]) for _ in range(rnd.randint(1, 5)))
                for _ in range(300)]
    gate = Gate([(i, f"/{p}/") for i, p in enumerate(patterns)])
    for _ in range(200):
        text = "".join(rnd.choices("abcABC x", k=rnd.randint(0, 12)))
        met = {i for i, p in enumerate(patterns) if re.search(p, text, re.IGNORECASE)}
        assert met <= gate.candidates(text)
    assert gate.candidates(None) == set()


def table_of(spark, rows):
    return rules.load_rules(spark.createDataFrame(rows, SCHEMA))


def test_ten_thousand_rules_equal_the_literal_form_of_two_hundred(spark, views):
    words = ["invoice", "meeting", "newsletter", "the", "reply", "order", "team", "budget", "holiday", "contract"]
    some = [(f"r{i:05d}", ("sender", "subject", "body")[i % 3], p, "act", i % 7, True) for i, p in enumerate(
        p for w in words for p in (w, f"/{w}s?/", f"re:\\b{w}\\b", f"/^.*{w}$/", f"/({w}|{w[::-1]})/"))][:200]
    rest = [(f"z{i:05d}", ("sender", "subject", "body")[i % 3], f"nowhere-{i}-{'x' * (i % 5)}", "none", 50, True) for i in range(10_000 - len(some))]
    few = rules.rule_rows(table_of(spark, some))
    e = views.E.select("email_id", "from_name", "from_email", "subject", "body")
    for first in (True, False):
        wide = apply_rule_table(e, table_of(spark, some + rest), stop_on_first=first)
        plain = rules.apply_rules(e, few, stop_on_first=first)
        a = {r.email_id: r.custom.matches for r in wide.collect()}
        assert a == {r.email_id: r.custom.matches for r in plain.collect()} and any(a.values())
        small = apply_rule_table(e, table_of(spark, some[:5]), stop_on_first=first)
        size = [len(d._jdf.queryExecution().optimizedPlan().toString()) for d in (small, wide)]
        assert abs(size[0] - size[1]) < 200


def test_odd_rows_and_no_rules(spark, views):
    e = views.E.select("email_id", "from_name", "from_email", "subject", "body").orderBy("email_id").limit(5)
    none = apply_rule_table(e, table_of(spark, []).limit(0))
    assert all(r.custom.matches == [] and r.custom.evaluated_count == 0 for r in none.collect())
    blank = e.selectExpr("email_id", "from_name", "from_email", "cast(null as string) AS subject", "repeat('ab ', 100000) AS body")
    rows = [("1", "subject", "/.*/", "a", 1, True), ("2", "body", "/(ab ){1,5}/", "b", 2, True), ("3", "body", " ", "c", 3, True)]
    for left in (rows, rows[1:]):
        got = apply_rule_table(blank, table_of(spark, left)).select("email_id", "custom").collect()
        plain = rules.apply_rules(blank, rules.rule_rows(table_of(spark, left))).select("email_id", "custom").collect()
        assert sorted(got) == sorted(plain) and all(len(r.custom.matches) == 1 for r in got)
