"""Rule tables of thousands of patterns: one automaton over required literals picks the rules worth trying.

The plan has the same size for any number of rules.  An automaton, built once per task, finds in one pass over a
text which rules' required literals occur; only those rules' expressions are then run, by Spark's own regex engine.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.operators.rules import DEFAULT_PRIORITY, MATCH_TYPE, _int, haystack, rule_regex, rule_rows, usable

FIELDS = ("sender", "subject", "body")
#: Syntax that the two regex engines read differently; such rules are tried on every text.
_FOREIGN = re.compile(r"\\[QEpPhHRXGzZkNxu0-9]|\(\?(?!:)|&&|\[[^\]]*\[")
_RULE = pa.struct([
    ("n", pa.int32()), ("priority", pa.int32()), ("rule_id", pa.string()), ("rule_type", pa.string()),
    ("rule_pattern", pa.string()), ("action", pa.string()), ("rx", pa.string()),
])
_RULE_TYPE = "array<struct<n:int,priority:int,rule_id:string,rule_type:string,rule_pattern:string,action:string,rx:string>>"


def _runs(parsed) -> Iterator[frozenset[str]]:
    """Sets of literals of which a match of a parsed sequence holds at least one, for each part that has any."""
    run = ""
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL" and arg < 128:
            run += chr(arg)
            continue
        if run:
            yield frozenset([run])
        run = ""
        if kind == "SUBPATTERN":
            yield from _runs(arg[-1])
        elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] > 0:
            yield from _runs(arg[2])
        elif kind == "BRANCH":
            ways = [best_literals(_runs(branch)) for branch in arg[1]]
            if all(ways):
                yield frozenset().union(*ways)
    if run:
        yield frozenset([run])


def best_literals(found: Iterator[frozenset[str]]) -> frozenset[str]:
    """Of several sets the one whose shortest literal is longest; empty if there is none."""
    return max(found, key=lambda s: (min(map(len, s)), -len(s)), default=frozenset())


def required_literals(pattern: str) -> frozenset[str]:
    """Lower-case literals of which every text that ``pattern`` (as rules write it) matches holds at least one.

    Empty if none is sure.  Only ASCII counts, as case is ignored for ASCII alone.
    """
    p = pattern.strip()
    if len(p) >= 2 and p.startswith("/") and p.endswith("/"):
        body = p[1:-1]
    elif p.startswith("re:"):
        body = p[3:]
    else:
        return best_literals(frozenset([x]) for x in re.findall(r"[\x00-\x7F]+", p.lower()))
    if _FOREIGN.search(body):
        return frozenset()
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            parsed = re._parser.parse(body)
    except (re.error, Warning, OverflowError):
        return frozenset()
    return frozenset(x.lower() for x in best_literals(_runs(parsed)))


class Gate:
    """Which rules of one field may match a text."""

    def __init__(self, rules: Sequence[tuple[int, str]]) -> None:
        """``rules`` are (number, pattern)."""
        owners: dict[str, list[int]] = {}
        self.always: list[int] = []
        for n, pattern in rules:
            literals = required_literals(pattern)
            if not literals:
                self.always.append(n)
            for x in literals:
                owners.setdefault(x, []).append(n)
        self.automaton = ahocorasick.Automaton()
        for x, numbers in owners.items():
            self.automaton.add_word(x, numbers)
        if owners:
            self.automaton.make_automaton()
        self.some = bool(owners)

    def candidates(self, text: str | None) -> set[int]:
        if text is None:
            return set()
        out = set(self.always)
        if self.some:
            lower = text.encode().lower().decode()  # bytes lower A-Z only
            for _, numbers in self.automaton.iter(lower):
                out.update(numbers)
        return out


def _candidates(rules: Sequence[Mapping]) -> Column:
    """Rules worth trying on a row, in evaluation order."""
    rows = [(i + 1, _int(r.get("priority"), DEFAULT_PRIORITY), str(r.get("rule_id") or ""), r["rule_type"], r["rule_pattern"],
             r.get("action"), rule_regex(r["rule_pattern"])) for i, r in enumerate(rules)]
    built: dict[str, object] = {}

    @F.arrow_udf(_RULE_TYPE)
    def find(sender: pa.Array, subject: pa.Array, body: pa.Array) -> pa.Array:
        if not built:
            for field in FIELDS:
                built[field] = Gate([(r[0], r[4]) for r in rows if r[3] == field])
            built["rows"] = pa.array([dict(zip(_RULE.names, r, strict=True)) for r in rows], _RULE)
        gates = [built[field] for field in FIELDS]
        flat, offsets = [], [0]
        for texts in zip(sender.to_pylist(), subject.to_pylist(), body.to_pylist(), strict=True):
            flat += [n - 1 for n in sorted(set().union(*[g.candidates(t) for g, t in zip(gates, texts, strict=True)]))]
            offsets.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), built["rows"].take(pa.array(flat, pa.int64())))

    return find(*[haystack(field) for field in FIELDS])


def apply_rule_table(df: DataFrame, rules: DataFrame, stop_on_first: bool = True, out: str = "custom") -> DataFrame:
    """``apply_rules`` for a table of rules (``load_rules``): struct (matches, evaluated_count), the same rows.

    The table is read on the driver, where more than MAX_RULES rows are an error.  Null fields match nothing; rows never
    move.  Rules without a sure literal are tried on every row.
    """
    live = usable(rule_rows(rules))
    sender, subject, body = (haystack(field) for field in FIELDS)

    def text(rule: Column) -> Column:
        return F.when(rule["rule_type"] == "sender", sender).when(rule["rule_type"] == "subject", subject).otherwise(body)

    def match(rule: Column) -> Column:
        return F.struct(
            rule["priority"].alias("priority"), rule["rule_id"].alias("rule_id"), rule["rule_type"].alias("rule_type"),
            rule["rule_pattern"].alias("rule_pattern"), rule["action"].alias("action"),
            F.coalesce(F.regexp_substr(text(rule), rule["rx"]), F.lit("")).alias("sample"))

    d = df.withColumn("__tried", _candidates(live))
    d = d.withColumn("__met", F.filter("__tried", lambda rule: F.rlike(text(rule), rule["rx"])))
    if stop_on_first:
        matches = F.transform(F.slice("__met", 1, 1), match)
        count = F.coalesce(F.get("__met", F.lit(0))["n"], F.lit(len(live)))
    else:
        matches, count = F.sort_array(F.transform("__met", match)), F.lit(len(live))
    return d.withColumn(
        out, F.struct(matches.cast(f"array<{MATCH_TYPE}>").alias("matches"), count.alias("evaluated_count"))).drop("__tried", "__met")
