"""Checks on generated replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.functions.text import blank, strip


def plain_words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^A-Za-z0-9_]+"), lambda w: w != "")


def validate_responses(
    df: DataFrame, response: str, query: str, rules: Sequence[tuple[str, str]] = (), min_confidence: float = 0.7,
) -> DataFrame:
    """Deductions from full confidence with their issues; ``rules`` are (contains | not_contains, text)."""
    r, asked = blank(F.col(response)), plain_words(blank(F.col(query)))
    share = F.size(F.array_intersect(asked, plain_words(r))) / F.size(asked)
    overlap = F.when(F.size(asked) == 0, 0.0).otherwise(share)
    empty = strip(r) == ""
    checks = [
        (empty, "Response is empty", 0.5), (~empty & (F.length(r) < 10), "Response is too short", 0.3),
        (overlap < 0.1, "Response may not address the query", 0.4),
        (r.contains("...") | F.lower(r).contains("incomplete"), "Response appears incomplete", 0.2),
    ]
    for kind, text in rules:
        if kind == "contains":
            checks.append((~r.contains(text), f"Response does not contain required text: {text}", 0.3))
        elif kind == "not_contains":
            checks.append((r.contains(text), f"Response contains prohibited text: {text}", 0.3))
    d = df.withColumn("query_overlap", F.round(overlap, 2)).withColumn(
        "issues", F.array_compact(F.array(*[F.when(c, m) for c, m, _ in checks]))
    )
    lost = sum((F.when(c, w).otherwise(0.0) for c, _, w in checks), F.lit(0.0))
    conf = F.least(F.greatest(1.0 - lost, F.lit(0.0)), F.lit(1.0))
    d = d.withColumn("confidence_score", F.round(conf, 2))
    s = F.col("confidence_score")
    return (
        d.withColumn("is_valid", s >= min_confidence).withColumn("requires_human_review", s < 0.5)
        .withColumn("confidence_level", F.when(s >= 0.8, "high").when(s >= 0.6, "medium").otherwise("low"))
    )


def edit_share(draft: Column, final: Column) -> Column:
    """Edit distance as a share of the longer text."""
    longer = F.greatest(F.length(draft), F.length(final))
    return F.when(longer == 0, 0.0).otherwise(F.round(F.levenshtein(draft, final) / longer, 6))
