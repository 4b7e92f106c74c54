"""Quality score by a sparse rule ensemble: tree paths over text statistics, lasso weights, compiled to columns."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.session import cut_lineage

#: Labelled rows that a model is fitted on: all, or about so many chosen by a hash of the id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 10, 3, 7
LASSO = 0.001

Condition = tuple[str, str, float]
Rule = tuple[Condition, ...]


def statistics() -> dict[str, Column]:
    """Named statistics over ``__text`` (not null), its ``__words`` and its ``__lines``."""
    def left(pattern: str) -> Column:
        return F.char_length(F.regexp_replace("__text", pattern, ""))

    chars = F.greatest(F.char_length("__text"), F.lit(1))
    words, lines = F.greatest(F.size("__words"), F.lit(1)), F.greatest(F.size("__lines"), F.lit(1))
    shares = {
        "upper_share": (F.char_length("__text") - left(r"\p{Lu}+")) / chars,
        "digit_share": (F.char_length("__text") - left(r"\p{Nd}+")) / chars,
        "symbol_share": (F.char_length("__text") - left(r"[^\p{L}\p{N}\s.,;:'\-]+")) / chars,
        "stop_share": (F.char_length("__text") - left(r"[.,;:]+")) / chars,
    }
    return {
        "chars": F.log1p(F.char_length("__text").cast("double")),
        "word_chars": F.char_length("__text") / words,
        "distinct_words": F.size(F.array_distinct("__words")) / words,
        "distinct_lines": F.size(F.array_distinct("__lines")) / lines,
        "line_words": F.size("__words") / lines,
        **shares,
    }


def with_statistics(docs: DataFrame, keep: list[str], *more: Column) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the statistics of its text, and ``more`` beside them."""
    base = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))
    split = base.withColumns({
        "__words": F.array_remove(F.split("__text", r"\s+"), ""), "__lines": F.split("__text", "\n")})
    return split.select(*keep, *[c.cast("double").alias(n) for n, c in statistics().items()], *more)


STATISTICS = (
    "chars", "word_chars", "distinct_words", "distinct_lines", "line_words", "upper_share", "digit_share",
    "symbol_share", "stop_share",
)


def tree_rules(description: str, names: tuple[str, ...]) -> set[Rule]:
    """Conjunctions on the way to every node of a described tree, each statistic bounded once a side."""
    path: list[Condition] = []
    out = set()
    for line in description.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        while path and path[-1][0] >= depth:
            path.pop()
        path.append((depth, (names[int(m[2])], m[3], float(m[4]))))
        tight: dict[tuple[str, str], float] = {}
        for _, (name, sign, bound) in path:
            best = min if sign == "<=" else max
            tight[name, sign] = best(bound, tight.get((name, sign), bound))
        out.add(tuple(sorted((n, s, b) for (n, s), b in tight.items())))
    return out


def rule_column(rule: Rule) -> Column:
    return reduce(and_, [F.col(n) <= b if s == "<=" else F.col(n) > b for n, s, b in rule])


@dataclass(frozen=True)
class QualityModel:
    """Weighted rules; a text's score is the logistic function of the weights of the rules it meets."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def learnable(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row may be learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Model of ``labels.quality`` from the texts of ``docs``, over learnable rows only.

    Trees of a small forest are cut into rules, and a lasso logistic regression keeps the few that matter.
    At most about ``max_rows`` labelled rows are used (a fixed share by hash of the id), so the broadcast
    side, the fitted table and the model are bounded whatever the corpus; statistics are of whole texts.
    Null labels are skipped.  Without rows of both classes the model is the smoothed share of class 1.
    """
    usable = labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("__label")).where(
        learnable(F.col("__id")) & F.col("__label").isNotNull())
    total = usable.count()
    share = min(1.0, max_rows / max(total, 1))
    sample = usable.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(share * 1_000_000))
    chosen = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("text", "__label")
    # at most about max_rows rows of numbers: one partition makes the many small jobs of a fit short
    table = cut_lineage(with_statistics(chosen, ["__label"])).coalesce(1)
    vectors = table.select(
        F.col("__label").alias("label"), *STATISTICS, array_to_vector(F.array(*STATISTICS)).alias("features"))
    counts = {r.label: r["count"] for r in vectors.groupBy("label").count().collect()}
    if len(counts) < 2:
        ones = counts.get(1.0, 0)
        p = (ones + 1) / (sum(counts.values()) + 2)
        return QualityModel((), math.log(p / (1 - p)))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="0.5", maxBins=64).fit(vectors)
    rules = sorted(set().union(*[tree_rules(t.toDebugString, STATISTICS) for t in forest.trees]))
    met = vectors.select("label", array_to_vector(F.array(*[rule_column(r).cast("double") for r in rules]))
                         .alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=30).fit(met)
    weights = [float(w) for w in lasso.coefficients]
    return QualityModel(
        tuple((r, w) for r, w in zip(rules, weights, strict=True) if w), float(lasso.intercept))


THRESHOLD = 0.3


def quality_scores(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, ...): (doc_id, held_out, score, predicted).

    The score depends on the text alone: statistics and rules are column expressions of the scan's stage, so
    nothing is shuffled.  Null and empty texts score like a text without characters.  Extra columns, also
    ones named like a statistic, are ignored.
    """
    scored = with_statistics(docs.select("doc_id", "text"), ["doc_id"]).select("doc_id", model.score().alias("score"))
    return scored.select(
        "doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``, with their columns.

    The condition names a column that is numbered per row, or the optimizer would move it below the
    statistics and work out each of them again for every rule that names it.
    """
    packed = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    scored = with_statistics(packed, ["__row"], F.monotonically_increasing_id().alias("__at"))
    return scored.where((F.col("__at") >= 0) & (model.score() >= threshold)).select("__row.*")
