"""Probability distributions over categories, coverage and citation confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve import scale


def to_probability(score: Column, total: Column) -> Column:
    return F.round(score / total, 6)


def normalize_probs(df: DataFrame, by: str, weight: str, min_prob: float = 0.0, out: str = "prob") -> DataFrame:
    """Share of the group total; a floor on positive shares, then shares again."""

    def shares(d: DataFrame, col: str) -> DataFrame:
        d = scale.with_totals(d, [by], __total=F.sum(col))
        total = F.when(F.col("__total") <= 0, 1.0).otherwise(F.col("__total"))
        return d.withColumn(out, to_probability(F.col(col), total)).drop("__total")

    d = shares(df, weight)
    if min_prob > 0:
        floored = F.when(F.col(out) > 0, F.greatest(F.col(out), F.lit(min_prob))).otherwise(F.col(out))
        d = shares(d.withColumn(out, floored), out)
    return d


def score_probs(df: DataFrame, by: str, score: str, out: str = "probability") -> DataFrame:
    """Scores to probabilities; a total that is not positive counts as 0.001."""
    d = scale.with_totals(df, [by], __total=F.sum(F.coalesce(F.col(score), F.lit(0.0))))
    total = F.when(F.col("__total") <= 0, 0.001).otherwise(F.col("__total"))
    return d.withColumn(out, to_probability(F.coalesce(F.col(score), F.lit(0.0)), total)).drop("__total")


def distribution_stats(df: DataFrame, by: str, prob: str) -> DataFrame:
    p = F.col(prob)
    d = df.groupBy(by).agg(
        F.sum(F.when(p > 0, -p * F.log(p)).otherwise(0.0)).alias("__h"), F.max(p).alias("__max"),
        F.min(p).alias("__min"), F.count("*").alias("n"),
    )
    h, n = F.col("__h"), F.col("n")
    conc = F.when((n > 1) & (h > 0), F.round(1.0 - h / F.log(n.cast("double")), 4)).otherwise(0.0)
    return d.select(
        by, F.round(h, 4).alias("entropy"), F.round("__max", 6).alias("max_prob"), F.round("__min", 6).alias("min_prob"),
        conc.alias("concentration"), "n",
    )


def ensure_distribution(df: DataFrame, key: str, shortlist: str, raw: str, chosen: str, confidence: str) -> DataFrame:
    """One row per category: the model's normalised distribution (``raw``: array of category/prob structs), or a
    fallback that gives the chosen category its confidence and splits the rest."""
    ok, dist = array_ensure(F.col(raw), F.col(shortlist), F.col(chosen), F.col(confidence))
    d = df.select(key, F.when(ok, "llm").otherwise("fallback").alias("source"), dist.alias("__d"))
    return d.select(key, "source", F.inline("__d"))


def complete_distribution(dist: DataFrame, shortlist: DataFrame, by: str, min_prob: float = 0.01) -> DataFrame:
    """Adds the shortlisted categories a distribution lacks, at the minimum probability."""
    missing = shortlist.join(dist.select(by, "category"), [by, "category"], "left_anti")
    added = missing.select(by, "category", F.lit(min_prob).alias("prob"), F.lit("added_missing").alias("source"))
    return dist.select(by, "category", "prob", "source").unionByName(added)


def coverage(top: Column) -> Column:
    """Band of the best score; above 1 is a gap, as is anything below 0.45."""
    return (
        F.when(top.between(0.85, 1.0), "strong").when(top.between(0.65, 0.85), "moderate")
        .when(top.between(0.45, 0.65), "weak").otherwise("gap")
    )


def coverage_signal(df: DataFrame, by: str, score: str = "score") -> DataFrame:
    return df.groupBy(by).agg(F.max(score).alias("top_score")).withColumn("coverage", coverage(F.col("top_score")))


def citation_confidence(df: DataFrame, by: str, order: str, k: int = 3, score: str = "score") -> DataFrame:
    """Mean of the best ``k`` scores, clamped, or null when there is none."""
    scored = df.where(F.col(score).isNotNull())
    top = scale.top_per_key(scored, [by], [F.desc(score), F.col(order)], max(k, 1))
    return top.groupBy(by).agg(
        F.round(F.least(F.greatest(F.avg(score), F.lit(0.0)), F.lit(1.0)), 4).alias("confidence")
    )


# --- the same over an array column: one row per query, nothing shuffles --------------------------


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def array_probs(weights: Column, min_prob: float = 0.0) -> Column:
    """Array of weights to probabilities, with the floor on positive shares."""

    def shares(a: Column) -> Column:
        total = F.when(_total(a) <= 0, 1.0).otherwise(_total(a))
        return F.transform(a, lambda x: to_probability(x, total))

    p = shares(weights)
    if min_prob > 0:
        p = shares(F.transform(p, lambda x: F.when(x > 0, F.greatest(x, F.lit(min_prob))).otherwise(x)))
    return p


def array_stats(probs: Column) -> Column:
    """Struct of entropy, extremes, concentration and size of an array of probabilities."""
    h = _total(F.transform(probs, lambda p: F.when(p > 0, -p * F.log(p)).otherwise(0.0)))
    n = F.size(probs)
    conc = F.when((n > 1) & (h > 0), F.round(1.0 - h / F.log(n.cast("double")), 4)).otherwise(0.0)
    return F.struct(
        F.round(h, 4).alias("entropy"), F.round(F.array_max(probs), 6).alias("max_prob"),
        F.round(F.array_min(probs), 6).alias("min_prob"), conc.alias("concentration"), n.alias("n"),
    )


def array_ensure(raw: Column, shortlist: Column, chosen: Column, confidence: Column) -> tuple[Column, Column]:
    """(whether the model gave a distribution, the array of category/prob structs as in ``ensure_distribution``)."""
    valid = raw.isNotNull() & (F.size(raw) > 0) & F.forall(raw, lambda d: d["category"].isNotNull() & d["prob"].isNotNull())
    total = F.aggregate(raw, F.lit(0.0), lambda s, d: s + d["prob"])
    total = F.when(total <= 0, 1.0).otherwise(total)
    given = F.transform(
        raw, lambda d: F.struct(d["category"].alias("category"), F.round(d["prob"] / total, 6).alias("prob")))
    conf = F.least(F.greatest(F.coalesce(confidence, F.lit(0.5)), F.lit(0.1)), F.lit(0.99))
    names = F.coalesce(shortlist, F.array(chosen))
    others = F.size(F.filter(names, lambda c: c != chosen))
    rest = F.when(others > 0, F.round((1.0 - conf) / others, 6)).otherwise(0.0)
    fallback = F.transform(
        names,
        lambda c: F.struct(c.alias("category"), F.when(c == chosen, F.round(conf, 6)).otherwise(rest).alias("prob")))
    ok = F.coalesce(valid, F.lit(False))
    return ok, F.when(ok, given).otherwise(fallback)


def with_ranking(df: DataFrame, shortlist: str, reply: str, min_prob: float = 0.01) -> DataFrame:
    """``df`` with ``ranking``, an array of (category, prob, source) by falling probability, and
    ``distribution_source``, from the referee's ``reply`` (category, confidence, distribution).

    Probabilities are normalised, positive ones get the floor and are normalised again; shortlisted categories
    that the referee left out follow at the floor as ``added_missing``.  Ties stay in the order given.  Without a
    chosen category the fallback takes the first of the shortlist.
    """
    r, names = F.col(reply), F.col(shortlist)
    ok, dist = array_ensure(r["distribution"], names, F.coalesce(r["category"], F.get(names, F.lit(0))), r["confidence"])
    d = df.withColumns({"distribution_source": F.when(ok, "llm").otherwise("fallback"), "__d": dist})
    d = d.withColumns({
        "__p": array_probs(F.col("__d.prob"), min_prob),
        "__missing": F.array_except(names, F.coalesce(F.col("__d.category"), F.array().cast("array<string>")))})
    source = F.col("distribution_source")
    met = F.transform("__d", lambda x, i: F.struct(
        (-F.get("__p", i)).alias("order"), i.alias("at"), x["category"].alias("category"), source.alias("source")))
    added = F.transform("__missing", lambda c, i: F.struct(
        F.lit(-min_prob).alias("order"), (F.size("__d") + i).alias("at"), c.alias("category"), F.lit("added_missing").alias("source")))
    ranked = F.transform(F.array_sort(F.concat(met, added)), lambda x: F.struct(
        x["category"].alias("category"), (-x["order"]).alias("prob"), x["source"].alias("source")))
    return d.withColumn("ranking", ranked).drop("__d", "__p", "__missing")
