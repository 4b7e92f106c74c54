"""Composite plans: categorise, retrieve, rank, request, answer, and the end-to-end funnel."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve import scale
from mailsieve.functions import jsonx as J
from mailsieve.functions import models
from mailsieve.functions.text import blank, sanitize_pdf, strip
from mailsieve.operators import contexts as C
from mailsieve.operators import distribution as D
from mailsieve.operators import intents as I
from mailsieve.operators import triage as TR
from mailsieve.operators import vectors as V
from mailsieve.operators.chunking import split_valid
from mailsieve.operators.quality import with_outcome
from mailsieve.operators.rules import RulePack
from mailsieve.session import cut_lineage

ANSWER = T.StructType([
    T.StructField("answer", T.StringType()),
    T.StructField("citations", T.ArrayType(T.StructType([
        T.StructField("chunk_id", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("uri", T.StringType()), T.StructField("score", T.DoubleType()),
    ]))),
])


@dataclass(frozen=True)
class Retrieved:
    contexts: DataFrame
    counts: DataFrame


@dataclass(frozen=True)
class Ranked:
    records: DataFrame
    distribution: DataFrame
    stats: DataFrame


def categorize(
    emails: DataFrame, categories: DataFrame, email_id: str, k: int = 3, min_prob: float = 0.01, fallback: str = "Other",
    preset: str | float = "balanced", name: str = "category", text: str | None = None,
    referee: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Shortlist by vector, distribution over the shortlist, then the referee gate: one row per e-mail.

    Without ``text`` the distribution are the shares of the vector scores.  With it a referee reads the text (null:
    empty) and the shortlist and replies (category, confidence, distribution); a missing distribution is replaced
    and categories it left out are added at ``min_prob``.  Everything after the scoring works on the arrays of the
    e-mail's own row, so nothing shuffles.
    """
    carry = [] if text is None else [text]
    top = V.category_arrays(emails, categories, email_id, name=name, carry=carry).select(
        email_id, *carry, F.slice("scores", 1, max(k, 1)).alias("__top")
    )
    d = top.withColumns({
        "__w": F.transform("__top", lambda s: V.category_score(s["cosine"])), "shortlist": F.col("__top.category")})
    if text is None:
        d = d.withColumn("ranking", F.arrays_zip(
            F.col("shortlist").alias("category"), D.array_probs(F.col("__w"), min_prob).alias("prob")))
        more = []
    else:
        reply = (referee or models.lexical_referee)(blank(F.col(text)), F.col("shortlist"))
        d = D.with_ranking(d.withColumn("__r", reply), "shortlist", "__r", min_prob)
        more = ["ranking", "distribution_source"]
    d = d.withColumn("__p", F.col("ranking.prob")).withColumn("confidence", F.array_max("__p"))
    d = d.select(
        email_id, "shortlist", F.array_max("__w").alias("top_score"), (F.array_max("__w") < 0.5).alias("low_confidence"),
        F.element_at("ranking", F.array_position("__p", F.col("confidence")).cast("int"))["category"].alias("category"),
        "confidence", *more, D.array_stats(F.col("__p")).alias("__s"),
    ).select("*", "__s.*").drop("__s", "n")
    return TR.referee_gate(d, V.category_names(categories, name), preset, fallback)


def dress_contexts(hits: DataFrame, metadata: Column, on_error: str = "skip") -> DataFrame:
    """Repair PDF text and mark contexts without text; the error behaviour skips, keeps or refuses them."""
    pdf = C.is_pdf_source(F.col("uri"), metadata)
    clean = F.when(pdf, sanitize_pdf(blank(F.col("text")))).otherwise(blank(F.col("text")))
    d = hits.withColumn("is_pdf", pdf).withColumn("text", clean).withColumn("processing_error", strip(F.col("text")) == "")
    if on_error == "skip":
        return d.where(~F.col("processing_error"))
    if on_error == "fail":
        return d.withColumn(
            "text", F.when(F.col("processing_error"), F.raise_error(F.concat(F.lit("context without text: "), "id")).cast("string"))
            .otherwise(F.col("text")),
        )
    return d.withColumn("text", F.when(F.col("processing_error"), "[Error processing context]").otherwise(F.col("text")))


def retrieve_contexts(
    queries: DataFrame, corpus: DataFrame, texts: DataFrame, text_key: str, metadata: Column, preset: str = "balanced",
    on_error: str = "skip", extra: Sequence[str] = (), **search,
) -> Retrieved:
    """Vector retrieval, text of the hits, repair, and counters per query.

    ``texts`` joins after the search, so only retrieved rows read their text.
    """
    hits = V.retrieve(queries, corpus, preset, carry=[text_key, *extra], **search)
    dressed = hits.join(texts, text_key)
    every = dress_contexts(dressed, metadata, "include")
    return Retrieved(dress_contexts(dressed, metadata, on_error), C.retrieval_counts(every, "query_id"))


def rank_contexts(
    records: DataFrame, by: str, query: str, category: str, weights: str | tuple[float, float] = "balanced",
    max_scored: int | None = None, top_n: int | None = None, scorer=None,
) -> Ranked:
    """Score the records of each query, mix, rank, cut, and describe the outcome.

    With ``max_scored`` only the first ones are scored; the rest take no part in ranks and probabilities.

    The mixed scores are written once as thin rows (query, id, scores): the results all read them, and
    neither the model nor the text scan runs again for each.
    """
    valid, _ = split_valid(records, ["id", "text"])
    if max_scored is not None:
        valid = scale.top_per_key(valid, [by], [F.col("rnk")], max_scored, "__first").drop("__first")
    scored = models.score(valid, query, "text", "relevance", scorer)
    scored = scored.select(by, "id", "relevance", models.lexical_alignment(F.col(category), F.col("text")).alias("alignment"))
    merged = C.merge_scores(valid.select(by, "id"), scored, [by, "id"], weights)
    ranked = C.rank_records(cut_lineage(merged), by)
    if top_n:
        ranked = ranked.where(F.col("rank") <= top_n)
    dist = D.score_probs(ranked, by, "score")
    stats = D.distribution_stats(dist, by, "probability").join(D.coverage_signal(ranked, by), by)
    full = ranked.join(valid.drop("score"), [by, "id"])
    return Ranked(full, dist.select(by, "id", "probability", F.round("score", 6).alias("score")), stats)


@dataclass(frozen=True)
class Prompting:
    """Columns of the queries that make up a system prompt: tone template or a prompt of one's own, signals from
    earlier stages, and the mailbox that answers."""

    template: Column | None = None
    custom: Column | None = None
    category: Column | None = None
    intent: Column | None = None
    confidence: Column | None = None
    channel: str = ""

    def system(self, default: Column) -> Column:
        """Template before the default, or the own prompt instead; then the channel, then what the signals add."""
        text = default if self.template is None else I.system_prompt(self.template, default, self.custom)
        if self.channel:
            text = F.concat(text, F.lit("\n\n" + self.channel))
        return I.enrich_prompt(text, *self._signals()[:2])

    def applied(self) -> Column:
        return I.applied_signals(*self._signals())

    def _signals(self) -> list[Column]:
        given = zip((self.category, self.intent, self.confidence), ("string", "string", "double"), strict=True)
        return [F.lit(None).cast(kind) if c is None else c for c, kind in given]


def build_requests(
    queries: DataFrame, contexts: DataFrame, by: str, question: str, system: str, preset: str = "balanced",
    strategy: str = "drop_low_score", dedupe: float = 0.9, prompting: Prompting | None = None,
) -> DataFrame:
    """Generation request per query: bounded, shortened, ordered, de-duplicated and fitted contexts.

    With ``prompting`` the column ``system`` is the default that the prompt is built from, before the contexts
    are fitted, since its length counts; ``applied_signals`` then says what went into it.
    """
    more = []
    if prompting is not None:
        queries = queries.withColumns({"applied_signals": prompting.applied(), system: prompting.system(F.col(system))})
        more = ["applied_signals"]
    n, budget, reserve = C.prompt_budget(preset)
    d = C.shrink(C.first_chunks(contexts, by, "rnk", n))
    d = C.drop_near_duplicates(C.trim_order(d, by, strategy), by, ["pos"], threshold=dedupe)
    d = d.join(queries.select(by, question, system), by)
    d = C.select_by_budget(d, by, "pos", F.col(question), F.col(system), budget)
    blob = C.join_blocks(d, by, C.default_block(), "pos")
    out = queries.join(blob, by, "left")
    user = F.concat(F.lit("Question:\n"), question, F.lit("\n\nContext:\n"), blank(F.col("context")))
    return out.select(
        by, F.coalesce("n_contexts", F.lit(0)).alias("n_contexts"), user.alias("user_text"), F.col(system).alias("system_text"),
        F.lit(reserve).alias("max_output_tokens"),
        F.to_json(F.struct(
            F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(user.alias("text"))).alias("parts"))).alias("contents"),
            F.struct(F.lit(0).alias("temperature"), F.lit(reserve).alias("maxOutputTokens"),
                     F.lit("application/json").alias("responseMimeType")).alias("generationConfig"),
        )).alias("payload"), *more,
    )


def parse_answers(df: DataFrame, key: str, reply: str) -> DataFrame:
    """Answer, citations and confidence (mean of the three best citation scores) of each reply."""
    d = df.withColumn("__r", J.parse_model_json(F.col(reply), ANSWER))
    cites = F.coalesce("__r.value.citations", F.array().cast(ANSWER["citations"].dataType))
    scores = F.sort_array(F.filter(F.transform(cites, lambda c: c["score"]), lambda s: s.isNotNull()), asc=False)
    best = F.slice(scores, 1, 3)
    mean = F.aggregate(best, F.lit(0.0), lambda a, s: a + s) / F.size(best)
    conf = F.when(F.size(best) > 0, F.round(F.least(F.greatest(mean, F.lit(0.0)), F.lit(1.0)), 4))
    return d.select(
        key, F.coalesce("__r.value.answer", F.col(reply)).alias("answer"), cites.alias("citations"),
        F.size(cites).alias("n_citations"), conf.alias("confidence"),
    )


def _routed(
    emails: DataFrame, predictions: DataFrame, pack: RulePack, actionable: Sequence[str], key: str,
) -> DataFrame:
    """(key, and for each routing stage whether the e-mail reaches it)."""
    f = TR.deterministic_filter(emails, pack).select(key, F.col("decision").alias("filter_decision"), "passed")
    d = f.join(predictions.withColumnRenamed("doc_id", key), key)
    d = TR.route_triage(d)
    d = TR.route_intent(d, actionable)
    d = TR.generator_gate(d)
    a = F.col("passed") & F.col("should_continue")
    b = a & F.col("is_actionable")
    stages = {"inbound": F.lit(True), "passed_filter": F.col("passed"), "continued": a, "actionable": b, "eligible": b & F.col("pass_to_responder")}
    return d.select(key, *[F.coalesce(c, F.lit(False)).alias(n) for n, c in stages.items()])


def _counts(flags: DataFrame, key: str) -> DataFrame:
    """(step, stage, n) of a table with one flag column a stage."""
    stages = [c for c in flags.columns if c != key]
    one = flags.agg(*[F.count_if(F.col(n)).alias(n) for n in stages])
    pairs = ", ".join(f"{i}, '{n}', {n}" for i, n in enumerate(stages))
    return one.select(F.expr(f"stack({len(stages)}, {pairs}) AS (step, stage, n)"))


def run_funnel(
    emails: DataFrame, predictions: DataFrame, pack: RulePack, actionable: Sequence[str], key: str = "email_id",
) -> DataFrame:
    """How many e-mails reach each routing stage: filter, triage, intent, generator."""
    return _counts(_routed(emails, predictions, pack, actionable, key), key)


def run_all(
    emails: DataFrame, predictions: DataFrame, pack: RulePack, actionable: Sequence[str], vectors: DataFrame,
    categories: DataFrame, corpus: DataFrame, texts: DataFrame, outcomes: DataFrame, key: str = "email_id",
    preset: str | float = "balanced", min_similarity: float = 0.5, top_k: int = 20, request: str = "conservative",
) -> DataFrame:
    """How many e-mails reach each stage from the filter to the outcome.

    Routing, categories with the referee, retrieval, ranking, the request, then what became of the answers
    (``outcomes``: key, rating, blocked).  ``vectors`` are (key, embedding), ``categories`` (category,
    embedding), ``corpus`` (vec_id, doc_id, uri, embedding), ``texts`` (doc_id, text).  Every stage works on
    those that reached it, and its keys are written once for the stages that follow.
    """
    flags = cut_lineage(_routed(emails, predictions, pack, actionable, key))
    asked = vectors.join(flags.where("eligible").select(key), key, "left_semi")
    sure = categorize(asked, categories, key, preset=preset).where("pass_to_responder")
    go = cut_lineage(asked.join(sure.select(key, "chosen"), key))
    queries = go.select(F.col(key).cast("string").alias("query_id"), "embedding", "chosen")
    found = retrieve_contexts(
        queries, corpus, texts, "doc_id", F.create_map().cast("map<string,string>"), "broad", extra=["uri"],
        min_similarity=min_similarity, top_k=top_k).contexts
    records = cut_lineage(found.join(queries.select("query_id", "chosen"), "query_id").withColumns({
        "id": F.concat(F.lit("v"), F.col("vec_id").cast("string")), "rnk": F.col("rank"), "source": F.lit(None).cast("string"),
        "question": F.concat(F.lit("About "), "chosen")}).drop("rank"))
    ranked = rank_contexts(records, "query_id", "question", "chosen").records
    best = cut_lineage(ranked.select("query_id", "id", "text", "source", "uri", "score", F.col("rank").alias("rnk")))
    ask = queries.select("query_id", F.concat(F.lit("About "), "chosen").alias("question"), F.lit("Be brief.").alias("system"))
    made = build_requests(ask, best, "query_id", "question", "system", request).where("n_contexts > 0")
    reached = {
        "categorized": go.select(F.col(key)), "retrieved": records.select(F.col("query_id").cast("long").alias(key)),
        "ranked": best.select(F.col("query_id").cast("long").alias(key)),
        "requested": made.select(F.col("query_id").cast("long").alias(key)),
    }
    for name, d in reached.items():
        flags = flags.join(d.distinct().withColumn(name, F.lit(True)), key, "left").withColumn(
            name, F.coalesce(name, F.lit(False)))
    ended = with_outcome(outcomes.withColumn("confidence", F.lit(None).cast("double"))).select(key, "outcome")
    flags = flags.join(ended, key, "left")
    for name in ("blocked", "accepted", "edited", "rejected"):
        flags = flags.withColumn(name, F.col("requested") & F.coalesce(F.col("outcome") == name, F.lit(False)))
    return _counts(flags.drop("outcome"), key)


def with_telemetry(
    df: DataFrame, stage: str, key: str, run_id: str, ok: Column | None = None, message: Column | None = None,
    corr: str | None = None, started: Column | None = None, ended: Column | None = None,
    facets: dict[str, Column] | None = None,
) -> DataFrame:
    """Envelope columns on every row, and row counts as observed metrics of the run (no extra job).

    Without an id of its own a row gets one that follows from run, stage and ``key``, so a repeated task gives
    it again.  ``facets`` go into a map of strings; without start and end the duration is null.
    """
    good = F.lit(True) if ok is None else ok
    own = F.md5(F.concat_ws("|", F.lit(run_id), F.lit(stage), F.col(key).cast("string")))
    cid = own if corr is None else F.coalesce(F.nullif(strip(F.col(corr)), F.lit("")), own)
    took = F.lit(None).cast("long") if started is None or ended is None else F.unix_millis(ended) - F.unix_millis(started)
    pairs = [x for n, c in (facets or {}).items() for x in (F.lit(n), c.cast("string"))]
    facet_map = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    tele = F.struct(
        F.when(good, 200).otherwise(500).alias("http_status"),
        F.coalesce(F.lit(None).cast("string") if message is None else message, F.when(good, "OK").otherwise("error")).alias("message"),
        F.lit(stage).alias("stage"), cid.alias("correlation_id"), took.alias("duration_ms"),
        F.map_filter(facet_map, lambda k, v: v.isNotNull()).alias("facets"),
    )
    d = df.withColumn("ok", good).withColumn("telemetry", tele)
    return d.observe(f"stage_{stage}", F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("ok")).alias("failed"))
