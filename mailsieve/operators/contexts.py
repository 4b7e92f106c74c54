"""Ranking, de-duplicating, packing and formatting retrieved contexts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve import scale
from mailsieve.functions.text import blank, est_tokens, strip, tokens, truncate_chunk

# fixed values: weight presets (relevance, category), request limits (chunks, prompt tokens, reserve)
WEIGHT_PRESETS = {"relevance_heavy": (0.9, 0.1), "balanced": (0.8, 0.2), "category_heavy": (0.6, 0.4)}
REQUEST_LIMITS = {"conservative": (15, 2500, 400), "balanced": (20, 3000, 512), "generous": (25, 4000, 800)}
SEPARATOR = "\n\n---\n\n"
# fixed values: prompt templates
PROMPT_TEMPLATES = {
    "standard": "Context:\n{{context}}\n\nQuery: {{query}}\n\nAnswer:",
    "customer_service": (
        "You are a customer service assistant.\n\nContext:\n{{context}}\n\nCustomer Question: {{query}}\n\nResponse:"
    ),
    "technical": (
        "You are a technical support specialist.\n\nContext:\n{{context}}\n\nTechnical Issue: {{query}}\n\nSolution:"
    ),
    "sales": "You are a sales representative.\n\nContext:\n{{context}}\n\nSales Inquiry: {{query}}\n\nResponse:",
}


def score_bucket(score: Column, parts: int = 256) -> Column:
    """Ascending bucket of a descending score, so that a hot query splits by score."""
    return -F.floor(F.coalesce(score, F.lit(0.0)) * parts)


def by_score(score: str = "score", rid: str = "id") -> list[Column]:
    return [F.desc(score), F.asc(rid)]


def merge_scores(
    records: DataFrame, scores: DataFrame, by: Sequence[str], weights: str | tuple[float, float] = "balanced",
) -> DataFrame:
    """Weighted relevance and alignment; a record the ranking left out scores 0."""
    wr, wc = WEIGHT_PRESETS[weights] if isinstance(weights, str) else weights
    total = wr + wc
    if total > 0 and abs(total - 1.0) > 1e-6:
        wr, wc = wr / total, wc / total
    merged = records.drop("score").join(scores, list(by), "left")
    mixed = F.col("relevance") * wr + F.col("alignment") * wc
    return merged.withColumn("score", F.coalesce(mixed, F.lit(0.0)))


def enrich_ranked(ranked: DataFrame, records: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ranked ids with the caller's content; rank order is a column and survives."""
    return ranked.join(records, list(by), "left")


def rank_records(df: DataFrame, by: str, score: str = "score", rid: str = "id", out: str = "rank") -> DataFrame:
    """1-based rank by score then id, split by score bucket within each query."""
    return scale.number_rows(df, [by], score_bucket(F.col(score)), by_score(score, rid), out)


def top_n(df: DataFrame, by: str, n: int) -> DataFrame:
    return scale.top_per_key(df, [by], by_score(), n)


def filter_by_category(df: DataFrame, by: str, values: Column, category: str) -> tuple[DataFrame, DataFrame]:
    """Records whose metadata value (text or list) contains the category, and per query whether none is left."""
    needle = category.lower()
    hit = F.coalesce(F.exists(values, lambda x: F.lower(x).contains(needle)), F.lit(False))
    marked = df.withColumn("__hit", hit)
    report = marked.groupBy(by).agg(
        F.count("*").alias("records"), F.count_if("__hit").alias("kept"),
        (F.count_if("__hit") == 0).alias("removed_all"),
    )
    return marked.where("__hit").drop("__hit"), report


# --- formatting -------------------------------------------------------------------------------


def context_block(rid: Column, source: Column, uri: Column, score: Column, text: Column, meta: Column | None = None) -> Column:
    def tagged(name: str, c: Column) -> Column:
        s = c.cast("string")
        return F.when(strip(blank(s)) != "", F.concat(F.lit(name), s))

    head = F.concat_ws(" ", F.concat(F.lit("["), rid, F.lit("]")), tagged("source=", source), tagged("uri=", uri), tagged("score=", score))
    tail = F.lit("") if meta is None else F.coalesce(F.concat(F.lit("\n(meta: "), meta, F.lit(")")), F.lit(""))
    return F.concat(head, F.lit("\n"), blank(text), tail)


def default_block(meta: Column | None = None) -> Column:
    return context_block(F.col("id"), F.col("source"), F.col("uri"), F.col("score"), F.col("text"), meta)


def join_blocks(df: DataFrame, by: str, block: Column, order: str, out: str = "context") -> DataFrame:
    """Blocks of each query in order.  Use after a bounded selection (request limits)."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), block.alias("b"))))
    return df.groupBy(by).agg(
        F.array_join(F.transform(rows, lambda x: x["b"]), SEPARATOR).alias(out), F.count("*").alias("n_contexts")
    )


def ranker_block(rid: Column, source: Column, text: Column) -> Column:
    """Preview for the ranking model: 401 characters of the content."""
    return F.concat(
        F.lit("ID: "), rid, F.lit("\nSource: "), F.coalesce(source, F.lit("unknown")), F.lit("\nContent: "),
        F.left(blank(text), F.lit(401)),
    )


# --- selection --------------------------------------------------------------------------------


def first_chunks(df: DataFrame, by: str, order: str, limit: int) -> DataFrame:
    """The first ``limit`` contexts of each query: every later step works on a bounded group."""
    return scale.top_per_key(df, [by], [F.col(order)], max(limit, 1), "__first").drop("__first")


def select_by_budget(
    df: DataFrame, by: str, order: str, question: Column, system: Column, budget: int, block: Column | None = None,
) -> DataFrame:
    """Longest prefix whose formatted prompt fits the token budget.

    Prompt length grows with every block, so a running sum answers the search directly.  The input is a
    bounded selection (``first_chunks``).
    """
    size = F.length(default_block() if block is None else block)
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.length(F.concat(F.lit("Question:\n"), question, F.lit("\n\nContext:\n"))) + F.length(system)
    blob = F.sum(size + len(SEPARATOR)).over(w) - len(SEPARATOR)
    return df.withColumn("prompt_tokens", F.ceil((fixed + blob) / 4.0)).where(F.col("prompt_tokens") <= budget)


def prompt_budget(preset: str = "balanced") -> tuple[int, int, int]:
    """(chunks, prompt budget, output reserve) of a preset."""
    chunks, total, reserve = REQUEST_LIMITS[preset]
    return chunks, max(total - reserve, 400), reserve


def drop_near_duplicates(df: DataFrame, by: str, order: Sequence[str], text: str = "text", threshold: float = 0.9) -> DataFrame:
    """Greedy in order within each bounded query group: a record too close to any kept one leaves."""
    pos = Window.partitionBy(by).orderBy(*order)
    d = df.withColumn("__pos", F.row_number().over(pos)).withColumn("__tok", F.array_distinct(tokens(F.col(text))))
    columns, schema = df.columns, df.schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__pos", ignore_index=True)
        kept: list[tuple[int, set]] = []
        for i, t in enumerate(set(t) for t in pdf["__tok"]):
            if not any(_overlap(t, k) >= threshold for _, k in kept):
                kept.append((i, t))
        return pdf.iloc[[i for i, _ in kept]][columns]

    return d.groupBy(by).applyInPandas(run, schema)


def _overlap(a: set, b: set) -> float:
    if not a or not b:
        return 0.0
    shared = len(a & b)
    return shared / (len(a) + len(b) - shared)


def mmr_order(df: DataFrame, by: str, alpha: float = 0.7, per_source_cap: int | None = 3) -> DataFrame:
    """Maximal-marginal-relevance order of each bounded query group (id, text, score, source).

    Capped sources lose their surplus records; the source named ``salience`` has no cap.
    """
    schema = T.StructType(df.schema.fields + [T.StructField("mmr_rank", T.IntegerType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "id"], ascending=[False, True], ignore_index=True)
        sets = [set(t) for t in pdf["__tok"]]
        overlap = np.zeros(len(pdf))
        used: dict[str, int] = {}
        left, order = list(range(len(pdf))), []
        while left:
            open_ = [
                i for i in left
                if per_source_cap is None or pdf["source"][i] == "salience" or used.get(pdf["source"][i], 0) < per_source_cap
            ]
            if not open_:
                break
            best = max(open_, key=lambda i: (alpha * pdf["score"][i] - (1 - alpha) * overlap[i], -i))
            order.append(best)
            left.remove(best)
            used[pdf["source"][best]] = used.get(pdf["source"][best], 0) + 1
            for i in left:
                overlap[i] = max(overlap[i], _overlap(sets[i], sets[best]))
        return pdf.iloc[order].assign(mmr_rank=range(1, len(order) + 1))[schema.names]

    return df.withColumn("__tok", tokens(F.col("text"))).groupBy(by).applyInPandas(run, schema)


def trim_order(df: DataFrame, by: str, strategy: str = "drop_low_score", given: str = "rnk") -> DataFrame:
    """Position column by strategy: score, MMR, or the given order."""
    if strategy == "diverse_mmr":
        return mmr_order(df, by).withColumnRenamed("mmr_rank", "pos")
    order = by_score() if strategy == "drop_low_score" else [F.col(given)]
    return df.withColumn("pos", F.row_number().over(Window.partitionBy(by).orderBy(*order)))


def pack_contexts(contexts: DataFrame, by: str, rid: str = "id", text: str = "text", max_tokens: int = 3000) -> DataFrame:
    """Greedy packing by score: what does not fit is skipped, smaller ones may still enter; when the best
    record alone is too big nothing is packed.  Streams thin rows (id, score, tokens) per query."""
    thin = contexts.select(by, rid, "score", est_tokens(F.col(text)).alias("tokens"))
    schema = T.StructType(
        [thin.schema[by], thin.schema[rid], T.StructField("tokens", T.LongType()), T.StructField("slot", T.LongType())]
    )

    def start():
        state = {"used": 0, "slot": 0, "shut": False}

        def step(part: pd.DataFrame) -> pd.DataFrame:
            picked = []
            for row, n in enumerate(part["tokens"].to_numpy()):
                if state["shut"]:
                    break
                if n > max_tokens and state["slot"] == 0:
                    state["shut"] = True
                elif state["used"] + n <= max_tokens:
                    state["used"] += int(n)
                    state["slot"] += 1
                    picked.append((row, state["slot"]))
            rows = part.iloc[[r for r, _ in picked]]
            return rows.assign(slot=[s for _, s in picked])[schema.names]

        return step

    return scale.ordered_fold(thin, [by], [F.desc("score"), F.asc(rid)], start, schema)


def compile_prompt(template: str, context: Column, query: Column) -> Column:
    """Placeholders are case-insensitive; a template with neither gets both appended."""
    import re

    c_rx, q_rx = r"(?i)\{\{\s*context\s*\}\}", r"(?i)\{\{\s*query\s*\}\}"

    def literal(c: Column) -> Column:
        return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))

    if not re.search(c_rx, template) and not re.search(q_rx, template):
        return F.concat(F.lit(template + "\n\nContext:\n"), context, F.lit("\n\nQuery: "), query, F.lit("\n\nAnswer:"))
    return F.regexp_replace(F.regexp_replace(F.lit(template), F.lit(c_rx), literal(context)), F.lit(q_rx), literal(query))


def build_prompts(
    queries: DataFrame, contexts: DataFrame, by: str, template: str = "standard", max_tokens: int = 3000,
    custom: str | None = None, instructions: str = "",
) -> DataFrame:
    """Prompt per query (columns ``by`` and ``query``) with token count, contexts used and truncation flag."""
    head = f"Instructions:\n{instructions.strip()}\n\n" if instructions.strip() else ""
    text = custom or PROMPT_TEMPLATES.get(template, head + PROMPT_TEMPLATES["standard"])
    packed = pack_contexts(contexts, by, max_tokens=max_tokens)
    chosen = packed.join(contexts.select(by, "id", "text"), [by, "id"])
    joined = join_blocks(chosen, by, F.col("text"), "slot")
    totals = contexts.groupBy(by).agg(F.count("*").alias("__all"))
    d = queries.join(totals, by, "left").join(joined, by, "left")
    prompt = compile_prompt(text, blank(F.col("context")), F.col("query"))
    used = F.coalesce("n_contexts", F.lit(0))
    return d.select(
        by, prompt.alias("prompt"), est_tokens(prompt).alias("token_count"), used.alias("context_used"),
        (used < F.coalesce("__all", F.lit(0))).alias("truncated"),
    )


# --- sources, counters, checks ----------------------------------------------------------------

# fixed values: metadata keys that point at a PDF
PDF_TYPE_KEYS = ("file_type", "fileType", "mimeType", "mime_type", "content_type", "contentType")
PDF_NAME_KEYS = ("source", "filename", "file_name", "fileName", "name")
PDF_PROCESSOR_KEYS = ("processor", "parser")
PDF_PAGE_KEYS = ("page", "pageNumber", "page_number")


def first_key(m: Column, keys: Sequence[str]) -> Column:
    return F.coalesce(*[F.try_element_at(m, F.lit(k)) for k in keys])


def is_pdf_source(uri: Column, metadata: Column) -> Column:
    u = F.lower(strip(blank(uri)))
    by_uri = u.endswith(".pdf") | u.rlike(r"\.pdf[?#]") | u.contains("/pdf/") | u.contains("_pdf_")
    kind = F.lower(blank(first_key(metadata, PDF_TYPE_KEYS)))
    name = F.lower(blank(first_key(metadata, PDF_NAME_KEYS)))
    proc = F.lower(blank(first_key(metadata, PDF_PROCESSOR_KEYS)))
    paged = F.lit(False)
    for k in PDF_PAGE_KEYS:
        paged = paged | F.map_contains_key(metadata, k)
    by_meta = kind.contains("pdf") | name.endswith(".pdf") | proc.rlike("pdf|document_ai|ocr") | paged
    return by_uri | F.coalesce(by_meta, F.lit(False))


def derive_source(metadata: Column, source_key: str = "source", uri_key: str = "uri") -> Column:
    return F.struct(
        first_key(metadata, [source_key, "source", "displayName"]).alias("source"),
        first_key(metadata, [uri_key, "sourceUri", "gcsUri", "url", "uri"]).alias("uri"),
    )


def metadata_kv(metadata: Column) -> Column:
    return F.map_entries(metadata)


def retrieval_counts(ctx: DataFrame, by: str) -> DataFrame:
    """Contexts, successes, errors, PDF contexts and whether some failed."""
    err = F.coalesce(F.col("processing_error"), F.lit(False))
    return ctx.groupBy(by).agg(
        F.count("*").alias("contexts_count"), F.count_if(~err).alias("success_count"), F.count_if(err).alias("error_count"),
        F.count_if(F.col("is_pdf") & ~err).alias("pdf_contexts_count"), (F.count_if(err) > 0).alias("partial_failure"),
    )


def citation_join(citations: DataFrame, contexts: DataFrame, by: str) -> DataFrame:
    """Grounded when at least one citation resolves; lift = mean cited score minus mean retrieved score."""
    cited = citations.select(by, F.col("chunk_id").alias("id")).distinct().withColumn("__cited", F.lit(True))
    d = contexts.join(cited, [by, "id"], "left")
    hit = F.col("__cited").isNotNull()
    return d.groupBy(by).agg(
        (F.count_if(hit) > 0).alias("grounded"), F.count_if(hit).alias("resolved"),
        F.round(F.avg(F.when(hit, F.col("score"))) - F.avg("score"), 6).alias("ranking_lift"),
    )


def hot_sources(ctx: DataFrame, n: int) -> DataFrame:
    counts = ctx.groupBy("source").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "source").limit(n)


def dedupe_stats(pool: DataFrame, kept: DataFrame, by: str) -> DataFrame:
    a = pool.groupBy(by).agg(F.count("*").alias("pool_size"))
    b = kept.groupBy(by).agg(F.count("*").alias("kept_chunks"))
    return a.join(b, by, "left").select(
        by, "pool_size", F.coalesce("kept_chunks", F.lit(0)).alias("kept_chunks"),
        (F.col("pool_size") - F.coalesce("kept_chunks", F.lit(0))).alias("dedup_dropped"),
    )


def context_sufficiency(contexts: DataFrame, by: str, category: str, required: Mapping[str, Sequence[str]]) -> DataFrame:
    """Required facts of the category that no context of the query mentions; each costs 0.1."""
    needs = [(c, f) for c, fs in required.items() for f in fs]
    low = F.lower(blank(F.col("text")))
    found = [F.max((low.contains(f.lower()) & (F.col(category) == c)).cast("int")).alias(f"__f{i}") for i, (c, f) in enumerate(needs)]
    d = contexts.groupBy(by, category).agg(*found)
    gaps = F.array_compact(
        F.array(*[F.when((F.col(category) == c) & (F.col(f"__f{i}") == 0), f) for i, (c, f) in enumerate(needs)])
    )
    d = d.withColumn("missing", gaps)
    return d.select(
        by, category, "missing", (F.size("missing") == 0).alias("sufficient"),
        F.round(F.size("missing") * -0.1, 2).alias("confidence_adjustment"),
    )


def shrink(df: DataFrame, n: int = 800) -> DataFrame:
    return df.withColumn("text", truncate_chunk(F.col("text"), n))
