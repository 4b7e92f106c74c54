"""Vectors, distributions and retrieved contexts."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsieve.catalog.sqlkit import q, strip
from mailsieve.functions import models
from mailsieve.operators import contexts as C
from mailsieve.operators import distribution as D
from mailsieve.operators import vectors as V
from mailsieve.registry import query

COS = "least(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 1.0)"


@query("f24_similarity", "VQ", sql=f"""
SELECT e.vec_id, round({COS}, 6) AS cosine, round({COS} * 100, 2) AS percentage, {COS} >= 0.7 AS is_similar,
  CASE WHEN {COS} BETWEEN 0.8 AND 1.0 THEN 'high' WHEN {COS} BETWEEN 0.6 AND 0.8 THEN 'medium' ELSE 'low' END AS level,
  round(1.0 / (1.0 + list_distance(q.embedding::DOUBLE[], e.embedding::DOUBLE[])), 6) AS euclidean,
  round(list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS dot,
  'dot product without normalization has no threshold' AS dot_error
FROM embeddings e JOIN VQ q ON e.label = q.label""")
def _(v):
    d = v.t("embeddings").join(v.VQ.select("label", F.col("embedding").alias("qv")), "label")
    a, b = F.col("embedding"), F.col("qv")
    d = d.select("vec_id", V.similarity(a, b).alias("c"), V.similarity(a, b, "euclidean", normalize=False).alias("e"),
                 F.round(V.dot(a, b), 6).alias("dot"), V.similarity(a, b, "dot_product", normalize=False).alias("p"))
    # a vector against itself can exceed 1 in the last bit; both engines then see the same rounded level
    return d.select("vec_id", F.col("c.score").alias("cosine"), F.col("c.percentage").alias("percentage"),
                    F.col("c.is_similar").alias("is_similar"), F.col("c.level").alias("level"), F.col("e.score").alias("euclidean"),
                    "dot", F.col("p.error").alias("dot_error"))


def run_sql(k: int, cond: str) -> str:
    return f"""
s AS (SELECT q.query_id, e.vec_id, e.label, round({COS}, 6) AS score FROM VQ q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s),
h AS (SELECT query_id, vec_id, label, score, rank FROM r WHERE rank <= {k} AND {cond})"""


@query("t1_retrieve", "VQ", sql=run_sql(20, "score >= 0.65") + " SELECT query_id, vec_id, score, rank FROM h")
def _(v):
    return V.retrieve(v.VQ, v.t("embeddings")).select("query_id", "vec_id", "score", F.col("rank").cast("long").alias("rank"))


@query("t1_retrieve_distance", "VQ", sql=run_sql(50, "1.0 - score <= 0.9") + " SELECT query_id, vec_id, score, rank FROM h")
def _(v):
    return V.retrieve(v.VQ, v.t("embeddings"), "broad", max_distance=0.9).select("query_id", "vec_id", "score", F.col("rank").cast("long").alias("rank"))


@query("j3_score_categories", "VQ", sql=f"""
s AS (SELECT e.vec_id, q.query_id AS category, {COS} AS cosine FROM VQ q, embeddings e)
SELECT vec_id, category, round(cosine, 6) AS cosine, round((cosine + 1) / 2, 6) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, category) AS rank FROM s""")
def _(v):
    s = V.score_categories(v.t("embeddings"), v.VQ.withColumnRenamed("query_id", "category"), "vec_id")
    return s.withColumn("rank", F.col("rank").cast("long"))


@query("t2_shortlist", "VQ", sql=f"""
s AS (SELECT e.vec_id, q.query_id AS category, {COS} AS cosine FROM VQ q, embeddings e),
r AS (SELECT *, round((cosine + 1) / 2, 6) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, category) AS rk FROM s)
SELECT vec_id, string_agg(category, ',' ORDER BY rk) AS shortlist, max(score) AS top_score, max(score) < 0.5 AS low_confidence FROM r WHERE rk <= 3 GROUP BY vec_id""")
def _(v):
    s = V.score_categories(v.t("embeddings"), v.VQ.withColumnRenamed("query_id", "category"), "vec_id")
    return V.shortlist(s, "vec_id", 3).withColumn("shortlist", F.array_join("shortlist", ","))


@query("a32_retrieval_eval", "VQ", sql=run_sql(10, "true") + """,
n AS (SELECT q.query_id, count(*) AS n_relevant FROM VQ q JOIN embeddings e ON q.label = e.label GROUP BY 1),
g AS (SELECT h.query_id, sum((h.label = q.label)::INT) AS hits, sum((h.label = q.label)::INT / log2(rank + 1.0)) AS dcg,
  min(CASE WHEN h.label = q.label THEN rank END) AS first_hit FROM h JOIN VQ q ON h.query_id = q.query_id GROUP BY 1)
SELECT n.query_id, round(hits::DOUBLE / n_relevant, 6) AS recall,
  round(dcg / list_sum(list_transform(range(1, least(n_relevant, 10) + 1), lambda r: 1.0 / log2(r + 1.0))), 6) AS ndcg,
  round(coalesce(1.0 / first_hit, 0), 6) AS mrr FROM n JOIN g ON n.query_id = g.query_id""")
def _(v):
    e = v.t("embeddings")
    run = V.nearest(v.VQ, e, 10, "query_id", "vec_id", carry=["label"])
    run = run.join(v.VQ.select("query_id", F.col("label").alias("ql")), "query_id")
    run = run.withColumn("relevant", (F.col("label") == F.col("ql")).cast("int"))
    n = v.VQ.select("query_id", "label").join(e.groupBy("label").agg(F.count("*").alias("n_relevant")), "label").select("query_id", "n_relevant")
    return V.retrieval_eval(run, n, 10)


@query("a34_index_health", "C", sql="""
SELECT (SELECT count(*) FROM embeddings) AS vectors, (SELECT count(*) FROM embeddings WHERE len(embedding) <> 64) AS bad_dim,
  count(*) AS chunks, round(avg((token_count < 10)::INT), 6) AS malformed_share, avg((token_count < 10)::INT) <= 0.01 AS malformed_ok,
  count(DISTINCT doc_id) AS docs, abs(count(DISTINCT doc_id) - (SELECT count(*) FROM documents)) <= 0.02 * (SELECT count(*) FROM documents) AS count_ok,
  count(DISTINCT doc_id) >= 0.99 * (SELECT count(*) FROM documents) AS ingest_ok FROM C""")
def _(v):
    from mailsieve.operators.quality import index_report

    return index_report(v.C, v.t("embeddings"), v.t("documents"), 64)


@query("u3_embed", "DOCS", sql="SELECT doc_id, 64 AS dim, CASE WHEN len(regexp_extract_all(lower(text), '[a-z0-9]+')) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM DOCS")
def _(v):
    d = models.embed(v.DOCS, "text")
    return d.select("doc_id", F.size("embedding").alias("dim"), F.round(V.norm(F.col("embedding")), 6).alias("norm"))


# --- distributions ----------------------------------------------------------------------------


@query("a7_normalize_probs", "DIST", sql="""
a AS (SELECT doc_id, category, round(weight / sum(weight) OVER (PARTITION BY doc_id), 6) AS p FROM DIST),
b AS (SELECT doc_id, category, CASE WHEN p > 0 THEN greatest(p, 0.15) ELSE p END AS p FROM a)
SELECT doc_id, category, round(p / sum(p) OVER (PARTITION BY doc_id), 6) AS prob FROM b""")
def _(v):
    return D.normalize_probs(v.DIST, "doc_id", "weight", 0.15).select("doc_id", "category", "prob")


STATS_SQL = """
s AS (SELECT doc_id, sum(CASE WHEN p > 0 THEN -p * ln(p) ELSE 0 END) AS h, max(p) AS mx, min(p) AS mn, count(*) AS n FROM p GROUP BY 1)
SELECT doc_id, round(h, 4) AS entropy, round(mx, 6) AS max_prob, round(mn, 6) AS min_prob,
  CASE WHEN n > 1 AND h > 0 THEN round(1.0 - h / ln(n), 4) ELSE 0.0 END AS concentration, n FROM s"""


@query("a6_distribution_stats", "DIST", sql="p AS (SELECT doc_id, round(weight / sum(weight) OVER (PARTITION BY doc_id), 6) AS p FROM DIST)," + STATS_SQL)
def _(v):
    return D.distribution_stats(D.normalize_probs(v.DIST, "doc_id", "weight"), "doc_id", "prob")


SHORT = "['cat_0', 'cat_1', 'cat_2', 'cat_4']"


@query("a8_ensure_distribution", "PRED DIST", sql=f"""
g AS (SELECT p.doc_id, 'llm' AS source, d.category, round(d.weight / sum(d.weight) OVER (PARTITION BY d.doc_id), 6) AS prob FROM PRED p JOIN DIST d ON p.doc_id = d.doc_id WHERE p.has_dist),
f AS (SELECT doc_id, category AS chosen, least(greatest(confidence, 0.1), 0.99) AS conf, unnest({SHORT}) AS category FROM PRED WHERE NOT has_dist)
SELECT * FROM g UNION ALL SELECT doc_id, 'fallback', category, CASE WHEN category = chosen THEN round(conf, 6)
  ELSE round((1.0 - conf) / len(list_filter({SHORT}, lambda c: c <> chosen)), 6) END FROM f""")
def _(v):
    raw = v.DIST.groupBy("doc_id").agg(F.collect_list(F.struct("category", F.col("weight").alias("prob"))).alias("raw"))
    d = v.PRED.join(raw, "doc_id", "left").withColumn("raw", F.when(F.col("has_dist"), F.col("raw")))
    d = d.withColumn("shortlist", F.array(*[F.lit(c) for c in ("cat_0", "cat_1", "cat_2", "cat_4")]))
    return D.ensure_distribution(d, "doc_id", "shortlist", "raw", "category", "confidence")


@query("j13_complete_distribution", "DIST", sql=f"""
a AS (SELECT doc_id, category, round(weight / sum(weight) OVER (PARTITION BY doc_id), 6) AS prob, 'llm' AS source FROM DIST),
s AS (SELECT doc_id, unnest({SHORT}) AS category FROM documents)
SELECT * FROM a UNION ALL SELECT s.doc_id, s.category, 0.01::DOUBLE, 'added_missing' FROM s LEFT JOIN a ON s.doc_id = a.doc_id AND s.category = a.category WHERE a.doc_id IS NULL""")
def _(v):
    dist = D.normalize_probs(v.DIST, "doc_id", "weight").withColumn("source", F.lit("llm"))
    short = v.t("documents").select("doc_id", F.explode(F.array(*[F.lit(c) for c in ("cat_0", "cat_1", "cat_2", "cat_4")])).alias("category"))
    return D.complete_distribution(dist, short, "doc_id")


@query("a9_coverage_signal", "CTX", sql="""
SELECT query_id, source, max(score) AS top_score, CASE WHEN max(score) BETWEEN 0.85 AND 1 THEN 'strong' WHEN max(score) BETWEEN 0.65 AND 0.85 THEN 'moderate'
  WHEN max(score) BETWEEN 0.45 AND 0.65 THEN 'weak' ELSE 'gap' END AS coverage FROM CTX GROUP BY 1, 2""")
def _(v):
    d = v.CTX.withColumn("k", F.struct("query_id", "source"))
    return D.coverage_signal(d, "k").select("k.*", "top_score", "coverage")


@query("a10_citation_confidence", "CTX", sql="""
r AS (SELECT source, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, id, query_id) AS rk FROM CTX)
SELECT source, round(least(greatest(avg(score), 0), 1), 4) AS confidence FROM r WHERE rk <= 3 GROUP BY 1""")
def _(v):
    return D.citation_confidence(v.CTX, "source", "id")


# --- contexts ---------------------------------------------------------------------------------

RANKING = """k AS (SELECT query_id, id, (length(source) + page % 7) / 20.0 AS relevance, CASE WHEN category = query_id THEN 1.0 ELSE 0.25 END AS alignment FROM CTX WHERE uri NOT LIKE '%.pdf')"""


def rankings(ctx):
    """Ranker answers for the records whose source is not a PDF; the others stay unranked."""
    return ctx.where(~F.col("uri").endswith(".pdf")).select(
        "query_id", "id", ((F.length("source") + F.col("page") % 7) / 20.0).alias("relevance"),
        F.when(F.col("category") == F.col("query_id"), 1.0).otherwise(0.25).alias("alignment"),
    )


@query("j1_merge_scores", "CTX", sql=RANKING + """
SELECT c.query_id, c.id, round(coalesce(0.8 * k.relevance + 0.2 * k.alignment, 0), 6) AS balanced, round(coalesce(0.75 * k.relevance + 0.25 * k.alignment, 0), 6) AS custom
FROM CTX c LEFT JOIN k ON c.query_id = k.query_id AND c.id = k.id""")
def _(v):
    ctx = v.CTX
    m = C.merge_scores(ctx, rankings(ctx), ["query_id", "id"]).select("query_id", "id", F.round("score", 6).alias("balanced"))
    n = C.merge_scores(ctx, rankings(ctx), ["query_id", "id"], (3.0, 1.0)).select("query_id", "id", F.round("score", 6).alias("custom"))
    return m.join(n, ["query_id", "id"])


@query("j2_enrich_ranked", "CTX", sql=RANKING + """,
r AS (SELECT query_id, id, relevance, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, id) AS rank FROM k)
SELECT r.query_id, r.rank, r.id, c.uri, md5(c.text) AS digest FROM r LEFT JOIN CTX c ON r.query_id = c.query_id AND r.id = c.id""")
def _(v):
    ctx = v.CTX
    ranked = C.rank_records(rankings(ctx), "query_id", "relevance").select("query_id", "id", "rank")
    return C.enrich_ranked(ranked, ctx, ["query_id", "id"]).select("query_id", "rank", "id", "uri", F.md5("text").alias("digest"))


@query("w3_rank_records", "CTX", sql="SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM CTX")
def _(v):
    return C.rank_records(v.CTX, "query_id").select("query_id", "id", "score", "rank")


@query("t3_top_n", "CTX", sql="""
SELECT query_id, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM CTX) x WHERE rank <= 7""")
def _(v):
    return C.top_n(v.CTX, "query_id", 7).select("query_id", "id", "score", F.col("rank").cast("long").alias("rank"))


@query("p23_filter_by_category", "CTX", sql="""
SELECT query_id, count(*) AS records, count(*) FILTER (category LIKE '%at_1%') AS kept, count(*) FILTER (category LIKE '%at_1%') = 0 AS removed_all FROM CTX GROUP BY 1""")
def _(v):
    return C.filter_by_category(v.CTX, "query_id", F.array("category"), "AT_1")[1]


META = """'{"category":"' || category || '","page":"' || page || '"}'"""
BLOCK = f"'[' || id || '] source=' || source || ' uri=' || uri || ' score=' || CAST(score AS VARCHAR) || chr(10) || text || chr(10) || '(meta: ' || {META} || ')'"


def meta_json():
    return F.to_json(F.create_map(F.lit("category"), F.col("category"), F.lit("page"), F.col("page").cast("string")))


@query("f33_format_contexts", "CTX", sql=f"""
SELECT query_id, md5(string_agg({BLOCK}, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rnk)) AS digest, count(*) AS n FROM CTX WHERE rnk <= 20 GROUP BY 1""")
def _(v):
    d = C.join_blocks(C.first_chunks(v.CTX, "query_id", "rnk", 20), "query_id", C.default_block(meta_json()), "rnk")
    return d.select("query_id", F.md5("context").alias("digest"), F.col("n_contexts").alias("n"))


@query("f34_ranker_prompt", "CTX", sql="""
SELECT query_id, string_agg('ID: ' || id || chr(10) || 'Source: ' || CASE WHEN uri LIKE '%.pdf' THEN 'unknown' ELSE source END || chr(10) || 'Content: ' || substr(text, 1, 401), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rnk) AS prompt
FROM CTX WHERE rnk <= 50 GROUP BY 1""")
def _(v):
    src = F.when(~F.col("uri").endswith(".pdf"), F.col("source"))
    d = C.first_chunks(v.CTX, "query_id", "rnk", 50)
    return C.join_blocks(d, "query_id", C.ranker_block(F.col("id"), src, F.col("text")), "rnk", "prompt").select("query_id", "prompt")


TRUNC = "substr(" + strip("regexp_replace(text, '\\s+', ' ', 'g')") + ", 1, 800)"
SHORT_BLOCK = "'[' || id || '] source=' || source || ' uri=' || uri || ' score=' || CAST(score AS VARCHAR) || chr(10) || t"


@query("w4_select_by_budget", "CTX", sql=f"""
a AS (SELECT query_id, id, rnk, length({SHORT_BLOCK}) AS n FROM (SELECT *, {TRUNC} AS t FROM CTX) x WHERE rnk <= 20),
b AS (SELECT query_id, id, cast(ceil((length('Question:' || chr(10) || 'What about ' || query_id || chr(10) || chr(10) || 'Context:' || chr(10)) + 10
  + sum(n + 7) OVER (PARTITION BY query_id ORDER BY rnk) - 7) / 4.0) AS BIGINT) AS prompt_tokens FROM a)
SELECT * FROM b WHERE prompt_tokens <= 2488""")
def _(v):
    n, budget, _ = C.prompt_budget("balanced")
    d = C.shrink(C.first_chunks(v.CTX, "query_id", "rnk", n))
    question = F.concat(F.lit("What about "), "query_id")
    return C.select_by_budget(d, "query_id", "rnk", question, F.lit("s" * 10), budget).select("query_id", "id", "prompt_tokens")


TOK = "list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))"


@query("f27_drop_near_duplicates", "CTX", sql=f"""--recursive
i AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY rnk) AS p, {TOK} AS t FROM CTX WHERE rnk <= 50),
w AS (SELECT query_id, p, len(t) AS n, unnest(t) AS w FROM i),
x AS (SELECT a.query_id, a.p, b.p AS o FROM w a JOIN w b ON a.query_id = b.query_id AND a.w = b.w AND b.p < a.p
  GROUP BY a.query_id, a.p, b.p, a.n, b.n HAVING count(*)::DOUBLE / (a.n + b.n - count(*)) >= 0.3),
r AS (SELECT query_id, 0::BIGINT AS p, []::BIGINT[] AS kept FROM (SELECT DISTINCT query_id FROM i) q
  UNION ALL SELECT r.query_id, r.p + 1, CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.query_id = r.query_id AND x.p = r.p + 1 AND list_contains(r.kept, x.o)) THEN r.kept ELSE list_append(r.kept, r.p + 1) END
  FROM r WHERE r.p < (SELECT max(p) FROM i WHERE i.query_id = r.query_id))
SELECT i.query_id, i.id FROM i JOIN (SELECT query_id, unnest(kept) AS p FROM r WHERE p = (SELECT max(p) FROM i WHERE i.query_id = r.query_id)) k ON i.query_id = k.query_id AND i.p = k.p""")
def _(v):
    d = C.first_chunks(v.CTX, "query_id", "rnk", 50)
    return C.drop_near_duplicates(d, "query_id", ["rnk"], threshold=0.3).select("query_id", "id")


@query("f28_mmr_order", "CTX", sql=f"""--recursive
i AS (SELECT query_id, id, score::DOUBLE AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS p, {TOK} AS t FROM CTX WHERE rnk <= 20),
w AS (SELECT query_id, p, len(t) AS n, unnest(t) AS w FROM i),
x AS (SELECT a.query_id, a.p, b.p AS o, count(*)::DOUBLE / (a.n + b.n - count(*)) AS ov FROM w a JOIN w b ON a.query_id = b.query_id AND a.w = b.w AND a.p <> b.p
  GROUP BY a.query_id, a.p, b.p, a.n, b.n),
r AS (SELECT query_id, 1 AS k, p, score, 0::DOUBLE AS ov FROM i
  UNION ALL SELECT c.query_id, c.k + 1, c.p, c.score, greatest(c.ov, coalesce(x.ov, 0::DOUBLE))
  FROM (SELECT *, first_value(p) OVER (PARTITION BY query_id ORDER BY 0.7::DOUBLE * score - (1 - 0.7::DOUBLE) * ov DESC, p) AS best FROM r) c
  LEFT JOIN x ON x.query_id = c.query_id AND x.p = c.p AND x.o = c.best WHERE c.p <> c.best),
z AS (SELECT query_id, k, p, row_number() OVER (PARTITION BY query_id, k ORDER BY 0.7::DOUBLE * score - (1 - 0.7::DOUBLE) * ov DESC, p) AS place FROM r)
SELECT i.query_id, i.id, z.k AS mmr_rank FROM z JOIN i ON i.query_id = z.query_id AND i.p = z.p WHERE place = 1""")
def _(v):
    d = C.first_chunks(v.CTX, "query_id", "rnk", 20).select("query_id", "id", "text", "score", "source")
    return C.mmr_order(d, "query_id", per_source_cap=None).select("query_id", "id", "mmr_rank")


@query("t5_trim_order", "CTX", sql="""
SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS by_score, row_number() OVER (PARTITION BY query_id ORDER BY rnk) AS as_given FROM CTX WHERE rnk <= 20""")
def _(v):
    d = C.first_chunks(v.CTX, "query_id", "rnk", 20)
    a = C.trim_order(d, "query_id").select("query_id", "id", F.col("pos").cast("long").alias("by_score"))
    b = C.trim_order(d, "query_id", "as_given").select("query_id", "id", F.col("pos").cast("long").alias("as_given"))
    return a.join(b, ["query_id", "id"])


@query("f30_build_prompts", "CTX", sql="""--recursive
i AS (SELECT query_id, id, text, cast(ceil(length(text) / 4.0) AS BIGINT) AS n, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS p FROM CTX),
r AS (SELECT query_id, 0::BIGINT AS p, 0::BIGINT AS used, 0::BIGINT AS slots, ''::VARCHAR AS ctx, false AS shut FROM (SELECT DISTINCT query_id FROM i) q
  UNION ALL SELECT r.query_id, i.p,
    CASE WHEN NOT shut AND used + n <= 3000 THEN used + n ELSE used END, CASE WHEN NOT shut AND used + n <= 3000 THEN slots + 1 ELSE slots END,
    CASE WHEN NOT shut AND used + n <= 3000 THEN ctx || CASE WHEN slots > 0 THEN chr(10) || chr(10) || '---' || chr(10) || chr(10) ELSE '' END || text ELSE ctx END,
    shut OR (slots = 0 AND n > 3000)
  FROM r JOIN i ON r.query_id = i.query_id AND i.p = r.p + 1),
f AS (SELECT * FROM r WHERE p = (SELECT max(p) FROM i WHERE i.query_id = r.query_id)),
o AS (SELECT query_id, slots, p AS total, 'Context:' || chr(10) || ctx || chr(10) || chr(10) || 'Query: What about ' || query_id || chr(10) || chr(10) || 'Answer:' AS prompt FROM f)
SELECT query_id, md5(prompt) AS digest, cast(ceil(length(prompt) / 4.0) AS BIGINT) AS token_count, slots AS context_used, slots < total AS truncated FROM o""")
def _(v):
    ctx = v.CTX
    qs = v.VQ.select("query_id", F.concat(F.lit("What about "), "query_id").alias("query"))
    return C.build_prompts(qs, ctx, "query_id").select("query_id", F.md5("prompt").alias("digest"), "token_count", "context_used", "truncated")


def meta_map():
    """Metadata map of a context, with the file name only for every third page number."""
    return F.when(F.col("page") % 2 == 0, F.create_map(F.lit("category"), F.col("category"), F.lit("gcsUri"), F.col("uri"))).otherwise(
        F.create_map(F.lit("displayName"), F.col("source"), F.lit("mimeType"), F.lit("text/plain"))
    )


@query("f48_derive_source", "CTX", sql="""
SELECT query_id, id, CASE WHEN page % 2 = 1 THEN source END AS source, CASE WHEN page % 2 = 0 THEN uri END AS uri,
  CASE WHEN page % 2 = 0 THEN 'category=' || category || ';gcsUri=' || uri ELSE 'displayName=' || source || ';mimeType=text/plain' END AS kv FROM CTX""")
def _(v):
    d = v.CTX.withColumn("m", meta_map())
    d = d.withColumn("s", C.derive_source(F.col("m"))).withColumn("kv", C.metadata_kv(F.col("m")))
    return d.select(
        "query_id", "id", "s.source", "s.uri",
        F.array_join(F.transform("kv", lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("kv"),
    )


@query("a11_retrieval_counts", "CTX", sql="""
SELECT query_id, count(*) AS contexts_count, count(*) FILTER (text <> '') AS success_count, count(*) FILTER (text = '') AS error_count,
  count(*) FILTER (text <> '' AND uri LIKE '%.pdf') AS pdf_contexts_count, count(*) FILTER (text = '') > 0 AS partial_failure FROM CTX GROUP BY 1""")
def _(v):
    m = F.create_map(F.lit("category"), F.col("category"))
    d = v.CTX.withColumn("processing_error", F.col("text") == "").withColumn("is_pdf", C.is_pdf_source(F.col("uri"), m))
    return C.retrieval_counts(d, "query_id")


CITE = "c AS (SELECT query_id, id AS chunk_id FROM CTX WHERE rnk IN (1, 4) AND category <> 'cat_3' UNION ALL SELECT DISTINCT query_id, 'nothing' FROM CTX)"


def citations(ctx):
    real = ctx.where(F.col("rnk").isin(1, 4) & (F.col("category") != "cat_3")).select("query_id", F.col("id").alias("chunk_id"))
    return real.unionByName(ctx.select("query_id").distinct().withColumn("chunk_id", F.lit("nothing")))


@query("j11_citation_join", "CTX", sql=CITE + """
SELECT t.query_id, count(c.chunk_id) > 0 AS grounded, count(c.chunk_id) AS resolved, round(avg(CASE WHEN c.chunk_id IS NOT NULL THEN t.score END) - avg(t.score), 6) AS ranking_lift
FROM CTX t LEFT JOIN c ON t.query_id = c.query_id AND t.id = c.chunk_id GROUP BY 1""")
def _(v):
    ctx = v.CTX
    return C.citation_join(citations(ctx), ctx, "query_id")


@query("a26_hot_sources", "CTX", sql="SELECT source, count(*) AS n FROM CTX GROUP BY 1 ORDER BY n DESC, source LIMIT 3")
def _(v):
    return C.hot_sources(v.CTX, 3)


@query("a26_dedupe_stats", "CTX", sql="""
SELECT query_id, count(*) AS pool_size, count(DISTINCT CASE WHEN text = '' THEN id ELSE text END) AS kept_chunks, count(*) - count(DISTINCT CASE WHEN text = '' THEN id ELSE text END) AS dedup_dropped
FROM CTX WHERE rnk <= 30 GROUP BY 1""")
def _(v):
    d = C.first_chunks(v.CTX, "query_id", "rnk", 30)
    return C.dedupe_stats(d, C.drop_near_duplicates(d, "query_id", ["rnk"], threshold=1.0), "query_id")


FACTS = {"cat_0": ["the", "zzz"], "cat_1": ["la", "qqq", "yyy"], "cat_2": ["de"]}


@query("f50_context_sufficiency", "CTX", sql="""
f AS (SELECT * FROM (VALUES ('cat_0', 'the'), ('cat_0', 'zzz'), ('cat_1', 'la'), ('cat_1', 'qqq'), ('cat_1', 'yyy'), ('cat_2', 'de')) x(cat, fact)),
m AS (SELECT c.query_id, f.fact, max(contains(lower(c.text), f.fact)::INT) AS found FROM CTX c LEFT JOIN f ON f.cat = c.query_id GROUP BY ALL)
SELECT query_id, coalesce(string_agg(fact, ',' ORDER BY fact DESC) FILTER (found = 0), '') AS missing, count(*) FILTER (found = 0) = 0 AS sufficient,
  round(count(*) FILTER (found = 0) * -0.1, 2)::DOUBLE AS confidence_adjustment FROM m GROUP BY 1""")
def _(v):
    d = C.context_sufficiency(v.CTX.withColumn("cat", F.col("query_id")), "query_id", "cat", FACTS)
    return d.select("query_id", F.array_join(F.sort_array("missing", asc=False), ",").alias("missing"), "sufficient", "confidence_adjustment")


@query("u2_score", "CTX", sql="""
t AS (SELECT query_id, id, list_distinct(regexp_extract_all(lower('the la de un and ' || source), '[a-z0-9]+')) AS a, regexp_extract_all(lower(text), '[a-z0-9]+') AS b FROM CTX)
SELECT query_id, id, round(len(list_intersect(a, b))::DOUBLE / len(a), 6) AS relevance FROM t""")
def _(v):
    d = v.CTX.withColumn("question", F.concat(F.lit("the la de un and "), "source"))
    return models.score(d, "question", "text").select("query_id", "id", "relevance")
