"""Composite plans over vectors, contexts, replies and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsieve.catalog.context_queries import COS, SHORT_BLOCK, TOK, TRUNC
from mailsieve.catalog.routing_queries import DEFAULT, STYLE, TONE
from mailsieve.catalog.rules_queries import QUICK, filter_sql
from mailsieve.operators import intents as I
from mailsieve.operators import responses as R
from mailsieve.operators import rules
from mailsieve.plans import answers as A
from mailsieve.registry import query


@query("f49_validate_responses", "CONV", sql=r"""
w AS (SELECT conv_id, turn, question, answer, list_filter(regexp_split_to_array(lower(question), '[^A-Za-z0-9_]+'), lambda x: x <> '') AS a,
  list_filter(regexp_split_to_array(lower(answer), '[^A-Za-z0-9_]+'), lambda x: x <> '') AS b FROM CONV),
o AS (SELECT *, CASE WHEN len(a) = 0 THEN 0.0 ELSE len(list_intersect(a, b))::DOUBLE / len(a) END AS ov FROM w),
c AS (SELECT *, round(least(greatest(1.0 - (CASE WHEN ov < 0.1 THEN 0.4 ELSE 0 END + CASE WHEN contains(answer, '...') OR contains(lower(answer), 'incomplete') THEN 0.2 ELSE 0 END
  + CASE WHEN length(trim(answer)) = 0 THEN 0.5 WHEN length(answer) < 10 THEN 0.3 ELSE 0 END + CASE WHEN NOT contains(answer, '.') THEN 0.3 ELSE 0 END + CASE WHEN contains(answer, 'th') THEN 0.3 ELSE 0 END), 0), 1), 2)::DOUBLE AS s FROM o)
SELECT conv_id, turn, round(ov, 2) AS query_overlap, s AS confidence_score, s >= 0.7 AS is_valid, s < 0.5 AS requires_human_review,
  CASE WHEN s >= 0.8 THEN 'high' WHEN s >= 0.6 THEN 'medium' ELSE 'low' END AS confidence_level FROM c""")
def _(v):
    d = R.validate_responses(v.CONV, "answer", "question", [("contains", "."), ("not_contains", "th")])
    return d.select("conv_id", "turn", "query_overlap", "confidence_score", "is_valid", "requires_human_review", "confidence_level")


@query("f51_edit_share", "CONV", sql=r"""
a AS (SELECT conv_id, turn, regexp_replace(question, '[^\x00-\x7F]', '?', 'g') AS x, regexp_replace(answer, '[^\x00-\x7F]', '?', 'g') AS y FROM CONV)
SELECT conv_id, turn, round(levenshtein(x, y)::DOUBLE / greatest(length(x), length(y)), 6) AS share FROM a""")
def _(v):
    # the oracle engine counts bytes, so letters outside ASCII are folded to one byte on both sides
    x, y = (F.regexp_replace(c, r"[^\x00-\x7F]", "?") for c in ("question", "answer"))
    return v.CONV.select("conv_id", "turn", R.edit_share(x, y).alias("share"))


@query("q4_categorize", "VQ", sql=f"""
s AS (SELECT e.vec_id, q.query_id AS category, {COS} AS cosine FROM VQ q, embeddings e),
r AS (SELECT vec_id, category, round((cosine + 1) / 2, 6) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, category) AS rk FROM s),
a AS (SELECT *, round(score / sum(score) OVER (PARTITION BY vec_id), 6) AS p FROM r WHERE rk <= 3),
b AS (SELECT vec_id, category, rk, greatest(p, 0.01) AS p FROM a), n AS (SELECT vec_id, category, rk, round(p / sum(p) OVER (PARTITION BY vec_id), 6) AS p FROM b),
g AS (SELECT vec_id, arg_max(category, p * 1000 - rk * 1e-9) AS top, max(p) AS conf, sum(-p * ln(p)) AS h, string_agg(category, ',' ORDER BY rk) AS shortlist FROM n GROUP BY 1)
SELECT vec_id, shortlist, CASE WHEN conf < 0.34 THEN 'Other' ELSE top END AS chosen, conf AS confidence, round(h, 4) AS entropy, conf >= 0.34 AS pass_to_responder FROM g""")
def _(v):
    d = A.categorize(v.t("embeddings"), v.VQ.withColumnRenamed("query_id", "category"), "vec_id", preset=0.34)
    return d.select("vec_id", F.array_join("shortlist", ",").alias("shortlist"), "chosen", "confidence", "entropy", "pass_to_responder")


@query("q4_rerank", "VQ", sql=f"""
s AS (SELECT e.vec_id, q.query_id AS category, {COS} AS cosine FROM VQ q, embeddings e JOIN documents ON doc_id = vec_id),
r AS (SELECT vec_id, category, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, category) AS rk FROM s),
t AS (SELECT doc_id AS vec_id, {TOK} AS words FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) x),
n AS (SELECT vec_id, category, rk, len(list_filter(words, lambda x: length(x) % 10 = CAST(substr(category, 5) AS INTEGER))) AS w FROM r JOIN t USING (vec_id) WHERE rk <= 3),
a AS (SELECT *, sum(w) OVER (PARTITION BY vec_id) AS total, count(*) OVER (PARTITION BY vec_id) AS k FROM n),
g AS (SELECT vec_id, category, rk, CASE WHEN total > 0 THEN 'llm' ELSE 'fallback' END AS source,
  CASE WHEN total > 0 AND w = 0 THEN NULL WHEN total > 0 THEN round(w::DOUBLE / total, 6) WHEN rk = 1 THEN 0.7 ELSE round(0.3 / (k - 1), 6) END::DOUBLE AS p FROM a),
h AS (SELECT *, greatest(round(p / sum(p) OVER (PARTITION BY vec_id), 6), 0.01) AS f FROM g),
m AS (SELECT *, p IS NULL AS added, CASE WHEN p IS NULL THEN 0.01 ELSE round(f / sum(CASE WHEN p IS NOT NULL THEN f END) OVER (PARTITION BY vec_id), 6) END::DOUBLE AS prob FROM h),
o AS (SELECT vec_id, source, string_agg(category || '=' || CAST(round(prob * 1000000) AS BIGINT) || CASE WHEN added THEN '+' ELSE '' END, ',' ORDER BY prob DESC, added, rk) AS ranking,
  first(category ORDER BY prob DESC, added, rk) AS top, max(prob) AS conf, sum(-prob * ln(prob)) AS h FROM m GROUP BY 1, 2)
SELECT vec_id, ranking, source, CASE WHEN conf < 0.4 THEN 'Other' ELSE top END AS chosen, conf AS confidence, round(h, 4) AS entropy FROM o""")
def _(v):
    docs = v.raw("documents").select(F.col("doc_id").alias("vec_id"), "text")
    emails = v.t("embeddings").join(docs, "vec_id")

    def referee(text, names):
        words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))
        found = F.transform(names, lambda c: F.struct(c.alias("category"), F.size(F.filter(
            words, lambda w: F.length(w) % 10 == F.substring(c, 5, 9).cast("int"))).cast("double").alias("prob")))
        return F.struct(F.lit(None).cast("string").alias("category"), F.lit(0.7).alias("confidence"),
                        F.filter(found, lambda x: x["prob"] > 0).alias("distribution"))

    d = A.categorize(emails, v.VQ.withColumnRenamed("query_id", "category"), "vec_id", preset=0.4, text="text", referee=referee)
    shown = F.transform("ranking", lambda x: F.concat(
        x["category"], F.lit("="), F.round(x["prob"] * 1_000_000).cast("long").cast("string"),
        F.when(x["source"] == "added_missing", "+").otherwise("")))
    return d.select("vec_id", F.array_join(shown, ",").alias("ranking"), F.col("distribution_source").alias("source"),
                    "chosen", "confidence", "entropy")


@query("q5_retrieve_contexts", "VQ", sql=f"""
s AS (SELECT q.query_id, e.vec_id, round({COS}, 6) AS score FROM VQ q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s),
h AS (SELECT r.query_id, r.vec_id, r.score, vec_id % 5 <> 4 AS ok FROM r WHERE rk <= 50 AND score >= 0.1)
SELECT query_id, count(*) AS contexts_count, count(*) FILTER (ok) AS success_count, count(*) FILTER (NOT ok) AS error_count,
  count(*) FILTER (ok AND vec_id % 3 = 0) AS pdf_contexts_count, count(*) FILTER (NOT ok) > 0 AS partial_failure, count(*) FILTER (ok) AS kept FROM h GROUP BY 1""")
def _(v):
    docs = v.raw("documents")
    # every fifth vector is of a document that is gone
    known = F.col("vec_id") % docs.agg(F.count("*")).scalar()
    corpus = v.t("embeddings").withColumn("doc_id", F.when(F.col("vec_id") % 5 == 4, -1 - F.col("vec_id")).otherwise(known))
    gone = corpus.where("doc_id < 0").select("doc_id", F.lit(None).cast("string").alias("text"))
    texts = docs.select("doc_id", "text").unionByName(gone)
    uri = F.concat(F.lit("gs://b/"), F.col("vec_id").cast("string"), F.when(F.col("vec_id") % 3 == 0, ".pdf").otherwise(".txt"))
    r = A.retrieve_contexts(
        v.VQ, corpus.withColumn("uri", uri), texts, "doc_id",
        F.create_map().cast("map<string,string>"), "broad", min_similarity=0.1, extra=["uri"],
    )
    kept = r.contexts.groupBy("query_id").agg(F.count("*").alias("kept"))
    return r.counts.join(kept, "query_id", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))


REL = "round(len(list_intersect(qa, tb))::DOUBLE / len(qa), 6)"
ALI = "round(CASE WHEN len(ca) = 0 OR len(tb) = 0 THEN 0.0 ELSE len(list_intersect(ca, tb))::DOUBLE / len(list_distinct(list_concat(ca, tb))) END, 6)"


@query("q6_rank_contexts", "CTX", sql=f"""
t AS (SELECT query_id, id, rnk, list_distinct(regexp_extract_all(lower('what is the ' || query_id), '[a-z0-9]+')) AS qa, regexp_extract_all(lower(query_id), '[a-z0-9]+') AS ca,
  regexp_extract_all(lower(text), '[a-z0-9]+') AS tb FROM CTX WHERE {"text <> ''"}),
s AS (SELECT query_id, id, 0.8 * {REL} + 0.2 * {ALI} AS score FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s),
n AS (SELECT *, CASE WHEN sum(score) OVER (PARTITION BY query_id) <= 0 THEN 0.001 ELSE sum(score) OVER (PARTITION BY query_id) END AS total FROM r WHERE rank <= 10),
p AS (SELECT query_id, score, round(score / total, 6) AS p FROM n)
SELECT query_id, round(sum(CASE WHEN p > 0 THEN -p * ln(p) ELSE 0 END), 4) AS entropy, round(max(p), 6) AS max_prob, count(*) AS n, round(max(score), 6) AS top_score,
  CASE WHEN max(score) BETWEEN 0.85 AND 1 THEN 'strong' WHEN max(score) BETWEEN 0.65 AND 0.85 THEN 'moderate' WHEN max(score) BETWEEN 0.45 AND 0.65 THEN 'weak' ELSE 'gap' END AS coverage FROM p GROUP BY 1""")
def _(v):
    d = v.CTX.withColumn("question", F.concat(F.lit("what is the "), "query_id")).withColumn("topic", F.col("query_id"))
    r = A.rank_contexts(d, "query_id", "question", "topic", top_n=10)
    return r.stats.select("query_id", "entropy", "max_prob", "n", F.round("top_score", 6).alias("top_score"), "coverage")


@query("q7_build_requests", "CTX", sql=f"""
a AS (SELECT query_id, id, score, t, {SHORT_BLOCK} AS blk FROM (SELECT *, {TRUNC} AS t FROM CTX) x WHERE rnk <= 15),
d AS (SELECT *, row_number() OVER (PARTITION BY query_id, CASE WHEN t = '' THEN id ELSE t END ORDER BY score DESC, id) AS copy FROM a),
b AS (SELECT query_id, blk, score, id, ceil((length('Question:' || chr(10) || 'About ' || query_id || chr(10) || chr(10) || 'Context:' || chr(10)) + 9
  + sum(length(blk) + 7) OVER (PARTITION BY query_id ORDER BY score DESC, id) - 7) / 4.0) AS tok FROM d WHERE copy = 1)
SELECT query_id, count(*) AS n_contexts, md5('Question:' || chr(10) || 'About ' || query_id || chr(10) || chr(10) || 'Context:' || chr(10) || string_agg(blk, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY score DESC, id)) AS digest,
  400 AS max_output_tokens FROM b WHERE tok <= 2100 GROUP BY 1""")
def _(v):
    qs = v.VQ.select("query_id", F.concat(F.lit("About "), "query_id").alias("question"), F.lit("Be brief.").alias("system"))
    d = A.build_requests(qs, v.CTX, "query_id", "question", "system", "conservative", dedupe=1.0)
    return d.select("query_id", F.col("n_contexts"), F.md5("user_text").alias("digest"), "max_output_tokens")


SYSTEM = TONE.replace("doc_id % 4", "label % 4").replace("doc_id", "query_id") + (
    " || chr(10) || chr(10) || 'Domain context: This is a ' || query_id || ' inquiry.' || " + STYLE)
INTENT = "CASE label % 4 WHEN 0 THEN 'information_request' WHEN 1 THEN 'action_request' WHEN 2 THEN 'complaint' END"


@query("q7_compose_requests", "CTX", sql=f"""--recursive
sys AS (SELECT query_id, intent, {SYSTEM} AS system FROM (SELECT label, query_id, {INTENT} AS intent FROM VQ) q),
a AS (SELECT query_id, id, score, t, {SHORT_BLOCK} AS blk FROM (SELECT *, {TRUNC} AS t FROM CTX) x WHERE rnk <= 15),
i AS (SELECT query_id, blk, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS p, {TOK.replace("text", "t")} AS tk FROM a),
w AS (SELECT query_id, p, len(tk) AS n, unnest(tk) AS w FROM i),
x AS (SELECT a.query_id, a.p, b.p AS o FROM w a JOIN w b ON a.query_id = b.query_id AND a.w = b.w AND b.p < a.p
  GROUP BY a.query_id, a.p, b.p, a.n, b.n HAVING count(*)::DOUBLE / (a.n + b.n - count(*)) >= 0.9),
r AS (SELECT query_id, 0::BIGINT AS p, []::BIGINT[] AS kept FROM (SELECT DISTINCT query_id FROM i) q
  UNION ALL SELECT r.query_id, r.p + 1, CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.query_id = r.query_id AND x.p = r.p + 1 AND list_contains(r.kept, x.o)) THEN r.kept ELSE list_append(r.kept, r.p + 1) END
  FROM r WHERE r.p < (SELECT max(p) FROM i WHERE i.query_id = r.query_id)),
k AS (SELECT i.* FROM i JOIN (SELECT query_id, unnest(kept) AS p FROM r WHERE p = (SELECT max(p) FROM i WHERE i.query_id = r.query_id)) u ON i.query_id = u.query_id AND i.p = u.p),
b AS (SELECT k.query_id, blk, p, system, intent, ceil((length('Question:' || chr(10) || 'About ' || k.query_id || chr(10) || chr(10) || 'Context:' || chr(10)) + length(system)
  + sum(length(blk) + 7) OVER (PARTITION BY k.query_id ORDER BY p) - 7) / 4.0) AS tok FROM k JOIN sys ON sys.query_id = k.query_id)
SELECT query_id, count(*) AS n_contexts, md5('Question:' || chr(10) || 'About ' || query_id || chr(10) || chr(10) || 'Context:' || chr(10) || string_agg(blk, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY p)) AS digest,
  md5(any_value(system)) AS system_digest, CASE WHEN any_value(intent) IN ('information_request', 'action_request') THEN 'category,intent' ELSE 'category' END AS signals FROM b WHERE tok <= 2100 GROUP BY query_id""")
def _(v):
    names = list(I.SYSTEM_TEMPLATES)
    template, label = F.lit("custom"), F.col("label")
    for n, k in enumerate(names):
        template = F.when(label % 4 == n, k).otherwise(template)
    intent = F.when(label % 4 == 0, "information_request").when(label % 4 == 1, "action_request").when(label % 4 == 2, "complaint")
    asked = v.VQ.select("label", "query_id", F.concat(F.lit("About "), "query_id").alias("question"), F.lit(DEFAULT).alias("system"))
    prompting = A.Prompting(template, F.concat(F.lit("Own prompt "), "query_id"), F.col("query_id"), intent)
    d = A.build_requests(asked, v.CTX, "query_id", "question", "system", "conservative", prompting=prompting)
    return d.select("query_id", "n_contexts", F.md5("user_text").alias("digest"), F.md5("system_text").alias("system_digest"),
                    F.array_join("applied_signals", ",").alias("signals"))


@query("q7_parse_answers", "CTX", sql="""
r AS (SELECT query_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC) AS k FROM CTX WHERE rnk <= 5)
SELECT query_id, 'about ' || query_id AS answer, 5 AS n_citations, (SELECT round(least(greatest(avg(score), 0), 1), 4) FROM r WHERE r.query_id = q.query_id AND k <= 3) AS confidence FROM (SELECT DISTINCT query_id FROM CTX) q""")
def _(v):
    from mailsieve.operators.contexts import first_chunks

    top = first_chunks(v.CTX, "query_id", "rnk", 5)
    reply = top.groupBy("query_id").agg(F.to_json(F.struct(
        F.concat(F.lit("about "), F.first("query_id")).alias("answer"),
        F.collect_list(F.struct(F.col("id").alias("chunk_id"), "source", "uri", "score")).alias("citations"),
    )).alias("reply"))
    reply = reply.withColumn("reply", F.concat(F.lit("```json\n"), "reply", F.lit("\n```")))
    return A.parse_answers(reply, "query_id", "reply").select("query_id", "answer", "n_citations", "confidence")


@query("q8_triage_funnel", "E PRED", sql=filter_sql(rules.quick_rules(QUICK)) + """,
j AS (SELECT NOT hard_block AS passed, p.*, ((p.decision = 'KEEP' AND confidence >= 0.6) OR p.decision = 'HUMAN') AS go,
  CASE WHEN confidence < 0.7 THEN 'unknown' ELSE intent END IN ('information_request', 'action_request', 'status_inquiry') AS act,
  (p.email_type = 'direct_request' AND intent = 'information_request' AND confidence >= 0.6 AND NOT safety_blocked) AS gen FROM f JOIN PRED p ON f.email_id = p.doc_id)
SELECT 0 AS step, 'inbound' AS stage, count(*) AS n FROM j UNION ALL SELECT 1, 'passed_filter', count(*) FILTER (passed) FROM j
UNION ALL SELECT 2, 'continued', count(*) FILTER (passed AND go) FROM j UNION ALL SELECT 3, 'actionable', count(*) FILTER (passed AND go AND act) FROM j
UNION ALL SELECT 4, 'eligible', count(*) FILTER (passed AND go AND act AND gen) FROM j""")
def _(v):
    return A.run_funnel(v.E, v.PRED, rules.quick_rules(QUICK), I.actionable_intents("hr_intents"))


@query("q8_run_all", "E PRED VQ O", sql=filter_sql(rules.quick_rules(QUICK)) + f""",
j AS (SELECT f.email_id, NOT hard_block AS passed, ((p.decision = 'KEEP' AND confidence >= 0.6) OR p.decision = 'HUMAN') AS go,
  CASE WHEN confidence < 0.7 THEN 'unknown' ELSE intent END IN ('information_request', 'action_request', 'status_inquiry') AS act,
  (p.email_type = 'direct_request' AND intent = 'information_request' AND confidence >= 0.6 AND NOT safety_blocked) AS gen FROM f JOIN PRED p ON f.email_id = p.doc_id),
l AS (SELECT j.email_id, e.embedding FROM j JOIN embeddings e ON e.vec_id = j.email_id WHERE passed AND go AND act AND gen),
cs AS (SELECT e.email_id, q.query_id AS category, {COS} AS cosine FROM VQ q, l e),
cr AS (SELECT *, round((cosine + 1) / 2, 6) AS score, row_number() OVER (PARTITION BY email_id ORDER BY cosine DESC, category) AS rk FROM cs),
ca AS (SELECT *, greatest(round(score / sum(score) OVER (PARTITION BY email_id), 6), 0.01) AS p FROM cr WHERE rk <= 3),
cp AS (SELECT email_id, round(p / sum(p) OVER (PARTITION BY email_id), 6) AS p FROM ca), cg AS (SELECT email_id FROM cp GROUP BY 1 HAVING max(p) >= 0.34),
rs AS (SELECT l.email_id, e.vec_id, list_cosine_similarity(l.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS c FROM l JOIN cg USING (email_id), embeddings e),
rk AS (SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY c DESC, vec_id) AS k FROM rs),
rt AS (SELECT DISTINCT email_id FROM rk JOIN documents d ON d.doc_id = rk.vec_id WHERE k <= 20 AND round(c, 6) >= 0.3 AND trim(d.text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''),
oc AS (SELECT rt.email_id, CASE WHEN blocked THEN 'blocked' WHEN rating >= 4 THEN 'accepted' WHEN rating = 3 THEN 'edited' ELSE 'rejected' END AS o FROM rt JOIN O ON O.doc_id = rt.email_id)
SELECT 0 AS step, 'inbound' AS stage, count(*) AS n FROM j UNION ALL SELECT 1, 'passed_filter', count(*) FILTER (passed) FROM j
UNION ALL SELECT 2, 'continued', count(*) FILTER (passed AND go) FROM j UNION ALL SELECT 3, 'actionable', count(*) FILTER (passed AND go AND act) FROM j
UNION ALL SELECT 4, 'eligible', count(*) FILTER (passed AND go AND act AND gen) FROM j UNION ALL SELECT 5, 'categorized', count(*) FROM cg
UNION ALL SELECT 6, 'retrieved', count(*) FROM rt UNION ALL SELECT 7, 'ranked', count(*) FROM rt UNION ALL SELECT 8, 'requested', count(*) FROM rt
UNION ALL SELECT 9, 'blocked', count(*) FILTER (o = 'blocked') FROM oc UNION ALL SELECT 10, 'accepted', count(*) FILTER (o = 'accepted') FROM oc
UNION ALL SELECT 11, 'edited', count(*) FILTER (o = 'edited') FROM oc UNION ALL SELECT 12, 'rejected', count(*) FILTER (o = 'rejected') FROM oc""")
def _(v):
    emb = v.t("embeddings")
    corpus = emb.select(
        "vec_id", F.col("vec_id").alias("doc_id"), F.concat(F.lit("gs://b/"), F.col("vec_id").cast("string"), F.lit(".txt")).alias("uri"), "embedding")
    return A.run_all(
        v.E, v.PRED, rules.quick_rules(QUICK), I.actionable_intents("hr_intents"), emb.select(F.col("vec_id").alias("email_id"), "embedding"),
        v.VQ.select(F.col("query_id").alias("category"), "embedding"), corpus, v.raw("documents").select("doc_id", "text"),
        v.O.select(F.col("doc_id").alias("email_id"), "rating", "blocked"), preset=0.34, min_similarity=0.3)


@query("q9_with_telemetry", "L", sql="""
SELECT event_id, status, CASE WHEN status = 'ok' THEN 200 ELSE 500 END AS http_status, CASE WHEN status = 'ok' THEN 'OK' ELSE 'error' END AS message,
  latency_ms AS duration_ms, retrieval_filter AS filter, CASE WHEN status = 'ok' THEN correlation_id ELSE md5('run|retrieve|' || event_id) END AS correlation_id FROM L""")
def _(v):
    d = v.L.drop("http_status").withColumn("correlation_id", F.when(F.col("status") == "ok", F.col("correlation_id")))
    end = F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")) + F.col("latency_ms"))
    d = A.with_telemetry(
        d, "retrieve", "event_id", "run", F.col("status") == "ok", corr="correlation_id", started=F.col("ts").cast("timestamp"),
        ended=end, facets={"filter": F.col("retrieval_filter"), "top_k": F.col("retrieval_top_k")})
    t = [F.col(f"telemetry.{c}").alias(c) for c in ("http_status", "message", "duration_ms", "correlation_id")]
    return d.select("event_id", "status", *t, F.try_element_at("telemetry.facets", F.lit("filter")).alias("filter"))
