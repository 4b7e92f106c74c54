"""Derived input views.  Each is a deterministic projection of the given tables.

Most view texts are plain SQL that Spark and DuckDB both accept (``@table`` marks a given table), so
the query and its oracle start from the same rows.  Views that need an operator (chunks, contexts)
have a Spark builder here and an independent SQL text for the oracle.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve.session import SPREAD, ship_package

TEXT_TABLES = ("documents", "pages", "conversations")
LF = "chr(10)"
TAB = "chr(9)"


def _email_sql(dialect: str) -> str:
    head = f"translate(substr(text, 1, 40), {LF} || {TAB} || chr(13), '   ')"
    ids = "cast(doc_id as string)"
    return f"""
SELECT doc_id AS email_id, 'Person ' || {ids} AS from_name,
  CASE doc_id % 12 WHEN 2 THEN 'noreply@example.com' WHEN 3 THEN 'news@example.com'
    WHEN 5 THEN 'support@example.com' ELSE 'user' || {ids} || '@company.com' END AS from_email,
  CASE doc_id % 12 WHEN 0 THEN 'RE: ' || {head} WHEN 1 THEN 'Out of Office: ' || {head}
    WHEN 4 THEN 'Invitation: ' || {head} WHEN 5 THEN '[Ticket #' || {ids} || '] ' || {head}
    WHEN 6 THEN 'Address change request' WHEN 7 THEN 'Question about leave'
    WHEN 11 THEN CASE WHEN doc_id % 24 = 11 THEN '' ELSE {head} END ELSE {head} END AS subject,
  CASE doc_id % 12
    WHEN 3 THEN text || {LF} || 'Click to unsubscribe at https://t.example.com/u?id=1'
    WHEN 4 THEN text || ' has invited you to lunch'
    WHEN 6 THEN 'Hi HR, I moved on 2024-11-12. Can you update my records?'
    WHEN 7 THEN 'How many sick days do I have left?'
    WHEN 8 THEN text || {LF} || 'On Mon, Jan 1, 2024 Ann wrote:' || {LF} || '> old text'
    WHEN 9 THEN text || {LF} || '--' || {LF} || 'John' || {LF} || 'Sent from my phone'
    WHEN 10 THEN '<p>' || text || '</p>' || {LF} || 'Call 555-123-4567, SSN 123-45-6789' || {LF}
      || 'This message is confidential'
    WHEN 11 THEN substr(text, 1, instr(text, '.')) || {LF} || {LF} || {LF} || {TAB} || ' '
      || substr(text, instr(text, '.') + 1)
    ELSE text END AS body,
  (doc_id % 7 = 0) AS has_unsub, (doc_id % 13 = 0) AS spf_fail,
  CASE WHEN doc_id % 5 = 0 AND doc_id % 29 = 0 THEN 'w4.pdf run.exe' WHEN doc_id % 5 = 0 THEN 'w4.pdf'
    WHEN doc_id % 29 = 0 THEN 'run.exe' ELSE '' END AS attach
FROM @documents"""


_SHARED = {
    "DOCS": """
SELECT doc_id, text, lang, source, n_chars, source || '/' || cast(doc_id as string) || '.txt' AS file_path,
  md5(text) AS checksum, cast(doc_id as string) || '.txt' AS file_name,
  CASE doc_id % 4 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'text/csv' WHEN 2 THEN 'application/pdf'
    ELSE 'image/png' END AS mime
FROM @documents""",
    # a document is missing from the previous snapshot when its label row says toxic, and from the
    # current one when its label row says low quality; of ten texts one had a word more at its end, one a line
    # more and one a line less at its start, and one a line break more at its end
    "PREV": """
SELECT d.doc_id, CASE d.doc_id % 10 WHEN 0 THEN d.text || ' edited' WHEN 1 THEN 'dropped line' || chr(10) || d.text
  WHEN 2 THEN CASE WHEN instr(d.text, chr(10)) > 0 THEN substr(d.text, instr(d.text, chr(10)) + 1) ELSE '' END
  WHEN 3 THEN d.text || chr(10) ELSE d.text END AS text
FROM @documents d LEFT JOIN @labels l ON d.doc_id = l.doc_id WHERE coalesce(l.toxic, 0) = 0""",
    "CUR": """
SELECT d.doc_id, d.text
FROM @documents d LEFT JOIN @labels l ON d.doc_id = l.doc_id WHERE coalesce(l.quality, 1) = 1""",
    "VQ": """
SELECT label, 'cat_' || cast(label as string) AS query_id, min(vec_id) AS vec_id,
  min_by(embedding, vec_id) AS embedding
FROM @embeddings GROUP BY label""",
    "PRED": """
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'KEEP' WHEN 1 THEN 'HUMAN' ELSE 'IRRELEVANT' END AS decision,
  cast(doc_id % 101 as double) / 100 AS confidence,
  CASE doc_id % 8 WHEN 0 THEN 'information_request' WHEN 1 THEN 'action_request' WHEN 2 THEN 'status_inquiry'
    WHEN 3 THEN 'complaint' WHEN 4 THEN 'feedback' WHEN 5 THEN 'escalation' WHEN 6 THEN 'auto_reply'
    ELSE 'unknown' END AS intent,
  CASE doc_id % 5 WHEN 4 THEN 'nonsense' ELSE 'cat_' || cast(doc_id % 5 as string) END AS category,
  CASE doc_id % 12 WHEN 0 THEN 'forwarded_chain' WHEN 3 THEN 'newsletter' ELSE 'direct_request' END AS email_type,
  (doc_id % 13 = 0) AS safety_blocked, (doc_id % 9 <> 0) AS has_dist
FROM @documents""",
    "RESP": """
SELECT doc_id, CASE doc_id % 6
  WHEN 0 THEN '{"category":"cat_' || cast(doc_id % 5 as string) || '","confidence":0.' || cast(doc_id % 9 + 1 as string)
    || ',"reasons":["a","b"],"note":"d' || cast(doc_id as string) || '"' || sk || '}'
  WHEN 1 THEN '```json' || chr(10) || '{"category":"cat_1","confidence":0.5,"reasons":["x"],"note":"d'
    || cast(doc_id as string) || '"' || sk || '}' || chr(10) || '```'
  WHEN 2 THEN 'Here is the result: {"category":"cat_2","confidence":0.25,"reasons":[],"note":"d'
    || cast(doc_id as string) || '"' || sk || '}'
  WHEN 3 THEN '{"category":"bogus","confidence":1.7,"reasons":["a","b","c","d","e"],"note":"d'
    || cast(doc_id as string) || '"' || sk || '}'
  WHEN 4 THEN '{"data":{"result":{"contexts":[{"chunkId":"c1","chunkText":"one ' || cast(doc_id as string)
    || '","score":0.9},{"text":"two","score":0.8,"sourceUri":"gs://b/x.pdf"}]}}' || sk || '}'
  ELSE '{"category":"cat_0","confidence":0.3, broken ' || cast(doc_id as string) END AS json_text
FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN ',"api_key":"s3cr3t' || cast(doc_id as string) || '"' ELSE '' END AS sk
      FROM @documents) x""",
    "L": """
SELECT event_id, ts, user_id, event_type, value,
  CASE event_type WHEN 'view' THEN 'rag_retrieve_contexts' WHEN 'click' THEN 'rank_texts_with_ranking_api'
    WHEN 'purchase' THEN 'rag_answer' WHEN 'signup' THEN 'gen_generate'
    ELSE CASE user_id % 4 WHEN 0 THEN 'rag_retrieve_contexts' WHEN 1 THEN 'rank_texts_with_ranking_api'
      WHEN 2 THEN 'rag_answer' ELSE 'gen_generate' END END AS action,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN event_type <> 'error' THEN 200 ELSE CASE event_id % 4 WHEN 0 THEN 403 WHEN 1 THEN 429 WHEN 2 THEN 500
    ELSE NULL END END AS http_status,
  cast(round(value * 10) as bigint) AS latency_ms, 20 AS retrieval_top_k,
  CASE event_id % 3 WHEN 0 THEN 'distance' WHEN 1 THEN 'similarity' ELSE NULL END AS retrieval_filter,
  CASE event_id % 3 WHEN 0 THEN 0.35 WHEN 1 THEN 0.65 ELSE NULL END AS retrieval_filter_val,
  CASE WHEN user_id % 3 = 0 THEN 'llm' ELSE 'rank_service' END AS rank_mode,
  event_id % 21 AS contexts_returned, 200 + event_id % 400 AS tokens_total,
  CASE WHEN event_id % 20 = 0 THEN 'MAX_TOKENS' ELSE 'STOP' END AS gen_finish_reason,
  cast(event_id % 100 as double) / 100 AS confidence,
  (event_id % 37 = 0) AS safety_blocked, (event_id % 11 = 0) AS answered_unknown,
  'u' || cast(user_id as string) || '-' || cast(cast(ts as date) as string) AS correlation_id,
  CASE user_id % 3 WHEN 0 THEN 'prod' WHEN 1 THEN 'stage' ELSE 'dev' END AS env,
  'R-' || cast(user_id % 5 as string) AS recipe_id, 'J-' || cast(user_id % 50 as string) AS job_id,
  CASE user_id % 4 WHEN 0 THEN 'us-central1' WHEN 1 THEN 'us-east4' WHEN 2 THEN 'europe-west4'
    ELSE 'asia-east1' END AS region,
  CASE WHEN event_id % 33 = 0 THEN 'NONSTANDARD/odd' WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity
FROM @events""",
    "M": """
SELECT event_id, ts, 'S' || cast(user_id % 10 as string) AS schedule, 'vm-' || cast(user_id % 3 as string) AS machine,
  cast(event_id % 400 as double) / 100 AS now_diff, cast(round(value) as bigint) AS current_duration,
  1 + user_id % 3 AS max_run_hours, (event_id % 2 = 0) AS critical_armed, (event_id % 3 = 0) AS extended_armed
FROM @events""",
    "H": """
SELECT user_id, count(*) AS batch_size, sum(value) / 100 AS processing_time,
  avg(CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END) AS success_rate, max(value) AS memory_usage
FROM @events GROUP BY user_id""",
    "O": """
SELECT d.doc_id, 1 + d.doc_id % 5 AS rating,
  CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE cast(d.doc_id % 100 as double) / 100 END AS confidence,
  coalesce(l.toxic, 0) = 1 AS blocked, d.lang AS category, d.source,
  cast(floor(d.doc_id / 100) as bigint) AS week, 50 + d.n_chars % 5000 AS latency_ms,
  cast(d.n_chars % 100 as double) / 100 AS edit_share, coalesce(l.quality, 1) AS grounded
FROM @documents d LEFT JOIN @labels l ON d.doc_id = l.doc_id""",
    "CONV": """
SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
FROM @conversations u JOIN @conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'""",
    "CONTR": """
SELECT c_custkey AS contractor_id, c_nationkey AS manager_id, c_custkey % 50 AS engagement_id,
  CASE WHEN c_custkey % 11 = 0 THEN 'Exited' ELSE 'Active' END AS status,
  CASE WHEN c_custkey % 37 = 0 THEN 'Formal PIP' ELSE 'None' END AS pip_status,
  CASE WHEN c_custkey % 23 = 0 THEN 'At risk' WHEN c_custkey % 23 = 1 THEN 'Watch' ELSE 'None' END AS risk_flag,
  c_mktsegment AS client
FROM @customer""",
    "INTER": """
SELECT o_orderkey AS interaction_id, o_custkey AS contractor_id, cast(o_orderdate as date) AS interaction_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'client_escalation' WHEN '2-HIGH' THEN 'client_kudos'
    WHEN '3-MEDIUM' THEN '1x1_manager_contractor' WHEN '4-NOT SPECIFIED' THEN 'client_stakeholder_meeting'
    ELSE 'internal_coaching' END AS interaction_type
FROM @orders""",
    "G": """
SELECT n_nationkey AS src, (3 * n_nationkey + 1) % 25 AS dst, 'call' AS kind FROM @nation
UNION ALL SELECT n_nationkey, n_nationkey, 'self' FROM @nation WHERE n_name IN (SELECT min(n_name) FROM @nation GROUP BY n_regionkey)
UNION ALL SELECT n_nationkey, 25 + n_nationkey, 'external' FROM @nation WHERE n_name IN (SELECT max(n_name) FROM @nation GROUP BY n_regionkey)""",
    "FILES": """
SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?].*$', '') AS path, url, html,
  page_id AS folder_id, CASE WHEN page_id > 0 THEN cast(floor((page_id - 1) / 3) as bigint) END AS parent_id,
  CASE page_id % 6 WHEN 0 THEN 'text/html' WHEN 1 THEN 'text/plain; charset=utf-8' WHEN 2 THEN 'application/json'
    WHEN 3 THEN 'application/pdf' WHEN 4 THEN 'image/png'
    ELSE 'application/vnd.google-apps.document' END AS mime,
  page_id * 3600 AS modified_s, length(html) AS size, (page_id % 14 = 0) AS fails, (page_id % 10 = 3) AS is_folder
FROM @pages""",
    "K": """
SELECT s_suppkey AS key_id, s_name AS account, s_nationkey, s_acctbal FROM @supplier""",
    "ACT": """
SELECT 'projects/p/keys/' || cast(s.s_suppkey as string) AS resource, max(l.l_shipdate) AS last_used
FROM @supplier s JOIN @lineitem l ON s.s_suppkey = l.l_suppkey WHERE s.s_acctbal > 0 GROUP BY s.s_suppkey""",
}


def _pdf_sql(dialect: str) -> str:
    bs = "chr(92)"
    return f"""
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN text || {bs} || 'nnext line' WHEN 1 THEN text || {bs} || {bs} || 'nnext line'
  WHEN 2 THEN text || {LF} || 'hyphen-' || {LF} || 'break' WHEN 3 THEN text || ' ( ) [ ] end' || {LF} || {LF} || {LF} || 'x'
  WHEN 4 THEN '##Head' || {LF} || text || {LF} || '   - item one  ' || {LF} || '- item two'
  ELSE text || chr(1) || ' tail..... ' END AS text
FROM @documents"""


def _dist_sql(dialect: str) -> str:
    gen = (
        "LATERAL (SELECT unnest(range(0, 3 + doc_id % 2)) AS j)"
        if dialect == "duckdb"
        else "LATERAL (SELECT explode(sequence(0L, 2 + doc_id % 2)) AS j)"
    )
    return f"""
SELECT doc_id, 'cat_' || cast(j as string) AS category, cast(1 + (doc_id + j) % 5 as double) AS weight
FROM @documents, {gen} g"""


_CHUNK_ORACLE = """
SELECT doc_id, i AS chunk_index, substr(text, cast(i * 360 + 1 as bigint), 400) AS text, i * 360 AS start_char,
  least(i * 360 + 400, len) AS end_char, cast(ceil(length(substr(text, cast(i * 360 + 1 as bigint), 400)) / 4.0) as bigint) AS token_count,
  len, source, file_path
FROM (SELECT *, unnest(range(0, CASE WHEN len <= 400 THEN 1 ELSE cast(ceil((len - 400) / 360.0) as bigint) + 1 END)) AS i
      FROM (SELECT doc_id, text, source, file_path, length(text) AS len FROM DOCS WHERE length(text) > 0) a) b"""

_CTX_ORACLE = """
SELECT query_id, 'v' || vec_id AS id, c.vec_id, round(cos, 6) AS score, rnk,
  CASE WHEN c.vec_id % 15 = 0 THEN '' ELSE d.text END AS text, d.source,
  'cat_' || label AS category, c.vec_id AS page,
  'gs://bucket/' || d.source || '/' || c.vec_id || CASE WHEN c.vec_id % 3 = 0 THEN '.pdf' ELSE '.txt' END AS uri
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cos DESC, vec_id) AS rnk
      FROM (SELECT q.query_id, e.vec_id, e.label,
              list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS cos
            FROM VQ q, embeddings e) s) c
JOIN documents d ON d.doc_id = c.vec_id % (SELECT count(*) FROM documents)
WHERE rnk <= 50"""

_DEPENDS = {"C": ["DOCS"], "CTX": ["VQ"]}


def _view_sql(name: str, dialect: str) -> str:
    if name == "E":
        return _email_sql(dialect)
    if name == "PDF":
        return _pdf_sql(dialect)
    if name == "DIST":
        return _dist_sql(dialect)
    return _SHARED[name]


def oracle_sql_text(views: list[str], body: str) -> str:
    """Inline the needed views as CTEs before ``body`` (which may start with its own CTEs)."""
    order: list[str] = []
    for v in views:
        for n in [*_DEPENDS.get(v, []), v]:
            if n not in order:
                order.append(n)
    texts = {"C": _CHUNK_ORACLE, "CTX": _CTX_ORACLE}
    ctes = [f"{n} AS ({re.sub(r'@([a-z]+)', chr(92) + '1', texts.get(n) or _view_sql(n, 'duckdb'))})" for n in order]
    body = body.strip()
    if not ctes:
        return body
    own = not re.match(r"(?i)(select|\()", body)
    recursive = "RECURSIVE " if body.startswith("--recursive") else ""
    body = body.removeprefix("--recursive").strip()
    return f"WITH {recursive}" + ", ".join(ctes) + (", " if own else " ") + body


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out over as many tasks as the session's SPREAD setting says, if it says so."""
    n = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(n)) if n else df


class Views:
    """Given tables and derived views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship_package(spark)
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def t(self, name: str) -> DataFrame:
        """Given table; text tables are dealt out over the cores when they are small."""
        return spread(self.raw(name)) if name in TEXT_TABLES else self.raw(name)

    def sql(self, name: str) -> DataFrame:
        text = re.sub(r"@([a-z]+)", lambda m: f"parquet.`{self.dir}/{m.group(1)}.parquet`", _view_sql(name, "spark"))
        df = self.spark.sql(text)
        return spread(df) if any(f"@{t}" in _view_sql(name, "spark") for t in TEXT_TABLES) else df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.sql(name)

    @cached_property
    def E(self) -> DataFrame:
        """E-mail envelopes with header map, attachment list and auth flags."""
        return self.sql("E").select(
            "email_id", "from_name", "from_email", "subject", "body",
            F.when(F.col("has_unsub"), F.create_map(F.lit("List-Unsubscribe"), F.lit("<mailto:off@example.com>")))
            .otherwise(F.create_map().cast("map<string,string>")).alias("headers"),
            F.when(F.col("attach") == "", F.array().cast("array<string>"))
            .otherwise(F.split("attach", " ")).alias("attachments"),
            F.create_map(F.lit("spf_fail"), F.col("spf_fail")).alias("auth"),
        )

    @cached_property
    def C(self) -> DataFrame:
        """Fixed-size chunks (100 tokens, 10 overlap, 4 characters per token) of every document."""
        from mailsieve.operators.chunking import chunk_fixed

        d = self.DOCS.select("doc_id", "text", "source", "file_path", F.length("text").alias("len"))
        return chunk_fixed(d, size=100, overlap=10)

    @cached_property
    def CTX(self) -> DataFrame:
        """The 50 nearest corpus vectors of each label's first vector, dressed as retrieved contexts."""
        from mailsieve.operators.vectors import nearest

        hits = nearest(
            self.VQ.select("query_id", "embedding"),
            self.t("embeddings").select("vec_id", "embedding", "label"),
            k=50, query_id="query_id", corpus_id="vec_id", carry=["label"],
        )
        docs = self.raw("documents").select("doc_id", "text", "source")
        n_docs = self.raw("documents").agg(F.count("*")).scalar()
        h = hits.withColumn("doc_id", F.col("vec_id") % n_docs)
        vid = F.col("vec_id").cast("string")
        return h.join(docs, "doc_id").select(
            "query_id", F.concat(F.lit("v"), vid).alias("id"), "vec_id", "score", F.col("rank").alias("rnk"),
            F.when(F.col("vec_id") % 15 == 0, "").otherwise(F.col("text")).alias("text"), "source",
            F.concat(F.lit("cat_"), F.col("label").cast("string")).alias("category"), F.col("vec_id").alias("page"),
            F.concat(
                F.lit("gs://bucket/"), "source", F.lit("/"), vid,
                F.when(F.col("vec_id") % 3 == 0, ".pdf").otherwise(".txt"),
            ).alias("uri"),
        )
