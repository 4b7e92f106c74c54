"""Chunks, batches, document snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsieve.catalog.text_queries import PAIR_SQL  # noqa: F401 - registered first
from mailsieve.functions import jsonx as J
from mailsieve.functions.text import token_change
from mailsieve.operators import changes
from mailsieve.operators import chunking as K
from mailsieve.registry import query

EMPTY = "cast(map() as map<string,string>)"


@query("f23a_chunk_fixed", "C", sql="""
SELECT doc_id, chunk_index, start_char, end_char, token_count, md5(text) AS digest FROM C""")
def _(v):
    return v.C.select("doc_id", "chunk_index", "start_char", "end_char", "token_count", F.md5("text").alias("digest"))


def smart_end(pos: str) -> str:
    lim = f"least({pos} + 400, len)"
    seg = f"substr(text, {pos} + 1, {lim} - {pos})"
    par = f"nullif(length(regexp_extract({seg}, '(?s)^(.*\\n{{2,}})', 1)), 0)"
    sen = f"""nullif(length(regexp_extract({seg}, '(?s)^(.*[.!?]["'')\\]]?\\s)', 1)), 0)"""
    return f"CASE WHEN {lim} = len THEN len ELSE {pos} + coalesce({par}, {sen}, {lim} - {pos}) END"


@query("f23b_chunk_smart", "DOCS", sql=f"""--recursive
d AS (SELECT doc_id, text, length(text) AS len FROM DOCS WHERE length(text) > 0),
r AS (SELECT doc_id, text, len, 0::BIGINT AS i, 0::BIGINT AS p, ({smart_end('0')})::BIGINT AS e FROM d
  UNION ALL SELECT doc_id, text, len, i + 1, np, ({smart_end('np')})::BIGINT
  FROM (SELECT doc_id, text, len, i, CASE WHEN e - 40 > p THEN e - 40 ELSE e END AS np FROM r WHERE e < len) n)
SELECT doc_id, i AS chunk_index, p AS start_char, e AS end_char, md5(substr(text, p + 1, e - p)) AS digest FROM r""")
def _(v):
    c = K.chunk_smart(v.DOCS, size=100, overlap=10)
    return c.select("doc_id", "chunk_index", "start_char", "end_char", F.md5("text").alias("digest"))


@query("f23c_chunk_words")
def _(v):
    return K.chunk_words(v.DOCS, size=400, overlap_tokens=10).select("doc_id", "chunk_index", "start_char", "end_char", "token_count")


@query("f23d_chunk_bytes", "DOCS", sql="""
SELECT doc_id, i AS index, n AS total, lower(substr(h, i * 1000 + 1, 1000)) AS chunk, cast(length(substr(h, i * 1000 + 1, 1000)) / 2 AS BIGINT) AS bytes
FROM (SELECT doc_id, h, n, unnest(range(0, n)) AS i FROM (SELECT doc_id, hex(encode(text)) AS h, cast(ceil(strlen(text) / 500.0) AS BIGINT) AS n FROM DOCS) a) b""")
def _(v):
    c = K.chunk_bytes(v.DOCS.select("doc_id", "text"), 500)
    return c.select("doc_id", "index", "total", F.lower(F.hex("chunk")).alias("chunk"), F.col("bytes").cast("long").alias("bytes"))


@query("f23e_process_documents", "DOCS", sql="""
d AS (SELECT doc_id, text, length(text) AS len, sha256(trim(file_path) || '|' || trim(checksum)) AS document_id FROM DOCS WHERE length(text) > 0),
c AS (SELECT *, unnest(range(0, CASE WHEN len <= 1000 THEN 1 ELSE cast(ceil((len - 1000) / 900.0) AS BIGINT) + 1 END)) AS i FROM d)
SELECT doc_id, document_id || '_chunk_' || i AS chunk_id, i AS chunk_index, i * 900 AS start_char, least(i * 900 + 1000, len) AS end_char FROM c""")
def _(v):
    return K.process_documents(v.DOCS).select("doc_id", "chunk_id", "chunk_index", "start_char", "end_char")


@query("w1_chunk_flags", "C", sql="""
SELECT doc_id, chunk_index, chunk_index > 0 AS has_overlap, end_char >= len AS is_final, count(*) OVER (PARTITION BY doc_id) AS total_chunks FROM C""")
def _(v):
    d = K.chunk_totals(K.with_flags(v.C, F.col("len")), "doc_id")
    return d.select("doc_id", "chunk_index", "has_overlap", "is_final", "total_chunks")


BATCH_SQL = "b AS (SELECT *, cast(floor((row_number() OVER (ORDER BY doc_id, chunk_index) - 1) / 25) AS BIGINT) AS batch_number FROM C)"


def batched(v):
    return K.assign_batches(v.C, 25, ["doc_id", "chunk_index"], F.floor(F.col("doc_id") / 64))


@query("w2_assign_batches", "C", sql=BATCH_SQL + " SELECT doc_id, chunk_index, batch_number FROM b")
def _(v):
    return batched(v).select("doc_id", "chunk_index", "batch_number")


@query("a5_batch_summary", "C", sql=BATCH_SQL + """
SELECT batch_number, count(DISTINCT doc_id) AS documents, count(*) AS chunks, sum(token_count)::BIGINT AS tokens FROM b GROUP BY 1""")
def _(v):
    return K.batch_summary(batched(v))


@query("q3_embedding_batches", "C", sql=BATCH_SQL + """
SELECT doc_id, chunk_index, batch_number, 'emb_batch_' || batch_number || '_run1' AS batch_id, md5(file_path || ': ' || text) AS text_digest,
  doc_id || '_' || chunk_index AS meta_id, 'RETRIEVAL_DOCUMENT' AS task_type, '' AS violations FROM b""")
def _(v):
    t = v.C.withColumn("id", F.concat_ws("_", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")))
    t = t.withColumnRenamed("text", "content").withColumn("title", F.col("file_path"))
    b = K.embedding_batches(t, 25, ["doc_id", "chunk_index"], F.floor(F.col("doc_id") / 64), "run1")
    b = J.validate_contract(b, "embedding_request")
    return b.select(
        "doc_id", "chunk_index", "batch_number", "batch_id", F.md5("text").alias("text_digest"),
        F.col("metadata")["id"].alias("meta_id"), F.col("metadata")["task_type"].alias("task_type"),
        F.array_join("violations", ";").alias("violations"),
    )


@query("f31_adapt_chunks", "C", sql="""
SELECT doc_id, chunk_index, doc_id || '_' || chunk_index AS record_id, 'base' AS origin, source AS lang_source, 'chunk_' || chunk_index AS meta_chunk FROM C""")
def _(v):
    c = v.C.withColumn("metadata", F.create_map(F.lit("origin"), F.lit("chunk"), F.lit("src"), F.col("source")))
    c = c.withColumn("base_metadata", F.create_map(F.lit("origin"), F.lit("base"), F.lit("chunk_id"), F.lit("x")))
    a = K.adapt_chunks(c, "docid_index")
    m = F.col("metadata")
    return a.select("doc_id", "chunk_index", "record_id", m["origin"].alias("origin"), m["src"].alias("lang_source"), m["chunk_id"].alias("meta_chunk"))


@query("f32_merge_metadata", "C", sql="""
SELECT doc_id, chunk_index, 'document' AS level, file_path AS file_name, 'google_drive' AS source, CAST(chunk_index AS VARCHAR) AS idx FROM C""")
def _(v):
    chunk = F.create_map(F.lit("level"), F.lit("chunk"), F.lit("idx"), F.col("chunk_index").cast("string"))
    doc = F.create_map(F.lit("level"), F.lit("document"), F.lit("source"), F.col("source"), F.lit("file_name"), F.lit("old"))
    ids = F.create_map(F.lit("file_name"), F.col("file_path"), F.lit("level"), F.lit(None).cast("string"))
    d = v.C.withColumn("m", K.merge_metadata(chunk, doc, ids))
    m = F.col("m")
    return d.select("doc_id", "chunk_index", m["level"].alias("level"), m["file_name"].alias("file_name"), m["source"].alias("source"), m["idx"].alias("idx"))


@query("p21_validate_contract", "C", sql="""
SELECT doc_id, chunk_index, CASE WHEN doc_id % 5 = 0 THEN 'text must be a string' ELSE '' END AS request_violations,
  'missing context_documents;missing user_query' AS prompt_violations,
  'file_hash must be a string;character_count must be an integer' AS metadata_violations FROM C""")
def _(v):
    d = v.C.select(
        "doc_id", "chunk_index", F.when(F.col("doc_id") % 5 != 0, F.col("text")).alias("text"),
        F.create_map(F.lit("a"), F.lit("b")).alias("metadata"), F.lit("x").alias("document_id"), F.lit(1).alias("file_hash"),
        F.lit(1).alias("word_count"), F.lit(1.5).alias("character_count"), F.lit(2).alias("estimated_tokens"), F.lit("t").alias("created_at"),
    )
    d = J.validate_contract(d, "embedding_request", "a")
    d = J.validate_contract(d, "prompt_request", "b")
    d = J.validate_contract(d, "document_metadata", "c")
    return d.select(
        "doc_id", "chunk_index", F.array_join("a", ";").alias("request_violations"),
        F.array_join("b", ";").alias("prompt_violations"), F.array_join("c", ";").alias("metadata_violations"),
    )


def with_blanks(v):
    """All documents, and a blank one more for every tenth."""
    blank = v.DOCS.where("doc_id % 10 = 3").withColumns({"doc_id": F.col("doc_id") + 1_000_000_000, "text": F.lit(" \n ")})
    return v.DOCS.unionByName(blank)


@query("p24_split_valid", "DOCS", sql="""
SELECT doc_id, 'valid' AS lane FROM DOCS UNION ALL SELECT doc_id + 1000000000, 'empty_text_content' FROM DOCS WHERE doc_id % 10 = 3""")
def _(v):
    good, bad = K.split_valid(with_blanks(v), ["text", "file_path"])
    return good.select("doc_id", F.lit("valid").alias("lane")).unionByName(bad.select("doc_id", F.col("reason").alias("lane")))


@query("j10_detect_changes_hash", "CUR PREV", sql="""
SELECT coalesce(c.doc_id, p.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL THEN 'added' WHEN c.doc_id IS NULL THEN 'removed' ELSE 'kept' END AS status,
  c.text IS DISTINCT FROM p.text AS has_changed, CASE WHEN c.text IS DISTINCT FROM p.text THEN 'hash_changed' ELSE 'none' END AS change_type
FROM CUR c FULL OUTER JOIN PREV p ON c.doc_id = p.doc_id""")
def _(v):
    return changes.detect_changes(v.CUR, v.PREV, "doc_id").select("doc_id", "status", "has_changed", "change_type")


# line counts without trailing empty lines, as the edits of PREV leave them
_N = r"len(string_split(regexp_replace(c.text, '\n+$', ''), chr(10)))"
_TAIL = r"length(regexp_extract(c.text, '\n+$'))"
LINE_PCT = rf"""CASE c.doc_id % 10 WHEN 1 THEN round(1.0 / ({_N} + 1) * 100, 2) WHEN 2 THEN round(1.0 / {_N} * 100, 2) WHEN 3 THEN 0.0
  ELSE CASE WHEN {_TAIL} > 0 THEN round({_TAIL}::DOUBLE / ({_N} + {_TAIL}) * 100, 2) ELSE round(2.0 / {_N} * 100, 2) END END"""


@query("j10_detect_changes_content", "CUR PREV", sql=f"""
SELECT coalesce(c.doc_id, p.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL OR c.doc_id IS NULL THEN 'hash_changed' WHEN c.text <> p.text THEN 'content_changed' ELSE 'none' END AS change_type,
  CASE WHEN c.text <> p.text THEN {LINE_PCT} ELSE 0.0 END AS change_percentage,
  CASE WHEN c.text <> p.text AND c.doc_id % 10 = 1 THEN 'dropped line' END AS first_removed,
  CASE WHEN c.text <> p.text AND c.doc_id % 10 = 2 THEN 1 ELSE 0 END AS only_added
FROM CUR c FULL OUTER JOIN PREV p ON c.doc_id = p.doc_id""")
def _(v):
    d = changes.detect_changes(v.CUR, v.PREV, "doc_id", check_type="content")
    lone = (F.size("added_content") == 1) & (F.size("removed_content") == 0) & (F.size("modified_sections") == 1)
    first = F.when(F.col("doc_id") % 10 == 1, F.get("removed_content", F.lit(0)))
    return d.select("doc_id", "change_type", "change_percentage", first.alias("first_removed"), lone.cast("int").alias("only_added"))


# parts between blanks, trailing empty ones dropped
_TOKENS = r"""(CASE WHEN regexp_replace({0}, '\s+$', '') = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(regexp_replace({0}, '\s+$', ''), '\s+') END)"""
_A, _B = _TOKENS.format("c.text"), _TOKENS.format("p.text")
CHANGE_SQL = f"""(SELECT CASE WHEN len(u) = 0 THEN 0.0 ELSE round((1.0 - len(s)::DOUBLE / len(u)) * 100, 2) END FROM (SELECT
  list_distinct(list_concat({_A}, {_B})) AS u, list_intersect({_A}, {_B}) AS s) z)"""


@query("j10_detect_changes_smart", "CUR PREV", sql=f"""
SELECT coalesce(c.doc_id, p.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL OR c.doc_id IS NULL THEN 'hash_changed'
  WHEN c.text <> p.text AND c.doc_id % 10 <> 3 THEN 'smart_changed' ELSE 'none' END AS change_type,
  CASE WHEN c.text <> p.text THEN {CHANGE_SQL} ELSE 0.0 END AS change_percentage FROM CUR c FULL OUTER JOIN PREV p ON c.doc_id = p.doc_id""")
def _(v):
    return changes.detect_changes(v.CUR, v.PREV, "doc_id", check_type="smart").select("doc_id", "change_type", "change_percentage")


@query("f21_token_change", "CUR PREV", sql=f"SELECT c.doc_id, {CHANGE_SQL} AS change FROM CUR c JOIN PREV p ON c.doc_id = p.doc_id")
def _(v):
    p = v.CUR.join(v.PREV.withColumnRenamed("text", "old"), "doc_id")
    return p.select("doc_id", token_change(F.col("text"), F.col("old")).alias("change"))


@query("f22_line_diff", "CUR PREV", sql=f"""
SELECT c.doc_id, CASE WHEN c.text = p.text THEN 0.0 ELSE {LINE_PCT} END AS pct,
  CASE WHEN c.text = p.text OR c.doc_id % 10 = 3 THEN 0 ELSE 1 END AS sections FROM CUR c JOIN PREV p ON c.doc_id = p.doc_id""")
def _(v):
    p = v.CUR.withColumnRenamed("text", "cur_text").join(v.PREV.withColumnRenamed("text", "prev_text"), "doc_id")
    return changes.line_diff(p, "doc_id").select("doc_id", F.col("line_change_percentage").alias("pct"), F.size("sections").alias("sections"))


_SETS = """
t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) AS w FROM DOCS),
s AS (SELECT doc_id, CASE WHEN len(w) > 0 THEN min(doc_id) OVER (PARTITION BY list_sort(w)) ELSE doc_id END AS class_id, w, len(w) AS n FROM t),
k AS (SELECT class_id, w, n FROM s WHERE doc_id = class_id AND n > 0),
p AS (SELECT a.class_id AS u, b.class_id AS v FROM k a JOIN k b ON a.class_id < b.class_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  WHERE 100 * len(list_intersect(a.w, b.w)) >= 90 * (a.n + b.n - len(list_intersect(a.w, b.w)))),
m AS (SELECT v, list(u) AS us, row_number() OVER (ORDER BY v) AS i FROM p GROUP BY v),
g AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS gone UNION ALL
  SELECT m.i, CASE WHEN len(list_filter(m.us, lambda x: NOT list_contains(g.gone, x))) > 0 THEN list_append(g.gone, m.v) ELSE g.gone END FROM g JOIN m ON m.i = g.i + 1),
z AS (SELECT gone FROM g ORDER BY i DESC LIMIT 1)"""


@query("f27_corpus_near_duplicates", "DOCS", sql=f"""--recursive{_SETS}
SELECT s.doc_id, s.class_id, (SELECT count(*) FROM p WHERE p.u = s.class_id OR p.v = s.class_id) AS n_links,
  s.doc_id = s.class_id AND NOT list_contains(z.gone, s.doc_id) AS kept FROM s, z""")
def _(v):
    from mailsieve.operators.similarity import corpus_near_duplicates

    return corpus_near_duplicates(v.DOCS.select("doc_id", "text"))


@query("s7_to_jsonl", "C", sql="""
SELECT '{"id":"' || doc_id || '_' || chunk_index || '","n":' || to_json(text) || '}' AS line, doc_id FROM C""")
def _(v):
    from mailsieve.sources.sinks import to_jsonl

    return to_jsonl(v.C, id_strategy="docid_index", text_field="n", include_metadata=False, keep=["doc_id"])


@query("u5_chunk_udtf", "DOCS", sql="""
SELECT doc_id, i AS chunk_index, i * 360 AS start_char, least(i * 360 + 400, len) AS end_char
FROM (SELECT doc_id, len, unnest(range(0, CASE WHEN len <= 400 THEN 1 ELSE cast(ceil((len - 400) / 360.0) AS BIGINT) + 1 END)) AS i
  FROM (SELECT doc_id, length(text) AS len FROM DOCS) a) b""")
def _(v):
    from mailsieve.functions.udtf import chunk_text

    d = v.DOCS.select("doc_id", "text")
    return d.lateralJoin(chunk_text(F.col("text").outer(), F.lit(100), F.lit(10))).select("doc_id", "chunk_index", "start_char", "end_char")


@query("u1_apply_user_fn", "DOCS", sql="SELECT doc_id, upper(lang) AS lang, n_chars * 2 AS doubled FROM DOCS")
def _(v):
    from mailsieve.functions.models import apply_user_fn

    def fn(pdf):
        return pdf.assign(lang=pdf["lang"].str.upper(), doubled=pdf["n_chars"] * 2)[["doc_id", "lang", "doubled"]]

    return apply_user_fn(v.t("documents").select("doc_id", "lang", "n_chars"), fn, "doc_id long, lang string, doubled long")


@query("q1_prepare_document_batch", "DOCS", sql="""
d AS (SELECT doc_id, text FROM DOCS UNION ALL SELECT doc_id + 1000000000, '' FROM DOCS WHERE doc_id % 10 = 3),
g AS (SELECT doc_id, length(text) AS len FROM d WHERE text <> ''),
c AS (SELECT doc_id, unnest(range(0, CASE WHEN len <= 1000 THEN 1 ELSE cast(ceil((len - 1000) / 900.0) AS BIGINT) + 1 END)) AS i FROM g),
b AS (SELECT doc_id, i, cast(floor((row_number() OVER (ORDER BY doc_id, i) - 1) / 40) AS BIGINT) AS n FROM c)
SELECT (SELECT count(*) FROM d) AS total_documents, (SELECT count(*) FROM c) AS total_chunks, (SELECT max(n) + 1 FROM b) AS total_batches,
  (SELECT count(*) FROM g) AS successful_documents, (SELECT count(*) FROM d WHERE text = '') AS failed_documents""")
def _(v):
    from mailsieve.plans.documents import prepare_document_batch

    return prepare_document_batch(with_blanks(v), batch_size=40).summary


@query("q2_chunk_objects", "DOCS", sql=f"""--recursive
d AS (SELECT doc_id, text, length(text) AS len FROM DOCS WHERE length(text) > 0),
r AS (SELECT doc_id, text, len, 0::BIGINT AS i, 0::BIGINT AS p, ({smart_end('0')})::BIGINT AS e FROM d
  UNION ALL SELECT doc_id, text, len, i + 1, np, ({smart_end('np')})::BIGINT
  FROM (SELECT doc_id, text, len, i, CASE WHEN e - 40 > p THEN e - 40 ELSE e END AS np FROM r WHERE e < len) n),
b AS (SELECT doc_id, e - p AS chars, cast(floor((row_number() OVER (ORDER BY doc_id, i) - 1) / 25) AS BIGINT) AS batch_number FROM r)
SELECT batch_number, count(*) AS n, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS docs FROM b GROUP BY 1""")
def _(v):
    from mailsieve.plans.documents import chunk_objects

    r = chunk_objects(with_blanks(v), size=100, overlap=10, run_id="r")
    return r.requests.groupBy("batch_number").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.countDistinct("doc_id").alias("docs")
    )
