"""Text, token, id and cleaning functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailsieve.catalog.sqlkit import chain, has, lines, norm_ws, q, strip, sub
from mailsieve.functions import ids, text as X
from mailsieve.plans import cleaning
from mailsieve.registry import query

HTML_SQL = chain(
    "{0}", (r"(?is)<script\b.*?</script>", ""), (r"(?is)<style\b.*?</style>", ""),
    (r"(?i)</(p|div|h\d|li|br|tr)>", "\n"), (r"(?i)<li[^>]*>", "• "), (r"</?[^>]+>", ""),
)
for _e, _c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
    HTML_SQL = f"replace({HTML_SQL}, {q(_e)}, {q(_c)})"
URL = q(X.URL_PATTERN)
PII_SQL = sub(sub("{0}", X.EMAIL_PATTERN, "[EMAIL]"), X.PHONE_PATTERN, "[PHONE]")
WORDS_SQL = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"
TOKENS_SQL = "regexp_extract_all(lower({0}), '[a-z0-9]+')"


def fill(template: str, expr: str) -> str:
    return template.replace("{0}", expr)


@query("f1_html_to_text", sql=f"SELECT page_id, {fill(HTML_SQL, 'html')} AS text FROM pages")
def _(v):
    return v.t("pages").select("page_id", X.html_to_text(F.col("html")).alias("text"))


@query("f2_strip_unicode_noise", "E", sql=f"""
SELECT email_id, replace({sub("body || chr(8203) || chr(160) || subject || chr(65279)", "[​-‍﻿]".encode().decode())}, chr(160), ' ') AS text FROM E""")
def _(v):
    noisy = F.concat("body", F.lit("​ "), "subject", F.lit("﻿"))
    return v.E.select("email_id", X.strip_unicode_noise(noisy).alias("text"))


QUOTE_SQL = r"""list_min(list_filter(list_transform(l, lambda x, i: CASE WHEN
  regexp_matches(x, '^\s*>') OR regexp_matches(x, '^On .+ wrote:\s*$', 'i')
  OR regexp_matches(x, '^-----Original Message-----\s*$', 'i')
  OR (regexp_matches(x, '^\s*From:\s.+', 'i') AND len(list_filter(l[i:i+5], lambda h: regexp_matches(h, '^\s*(Sent|To|Subject):', 'i'))) > 0)
  THEN i - 1 END), lambda p: p IS NOT NULL))"""


def tail_sql(pattern: str, window: int) -> str:
    return f"""list_max(list_filter(list_transform(l, lambda x, i: CASE WHEN i > len(l) - {window}
      AND {has('x', pattern)} THEN i - 1 END), lambda p: p IS NOT NULL))"""


@query("f3_cut_quotes", "E", sql=f"SELECT email_id, {QUOTE_SQL} AS kept_lines FROM (SELECT email_id, {lines('body')} AS l FROM E) x")
def _(v):
    return v.E.select("email_id", X.quote_cut(X.as_lines(F.col("body"))).cast("long").alias("kept_lines"))


@query("f4_cut_signature", "E", sql=f"SELECT email_id, {tail_sql(X.SIGNATURE_LINE, 40)} AS kept_lines FROM (SELECT email_id, {lines('body')} AS l FROM E) x")
def _(v):
    return v.E.select("email_id", X.signature_cut(X.as_lines(F.col("body"))).cast("long").alias("kept_lines"))


@query("f5_cut_disclaimer", "E", sql=f"SELECT email_id, {tail_sql(X.DISCLAIMER_LINE, 80)} AS kept_lines FROM (SELECT email_id, {lines('body')} AS l FROM E) x")
def _(v):
    return v.E.select("email_id", X.disclaimer_cut(X.as_lines(F.col("body"))).cast("long").alias("kept_lines"))


@query("f6_extract_urls", "E", sql=f"""
SELECT 'mail' AS kind, email_id AS id, array_to_string(regexp_extract_all(body, {URL}), ' ') AS urls FROM E
UNION ALL SELECT 'page', page_id, array_to_string(regexp_extract_all(html || ' ' || url, {URL}), ' ') FROM pages""")
def _(v):
    def urls(df, kind, i, c):
        return df.select(F.lit(kind).alias("kind"), F.col(i).alias("id"), F.array_join(X.extract_urls(c), " ").alias("urls"))

    return urls(v.E, "mail", "email_id", F.col("body")).unionAll(
        urls(v.t("pages"), "page", "page_id", F.concat("html", F.lit(" "), "url"))
    )


@query("f7_normalize_ws", "E", sql=f"SELECT email_id, {norm_ws('body')} AS text FROM E")
def _(v):
    return v.E.select("email_id", X.normalize_ws(F.col("body")).alias("text"))


@query("f8_extract_query", "E", sql=f"""
SELECT email_id, coalesce(list_filter(regexp_split_to_array(body, '\\n{{2,}}'), lambda p: {strip('p')} <> '')[1], substr(body, 1, 200)) AS text FROM E""")
def _(v):
    return v.E.select("email_id", X.extract_query(F.col("body")).alias("text"))


# the cleaning steps of one message, spelled as successive CTEs
CLEAN_SQL = f"""
s0 AS (SELECT email_id AS id, body AS raw, CASE WHEN contains(body, '<') AND contains(body, '>') THEN {fill(HTML_SQL, 'body')} ELSE body END AS t FROM E),
s1 AS (SELECT id, raw, {lines('t')} AS l FROM s0),
s2 AS (SELECT id, raw, l, {QUOTE_SQL} AS c FROM s1),
s3 AS (SELECT id, raw, CASE WHEN c IS NULL THEN l ELSE l[1:c] END AS l, (c IS NOT NULL)::INT AS n FROM s2),
s4 AS (SELECT id, raw, n, l, {tail_sql(X.SIGNATURE_LINE, 40)} AS c FROM s3),
s5 AS (SELECT id, raw, n + (c IS NOT NULL)::INT AS n, CASE WHEN c IS NULL THEN l ELSE l[1:c] END AS l FROM s4),
s6 AS (SELECT id, raw, n, l, {tail_sql(X.DISCLAIMER_LINE, 80)} AS c FROM s5),
s7 AS (SELECT id, raw, n + (c IS NOT NULL)::INT AS n, array_to_string(CASE WHEN c IS NULL THEN l ELSE l[1:c] END, chr(10)) AS t FROM s6),
s8 AS (SELECT id, raw, n, regexp_extract_all(t, {URL}) AS urls, {norm_ws('t')} AS t FROM s7)"""


@query("f9_clean_email", "E", sql=CLEAN_SQL + f"""
SELECT id AS email_id, t AS cleaned_text, coalesce(list_filter(regexp_split_to_array(t, '\\n{{2,}}'), lambda p: {strip('p')} <> '')[1], substr(t, 1, 200)) AS extracted_query,
  cast(n AS BIGINT) AS removed_sections_count, cast(len(urls) AS BIGINT) AS urls_count, length(raw) AS original_length, length(t) AS cleaned_length,
  CASE WHEN length(raw) = 0 THEN 0.0 ELSE round((1 - length(t)::DOUBLE / length(raw)) * 100, 2) END AS reduction_percentage,
  length(t) > 0 AS pass_fail, CASE WHEN length({strip('t')}) > 10 THEN 'ready_for_chunking' ELSE 'check_email_content' END AS action_required
FROM s8""")
def _(v):
    out = cleaning.clean_email(v.E, "body", extract_urls=True)
    return out.select(
        "email_id", "cleaned_text", "extracted_query", F.col("removed_sections_count").cast("long").alias("removed_sections_count"),
        F.col("urls_count").cast("long").alias("urls_count"), F.col("original_length").cast("long").alias("original_length"),
        F.col("cleaned_length").cast("long").alias("cleaned_length"), "reduction_percentage", "pass_fail", "action_required",
    )


@query("f10_prepare_text", "DOCS", sql=f"""
SELECT doc_id, text, cast(length(text) AS BIGINT) AS final_length, cast(len({WORDS_SQL.replace('{0}', 'text')}) AS BIGINT) AS word_count,
  CASE WHEN n0 = 0 THEN 0.0 ELSE round((1 - length(text)::DOUBLE / n0) * 100, 2) END AS reduction_percentage,
  'normalize_whitespace,remove_pii' AS operations
FROM (SELECT doc_id, length(text) AS n0, {fill(PII_SQL, norm_ws('text'))} AS text FROM DOCS) x""")
def _(v):
    out = cleaning.prepare_text(v.DOCS, "text", source_type="document", remove_pii=True)
    return out.select(
        "doc_id", F.col("prepared_text").alias("text"), F.col("final_length").cast("long").alias("final_length"),
        "word_count", "reduction_percentage", F.array_join("operations", ",").alias("operations"),
    )


@query("f11_mask_pii", "DOCS", sql=f"SELECT doc_id, {fill(PII_SQL, 'text')} AS text FROM DOCS")
def _(v):
    return v.DOCS.select("doc_id", X.mask_pii(F.col("text")).alias("text"))


@query("f12_strip_urls", "E", sql=f"""
SELECT email_id, {sub("body || ' see www.example.org/a(b)'", r"https?://\S+|www\.\S+")} AS text FROM E""")
def _(v):
    return v.E.select("email_id", X.strip_urls(F.concat("body", F.lit(" see www.example.org/a(b)"))).alias("text"))


def pdf_sql(expr: str) -> str:
    ctes = [f"p0 AS (SELECT doc_id, {expr} AS t FROM PDF)"]
    s = "t"
    for old, new in ((r"\\n", "\n"), (r"\\t", " "), (r"\\r", ""), (r"\\" + '"', '"'), (r"\\'", "'"), (r"\\", "\\"),
                     (r"\n", "\n"), (r"\t", " "), (r"\r", "")):
        s = f"replace({s}, {q(old)}, {q(new)})"
    ctes.append(f"p1 AS (SELECT doc_id, {s} AS t FROM p0)")
    rules = ((r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), (r"([0-9A-Za-z_])-\n([0-9A-Za-z_])", r"\1\2"), (r"\r\n|\r", "\n"),
             (r"\n{3,}", "\n\n"), (r"[ \t]+", " "), (r"(?m)^[ \t]+|[ \t]+$", ""), (r"##(\w)", r"## \1"),
             (r"(?m)\.\.+$", "..."), (r"\s*\n\s*-\s*", "\n• "), (r"([.!?])\s*\n+([A-Z])", r"\1 \2"), (r"\[\s*\]", ""),
             (r"\(\s*\)", ""))
    ctes.append(f"p2 AS (SELECT doc_id, {chain('t', *rules)} AS t FROM p1)")
    ctes.append(f"p3 AS (SELECT doc_id, {chain(strip('t'), (chr(92) + 's+' + chr(92) + 'n', chr(10)), (chr(92) + 'n' + chr(92) + 's+', chr(10)))} AS t FROM p2)")
    return ", ".join(ctes) + f" SELECT doc_id, {strip('t')} AS text FROM p3"


@query("f13_sanitize_pdf", "PDF", sql=pdf_sql("text"))
def _(v):
    return v.PDF.select("doc_id", X.sanitize_pdf(F.col("text")).alias("text"))


@query("f14_truncate_chunk", "C", sql=f"SELECT doc_id, chunk_index, substr({strip(sub('text', chr(92) + 's+', ' '))}, 1, 300) AS text FROM C")
def _(v):
    return v.C.select("doc_id", "chunk_index", X.truncate_chunk(F.col("text"), 300).alias("text"))


@query("f15_est_tokens", "DOCS", sql="""
SELECT doc_id, cast(ceil(length(text) / 4.0) AS BIGINT) AS tokens, cast(ceil(length(text) / 3.5) AS BIGINT) AS tokens_35 FROM DOCS""")
def _(v):
    return v.DOCS.select(
        "doc_id", X.est_tokens(F.col("text")).alias("tokens"), X.est_tokens(F.col("text"), 3.5).alias("tokens_35")
    )


@query("f16_word_count", "DOCS", sql=f"""
SELECT doc_id, cast(len({WORDS_SQL.replace('{0}', 'text')}) AS BIGINT) AS words, length(text) AS chars FROM DOCS""")
def _(v):
    return v.DOCS.select("doc_id", X.word_count(F.col("text")).alias("words"), F.length("text").cast("long").alias("chars"))


ACCENT_SQL = "regexp_matches(lower(text), '[àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ]')"


@query("f17_language_flag", "DOCS", sql=f"SELECT doc_id, CASE WHEN {ACCENT_SQL} THEN 'non-english' ELSE 'english' END AS language FROM DOCS")
def _(v):
    return v.DOCS.select("doc_id", X.language_flag(F.col("text")).alias("language"))


SUMMARY_SQL = "substr(text, 1, 200) || CASE WHEN length(text) > 200 THEN '...' ELSE '' END"


@query("f18_summary", "DOCS", sql=f"SELECT doc_id, {SUMMARY_SQL} AS summary FROM DOCS")
def _(v):
    return v.DOCS.select("doc_id", X.summary(F.col("text")).alias("summary"))


TOPIC_SQL = f"""
w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9\\-]+')) AS word FROM DOCS),
n AS (SELECT doc_id, word, count(*) AS c FROM w WHERE length(word) >= 4 AND word NOT IN ({', '.join(q(x) for x in X.TOPIC_STOPWORDS)}) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, word) AS rk FROM n)"""


@query("t4_key_topics", "DOCS", sql=TOPIC_SQL + " SELECT doc_id, word, c AS n, rk AS rank FROM r WHERE rk <= 5")
def _(v):
    return cleaning.key_topics(v.DOCS, "doc_id", "text", 5).select("doc_id", "word", "n", F.col("rank").cast("long").alias("rank"))


@query("f19_document_metadata", "DOCS", sql=TOPIC_SQL + f""",
k AS (SELECT doc_id, string_agg(word, ',' ORDER BY rk) AS topics FROM r WHERE rk <= 5 GROUP BY doc_id)
SELECT d.doc_id, sha1(file_path || '|' || sha256(text)) AS document_id, sha256(text) AS file_hash,
  cast(len({WORDS_SQL.replace('{0}', 'text')}) AS BIGINT) AS word_count, length(text) AS character_count,
  cast(ceil(length(text) / 4.0) AS BIGINT) AS estimated_tokens, CASE WHEN {ACCENT_SQL} THEN 'non-english' ELSE 'english' END AS language,
  {SUMMARY_SQL} AS summary, coalesce(topics, '') AS key_topics
FROM DOCS d LEFT JOIN k ON d.doc_id = k.doc_id""")
def _(v):
    m = cleaning.document_metadata(v.DOCS, "doc_id", "text", "file_path")
    return m.withColumn("key_topics", F.array_join("key_topics", ","))


@query("f20_document_ids", "DOCS", sql="""
SELECT doc_id, sha256(trim(file_path) || '|' || trim(checksum)) AS document_id, sha1(file_path || '|' || sha256(text)) AS content_id,
  md5(text) AS md5, sha256(text) AS sha256 FROM DOCS""")
def _(v):
    return v.DOCS.select(
        "doc_id", ids.document_id(F.col("file_path"), F.col("checksum")).alias("document_id"),
        ids.content_document_id(F.col("file_path"), F.col("text")).alias("content_id"),
        F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"),
    )


@query("f25_tokens", "DOCS", sql=f"SELECT doc_id, array_to_string({fill(TOKENS_SQL, 'text')}, ' ') AS tokens FROM DOCS")
def _(v):
    return v.DOCS.select("doc_id", F.array_join(X.tokens(F.col("text")), " ").alias("tokens"))


PAIR_SQL = f"""
p AS (SELECT a.doc_id, {fill(TOKENS_SQL, 'a.text')} AS x, {fill(TOKENS_SQL, 'b.text')} AS y FROM CUR a JOIN PREV b ON a.doc_id = b.doc_id)"""


@query("f26_jaccard", "CUR PREV", sql=PAIR_SQL + """
SELECT doc_id, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE round(len(list_intersect(x, y))::DOUBLE / len(list_distinct(list_concat(x, y))), 6) END AS jaccard FROM p""")
def _(v):
    p = v.CUR.select("doc_id", X.tokens(F.col("text")).alias("x")).join(
        v.PREV.select("doc_id", X.tokens(F.col("text")).alias("y")), "doc_id"
    )
    return p.select("doc_id", F.round(X.jaccard(F.col("x"), F.col("y")), 6).alias("jaccard"))


@query("x3_token_overlap", "CUR PREV", sql=PAIR_SQL + """
SELECT doc_id, len(list_intersect(x, y)) AS shared, len(list_distinct(list_concat(x, y))) AS total FROM p""")
def _(v):
    p = v.CUR.select("doc_id", X.tokens(F.col("text")).alias("x")).join(
        v.PREV.select("doc_id", X.tokens(F.col("text")).alias("y")), "doc_id"
    )
    return p.select(
        "doc_id", F.size(F.array_intersect("x", "y")).cast("long").alias("shared"),
        F.size(F.array_union("x", "y")).cast("long").alias("total"),
    )


@query("f29_salience", "E", sql=f"""
f AS (SELECT email_id, regexp_replace('Subject: ' || subject || chr(10) || 'Hello,' || chr(10) || body, '(?i)^\\s*(subject:\\s*[^\\n]+\\n+)?\\s*(hi|hello|hey)[^a-z0-9]*\\n+', '') AS t FROM E),
g AS (SELECT email_id, t, string_split({sub('t', r'([.!?])' + chr(92) + 's+', chr(92) + '1' + chr(1))}, chr(1)) AS s FROM f)
SELECT email_id, substr({strip("coalesce(list_filter(s, lambda x: length(" + strip('x') + ") >= 12 AND NOT regexp_matches(x, '(?i)^(hi|hello|hey)" + chr(92) + "b'))[1], substr(t, 1, 500))")}, 1, 500) AS span FROM g""")
def _(v):
    t = F.concat(F.lit("Subject: "), "subject", F.lit("\nHello,\n"), "body")
    return v.E.select("email_id", X.salience(t, 500).alias("span"))


@query("f47_b64_to_hex", "DOCS", sql="SELECT doc_id, md5(text) AS hex FROM DOCS")
def _(v):
    return v.DOCS.select("doc_id", ids.b64_to_hex(F.base64(F.unhex(F.md5("text")))).alias("hex"))


@query("u4_count_tokens", "DOCS", sql="SELECT sum(cast(ceil(length(text) / 4.0) AS BIGINT))::BIGINT AS tokens, source FROM DOCS GROUP BY source")
def _(v):
    from mailsieve.functions.models import count_tokens

    return v.DOCS.groupBy("source").agg(F.sum(count_tokens(F.col("text"))).alias("tokens"))
