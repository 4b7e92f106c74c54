"""Files, inventories, access, JSON and payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mailsieve.catalog.sqlkit import q
from mailsieve.functions import jsonx as J
from mailsieve.functions import mime as H
from mailsieve.operators import contexts as C
from mailsieve.operators import inventory as I
from mailsieve.operators import lanes
from mailsieve.fixtures import spread
from mailsieve.registry import query
from mailsieve.schemas import MODEL_REPLY
from mailsieve.session import scratch_dir
from mailsieve.sources import files as S
from mailsieve.sources import sinks
from mailsieve.sources.json_csv import first_seen, flatten_rows, json_to_csv


def inventory(v):
    return v.FILES.select(F.col("page_id").alias("id"), "path", "mime", F.col("modified_s").alias("modified"), "size", "parent_id")


@query("s1_list_files", "FILES", sql="""
SELECT page_id AS id, path, modified_s AS modified FROM FILES WHERE modified_s >= 36000 AND mime IN ('text/html', 'application/pdf') AND mime <> 'application/vnd.google-apps.folder'""")
def _(v):
    return S.list_files(inventory(v), modified_after=36000, mime_types="text/html, application/pdf", exclude_folders=True).select("id", "path", "modified")


@query("s2_list_objects", "FILES", sql="""
u AS (SELECT path, substr(path, 3) AS rest FROM FILES WHERE starts_with(path, 'th'))
SELECT 'object' AS kind, path FROM u WHERE NOT contains(rest, '/') UNION ALL SELECT DISTINCT 'prefix', 'th' || string_split(rest, '/')[1] || '/' FROM u WHERE contains(rest, '/')""")
def _(v):
    objects, prefixes = S.list_objects(v.FILES, "th", "/")
    return objects.select(F.lit("object").alias("kind"), "path").unionByName(prefixes.select(F.lit("prefix").alias("kind"), F.col("prefix").alias("path")))


@query("s4_read_content", "DOCS", sql="""
x AS (SELECT doc_id, text, mime IN ('text/plain', 'text/csv') AS ok, encode(text) AS b FROM DOCS)
SELECT doc_id, CASE WHEN ok THEN 200 ELSE 415 END AS status, false AS content_truncated, CASE WHEN ok THEN md5(b) END AS checksum_md5, CASE WHEN ok THEN sha256(b) END AS checksum_sha256,
  CASE WHEN ok THEN octet_length(b) END AS fetched_bytes, CASE WHEN ok THEN text END AS whole_text FROM x""")
def _(v):
    d = S.read_content(v.DOCS.withColumn("bytes", F.encode("text", "UTF-8")))
    return d.select("doc_id", "status", "content_truncated", "checksum_md5", "checksum_sha256", F.col("fetched_bytes").cast("long").alias("fetched_bytes"),
                    F.col("text_content").alias("whole_text"))


@query("s5_write_objects", "DOCS", sql="SELECT file_path AS name, strlen(text) AS bytes_uploaded FROM DOCS")
def _(v):
    rows = sinks.object_rows(v.DOCS, "file_path", "text", F.create_map(F.lit("doc_id"), F.col("doc_id")))
    out = sinks.write_objects(rows, f"{scratch_dir(v.spark)}/objects-{uuid.uuid4().hex}")
    return out.withColumn("bytes_uploaded", F.col("bytes_uploaded").cast("long"))


TRANSFER = """
x AS (SELECT page_id AS pos, 'out/' || coalesce(CASE WHEN page_id % 4 = 0 THEN 'copy-' || page_id END, path) AS nm, mime,
  CASE WHEN mime LIKE 'application/vnd.google-apps.%' AND is_folder THEN 'SKIPPED' WHEN fails THEN 'TRANSFER_FAILED' END AS error_code FROM FILES),
y AS (SELECT pos, error_code, nm || CASE WHEN contains(substr(nm, 5), '.') THEN '' ELSE CASE mime WHEN 'application/pdf' THEN '.pdf' WHEN 'image/png' THEN '.png' ELSE '' END END AS object_name,
  CASE WHEN error_code IS NULL THEN 'uploaded' ELSE 'failed' END AS lane FROM x)"""


def transfer_input(v):
    f = v.FILES
    items = f.select(
        F.col("page_id").alias("pos"), F.col("page_id").alias("file_id"),
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("copy-"), F.col("page_id").cast("string"))).alias("target_name"),
        F.when(F.col("is_folder"), "skip").alias("editors_mode"),
    )
    return items, f.select(F.col("page_id").alias("file_id"), F.col("path").alias("name"), "mime", "fails")


@query("s6_transfer", "FILES", sql=TRANSFER + " SELECT pos, object_name, lane, error_code FROM y")
def _(v):
    return S.transfer(*transfer_input(v), prefix="out").lanes.select("pos", "object_name", "lane", "error_code")


@query("s6_transfer_summary", "FILES", sql=TRANSFER + """
SELECT false AS stopped, count(*) AS total, count(*) FILTER (lane = 'uploaded') AS success, count(*) FILTER (lane = 'failed') AS failed, CASE WHEN count(*) FILTER (lane = 'failed') > 0 THEN 207 ELSE 200 END AS status FROM y
UNION ALL SELECT true, count(*), count(*) FILTER (lane = 'uploaded'), count(*) FILTER (lane = 'failed'), 207 FROM y WHERE pos <= (SELECT min(pos) FROM y WHERE lane = 'failed')""")
def _(v):
    items, files = transfer_input(v)
    a = S.transfer(items, files, prefix="out").summary.withColumn("stopped", F.lit(False))
    return a.unionByName(S.transfer(items, files, prefix="out", stop_on_error=True).summary.withColumn("stopped", F.lit(True)))


NESTED = "'{\"n\": ' || event_id || ', \"user\": {\"id\": ' || user_id || ', \"tags\": [\"a,b\", \"' || event_type || '\"]}, \"e\": {}, \"p\": ' || props || CASE WHEN event_type = 'error' THEN ', \"err\": true' ELSE '' END || '}'"


def nested(v):
    s = [F.col(c).cast("string") for c in ("event_id", "user_id")]
    return spread(v.t("events")).select(
        "event_id", "event_type",
        F.concat(F.lit('{"n": '), s[0], F.lit(', "user": {"id": '), s[1], F.lit(', "tags": ["a,b", "'), "event_type", F.lit('"]}, "e": {}, "p": '),
                 "props", F.when(F.col("event_type") == "error", ', "err": true').otherwise(""), F.lit("}")).alias("json"),
    )


K = "regexp_extract(props, '([0-9]+)', 1)"


@query("s8_json_to_csv", sql=f"""
SELECT event_id, event_id || ',' || user_id || ',"a,b",' || event_type || ',,' || {K} || ',' || CASE WHEN event_type = 'error' THEN 'true' ELSE '' END AS line FROM events""")
def _(v):
    return json_to_csv(nested(v), "event_id", "json").lines.select(F.col("key").alias("event_id"), "line")


@query("w10_first_seen", sql="""
WITH e AS (SELECT min(event_id) AS f FROM events WHERE event_type = 'error'), a AS (SELECT min(event_id) AS f FROM events)
SELECT path, (SELECT f FROM a) AS first_row FROM (VALUES ('n'), ('user.id'), ('user.tags[0]'), ('user.tags[1]'), ('e'), ('p.k')) x(path) UNION ALL SELECT 'err', f FROM e""")
def _(v):
    d = first_seen(flatten_rows(nested(v), "event_id", "json"))
    return d.select("path", F.col("first.key").alias("first_row"))


@query("f37_json_compact", sql=f"""
SELECT event_id, '{{"k":' || {K} || ',"e":false,"f":0,"l":[1]}}' AS compact FROM events""")
def _(v):
    k = F.regexp_extract("props", r"([0-9]+)", 1)
    t = F.concat(F.lit('{"k": '), k, F.lit(', "a": "", "b": [], "c": {"d": null}, "e": false, "f": 0, "l": ["", 1]}'))
    return v.t("events").select("event_id", J.json_compact(t).alias("compact"))


@query("f41_dig", sql=f"SELECT event_id, {K} AS k, event_type AS tag FROM events")
def _(v):
    d = nested(v)
    return d.select("event_id", J.dig(F.col("json"), "p.k").alias("k"), J.dig(F.col("json"), "user.tags[1]").alias("tag"))


@query("f40_coerce", sql="""
SELECT event_id, CAST(trunc(value) AS BIGINT) AS i, value AS f, event_type = 'view' AS b, CAST(ts::DATE AS VARCHAR) AS d, NULL::BIGINT AS bad FROM events""")
def _(v):
    e = v.t("events")
    flag = F.when(F.col("event_type") == "view", " Yes").otherwise("no")
    return e.select(
        "event_id", J.coerce(F.concat(F.lit(" "), F.col("value").cast("string")), "integer").alias("i"), J.coerce(F.col("value"), "float").alias("f"),
        J.coerce(flag, "boolean").alias("b"), J.coerce(F.col("ts").cast("string"), "date").alias("d"), J.coerce(F.col("event_type"), "integer").alias("bad"),
    )


@query("f44_csv_field", "DOCS", sql="""
SELECT doc_id, CASE WHEN regexp_matches(text, '[,"\n\r]') THEN '"' || replace(text, '"', '""') || '"' ELSE text END AS field FROM DOCS""")
def _(v):
    return v.DOCS.select("doc_id", H.csv_field(F.col("text")).alias("field"))


@query("f45_extract_resource_id", "FILES", sql="""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'file_' || page_id WHEN 1 THEN 'fold-' || page_id WHEN 2 THEN 'q' || page_id ELSE 'plain' || page_id END AS id FROM FILES""")
def _(v):
    p, k = F.col("page_id").cast("string"), F.col("page_id") % 4
    link = (
        F.when(k == 0, F.concat(F.lit("https://x.example/d/file_"), p, F.lit("/edit"))).when(k == 1, F.concat(F.lit("https://x.example/folders/fold-"), p))
        .when(k == 2, F.concat(F.lit("https://x.example/open?a=1&id=q"), p)).otherwise(F.concat(F.lit("  plain"), p))
    )
    return v.FILES.select("page_id", H.extract_resource_id(link).alias("id"))


@query("f46_value_helpers", "FILES", sql="""
SELECT page_id, mime || ',x' AS list, path || CASE WHEN path LIKE '%/' THEN '' ELSE '/' END AS prefix, strftime(make_timestamp((modified_s * 1000000)::BIGINT), '%Y-%m-%dT%H:%M:%SZ') AS iso,
  CASE WHEN is_folder THEN NULL ELSE size END AS size, least(greatest(page_id, 5), 50) AS clamped FROM FILES""")
def _(v):
    raw = F.concat(F.lit(" "), "mime", F.lit(" , ,x,"), "mime")
    size = F.when(F.col("is_folder"), "").otherwise(F.col("size").cast("string"))
    return v.FILES.select(
        "page_id", F.array_join(lanes.to_list(raw), ",").alias("list"), H.norm_prefix(F.col("path")).alias("prefix"),
        H.to_iso_utc(F.timestamp_seconds("modified_s")).alias("iso"), H.to_int(size).alias("size"), H.clamp(F.col("page_id"), 5, 50).alias("clamped"),
    )


@query("x4_clean_ids", "FILES", sql="""
SELECT page_id, 'page-' || lpad(CAST(page_id AS VARCHAR), 4, '0') || CASE WHEN is_folder THEN ',short' ELSE '' END AS ids, NOT is_folder AS valid FROM FILES""")
def _(v):
    one = F.concat(F.lit("page-"), F.lpad(F.col("page_id").cast("string"), 4, "0"))
    raw = F.array(one, F.lit(" "), F.concat(one, F.lit(" ")), F.when(F.col("is_folder"), "short").otherwise(""))
    return v.FILES.select("page_id", F.array_join(lanes.clean_ids(raw), ",").alias("ids"), lanes.ids_valid(raw).alias("valid"))


@query("p19_is_pdf_source", "FILES", sql="""
SELECT page_id, (mime = 'application/pdf' OR page_id % 5 = 0 OR page_id % 7 = 0) AS is_pdf FROM FILES""")
def _(v):
    uri = F.when(F.col("page_id") % 5 == 0, F.concat("path", F.lit(".PDF?x=1"))).otherwise(F.col("path"))
    base = F.create_map(F.lit("mimeType"), F.col("mime"))
    meta = F.when(F.col("page_id") % 7 == 0, F.map_concat(base, F.create_map(F.lit("parser"), F.lit("OCR v2")))).otherwise(base)
    return v.FILES.select("page_id", C.is_pdf_source(uri, meta).alias("is_pdf"))


@query("p20_mime_maps", "FILES", sql="""
SELECT page_id, mime IN ('text/html', 'text/plain; charset=utf-8', 'application/json') AS textual, mime LIKE 'application/vnd.google-apps.%' AS editor,
  CASE WHEN mime LIKE 'application/vnd.google-apps.%' THEN CASE WHEN page_id % 2 = 0 THEN 'application/pdf' ELSE 'text/plain' END ELSE CASE WHEN page_id % 2 = 0 THEN 'application/pdf' ELSE 'image/gif' END END AS export,
  CASE mime WHEN 'application/pdf' THEN '.pdf' WHEN 'image/png' THEN '.png' END AS ext FROM FILES""")
def _(v):
    m, pref = F.col("mime"), F.when(F.col("page_id") % 2 == 0, "application/pdf").otherwise("image/gif")
    return v.FILES.select(
        "page_id", H.is_textual_mime(m).alias("textual"), H.is_editor_mime(m).alias("editor"), H.export_mime(m, pref).alias("export"), H.ext_for_mime(m).alias("ext")
    )


# --- model replies ----------------------------------------------------------------------------

SPEC = {
    "category": {"type": "string", "enum": ["cat_0", "cat_1", "cat_2", "cat_3", "cat_4"]},
    "confidence": {"type": "number", "minimum": 0.0, "maximum": 1.0}, "reasons": {"type": "array", "max_items": 3}, "note": {"type": "string"},
}


def wrapped_replies(v):
    """Replies, some inside one or two wrapper objects, some with a lone value where a list is declared."""
    text, n = F.col("json_text"), F.col("doc_id")
    return v.RESP.withColumn("json_text", (
        F.when(n % 12 == 0, F.concat(F.lit('{"data":{"result":'), text, F.lit('},"status":"ok"}')))
        .when(n % 12 == 3, F.concat(F.lit('{"items":'), text, F.lit("}")))
        .when(n % 6 == 1, F.replace(text, F.lit('["x"]'), F.lit('"x"'))).otherwise(text)))


@query("f38_parse_model_json", "RESP", sql="""
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'cat_' || doc_id % 5 WHEN 1 THEN 'cat_1' WHEN 2 THEN 'cat_2' WHEN 3 THEN 'bogus' END AS category,
  CASE doc_id % 6 WHEN 0 THEN (doc_id % 9 + 1) / 10.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 WHEN 3 THEN 1.7 END::DOUBLE AS confidence,
  CASE doc_id % 6 WHEN 4 THEN 'no_known_field' WHEN 5 THEN 'invalid_json' END AS error FROM RESP""")
def _(v):
    d = wrapped_replies(v).withColumn("r", J.parse_model_json(F.col("json_text"), MODEL_REPLY))
    return d.select("doc_id", "r.value.category", "r.value.confidence", "r.error")


@query("p22_repair", "RESP", sql="""
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'cat_' || doc_id % 5 WHEN 1 THEN 'cat_1' WHEN 2 THEN 'cat_2' ELSE 'cat_0' END AS category,
  CASE doc_id % 6 WHEN 0 THEN (doc_id % 9 + 1) / 10.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 WHEN 3 THEN 1.0 ELSE 0.0 END::DOUBLE AS confidence,
  CASE doc_id % 6 WHEN 0 THEN 'a,b' WHEN 1 THEN 'x' WHEN 3 THEN 'a,b,c' ELSE '' END AS reasons, doc_id % 6 >= 4 AS is_fallback,
  CASE doc_id % 6 WHEN 3 THEN 'Invalid enum value for category, using default' WHEN 4 THEN 'Missing required field: category; Missing required field: confidence; Missing required field: reasons; Missing required field: note'
    WHEN 5 THEN 'Missing required field: category; Missing required field: confidence; Missing required field: reasons; Missing required field: note' ELSE '' END AS errors FROM RESP""")
def _(v):
    d = wrapped_replies(v).withColumn("value", J.parse_model_json(F.col("json_text"), MODEL_REPLY)["value"])
    d = d.withColumn("r", J.repair(F.col("value"), SPEC)).withColumn("e", J.repair_errors(F.col("value"), SPEC))
    return d.select("doc_id", "r.category", "r.confidence", F.array_join("r.reasons", ",").alias("reasons"), "r.is_fallback", F.array_join("e", "; ").alias("errors"))


@query("f39_redact_json", "RESP", sql="""
SELECT doc_id, CASE WHEN doc_id % 6 IN (0, 3, 4) AND doc_id % 7 = 0 THEN '[REDACTED]' END AS api_key, CASE WHEN doc_id % 6 IN (0, 3) THEN 'd' || doc_id END AS note,
  contains(json_text, 's3cr3t') AND doc_id % 6 IN (1, 2) AS leaks FROM RESP""")
def _(v):
    d = v.RESP.withColumn("r", J.redact_json(F.col("json_text")))
    return d.select("doc_id", F.get_json_object("r", "$.api_key").alias("api_key"), F.get_json_object("r", "$.note").alias("note"), F.col("r").contains("s3cr3t").alias("leaks")).withColumn(
        "api_key", F.when((F.col("doc_id") % 6).isin(0, 3, 4), F.col("api_key"))).withColumn("note", F.when((F.col("doc_id") % 6).isin(0, 3), F.col("note")))


@query("s13_parse_contexts", "RESP", sql="""
SELECT doc_id, 0 AS pos, 'c1' AS id, 'one ' || doc_id AS text, 0.9::DOUBLE AS score, NULL::VARCHAR AS uri FROM RESP WHERE doc_id % 6 = 4
UNION ALL SELECT doc_id, 1, 'ctx-2', 'two', 0.8, 'gs://b/x.pdf' FROM RESP WHERE doc_id % 6 = 4""")
def _(v):
    return J.parse_contexts(v.RESP, "json_text", "doc_id").select("doc_id", "pos", "id", "text", "score", "uri")


ERR = "'{\"error\":{\"code\":' || (400 + doc_id % 5) || ',\"message\":\"bad\",\"details\":[{\"@type\":\"type.googleapis.com/google.rpc.BadRequest\",\"fieldViolations\":[{\"field\":\"f' || doc_id || '\",\"description\":\"wrong\"}]}]}}'"


@query("f54_extract_error", "RESP", sql="""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 400 + doc_id % 5 WHEN doc_id % 3 = 1 THEN 503 END AS code, CASE WHEN doc_id % 3 = 0 THEN 'bad' END AS message,
  CASE WHEN doc_id % 3 = 0 THEN 'f' || doc_id || ': wrong' ELSE '' END AS violations FROM RESP""")
def _(v):
    i = F.col("doc_id")
    body = F.concat(
        F.lit('{"error":{"code":'), (400 + i % 5).cast("string"),
        F.lit(',"message":"bad","details":[{"@type":"type.googleapis.com/google.rpc.BadRequest","fieldViolations":[{"field":"f'),
        i.cast("string"), F.lit('","description":"wrong"}]}]}}'),
    )
    text = F.when(i % 3 == 0, body).when(i % 3 == 1, "upstream said 503 Service Unavailable").otherwise("no code here 12345")
    d = v.RESP.withColumn("e", J.extract_error(text))
    return d.select("doc_id", "e.code", "e.message", F.array_join("e.violations", ",").alias("violations"))


CAT_FILE = {
    "array": '[{"name": "PTO", "description": "Leave", "examples": ["a", "b"]}, "Payroll", {"name": " "}, {"name": "Benefits"}]',
    "items": '{"items": [{"name": "PTO", "description": "Leave", "examples": ["a", "b"]}, "Payroll", {"name": ""}, {"name": "Benefits"}]}',
}


@query("s11_load_categories", "PRED", sql="""
c AS (SELECT * FROM (VALUES ('PTO', 'Leave', 2), ('Payroll', NULL, 0), ('Benefits', NULL, 0)) x(name, description, n_examples)),
p AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'PTO' WHEN 1 THEN 'Payroll' WHEN 2 THEN 'Benefits' ELSE 'None' END AS pick FROM PRED)
SELECT c.name, c.description, c.n_examples, count(*) * 2 AS picks FROM p JOIN c ON p.pick = c.name GROUP BY ALL""")
def _(v):
    from mailsieve.sources.tables import load_categories

    k = F.col("doc_id") % 4
    picks = v.PRED.select(F.when(k == 0, "PTO").when(k == 1, "Payroll").when(k == 2, "Benefits").otherwise("None").alias("name"))
    found = []
    for text in CAT_FILE.values():
        path = f"{scratch_dir(v.spark)}/categories-{uuid.uuid4().hex}"
        v.spark.createDataFrame([(text,)], "value string").write.text(path)
        found.append(load_categories(v.spark, path))
    cats = found[0].unionByName(found[1]).withColumn("n_examples", F.size("examples"))
    return picks.join(cats, "name").groupBy("name", "description", "n_examples").agg(F.count("*").alias("picks"))


# --- inventory and access ---------------------------------------------------------------------


def workspace(v):
    projects = v.t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), (F.col("r_regionkey") * 5).alias("folder_id"))
    n = v.t("nation")
    folders = n.select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") == 7, 99).when(F.col("n_nationkey") > 4, F.floor(F.col("n_nationkey") / 5)).cast("long").alias("parent_id"),
        (F.col("n_regionkey") + F.when(F.col("n_nationkey") == 3, 50).otherwise(0)).alias("project_id"), (F.col("n_nationkey") % 5 == 0).alias("is_project"),
    )
    recipes = v.t("supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), (F.col("s_acctbal") > 0).alias("running"),
        F.col("s_nationkey").alias("folder_id"), (F.col("s_nationkey") % 6).alias("project_id"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal").cast("string")).alias("last_run"),
    )
    return projects, folders, recipes


WORK = """
p AS (SELECT r_regionkey AS id, r_name AS name, r_regionkey * 5 AS folder_id FROM region),
f AS (SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_nationkey = 7 THEN 99 WHEN n_nationkey > 4 THEN n_nationkey // 5 END AS parent_id,
  n_regionkey + CASE WHEN n_nationkey = 3 THEN 50 ELSE 0 END AS project_id, n_nationkey % 5 = 0 AS is_project FROM nation),
r AS (SELECT s_suppkey AS id, s_name AS name, s_acctbal > 0 AS running, s_nationkey AS folder_id, s_nationkey % 6 AS project_id, CASE WHEN s_acctbal > 0 THEN CAST(s_acctbal AS VARCHAR) END AS last_run FROM supplier)"""
FOLDERS = """SELECT f.id, f.name, CASE WHEN f.parent_id IS NULL THEN 'TOP LEVEL' ELSE coalesce(g.name, '[ID: ' || f.parent_id || '] (not found)') END AS parent_folder,
  coalesce(p.name, '[ID: ' || f.project_id || ']') AS project_name FROM f LEFT JOIN f g ON f.parent_id = g.id LEFT JOIN p ON f.project_id = p.id"""
RECIPES = """SELECT r.id, r.name, CASE WHEN running THEN 'ACTIVE' ELSE 'STOPPED' END AS status, coalesce(p.name, CAST(r.project_id AS VARCHAR)) AS project,
  coalesce(f.name, CAST(r.folder_id AS VARCHAR)) AS folder, coalesce(last_run, 'NEVER') AS last_run FROM r LEFT JOIN p ON r.project_id = p.id LEFT JOIN f ON r.folder_id = f.id"""


@query("j5_named_folders", sql="WITH " + WORK + " " + FOLDERS)
def _(v):
    projects, folders, _r = workspace(v)
    return I.named_folders(folders, projects)


@query("j5_named_recipes", sql="WITH " + WORK + " " + RECIPES)
def _(v):
    projects, folders, recipes = workspace(v)
    return I.named_recipes(recipes, folders, projects)


@query("j6_resolve_project", sql="WITH " + WORK + """
SELECT r.id AS recipe_id, r.folder_id, f.name AS folder_name, f.is_project AS is_project_folder, CASE WHEN f.is_project THEN o.id ELSE f.project_id END AS project_id,
  CASE WHEN f.is_project THEN o.name ELSE p.name END AS project_name, CASE WHEN f.is_project THEN r.folder_id ELSE p.folder_id END AS project_folder_id
FROM r LEFT JOIN f ON r.folder_id = f.id LEFT JOIN p o ON o.folder_id = f.id LEFT JOIN p ON p.id = f.project_id""")
def _(v):
    projects, folders, recipes = workspace(v)
    return I.resolve_project(recipes, folders, projects).drop("error")


@query("s14_sync_inventory", sql="WITH " + WORK + f" SELECT 'folders' AS sheet, id, name, parent_folder AS detail FROM ({FOLDERS}) x UNION ALL SELECT 'recipes', id, name, last_run FROM ({RECIPES}) y")
def _(v):
    out = f"{scratch_dir(v.spark)}/inventory-{uuid.uuid4().hex}"
    I.sync_inventory(*workspace(v), out)
    f = v.spark.read.parquet(out + "/folders").select(F.lit("folders").alias("sheet"), "id", "name", F.col("parent_folder").alias("detail"))
    return f.unionByName(v.spark.read.parquet(out + "/recipes").select(F.lit("recipes").alias("sheet"), "id", "name", F.col("last_run").alias("detail")))


@query("j7_key_usage", "K ACT", sql="""
SELECT key_id, account, coalesce(CAST(last_used::DATE AS VARCHAR), 'no_recent_usage') AS last_used FROM K LEFT JOIN ACT ON CAST(key_id AS VARCHAR) = string_split(resource, '/keys/')[2]""")
def _(v):
    return I.key_usage(v.K, v.ACT.withColumn("last_used", F.col("last_used").cast("date")))


@query("j8_access_matrix", "K", sql="""
a AS (SELECT account, key_id % 5 IN (0, 2) AS can_read, key_id % 3 = 1 AS can_write FROM K)
SELECT account, can_read, can_write, concat_ws('; ', CASE WHEN NOT can_read THEN 'no input access' END, CASE WHEN NOT can_write THEN 'no output access' END) AS notes, can_read AND can_write AS candidate FROM a""")
def _(v):
    k = v.K
    one = F.array("account")
    i = k.select(F.concat(F.lit("role"), (F.col("key_id") % 5).cast("string")).alias("role"), one.alias("members"))
    o = k.select(F.concat(F.lit("role"), (F.col("key_id") % 3).cast("string")).alias("role"), one.alias("members"))
    return I.access_matrix(k.select("account"), i, o, ["role0", "role2"], ["role1"])


PAY = "'{\"kind\":\"key\",\"account\":\"' || account || '\",\"id\":\"' || key_id || '\",\"field_1_x\":\"' || s_nationkey || '\"}'"


def payload(v):
    none = F.lit(None).cast("string")
    static = F.create_map(F.lit("kind"), F.lit("static"), F.lit("blank"), F.lit(" "))
    mapped = F.create_map(F.lit("kind"), F.lit("key"), F.lit("account"), F.col("account"))
    prefill = F.create_map(F.lit("id"), F.col("key_id").cast("string"), F.lit("gone"), none)
    entries = F.array(F.create_map(F.lit("x"), F.col("s_nationkey").cast("string")))
    return v.K.withColumn("m", H.layered_payload(static, mapped, prefill, entries, "field_{{i}}_{{field}}", 1))


@query("f42_layered_payload", "K", sql=f"SELECT key_id, {PAY} AS payload, 'missing_one' AS missing FROM K")
def _(v):
    d = payload(v)
    return d.select("key_id", F.to_json("m").alias("payload"), F.array_join(H.require(F.col("m"), ["account", "missing_one"]), ",").alias("missing"))


@query("f43_build_url", "K", sql=f"""
SELECT key_id, 'https://f.example/x?a=1&pre%20fill=' || url_encode({PAY}) AS url, 'https://f.example/x?pre%20fill=' || base64(encode({PAY})) AS url64,
  'https://f.example/x?pre%20fill=' || rtrim(translate(base64(encode({PAY})), '+/', '-_'), '=') AS url64u FROM K""")
def _(v):
    p = F.to_json("m")
    return payload(v).select(
        "key_id", H.build_url(F.lit("https://f.example/x?a=1"), "pre fill", p).alias("url"),
        H.build_url(F.lit("https://f.example/x"), "pre fill", p, "base64").alias("url64"),
        H.build_url(F.lit("https://f.example/x"), "pre fill", p, "base64url").alias("url64u"),
    )
