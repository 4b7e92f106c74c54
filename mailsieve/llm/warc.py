"""Not-modified revisits of web archives, resolved to the latest earlier full response of their page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer may change in the stored response.
PERMITTED = ("cache-control", "date", "etag", "expires", "last-modified", "server", "vary")
#: Captures of one page in so many seconds are ordered in one task.
BUCKET_SECONDS = 86_400

SCHEMA = (
    "record_id long, kind string, url string, captured long, status int, headers map<string,string>, payload string")


def canonical_url(url: Column) -> Column:
    """Scheme, fragment, user, leading www, default port and trailing slashes removed, host in lower case, query
    parameters sorted; null stays null."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    ordered = F.array_join(F.array_sort(F.array_remove(F.split(query, "&"), "")), "&")
    return F.concat(host, path, F.when(ordered != "", F.concat(F.lit("?"), ordered)).otherwise(F.lit("")))


def _validator(headers: Column, name: str) -> Column:
    return F.nullif(F.regexp_replace(F.trim(F.get(F.map_values(F.map_filter(
        headers, lambda k, v: F.lower(k) == name)), F.lit(0))), "^W/", ""), F.lit(""))


def _lower_keys(headers: Column) -> Column:
    """Headers with names in lower case; of names that fall together the greatest value stays."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    values = F.transform(names, lambda n: F.array_max(
        F.transform(F.filter(entries, lambda e: F.lower(e["key"]) == n), lambda e: e["value"])))
    return F.map_from_arrays(names, values)


def latest_full(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """For each revisit (record_id, captured, page) the id ``full_id`` of the latest earlier full response.

    Thin rows only.  Within a page and bucket a running maximum finds the response; across buckets each
    page's last response of every bucket is carried on, so a page captured all the time is split by time.
    """
    thin = records.select(
        "record_id", "captured", "page", F.col("kind").alias("kind"),
        F.floor(F.col("captured") / bucket_seconds).alias("bucket"),
        F.when(F.col("kind") == "response", F.struct("captured", "record_id")).alias("full"))
    ends = thin.where("full is not null").groupBy("page", "bucket").agg(F.max("full").alias("last"))
    marks = thin.where("kind = 'revisit'").select("page", "bucket").distinct().join(ends, ["page", "bucket"], "full")
    before = Window.partitionBy("page").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("page", "bucket", F.max("last").over(before).alias("carried"))
    own = Window.partitionBy("page", "bucket").orderBy("captured", "record_id").rowsBetween(
        Window.unboundedPreceding, -1)
    met = thin.withColumn("met", F.max("full").over(own)).where("kind = 'revisit'")
    joined = met.join(carried, ["page", "bucket"], "left")
    return joined.select(
        "record_id", "captured", "page", F.coalesce("met", "carried")["record_id"].alias("full_id"))


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``records`` (SCHEMA, more columns are ignored) -> one row for each revisit: (record_id, page, captured,
    outcome, full_id, headers, payload).

    A full response has kind ``response``, status 200 and a payload.  A revisit (kind ``revisit``) goes to the
    latest full response of its canonical URL before it (by time, then id).  If both have an etag these must
    be equal but for weakness, else if both have a last-modified date these must be; ``outcome`` is
    ``resolved``, ``mismatch`` (they differ), ``unvalidated`` (nothing to compare) or ``orphan`` (no response).
    Only resolved and unvalidated revisits get the payload, and the response's headers with the PERMITTED
    ones of the revisit put over them; names come out in lower case.

    Records without an id, time, URL or kind take no part; records that repeat an id are one.  Null headers
    are none.  No records give no rows.
    """
    page = canonical_url(F.col("url"))
    sound = records.select(
        F.col("record_id").cast("long").alias("record_id"), "kind", "status", F.col("captured").cast("long")
        .alias("captured"), page.alias("page"), "headers", "payload",
    ).where("record_id is not null and captured is not null and page is not null and kind is not null")
    full = sound.where("kind = 'response' and status = 200 and payload is not null")
    revisits = sound.where("kind = 'revisit'")
    names = ["record_id", "captured", "page", "kind"]
    found = latest_full(full.select(names).union(revisits.select(names)).dropDuplicates(["record_id"]), bucket_seconds)
    asked = revisits.select("record_id", F.col("headers").alias("new")).dropDuplicates(["record_id"])
    stored = full.select(F.col("record_id").alias("full_id"), F.col("headers").alias("old"), "payload")
    wanted = stored.join(found.select("full_id").distinct(), "full_id", "left_semi").dropDuplicates(["full_id"])
    rows = found.join(asked, "record_id").join(wanted, "full_id", "left")

    def same(name: str) -> Column:
        return _validator(F.col("old"), name) == _validator(F.col("new"), name)

    agrees = F.coalesce(same("etag"), same("last-modified"))
    outcome = (
        F.when(F.col("full_id").isNull(), "orphan").when(agrees.isNull(), "unvalidated").when(agrees, "resolved")
        .otherwise("mismatch"))
    over = F.map_filter(_lower_keys(F.col("new")), lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(_lower_keys(F.col("old")), lambda k, v: ~F.array_contains(F.map_keys(over), k))
    takes = F.col("outcome").isin("resolved", "unvalidated")
    return rows.withColumn("outcome", outcome).select(
        "record_id", "page", "captured", "outcome", "full_id",
        F.when(takes, F.map_concat(kept, over)).alias("headers"), F.when(takes, F.col("payload")).alias("payload"))


def page_records(pages: DataFrame) -> DataFrame:
    """Archive records of ``pages`` (page_id, url, html): each page's full response, and a later revisit of it.

    Times, and what validators the revisit brings (the same, weak, a date only, another one, or none), follow
    from the page's id; a page without an id, URL or text gives records that the resolver leaves out.
    """
    n = F.col("page_id")
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    day = F.concat(F.lit("day "), (n % 97).cast("string"))
    header = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    stored = header("Content-Type", F.lit("text/html"), "ETag", tag, "Last-Modified", day, "Date",
                    F.concat(F.lit("stored "), n.cast("string")))
    date = ("Date", F.concat(F.lit("checked "), n.cast("string")), "Content-Length", F.lit("0"))
    brings = (
        F.when(n % 5 == 0, header("etag", tag, *date)).when(n % 5 == 1, header("ETag", F.concat(F.lit("W/"), tag), *date))
        .when(n % 5 == 2, header("last-modified", day, *date)).when(n % 5 == 3, header("ETag", F.lit('"stale"'), *date))
        .otherwise(header(*date)))
    at = n * 60
    response = pages.select(
        (2 * n).alias("record_id"), F.lit("response").alias("kind"), "url", at.alias("captured"),
        F.lit(200).alias("status"), stored.alias("headers"), F.col("html").alias("payload"))
    revisit = pages.select(
        (2 * n + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url",
        (at + 30 + (n % 1009) * 977).alias("captured"), F.lit(304).alias("status"), brings.alias("headers"),
        F.lit(None).cast("string").alias("payload"))
    return response.union(revisit)


def revisit_digest(records: DataFrame) -> DataFrame:
    """Resolved revisits with digests for their headers and payload."""
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return resolve_revisits(records).select(
        "record_id", "page", "captured", "outcome", "full_id", F.array_join(lines, "\n").alias("headers"),
        F.sha2("payload", 256).alias("payload_sha256"))
