"""File and object inventories: listing, content, transfer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve.functions.mime import ext_for_mime, is_editor_mime, is_textual_mime, norm_prefix
from mailsieve.functions.text import strip_urls

FOLDER_MIME = "application/vnd.google-apps.folder"


def scan_files(spark: SparkSession, path: str, glob: str = "*", after: str | None = None, before: str | None = None) -> DataFrame:
    """Files below a folder with size, time and content; name and time filters prune before reading."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if after:
        r = r.option("modifiedAfter", after)
    if before:
        r = r.option("modifiedBefore", before)
    return r.load(path)


def list_files(
    files: DataFrame, modified_after=None, modified_before=None, mime_types: Sequence[str] | str = (),
    exclude_folders: bool = False, parent=None, limit: int | None = None, after: tuple | None = None,
) -> DataFrame:
    """Files (columns ``id``, ``mime``, ``modified``, ``parent_id``); bounds are inclusive.

    With a ``limit`` a page comes out, newest first, ties by id; ``after`` is (modified, id) of the last row of
    the page before.
    """
    types = mime_types.split(",") if isinstance(mime_types, str) else list(mime_types)
    types = [t.strip() for t in types if t.strip()]
    d = files
    if modified_after is not None:
        d = d.where(F.col("modified") >= modified_after)
    if modified_before is not None:
        d = d.where(F.col("modified") <= modified_before)
    if types:
        d = d.where(F.col("mime").isin(types))
    if exclude_folders:
        d = d.where(F.col("mime") != FOLDER_MIME)
    if parent is not None:
        d = d.where(F.col("parent_id") == parent)
    if after is not None:
        at, last = after
        d = d.where((F.col("modified") < at) | ((F.col("modified") == at) & (F.col("id") > last)))
    return d if limit is None else d.orderBy(F.desc("modified"), "id").limit(limit)


def list_objects(objects: DataFrame, prefix: str = "", delimiter: str = "") -> tuple[DataFrame, DataFrame]:
    """Objects right below the prefix, and the distinct common prefixes of the deeper ones."""
    under = objects.where(F.col("path").startswith(prefix))
    if not delimiter:
        return under, under.select(F.lit("").alias("prefix")).limit(0)
    rest = F.substring(F.col("path"), len(prefix) + 1, 2**31 - 1)
    deep = rest.contains(delimiter)
    folder = F.concat(F.lit(prefix), F.substring_index(rest, delimiter, 1), F.lit(delimiter))
    return under.where(~deep), under.where(deep).select(folder.alias("prefix")).distinct()


def read_content(
    df: DataFrame, raw: str = "bytes", mime: str = "mime", mode: str = "text", max_bytes: int | None = None, no_urls: bool = False,
) -> DataFrame:
    """Content by mode (none, text, bytes) with digests of the fetched bytes.

    Text is read from textual types only; other types get status 415 and no content.  Broken UTF-8 is
    replaced and a byte order mark dropped.  ``max_bytes`` fetches a prefix and flags what was cut.
    """
    size = F.lit(2**31 - 1 if max_bytes is None else max_bytes)
    fetched = F.when(F.octet_length(raw) > size, F.substring(F.col(raw), F.lit(1), size)).otherwise(F.col(raw))
    d = df.withColumn("__b", fetched if mode != "none" else F.lit(None).cast("binary"))
    textual = is_textual_mime(F.col(mime))
    status = F.when(~textual, 415).otherwise(200) if mode == "text" else F.lit(200)
    text = F.regexp_replace(F.make_valid_utf8(F.col("__b").cast("string")), "^﻿", "")
    if no_urls:
        text = strip_urls(text)
    ok = status == 200
    return (
        d.withColumn("status", status)
        .withColumn("text_content", F.when(ok & F.lit(mode == "text"), text))
        .withColumn("content_bytes", F.when(ok & F.lit(mode == "bytes"), F.base64("__b")))
        .withColumn("content_truncated", ok & F.lit(mode != "none") & (F.octet_length(raw) > size))
        .withColumn("fetched_bytes", F.when(ok, F.octet_length("__b")))
        .withColumn("checksum_md5", F.when(ok, F.md5("__b")))
        .withColumn("checksum_sha256", F.when(ok, F.sha2("__b", 256)))
        .drop("__b")
    )


@dataclass(frozen=True)
class Transfer:
    lanes: DataFrame
    summary: DataFrame


def transfer(
    items: DataFrame, files: DataFrame, prefix: str = "", editors_mode: str = "text", content_type: str | None = None,
    stop_on_error: bool = False,
) -> Transfer:
    """Copy plan with partial success.

    ``items``: pos, file_id and optional per-item target_name, editors_mode, content_type; ``files``:
    file_id, name, mime, fails.  Each item ends in the uploaded or failed lane; with ``stop_on_error``
    nothing after the first failure is attempted.
    """
    def over(name: str, default) -> Column:
        own = F.col(name) if name in items.columns else F.lit(None).cast("string")
        return F.coalesce(F.when(own != "", own), F.lit(default))

    base = F.lit("") if not prefix else norm_prefix(F.lit(prefix))
    own_name = F.col("target_name") if "target_name" in items.columns else F.lit(None).cast("string")
    i = items.select(
        "pos", "file_id", F.when(own_name != "", own_name).alias("__target"), over("editors_mode", editors_mode).alias("__mode"),
        over("content_type", content_type).alias("__ctype"),
    )
    d = i.join(files.select("file_id", "name", "mime", "fails"), "file_id", "left")
    name = F.coalesce("__target", "name")
    ext = F.when(name.contains("."), "").otherwise(F.coalesce(ext_for_mime(F.col("mime")), F.lit("")))
    skipped = is_editor_mime(F.col("mime")) & (F.col("__mode") == "skip")
    code = (
        F.when(F.col("name").isNull(), "NOT_FOUND").when(skipped, "SKIPPED").when(F.col("fails"), "TRANSFER_FAILED")
    )
    d = d.select(
        "pos", "file_id", F.concat(base, name, ext).alias("object_name"), code.alias("error_code"),
        F.coalesce("__ctype", "mime").alias("content_type"), F.when(code.isNull(), "uploaded").otherwise("failed").alias("lane"),
    )
    if stop_on_error:
        first = d.where(F.col("lane") == "failed").agg(F.min("pos")).scalar()
        d = d.where(F.col("pos") <= F.coalesce(first, F.lit(2**62)))
    bad = F.count_if(F.col("lane") == "failed")
    summary = d.agg(
        F.count("*").alias("total"), F.count_if(F.col("lane") == "uploaded").alias("success"), bad.alias("failed"),
        F.when(bad > 0, 207).otherwise(200).alias("status"),
    )
    return Transfer(d, summary)
