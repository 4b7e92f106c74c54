"""Stable identifiers and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailsieve.functions.text import blank, strip


def document_id(path: Column, checksum: Column) -> Column:
    return F.sha2(F.concat(strip(blank(path)), F.lit("|"), strip(blank(checksum))), 256)


def content_document_id(path: Column, content: Column) -> Column:
    return F.sha1(F.concat(blank(path), F.lit("|"), F.sha2(blank(content), 256)))


def b64_to_hex(c: Column) -> Column:
    return F.lower(F.hex(F.unbase64(c)))


def ensure_correlation_id(c: Column) -> Column:
    """Trimmed caller id, or a new one."""
    own = strip(c)
    return F.coalesce(F.when(own != "", own), F.uuid())
