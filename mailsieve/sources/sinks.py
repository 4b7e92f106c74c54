"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.operators.chunking import adapt_chunks


def to_jsonl(
    chunks: DataFrame, id_field: str = "id", id_strategy: str = "chunk_id", text_field: str = "text",
    include_metadata: bool = False, keep: Sequence[str] = (), prefix: str = "doc",
) -> DataFrame:
    """One JSON line per chunk in column ``line``; metadata only when asked for."""
    d = adapt_chunks(chunks, id_strategy, prefix)
    parts = [F.col("record_id").alias(id_field), F.col("text").alias(text_field)]
    if include_metadata:
        parts.append(F.col("metadata"))
    return d.select(*keep, F.to_json(F.struct(*parts)).alias("line"))


def write_jsonl(chunks: DataFrame, path: str, **options) -> None:
    to_jsonl(chunks, **options).select("line").write.mode("overwrite").text(path)


def object_rows(df: DataFrame, name: str, content: str, metadata: Column | None = None, base64: bool = False) -> DataFrame:
    """Rows ready to store: bytes, size, and metadata values as strings."""
    body = F.unbase64(content) if base64 else F.encode(F.col(content), "UTF-8")
    meta = F.transform_values(metadata, lambda k, v: v.cast("string")) if metadata is not None else F.create_map().cast(
        "map<string,string>"
    )
    return df.select(
        F.col(name).alias("name"), body.alias("bytes"), F.octet_length(body).alias("bytes_uploaded"), meta.alias("metadata")
    )


def write_objects(rows: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Store object rows and return the name and size of what was written."""
    rows.write.mode(mode).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select("name", "bytes_uploaded")
