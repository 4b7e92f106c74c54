"""Document batches: chunk, batch, keep the failures, count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.functions.ids import document_id
from mailsieve.operators import chunking as K
from mailsieve.operators.lanes import union_lanes

# documents per ordering bucket; positions inside a bucket are counted by one task
DOCS_PER_BUCKET = 64


@dataclass(frozen=True)
class DocumentBatch:
    chunks: DataFrame
    failed: DataFrame
    summary: DataFrame


@dataclass(frozen=True)
class ObjectBatch:
    requests: DataFrame
    skipped: DataFrame


def prepare_document_batch(docs: DataFrame, batch_size: int = 25, size: int = 1000, overlap: int = 100) -> DocumentBatch:
    """Documents (doc_id, file_path, checksum, text) to numbered chunk batches with a failure lane."""
    good, bad = K.split_valid(docs, ["text"])
    chunks = K.process_documents(good, size, overlap)
    bucket = F.floor(F.col("doc_id") / DOCS_PER_BUCKET)
    batched = K.assign_batches(chunks, batch_size, ["doc_id", "chunk_index"], bucket)
    n = max(batch_size, 1)
    lanes = union_lanes(
        documents=docs.select("doc_id"), failed=bad.select("doc_id"), chunks=chunks.select("doc_id"),
    )
    lane = F.col("lane")
    summary = lanes.agg(
        F.count_if(lane == "documents").alias("total_documents"), F.count_if(lane == "chunks").alias("total_chunks"),
        F.ceil(F.count_if(lane == "chunks") / F.lit(float(n))).alias("total_batches"),
        F.countDistinct(F.when(lane == "chunks", F.col("doc_id"))).alias("successful_documents"),
        F.count_if(lane == "failed").alias("failed_documents"),
    )
    return DocumentBatch(batched, bad, summary)


def chunk_objects(
    objects: DataFrame, size: int = 1000, overlap: int = 100, batch_size: int = 25, run_id: str = "run", smart: bool = True,
) -> ObjectBatch:
    """Objects (doc_id, file_path, checksum, text) to embedding requests; empty ones are skipped."""
    good, bad = K.split_valid(objects, ["text"])
    d = good.select("doc_id", "text", document_id(F.col("file_path"), F.col("checksum")).alias("document_id"), "file_path")
    if smart:
        chunks = K.chunk_smart(d, size, overlap, id_cols=("doc_id", "document_id", "file_path"))
    else:
        chunks = K.chunk_fixed(d, size, overlap)
    texts = chunks.select(
        "doc_id", "chunk_index", F.concat("document_id", F.lit("_"), F.col("chunk_index").cast("string")).alias("id"),
        F.col("file_path").alias("title"), F.col("text").alias("content"),
    )
    requests = K.embedding_batches(
        texts, batch_size, ["doc_id", "chunk_index"], F.floor(F.col("doc_id") / DOCS_PER_BUCKET), run_id
    )
    return ObjectBatch(requests, bad)
