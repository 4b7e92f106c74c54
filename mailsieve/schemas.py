"""Entity schemas."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _list(t: T.DataType) -> T.ArrayType:
    return T.ArrayType(t)


def _map(t: T.DataType) -> T.MapType:
    return T.MapType(S, t)


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


EMAIL_ENVELOPE = _record(
    message_id=S, from_email=S, from_name=S, subject=S, body=S, headers=_map(S), attachments=_list(S), auth=_map(B)
)
RULE_ROW = _record(rule_id=S, rule_type=S, rule_pattern=S, action=S, priority=I, active=B)
PACK_ROW = _record(
    rule_id=S, family=S, field=S, operator=S, pattern=S, weight=I, cap_per_email=I, action=S, priority=I, enabled=S,
    category=S, flag_a=S, flag_b=S, notes=S,
)
CHUNK = _record(
    chunk_id=S, chunk_index=L, text=S, token_count=L, start_char=L, end_char=L, metadata=_map(S)
)
EMBEDDING_REQUEST = _record(text=S, metadata=_map(S))
DATAPOINT = _record(
    datapoint_id=S, feature_vector=_list(D), restricts=_list(_record(namespace=S, allow_list=_list(S)))
)
CONTEXT = _record(
    id=S, text=S, score=D, source=S, uri=S, metadata=_map(S), is_pdf=B, processing_error=B, llm_relevance=D,
    category_alignment=D,
)
CATEGORY = _record(name=S, description=S, examples=_list(S))
GATE = _record(prelim_pass=B, hard_block=B, hard_reason=S, soft_score=I, decision=S, generator_hint=S)
FILE_META = _record(id=S, name=S, mime_type=S, size=L, modified_time=TS, checksum=S, owners=_list(S))
OBJECT_META = _record(
    bucket=S, name=S, size=L, content_type=S, updated=TS, md5_hash=S, crc32c=S, metadata=_map(S)
)
METRIC_POINT = _record(ts=TS, value=D, metadata=_map(S))
LOG_ROW = _record(
    timestamp=TS, action=S, status=S, http_status=L, latency_ms=L, retrieval_top_k=L, retrieval_filter=S,
    retrieval_filter_val=D, rank_mode=S, rank_model=S, contexts_returned=L, tokens_prompt=L, tokens_candidates=L,
    tokens_total=L, gen_finish_reason=S, confidence=D, safety_blocked=B, answered_unknown=B, correlation_id=S, env=S,
    recipe_id=S, job_id=S, region=S,
)
MODEL_REPLY = _record(category=S, confidence=D, reasons=_list(S), note=S)

# fixed values: required fields and field types of the exchanged records
CONTRACTS: dict[str, tuple[tuple[str, ...], dict[str, str]]] = {
    "cleaned_text": (
        ("text", "removed_sections", "word_count", "cleaning_applied"),
        {"text": "string", "removed_sections": "array", "word_count": "integer", "cleaning_applied": "object"},
    ),
    "embedding_request": (("text", "metadata"), {"text": "string", "metadata": "object"}),
    "classification_request": (("content", "rules_source"), {"content": "string", "rules_source": "string"}),
    "classification_response": (
        ("selected_category", "confidence"),
        {"selected_category": "string", "confidence": "float", "alternatives": "array", "usage_metrics": "object"},
    ),
    "classification_result": (
        ("pattern_match", "rule_source", "matches", "debug"), {"rule_source": "string", "matches": "array", "debug": "object"},
    ),
    "prompt_request": (("context_documents", "user_query"), {"context_documents": "array", "user_query": "string"}),
    "email_cleaning_result": (
        ("cleaned_text", "original_length", "cleaned_length"),
        {"cleaned_text": "string", "removed_sections": "array", "extracted_urls": "array", "removed_sections_count": "integer",
         "urls_count": "integer", "original_length": "integer", "cleaned_length": "integer",
         "reduction_percentage": "float"},
    ),
    "chunking_result": (
        ("chunks", "total_chunks"),
        {"chunks": "array", "first_chunk": "object", "chunks_json": "string", "total_chunks": "integer", "total_tokens": "integer"},
    ),
    "similarity_result": (
        ("similarity_score", "is_similar", "similarity_type"),
        {"similarity_score": "float", "similarity_percentage": "float", "similarity_type": "string",
         "computation_time_ms": "integer", "threshold_used": "float"},
    ),
    "document_metadata": (
        ("document_id", "file_hash", "word_count", "character_count", "estimated_tokens", "created_at"),
        {"document_id": "string", "file_hash": "string", "word_count": "integer", "character_count": "integer",
         "estimated_tokens": "integer", "language": "string", "summary": "string"},
    ),
    "change_detection": (
        ("change_type",),
        {"change_type": "string", "added_content": "array", "removed_content": "array", "modified_sections": "array"},
    ),
    "metrics_result": (
        ("average", "median", "min", "max", "total_count"),
        {"average": "float", "median": "float", "min": "float", "max": "float", "std_deviation": "float",
         "percentile_95": "float", "percentile_99": "float", "total_count": "integer"},
    ),
}
