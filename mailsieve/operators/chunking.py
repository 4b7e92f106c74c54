"""Splitting documents into chunks and chunks into batches."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve import scale
from mailsieve.functions.ids import document_id
from mailsieve.functions.text import blank, est_tokens, strip
from mailsieve.session import bounded_batches

PARAGRAPH_END = re.compile(r"\n{2,}")
SENTENCE_END = re.compile(r"""[.!?]["')\]]?\s""")
SENTENCE_STOP = re.compile(r"[.!?]\s+")
BLANKS = re.compile(r"\s+")
#: Chunks in an Arrow batch that a Python task returns.
CHUNK_ROWS = 1024


def _window(size: int, overlap: int, chars_per_token: float) -> tuple[int, int]:
    """Chunk length and overlap in characters."""
    size = max(size, 1)
    overlap = min(max(overlap, 0), size - 1)
    cpt = chars_per_token if chars_per_token > 0 else 4.0
    return int(size * cpt + 0.5), int(overlap * cpt + 0.5)


def chunk_fixed(
    df: DataFrame, size: int = 1000, overlap: int = 100, chars_per_token: float = 4.0, text: str = "text"
) -> DataFrame:
    """Equal windows.  Starts follow from the length alone, so a generator does it without a shuffle."""
    length, back = _window(size, overlap, chars_per_token)
    return _fixed_windows(df, length, F.lit(back), text)


def _fixed_windows(df: DataFrame, length: int, back: Column, text: str) -> DataFrame:
    n = F.length(text)
    step = (F.lit(length) - back).cast("long")
    last = F.when(n <= length, F.lit(0)).otherwise(F.ceil((n - length) / step.cast("double")))
    others = [c for c in df.columns if c != text]
    d = df.where(n > 0).select(
        *others, F.col(text).alias("__whole"), step.alias("__step"),
        F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("chunk_index"),
    )
    start = F.col("chunk_index") * F.col("__step")
    d = d.withColumn("start_char", start).withColumn(
        "end_char", F.least(start + length, F.length("__whole").cast("long"))
    )
    d = d.withColumn(text, F.substring(F.col("__whole"), F.col("start_char").cast("int") + 1, F.lit(length)))
    d = d.withColumn("token_count", est_tokens(F.col(text)))
    return d.drop("__whole", "__step")


def with_flags(chunks: DataFrame, total_chars: Column) -> DataFrame:
    """Overlap and final flags follow from the chunk's own row."""
    return chunks.withColumn("has_overlap", F.col("chunk_index") > 0).withColumn(
        "is_final", F.col("end_char") >= total_chars
    )


def chunk_totals(chunks: DataFrame, by: str) -> DataFrame:
    """Chunk count per document, joined back (pre-aggregated; a huge document does not sit in one window)."""
    totals = chunks.groupBy(by).agg(F.count("*").alias("total_chunks"))
    return chunks.join(totals, by)


class _Marks:
    """Matches of a pattern in a text, found once, for questions about the last one before a place."""

    def __init__(self, pattern: re.Pattern[str], text: str) -> None:
        spans = [m.span() for m in pattern.finditer(text)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def last_ending(self, by: int, since: int) -> int | None:
        """End of the last match that ends at ``by`` or before and starts at ``since`` or later."""
        k = bisect_right(self.ends, by) - 1
        return self.ends[k] if k >= 0 and self.starts[k] >= since else None

    def last_starting(self, by: int, since: int) -> int | None:
        """Start of the last match that starts at ``by`` or before and at ``since`` or later."""
        k = bisect_right(self.starts, by) - 1
        return self.starts[k] if k >= 0 and self.starts[k] >= since else None

    def last_cut(self, by: int, since: int, least: int) -> int | None:
        """End of the last match of which ``least`` characters lie in ``since``..``by``, cut to ``by``."""
        k = bisect_right(self.starts, by - least) - 1
        if k < 0:
            return None
        end = min(self.ends[k], by)
        return end if end - max(self.starts[k], since) >= least else None


def _spans(total: int, length: int, back: int, choose: Callable[[int, int], int]) -> Iterator[tuple[int, int]]:
    """Consecutive (start, end) pairs: ``choose(start, tentative end)`` ends a chunk, the next one starts ``back``
    before, unless that would not move on."""
    start = 0
    while start < total:
        end = choose(start, start + length) if start + length < total else total
        yield start, end
        if end >= total:
            return
        start = end - back if end - back > start else end


def boundary_spans(
    text: str, length: int, back: int, sentences: bool, paragraphs: bool
) -> Iterator[tuple[int, int]]:
    """(start, end) pairs that prefer a paragraph end, then a sentence end, inside each window."""
    gaps = _Marks(PARAGRAPH_END, text) if paragraphs else None
    stops = _Marks(SENTENCE_END, text) if sentences else None

    def choose(start: int, limit: int) -> int:
        end = gaps.last_cut(limit, start, 2) if gaps else None
        if end is None and stops:
            end = stops.last_ending(limit, start)
        return limit if end is None else end

    return _spans(len(text), length, back, choose)


def word_spans(
    text: str, size: int, back: int, before: int = 200, beyond: int = 50, least: float = 0.5
) -> Iterator[tuple[int, int]]:
    """Sentence end near the target, else the last blank before it, else the target itself.

    A sentence may start ``before`` characters before the target and its end lie ``beyond`` it, if the chunk gets
    more than the share ``least`` of its size.
    """
    stops, blanks = _Marks(SENTENCE_STOP, text), _Marks(BLANKS, text)

    def choose(start: int, target: int) -> int:
        end = stops.last_ending(target + beyond, max(target - before, start))
        if end is not None and end > start + int(size * least):
            return end
        blank_at = blanks.last_starting(target, start + 1)
        return target if blank_at is None else blank_at

    return _spans(len(text), size, back, choose)


def _explode_spans(df: DataFrame, spans, text: str, id_cols: Sequence[str]) -> DataFrame:
    """Apply a span generator to each document; a task holds one bounded Arrow batch and CHUNK_ROWS chunks."""
    schema = T.StructType(
        [df.schema[c] for c in id_cols]
        + [
            T.StructField("chunk_index", T.LongType()), T.StructField(text, T.StringType()),
            T.StructField("start_char", T.LongType()), T.StructField("end_char", T.LongType()),
        ]
    )

    def chunks(batch: pa.RecordBatch) -> Iterator[tuple]:
        for *ids, doc in zip(*batch.columns, strict=True):
            doc, keys = doc.as_py() or "", [c.as_py() for c in ids]
            for i, (a, b) in enumerate(spans(doc)):
                yield *keys, i, doc[a:b], a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [*batch.schema.types[:-1], pa.int64(), pa.string(), pa.int64(), pa.int64()]
            rows = chunks(batch)
            while part := list(islice(rows, CHUNK_ROWS)):
                cols = zip(*part, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], schema.names)

    out = bounded_batches(df.select(*id_cols, text)).mapInArrow(run, schema)
    return out.withColumn("token_count", est_tokens(F.col(text)))


def chunk_smart(
    df: DataFrame, size: int = 1000, overlap: int = 100, chars_per_token: float = 4.0, sentences: bool = True,
    paragraphs: bool = True, text: str = "text", id_cols: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Windows that end on a paragraph or sentence when one ends inside them."""
    length, back = _window(size, overlap, chars_per_token)
    return _explode_spans(df, lambda s: boundary_spans(s, length, back, sentences, paragraphs), text, list(id_cols))


def chunk_words(
    df: DataFrame, size: int = 1000, overlap_tokens: int = 0, text: str = "text", id_cols: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Character windows that end on a sentence near the target, else on a blank."""
    return _explode_spans(df, lambda s: word_spans(s, max(size, 1), overlap_tokens * 4), text, list(id_cols))


def chunk_bytes(df: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Byte slices with index and total."""
    raw = F.encode(F.col(text), "UTF-8")
    total = F.ceil(F.octet_length(raw) / F.lit(float(size)))
    others = [c for c in df.columns if c != text]
    d = df.where(F.octet_length(raw) > 0).select(
        *others, raw.alias("__raw"), total.alias("total"),
        F.explode(F.sequence(F.lit(0).cast("long"), total - 1)).alias("index"),
    )
    piece = F.substring(F.col("__raw"), (F.col("index") * size + 1).cast("int"), F.lit(size))
    return d.withColumn("chunk", piece).withColumn("bytes", F.octet_length("chunk")).drop("__raw")


def process_documents(
    docs: DataFrame, size: int = 1000, overlap: int = 100, path: str = "file_path", checksum: str = "checksum",
    text: str = "text",
) -> DataFrame:
    """Characters-based chunking with document ids: sizes in characters become tokens of four."""
    length = -(-max(size, 100) // 4) * 4
    back = min(-(-max(overlap, 0) // 4) * 4, length - 4)
    d = docs.withColumn("document_id", document_id(F.col(path), F.col(checksum)))
    c = _fixed_windows(d, length, F.when(F.length(text) <= 1000, 0).otherwise(back), text)
    return c.withColumn("chunk_id", F.concat("document_id", F.lit("_chunk_"), F.col("chunk_index").cast("string")))


# --- batches ------------------------------------------------------------------------------------


def assign_batches(
    df: DataFrame, n: int, order: Sequence[str], bucket: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Slices of ``n`` consecutive rows, numbered from 0, over the table or within ``by``.

    ``bucket`` is a monotone function of ``order``; positions come from per-bucket counts, so no
    single task sees the whole table.
    """
    n = max(n, 1)
    d = scale.number_rows(df, list(by), bucket, list(order), "__pos")
    return d.withColumn("batch_number", F.floor((F.col("__pos") - 1) / F.lit(float(n)))).drop("__pos")


def batch_summary(chunks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Documents and chunks per batch."""
    return chunks.groupBy("batch_number").agg(
        F.countDistinct(doc).alias("documents"), F.count("*").alias("chunks"),
        F.sum("token_count").alias("tokens"),
    )


def embedding_batches(
    texts: DataFrame, n: int, order: Sequence[str], bucket: Column, run_id: str, task_type: str = "RETRIEVAL_DOCUMENT",
    include_title: bool = True, prefix: str = "emb_batch",
) -> DataFrame:
    """Embedding requests (``id``, ``title``, ``content`` in) with batch ids built from a passed run id."""
    d = assign_batches(texts, n, order, bucket)
    title, content = blank(F.col("title")), blank(F.col("content"))
    text = F.when(F.lit(include_title) & (title != ""), F.concat(title, F.lit(": "), content)).otherwise(content)
    batch = F.concat(F.lit(prefix + "_"), F.col("batch_number").cast("string"), F.lit("_" + run_id))
    stamps = F.create_map(
        F.lit("id"), F.col("id"), F.lit("title"), title, F.lit("task_type"), F.lit(task_type), F.lit("batch_id"), batch
    )
    own = F.col("metadata") if "metadata" in texts.columns else F.create_map().cast("map<string,string>")
    return d.withColumn("text", text).withColumn("batch_id", batch).withColumn("metadata", merge_maps(own, stamps))


def merge_maps(*maps: Column) -> Column:
    """Later maps win; does not depend on the session's duplicate-key policy."""

    def two(a: Column, b: Column) -> Column:
        kept = F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k))
        return F.map_concat(kept, b)

    out = maps[0]
    for m in maps[1:]:
        out = two(out, m)
    return out


def merge_metadata(chunk: Column, document: Column, ids: Column, source: str = "google_drive") -> Column:
    """Chunk metadata < document metadata < explicit ids; the source is stamped last."""
    stamped = F.create_map(F.lit("source"), F.lit(source))
    given = F.map_filter(ids, lambda k, v: v.isNotNull())
    return merge_maps(chunk, document, given, stamped)


def adapt_chunks(chunks: DataFrame, strategy: str = "chunk_id", prefix: str = "doc", doc: str = "doc_id") -> DataFrame:
    """Record ids by strategy plus metadata with precedence chunk < base < index stamps."""
    i = F.col("chunk_index").cast("string")
    own = F.col("chunk_id") if "chunk_id" in chunks.columns else F.concat(F.lit("chunk_"), i)
    record = {
        "chunk_id": own,
        "prefix_index": F.concat(F.lit(prefix + "_"), i),
        "docid_index": F.concat(F.col(doc).cast("string"), F.lit("_"), i),
    }[strategy]
    meta = F.col("metadata") if "metadata" in chunks.columns else F.create_map().cast("map<string,string>")
    base = F.col("base_metadata") if "base_metadata" in chunks.columns else F.create_map().cast("map<string,string>")
    stamps = F.create_map(F.lit("chunk_index"), i, F.lit("chunk_id"), own)
    return chunks.withColumn("record_id", record).withColumn("metadata", merge_maps(meta, base, stamps))


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with text in every required column, and the reject lane with its reason."""
    bad = F.lit(False)
    for c in required:
        bad = bad | (strip(blank(F.col(c))) == "")
    return df.where(~bad), df.where(bad).withColumn("reason", F.lit("empty_text_content"))
