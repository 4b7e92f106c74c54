"""Composite text plans: message cleaning, preparation for a model, document metadata."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve.functions import ids
from mailsieve.functions import text as X


def _keep(lines: Column, cut: Column) -> Column:
    return F.when(cut.isNull(), lines).otherwise(F.slice(lines, F.lit(1), cut))


def _reduction(before: Column, after: Column) -> Column:
    return F.when(before == 0, 0.0).otherwise(F.round((1 - after / before) * 100, 2))


def clean_email(
    df: DataFrame, body: str = "body", strip_html: bool | None = None, remove_quotes: bool = True,
    remove_signatures: bool = True, remove_disclaimers: bool = True, extract_urls: bool = False,
    normalize: bool = True, strip_noise: bool = True, signature_window: int = 40, drop_quoted: bool = False,
) -> DataFrame:
    """Adds the cleaned text, what was removed, counts and flags.  One narrow projection per step.

    ``strip_html=None`` strips only text that looks like HTML; ``drop_quoted`` keeps what follows a
    quoted line instead of cutting at the first one.
    """
    raw = X.blank(F.col(body))
    t = raw
    if strip_html is not False:
        looks = F.lit(True) if strip_html else raw.contains("<") & raw.contains(">")
        t = F.when(looks, X.html_to_text(raw)).otherwise(raw)
    if strip_noise:
        t = X.strip_unicode_noise(t)
    d = df.withColumn("__lines", X.as_lines(t)).withColumn(
        "removed_sections", F.array().cast("array<string>")
    )

    def cut_at(d: DataFrame, cut: Column) -> DataFrame:
        d = d.withColumn("__cut", cut)
        tail = F.array_join(F.slice("__lines", F.col("__cut") + 1, F.size("__lines")), "\n")
        d = d.withColumn(
            "removed_sections",
            F.when(F.col("__cut").isNull(), F.col("removed_sections")).otherwise(
                F.array_append("removed_sections", tail)
            ),
        )
        return d.withColumn("__lines", _keep(F.col("__lines"), F.col("__cut")))

    lines = F.col("__lines")
    if drop_quoted:
        d = d.withColumn("__lines", X.drop_quoted_lines(lines))
    elif remove_quotes:
        d = cut_at(d, X.quote_cut(lines))
    if remove_signatures:
        d = cut_at(d, X.signature_cut(lines, signature_window))
    if remove_disclaimers:
        d = cut_at(d, X.disclaimer_cut(lines))
    joined = F.array_join("__lines", "\n")
    urls = X.extract_urls(joined) if extract_urls else F.array().cast("array<string>")
    d = d.withColumn("extracted_urls", urls).withColumn(
        "cleaned_text", X.normalize_ws(joined) if normalize else joined
    )
    clean = F.col("cleaned_text")
    has_content = F.length(X.strip(clean)) > 10
    return (
        d.withColumn("extracted_query", X.extract_query(clean))
        .withColumn("removed_sections_count", F.size("removed_sections"))
        .withColumn("urls_count", F.size("extracted_urls"))
        .withColumn("original_length", F.length(raw))
        .withColumn("cleaned_length", F.length(clean))
        .withColumn("reduction_percentage", _reduction(F.length(raw), F.length(clean)))
        .withColumn("pass_fail", F.length(clean) > 0)
        .withColumn("has_content", has_content)
        .withColumn("action_required", F.when(has_content, "ready_for_chunking").otherwise("check_email_content"))
        .drop("__lines", "__cut")
    )


def prepare_text(
    df: DataFrame, text: str = "text", source_type: str = "general", task_type: str = "general",
    normalize: bool = True, extract_urls: bool = False, max_length: int = 0, remove_pii: bool = False, **email_options,
) -> DataFrame:
    """Source-specific cleaning, optional truncation and masking, with the list of operations applied."""
    raw = X.blank(F.col(text))
    if source_type == "email":
        d = clean_email(df, text, extract_urls=extract_urls, normalize=normalize, **email_options)
        d = d.withColumn("prepared_text", F.col("cleaned_text"))
        ops = ["email_preprocessing"]
        ops += [o for o in ("remove_quotes", "remove_signatures", "remove_disclaimers") if email_options.get(o, True)]
        ops += ["normalize_whitespace"] if normalize else []
    else:
        d = df.withColumn("prepared_text", X.normalize_ws(raw) if normalize else raw)
        ops = ["normalize_whitespace"] if normalize else []
        urls = X.extract_urls(F.col("prepared_text")) if extract_urls else F.array().cast("array<string>")
        d = d.withColumn("extracted_urls", urls).withColumn("removed_sections", F.array().cast("array<string>"))
        ops += ["extract_urls"] if extract_urls else []
    operations = F.array(*[F.lit(o) for o in ops]).cast("array<string>")
    if max_length > 0:
        long = F.length("prepared_text") > max_length
        operations = F.when(long, F.array_append(operations, F.lit("truncate_to_max_length"))).otherwise(operations)
        d = d.withColumn("__ops", operations).withColumn("prepared_text", F.left("prepared_text", F.lit(max_length)))
        operations = F.col("__ops")
    if remove_pii:
        d = d.withColumn("prepared_text", X.mask_pii(F.col("prepared_text")))
        operations = F.array_append(operations, F.lit("remove_pii"))
    final = F.length("prepared_text")
    return (
        d.withColumn("operations", operations)
        .withColumn("word_count", X.word_count(F.col("prepared_text")))
        .withColumn("original_length", F.length(raw))
        .withColumn("final_length", final)
        .withColumn("reduction_percentage", _reduction(F.length(raw), final))
        .withColumn("source_type", F.lit(source_type))
        .withColumn("task_type", F.lit(task_type))
        .drop("__ops")
    )


_TOPIC_WORD = re.compile(r"[a-z0-9\-]{4,}")


def _topics(text: str | None, n: int) -> list[dict]:
    found = Counter(w for w in _TOPIC_WORD.findall((text or "").lower()) if w not in X.TOPIC_STOPWORDS)
    best = sorted(found.items(), key=lambda wc: (-wc[1], wc[0]))[:n]
    return [{"word": w, "n": c} for w, c in best]


def with_topics(df: DataFrame, text: str, n: int = 5, out: str = "topics") -> DataFrame:
    """Most frequent long words of each document as an array of (word, n).

    A document is one row, so its words are counted where it is; a group-by would shuffle every
    (document, word) pair of the corpus.
    """
    kind = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: _topics(t, n))

    return df.withColumn(out, F.pandas_udf(count, kind)(F.col(text)))


def key_topics(df: DataFrame, doc: str, text: str, n: int = 5) -> DataFrame:
    """One row per document and topic, with its rank (ties: word ascending)."""
    kind = df.schema[doc].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (d, t["word"], t["n"], i)
                for d, body in zip(pdf[doc], pdf[text]) for i, t in enumerate(_topics(body, n), 1)
            ]
            yield pd.DataFrame(rows, columns=[doc, "word", "n", "rank"])

    return df.select(doc, text).mapInPandas(count, f"{doc} {kind}, word string, n bigint, rank int")


def document_metadata(df: DataFrame, doc: str, text: str, path: str, n_topics: int = 5) -> DataFrame:
    """Ids, counts, language flag, summary and key topics per document; a narrow plan without a shuffle."""
    c = F.col(text)
    d = with_topics(df.select(doc, text, path), text, n_topics)
    return d.select(
        doc, ids.content_document_id(F.col(path), c).alias("document_id"), F.sha2(c, 256).alias("file_hash"),
        X.word_count(c).alias("word_count"), F.length(c).cast("long").alias("character_count"),
        X.est_tokens(c).alias("estimated_tokens"), X.language_flag(c).alias("language"), X.summary(c).alias("summary"),
        F.col("topics.word").alias("key_topics"),
    )
