"""Model calls as pluggable columns; the defaults are deterministic so results can be checked."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve.functions.text import est_tokens, jaccard, tokens
from mailsieve.session import bounded_batches


def count_tokens(text: Column, counter: Callable[[Column], Column] | None = None) -> Column:
    return (counter or est_tokens)(text)


def lexical_score(query: Column, text: Column) -> Column:
    """Share of the distinct query tokens that the text contains."""
    q = F.array_distinct(tokens(query))
    return F.when(F.size(q) == 0, 0.0).otherwise(
        F.round(F.size(F.array_intersect(q, tokens(text))) / F.size(q), 6)
    )


def lexical_alignment(category: Column, text: Column) -> Column:
    return F.round(jaccard(tokens(category), tokens(text)), 6)


def lexical_referee(text: Column, names: Column) -> Column:
    """Referee's reply (category, confidence, distribution) by the words that text and category share; categories
    that share none are left out, and without any the reply is empty."""
    shares = F.transform(names, lambda c: F.struct(c.alias("category"), lexical_alignment(c, text).alias("prob")))
    best = F.array_max(F.transform(shares, lambda x: F.struct(x["prob"].alias("prob"), x["category"].alias("category"))))
    return F.struct(
        F.when(best["prob"] > 0, best["category"]).alias("category"), F.when(best["prob"] > 0, best["prob"]).alias("confidence"),
        F.filter(shares, lambda x: x["prob"] > 0).alias("distribution"))


def score(
    df: DataFrame, query: str, text: str, out: str = "relevance",
    scorer: Callable[[Iterator[tuple[pd.Series, pd.Series]]], Iterator[pd.Series]] | None = None,
) -> DataFrame:
    """Relevance column.  ``scorer`` (iterator of Arrow batches, so a model loads once per task) replaces
    the lexical default."""
    if scorer is None:
        return df.withColumn(out, lexical_score(F.col(query), F.col(text)))
    udf = F.pandas_udf(scorer, T.DoubleType())
    return df.withColumn(out, udf(F.col(query), F.col(text)))


_WORD = re.compile(r"[a-z0-9]+")


def hashed_words(texts: pd.Series, dim: int) -> list[np.ndarray]:
    """Normalised bag of words; the slot of a word is its CRC-32 modulo ``dim``."""
    out = []
    for t in texts:
        v = np.zeros(dim)
        for w in _WORD.findall((t or "").lower()):
            v[zlib.crc32(w.encode()) % dim] += 1.0
        n = np.linalg.norm(v)
        out.append(v / n if n else v)
    return out


def embed(df: DataFrame, text: str, out: str = "embedding", dim: int = 64, embedder=None, batch: int = 250) -> DataFrame:
    """Text to vector in batches of at most ``batch`` texts (the service limit of the model behind it)."""
    call = embedder or (lambda s: hashed_words(s, dim))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            parts = [call(s.iloc[i : i + batch]) for i in range(0, len(s), batch)]
            yield pd.Series([v for p in parts for v in p])

    return bounded_batches(df).withColumn(out, run(F.col(text)))


def apply_user_fn(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """User function over Arrow batches of rows."""
    return df.mapInPandas(lambda batches: (fn(b) for b in batches), schema)
