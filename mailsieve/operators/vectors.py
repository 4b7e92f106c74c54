"""Vector scoring and exact nearest-neighbour retrieval."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsieve import scale
from mailsieve.session import cut_lineage

# queries of a search task, corpus rows dealt to it, and the most categories a configured list may have
QUERY_BLOCK = 1024
BLOCK_ROWS = 65536
MAX_CATEGORIES = 4096
# fixed values: retrieval presets (top_k, minimum similarity)
RETRIEVAL_PRESETS = {"precise": (10, 0.8), "balanced": (20, 0.65), "broad": (50, 0.5)}


def _sum_of(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return _sum_of(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_sum_of(F.transform(doubles(a), lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    c = F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
    return F.greatest(F.least(c, F.lit(1.0)), F.lit(-1.0))


def similarity(a: Column, b: Column, kind: str = "cosine", normalize: bool = True, threshold: float = 0.7) -> Column:
    """Struct with score, percentage, verdict, level and an error text instead of an exception."""
    # unit vectors need no rebuilding: their dot product is the cosine, their squared distance 2 - 2 cos
    cos = cosine(a, b)
    if kind == "euclidean" and normalize:
        score = 1.0 / (1.0 + F.sqrt(2.0 - 2.0 * cos))
    elif kind == "euclidean":
        gap = F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y))
        score = 1.0 / (1.0 + F.sqrt(_sum_of(gap)))
    elif kind == "dot_product" and not normalize:
        score = dot(a, b)
    else:
        score = cos
    error = F.when(F.size(a) != F.size(b), "vectors must be the same length").when(
        F.size(a) == 0, "vectors cannot be empty"
    )
    if kind == "dot_product" and not normalize:
        error = error.otherwise("dot product without normalization has no threshold")
    fine = error.isNull()

    def describe(x: Column) -> Column:
        percent = F.round(x * 100, 2) if kind in ("cosine", "euclidean") else F.lit(None).cast("double")
        level = F.when(x.between(0.8, 1.0), "high").when(x.between(0.6, 0.8), "medium").otherwise("low")
        return F.struct(
            F.round(x, 6).alias("score"), percent.alias("percentage"), (x >= threshold).alias("is_similar"),
            F.when(fine, level).alias("level"), error.alias("error"),
        )

    # a one-element array binds the score, so the vectors are walked once
    return F.transform(F.array(F.when(fine, score)), describe)[0]


def _unit(rows: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def _fold(held: tuple[np.ndarray, np.ndarray], scores: np.ndarray, places: np.ndarray, k: int) -> tuple:
    """The ``k`` best of ``held`` (scores and places, a row a query) and a batch; ties go to the smaller place."""
    every = np.concatenate([held[0], scores], axis=1)
    where = np.concatenate([held[1], np.broadcast_to(places, scores.shape)], axis=1)
    if every.shape[1] <= k:
        return every, where
    pick = np.argpartition(-every, k - 1, axis=1)[:, :k]
    floor = np.take_along_axis(every, pick, axis=1).min(axis=1)
    for row in np.flatnonzero((every >= floor[:, None]).sum(axis=1) > k):
        near = np.flatnonzero(every[row] >= floor[row])
        pick[row] = near[np.lexsort((where[row, near], -every[row, near]))][:k]
    return np.take_along_axis(every, pick, axis=1), np.take_along_axis(where, pick, axis=1)


def _search(k: int, schema: T.StructType):
    """Best corpus rows for the queries of each task; its queries come first, then its corpus rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, queries, matrix, held, ids = None, [], None, None, []

        def close() -> pd.DataFrame:
            rows, cols = np.nonzero(np.isfinite(held[0]))
            return pd.DataFrame({
                schema.names[0]: [queries[r] for r in rows],
                schema.names[1]: [ids[held[1][r, c]] for r, c in zip(rows, cols, strict=True)],
                "score": held[0][rows, cols],
            })

        for pdf in batches:
            for (own, kind), part in pdf.groupby(["__task", "__kind"], sort=True):
                vectors = _unit(part["__vec"])
                if kind == 0:
                    if own != task:
                        if held is not None:
                            yield close()
                        task, queries, matrix, held, ids = own, [], None, None, []
                    queries += part["__query"].tolist()
                    matrix = vectors if matrix is None else np.concatenate([matrix, vectors])
                elif own == task:
                    if held is None:
                        held = np.empty((len(queries), 0)), np.empty((len(queries), 0), np.int64)
                    order = part["__corpus"].argsort(kind="stable").to_numpy()
                    names = part["__corpus"].to_numpy()[order]
                    # rows come sorted by id within a task, so a later place is a larger id
                    places = np.arange(len(ids), len(ids) + len(names))
                    ids += names.tolist()
                    held = _fold(held, matrix @ vectors[order].T, places, k)
        if held is not None:
            yield close()

    return run


def nearest(
    queries: DataFrame, corpus: DataFrame, k: int, query_id: str, corpus_id: str, vector: str = "embedding",
    carry: Sequence[str] = (), query_block: int = QUERY_BLOCK, keep_hits: bool = True,
) -> DataFrame:
    """Exact cosine top-``k`` of ``corpus`` for every query: (query_id, corpus_id, carry…, score, rank).

    One plan for every size: queries are dealt into blocks of about ``query_block`` and corpus rows into blocks
    of about BLOCK_ROWS; each pair of blocks is a task that holds its queries and streams its corpus rows in
    the order of their ids past them as matrix products.  A task holds ``query_block`` vectors, their ``k`` best
    and one batch, and sends ``k`` rows a query.  Only ids travel with the scores; ``carry`` joins the hits.
    Ranks follow the unrounded cosine (ties: smaller id); the score comes out rounded to 6 places.

    ``keep_hits`` writes the hits (at most ``k`` per query) to the scratch folder: later steps read them
    several times, and each reading would otherwise scan the corpus again.
    """
    asked = queries.select(F.col(query_id).alias("__query"), F.col(vector).alias("__vec")).where("__vec is not null")
    slim = corpus.select(F.col(corpus_id).alias("__corpus"), F.col(vector).alias("__vec")).where("__vec is not null")
    n_queries, n_rows = asked.count(), slim.count()
    qblocks, blocks = max(1, -(-n_queries // query_block)), max(1, -(-n_rows // BLOCK_ROWS))
    none_q, none_c = (F.lit(None).cast(d.schema[c].dataType) for d, c in ((asked, "__query"), (slim, "__corpus")))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("*", (F.pmod(F.xxhash64("__query"), F.lit(qblocks))).alias("__q"), each(blocks).alias("__b"))
    right = slim.select("*", (F.pmod(F.xxhash64("__corpus"), F.lit(blocks))).alias("__b"), each(qblocks).alias("__q"))
    task = (F.col("__b") * qblocks + F.col("__q")).alias("__task")
    both = left.select(task, F.lit(0).alias("__kind"), "__query", none_c.alias("__corpus"), "__vec").union(
        right.select(task, F.lit(1).alias("__kind"), none_q.alias("__query"), "__corpus", "__vec"))
    schema = T.StructType([
        T.StructField(query_id, queries.schema[query_id].dataType),
        T.StructField(corpus_id, corpus.schema[corpus_id].dataType), T.StructField("score", T.DoubleType()),
    ])
    local = both.repartition("__task").sortWithinPartitions("__task", "__kind", "__corpus").mapInPandas(
        _search(k, schema), schema)
    top = scale.top_per_key(local, [query_id], [F.desc("score"), F.col(corpus_id)], k)
    if carry:
        top = top.join(corpus.select(corpus_id, *carry), corpus_id)
    hits = top.select(query_id, corpus_id, *carry, F.round("score", 6).alias("score"), "rank")
    return cut_lineage(hits) if keep_hits else hits


def retrieve(
    queries: DataFrame, corpus: DataFrame, preset: str = "balanced", top_k: int | None = None,
    min_similarity: float | None = None, max_distance: float | None = None, ids: Sequence | None = None,
    query_id: str = "query_id", corpus_id: str = "vec_id", carry: Sequence[str] = (), on_empty: str = "empty",
) -> DataFrame:
    """Top-k retrieval under a similarity floor or a distance ceiling (never both).

    A query without hits stays absent (``empty``), gets one row without an id (``placeholder``) or fails
    the job (``error``).
    """
    if min_similarity is not None and max_distance is not None:
        raise ValueError("give a similarity floor or a distance ceiling, not both")
    k, floor = RETRIEVAL_PRESETS[preset]
    k = max(top_k or k, 1)
    pool = corpus.where(F.col(corpus_id).isin(list(ids))) if ids is not None else corpus
    hits = nearest(queries, pool, k, query_id, corpus_id, carry=carry)
    if max_distance is not None:
        hits = hits.where(1.0 - F.col("score") <= max_distance)
    else:
        hits = hits.where(F.col("score") >= (floor if min_similarity is None else min_similarity))
    if on_empty in ("placeholder", "error"):
        missing = queries.select(query_id).join(hits.select(query_id).distinct(), query_id, "left_anti")
        score = F.lit(0.0)
        if on_empty == "error":
            score = F.raise_error(F.concat(F.lit("nothing retrieved for "), F.col(query_id).cast("string"))).cast("double")
        hits = hits.unionByName(missing.withColumn("score", score), allowMissingColumns=True)
    return hits


def _bounded_list(categories: DataFrame) -> pd.DataFrame:
    """A configured list of categories on the driver; more than MAX_CATEGORIES are an error, never a cut."""
    rows = categories.limit(MAX_CATEGORIES + 1).toPandas()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories; use nearest() with the categories as corpus")
    return rows


def category_names(categories: DataFrame, name: str = "category") -> list[str]:
    return _bounded_list(categories.select(name))[name].tolist()


def category_arrays(
    emails: DataFrame, categories: DataFrame, email_id: str, vector: str = "embedding", name: str = "category",
    carry: Sequence[str] = (),
) -> DataFrame:
    """(email_id, ``carry``, scores): categories with their cosines, best first, as one array per e-mail.

    Categories are a configured list (checked against ``MAX_CATEGORIES``); nothing shuffles.
    """
    cats = _bounded_list(categories.select(name, F.col(vector).alias("__vec")))
    cats = cats.sort_values(name, ignore_index=True)
    names, mat = cats[name].to_numpy(), _unit(cats["__vec"])
    schema = T.StructType(
        [emails.schema[c] for c in (email_id, *carry)]
        + [T.StructField("scores", T.ArrayType(T.StructType([
            T.StructField("category", T.StringType()), T.StructField("cosine", T.DoubleType())])))]
    )

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if not len(part):
                continue
            cos = _unit(part["__vec"]) @ mat.T
            order = np.argsort(-cos, axis=1, kind="stable")
            ranked = [[{"category": names[j], "cosine": float(row[j])} for j in o] for row, o in zip(cos, order)]
            yield pd.DataFrame({**{c: part[c] for c in (email_id, *carry)}, "scores": ranked})

    return emails.select(email_id, *carry, F.col(vector).alias("__vec")).mapInPandas(scan, schema)


def category_score(cosine: Column) -> Column:
    return F.round((cosine + 1.0) / 2.0, 6)


def score_categories(
    emails: DataFrame, categories: DataFrame, email_id: str, vector: str = "embedding", name: str = "category"
) -> DataFrame:
    """One row per e-mail and category: cosine, score ``(cos + 1) / 2`` and rank."""
    packed = category_arrays(emails, categories, email_id, vector, name)
    out = packed.select(email_id, F.posexplode("scores").alias("pos", "s"))
    return out.select(
        email_id, F.col("s.category").alias("category"), F.round("s.cosine", 6).alias("cosine"),
        category_score(F.col("s.cosine")).alias("score"), (F.col("pos") + 1).alias("rank"),
    )


def shortlist(scores: DataFrame, by: str, k: int = 3) -> DataFrame:
    """Best ``k`` categories per e-mail and whether even the best is weak."""
    picked = scores.where(F.col("rank") <= max(k, 1))
    return picked.groupBy(by).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "category"))), lambda x: x["category"]).alias(
            "shortlist"
        ),
        F.max("score").alias("top_score"),
        (F.max("score") < 0.5).alias("low_confidence"),
    )


def retrieval_eval(run: DataFrame, relevant: DataFrame, k: int, query_id: str = "query_id") -> DataFrame:
    """Recall@k, nDCG@k and reciprocal rank per query; ``run`` has a rank and a 0/1 ``relevant``."""
    top = run.where(F.col("rank") <= k)
    gain = F.col("relevant") / F.log2(F.col("rank") + 1.0)
    got = top.groupBy(query_id).agg(
        F.sum("relevant").alias("hits"), F.sum(gain).alias("dcg"),
        F.min(F.when(F.col("relevant") == 1, F.col("rank"))).alias("first_hit"),
    )
    ideal = _sum_of(
        F.transform(F.sequence(F.lit(1), F.least(F.col("n_relevant"), F.lit(k)).cast("int")), lambda r: 1.0 / F.log2(r + 1.0))
    )
    return relevant.join(got, query_id, "left").select(
        query_id,
        F.round(F.coalesce(F.col("hits"), F.lit(0)) / F.col("n_relevant"), 6).alias("recall"),
        F.round(F.coalesce(F.col("dcg"), F.lit(0.0)) / ideal, 6).alias("ndcg"),
        F.round(F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0)), 6).alias("mrr"),
    )


def index_health(vectors: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """Vector count, wrong dimension count and share."""
    bad = F.coalesce(F.size(vector) != dim, F.lit(True))
    return vectors.agg(
        F.count("*").alias("vectors"), F.count_if(bad).alias("bad_dim"),
        F.round(F.avg(bad.cast("double")), 6).alias("bad_share"),
    )
