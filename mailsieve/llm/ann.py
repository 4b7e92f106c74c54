"""Nearest neighbours by a forest of random-projection trees: one queue over all trees, exact reranking."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsieve.llm.streams import bounded_batches
from mailsieve.scale import top_per_key
from mailsieve.session import cut_lineage

TREES = 12
#: Vectors that planes are fitted on, about, chosen by a hash of the id; every vector is indexed.
SAMPLE_ROWS = 20_000
#: Rows meant for a leaf, and the fewest sampled vectors a leaf is cut from.
LEAF_ROWS, LEAF_SAMPLE = 400, 8
#: A query looks at leaves until it has met this share of the sampled vectors, by one rule for all sizes.
SHARE = 0.66
#: Distinct vectors in one task; queries stream past them, so many at a time.
BLOCK_ROWS, QUERY_ROWS = 4096, 64
#: Scores by matrix product this far below the best ones are worked out again in the order of the dimensions.
SLACK = 1e-9


@dataclass(frozen=True)
class Forest:
    """Complete binary trees: node i has children 2i+1 (at most the cut) and 2i+2."""

    planes: np.ndarray
    cuts: np.ndarray
    depth: int

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 1) -> Forest:
        """Planes through random directions at the median of the sampled vectors that reach them."""
        n, dims = sample.shape
        leaves = min(rows / leaf_rows, n / LEAF_SAMPLE)
        depth = max(0, math.floor(math.log2(leaves))) if leaves > 1 else 0
        rng = np.random.default_rng(seed)
        planes, cuts = np.zeros((trees, 2**depth - 1, dims)), np.zeros((trees, 2**depth - 1))
        for t in range(trees):
            held = {0: np.arange(n)}
            for node in range(2**depth - 1):
                own = held.pop(node)
                plane = rng.normal(size=dims)
                plane /= np.linalg.norm(plane)
                side = sample[own] @ plane
                cut = float(np.median(side)) if len(own) else 0.0
                planes[t, node], cuts[t, node] = plane, cut
                held[2 * node + 1], held[2 * node + 2] = own[side <= cut], own[side > cut]
        return cls(planes, cuts, depth)

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        """Signed distance of each vector from each plane: (vectors, trees, nodes)."""
        return np.einsum("nd,tkd->ntk", vectors, self.planes, optimize=True) - self.cuts

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree."""
        trees = len(self.planes)
        out = np.zeros((len(vectors), trees), np.int64)
        for t in range(trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                over = (vectors * self.planes[t, node]).sum(axis=1) > self.cuts[t, node]
                node = 2 * node + 1 + over
            out[:, t] = node - (2**self.depth - 1)
        return out

    def members(self, vectors: np.ndarray) -> list[list[np.ndarray]]:
        """For each tree and leaf, which of ``vectors`` lie in it."""
        leaves = self.leaves(vectors)
        return [[np.flatnonzero(leaves[:, t] == x) for x in range(2**self.depth)] for t in range(len(self.planes))]

    def visit(self, margins: np.ndarray, members: list[list[np.ndarray]], target: float) -> list[tuple[int, int]]:
        """Leaves (tree, leaf) in the order of one queue shared by the trees, until ``target`` members are met.

        A branch waits at the worst distance by which the query lies on the wrong side of a plane above it.  A
        member met in several trees counts once.
        """
        first, out = 2**self.depth - 1, []
        met = np.zeros(sum(map(len, members[0])), bool)
        queue = [(-math.inf, t, 0) for t in range(len(members))]
        while queue and met.sum() < target:
            wait, t, node = heapq.heappop(queue)
            while node < first:
                d = float(margins[t, node])
                near, far = (2 * node + 2, 2 * node + 1) if d > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (max(wait, abs(d)), t, far))
                wait, node = max(wait, -abs(d)), near
                if queue[0][0] < wait:
                    heapq.heappush(queue, (wait, t, node))
                    break
            else:
                out.append((t, node - first))
                met[members[t][node - first]] = True
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products, each summed in the order of the dimensions, so equal vectors give equal numbers."""
    out = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        out += a[:, d, None] * b[None, :, d]
    return out


def _squares(a: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * a[:, d]
    return out


def scaled(a: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their largest component near one: squares neither overflow nor vanish."""
    return np.ldexp(a, -np.frexp(np.abs(a).max(axis=1, initial=0.0))[1][:, None])


class Block:
    """Distinct vectors of a task, each with the least ids that have it and its leaf in every tree."""

    def __init__(self, ids: list[list[int]], vectors: np.ndarray, leaves: np.ndarray) -> None:
        self.ids, self.vectors, self.leaves = ids, scaled(vectors), leaves
        self.lengths = np.sqrt(_squares(self.vectors))

    def candidates(self, visited: np.ndarray) -> np.ndarray:
        """Which vectors lie in a leaf that a query visits, whatever the number of trees: (queries, vectors)."""
        out = visited[:, self.leaves[:, 0]]
        for t in range(1, self.leaves.shape[1]):
            out |= visited[:, self.leaves[:, t]]
        return out

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, visited: np.ndarray, k: int) -> list[tuple]:
        """(query, id, score) of the ``k`` nearest candidates of each query, its own id left out, ties to the
        smaller id.  Every candidate is scored once."""
        queries, out = scaled(queries), []
        sizes = np.sqrt(_squares(queries))
        met = self.candidates(visited)
        some = np.flatnonzero(met.any(axis=0))
        rough = queries @ self.vectors[some].T / (sizes[:, None] * self.lengths[some][None, :])
        rough[~met[:, some]] = -np.inf
        for i, q in enumerate(query_ids.tolist()):
            row = rough[i]
            least = np.partition(row, len(row) - k - 1)[len(row) - k - 1] if len(row) > k + 1 else -np.inf
            near = some[np.flatnonzero((row >= least - SLACK) & (row > -np.inf))]
            score = _dots(queries[i : i + 1], self.vectors[near])[0] / (sizes[i] * self.lengths[near])
            found = [(-s, x) for s, at in zip(score.tolist(), near.tolist(), strict=True) for x in self.ids[at] if x != q]
            out += [(q, x, -s) for s, x in sorted(found)[:k]]
        return out


def _rerank(k: int, cells: int):
    def scores(block: Block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own, data = np.asarray(batch.column("id")), _matrix(batch.column("embedding"))
        bits = np.frombuffer(b"".join(batch.column("visited").to_pylist()), np.uint8).reshape(len(own), -1)
        for a in range(0, len(own), QUERY_ROWS):
            visited = np.unpackbits(bits[a : a + QUERY_ROWS], axis=1, count=cells).astype(bool)
            found = block.nearest(own[a : a + QUERY_ROWS], data[a : a + QUERY_ROWS], visited, k)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)],
                    ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, block = None, [], None
        for batch in batches:
            tasks, kinds = np.asarray(batch.column("task")), np.asarray(batch.column("is_query"))
            cuts = np.flatnonzero((tasks[1:] != tasks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tasks)], strict=True):
                if a == b:
                    continue
                if tasks[a] != task:
                    task, held, block = tasks[a], [], None
                if not kinds[a]:
                    held.append(batch.slice(a, b - a))
                elif held:
                    if block is None:
                        block = Block(
                            [x for h in held for x in h.column("ids").to_pylist()],
                            np.concatenate([_matrix(h.column("embedding")) for h in held]),
                            np.concatenate([_matrix(h.column("leaves")) for h in held]).astype(np.int64))
                    yield from scores(block, batch.slice(a, b - a))

    return run


def _usable(vector: Column) -> Column:
    """No null, infinite or undefined component, and some that is not zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(
    table: DataFrame, is_query: Column, k: int = 5, trees: int = TREES, share: float = SHARE,
) -> DataFrame:
    """``table`` (vec_id, embedding, ...) -> (query_id, rank, vec_id, score): the ``k`` nearest by cosine that each
    query row (``is_query``, over vec_id) finds among all other rows.

    Equal vectors are one, with the ``k`` + 1 least of their ids.  Planes are fitted on about SAMPLE_ROWS distinct
    vectors; every distinct vector has a leaf in each tree.  A query takes leaves from one queue over all trees until
    it has met ``share`` of the sampled vectors, each counted once; its candidates are the vectors in any of those
    leaves.  Vectors are dealt into blocks of about BLOCK_ROWS, the queries stream past each block with their
    visited leaves, and a block scores each candidate of a query once and sends back its ``k`` best.  What reaches the
    driver, the sample, is bounded by SAMPLE_ROWS.

    Scores are in double precision on the original values (times a power of two that cancels out); ties go to the
    smaller id, also among equal vectors.  Rows with a null id take no part, nor do vectors that are null, zero, of
    another length than most, or hold a null or non-finite component.  Rows that repeat an id count as one, with its
    best score.  Fewer than ``k`` others met give as many rows.  Extra columns are ignored.
    """
    spark = table.sparkSession
    rows = bounded_batches(table).select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"),
        is_query.alias("asks"),
    ).where(F.col("id").isNotNull() & _usable(F.col("embedding")))
    lengths = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = lengths["dims"]
    rows = rows.where(F.size("embedding") == dims)
    by_vector = Window.partitionBy("embedding").orderBy("id")
    few = rows.select("id", "embedding", F.dense_rank().over(by_vector).alias("place")).where(F.col("place") <= k + 1)
    distinct = cut_lineage(few.groupBy("embedding").agg(F.array_sort(F.collect_set("id")).alias("ids")))
    n = distinct.count()
    kept = F.pmod(F.xxhash64("embedding"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE_ROWS / n))
    chosen = distinct.where(kept).orderBy(F.get("ids", F.lit(0))).select("embedding").toArrow()
    sample = scaled(np.array(chosen.column("embedding").to_pylist(), float).reshape(-1, dims))
    sample /= np.sqrt(_squares(sample))[:, None]
    fitted = Forest.fit(sample, n, trees)
    forest = spark.sparkContext.broadcast((fitted, sample))
    per_tree = 2**fitted.depth
    cells = trees * per_tree

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = forest.value
        for batch in batches:
            data = scaled(_matrix(batch.column("embedding")))
            leaves = own.leaves(data / np.sqrt(_squares(data))[:, None]) + per_tree * np.arange(trees)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, leaves.size + 1, trees, dtype=np.int32)), pa.array(leaves.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "leaves"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, members = forest.value[0], None
        for batch in batches:
            members = own.members(forest.value[1]) if members is None else members
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                data = scaled(_matrix(part.column("embedding")))
                margins = own.margins(data / np.sqrt(_squares(data))[:, None])
                visited = np.zeros((part.num_rows, cells), bool)
                for i, m in enumerate(margins):
                    visited[i, [t * per_tree + x for t, x in own.visit(m, members, share * len(forest.value[1]))]] = True
                packed = [row.tobytes() for row in np.packbits(visited, axis=1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(packed, pa.binary())], [*part.schema.names, "visited"])

    blocks = -(-n // BLOCK_ROWS)
    indexed = distinct.mapInArrow(place, "embedding array<double>, ids array<long>, leaves array<long>")
    dealt = indexed.select(
        F.pmod(F.xxhash64("embedding"), F.lit(blocks)).alias("task"), F.lit(0).alias("is_query"), F.lit(None).cast("long").alias("id"),
        "embedding", "ids", "leaves", F.lit(None).cast("binary").alias("visited"))
    asked = rows.where("asks").select("id", "embedding").mapInArrow(ask, "id long, embedding array<double>, visited binary")
    asks = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("task"), F.lit(1).alias("is_query"), "id", "embedding",
        F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<long>").alias("leaves"), "visited")
    scored = (
        dealt.union(asks).repartition("task").sortWithinPartitions("task", "is_query")
        .mapInArrow(_rerank(k, cells), "query_id long, vec_id long, score double"))
    once = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = top_per_key(once, ["query_id"], [F.desc("score"), F.col("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
