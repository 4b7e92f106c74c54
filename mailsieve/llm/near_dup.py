"""MinHash near-duplicate detection: minima, bands, signature verification, exact sets, star components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.components import connected_components
from mailsieve.llm.shingles import mix, shingle_sets
from mailsieve.llm.streams import bounded_batches, slices, utf8, whole_groups
from mailsieve.session import cut_lineage

WIDTH = 5
ROWS = 5
#: Chance that a pair exactly at the threshold shares no band, and that its signature looks too far apart.
MISS = 1e-6
#: Members in a block of a band bucket; of a larger bucket two blocks meet in a task.
BUCKET = 4096
#: Bytes of text in a block of a candidate group; two blocks meet in a task.
BLOCK = 4 << 20


def band_count(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def least_agreement(percent: int, minima: int) -> int:
    """Fewest equal minima that a pair at the threshold has, but for a chance of MISS."""
    p, tail = percent / 100, 0.0
    for equal in range(minima + 1):
        tail += math.comb(minima, equal) * p**equal * (1 - p) ** (minima - equal)
        if tail > MISS:
            return equal
    return minima


def _sketch(percent: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    bands = band_count(percent)
    seeds = mix(np.arange(1, 2 * bands * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    factors, shifts = seeds[::2] | np.uint64(1), seeds[1::2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets, at = shingle_sets(*utf8(part.column("text")), width)
                sizes = np.diff(at)
                full = np.flatnonzero(sizes)
                keys: list[bytes | None] = [None] * len(sizes)
                signatures: list[bytes | None] = [None] * len(sizes)
                minima = np.empty((bands * ROWS, len(full)), np.uint64)
                if len(full):
                    short = sets >> np.uint64(32)
                    held = np.empty_like(short)
                    for i in range(bands * ROWS):
                        np.multiply(short, factors[i], out=held)
                        np.add(held, shifts[i], out=held)
                        np.minimum.reduceat(held, at[full], out=minima[i])
                minima >>= np.uint64(32)
                own = mix(minima * factors[:, None]).astype(np.uint8).T
                buckets = np.arange(bands, dtype=np.uint64)[:, None] * np.ones(len(full), np.uint64)
                for i in range(ROWS):
                    buckets = mix((buckets << np.uint64(1)) ^ minima[i::ROWS] * factors[i] ^ buckets)
                for j, row in enumerate(full.tolist()):
                    keys[row] = hashlib.blake2b(sets[at[row] : at[row + 1]].tobytes(), digest_size=16).digest()
                    signatures[row] = own[j].tobytes()
                lists = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text_hash"), part.column("octets"), pa.array(sizes),
                        pa.array(keys, pa.binary()), pa.array(signatures, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(buckets.T.ravel().view(np.int64))),
                    ],
                    ["doc_id", "text_hash", "octets", "n_shingles", "key", "signature", "buckets"],
                )

    return run


def spanning_forest(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges that span the components of the graph whose edges ``linked(i, others)`` answers.

    A node is compared only with those that nothing reached so far, so a tight group costs one comparison
    for each member.
    """
    rest, out = np.arange(n), []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = linked(i, rest)
            near = rest[hit].tolist()
            out += [(i, j) for j in near]
            queue += near
            rest = rest[~hit]
    return out


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])


def _signature_links(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, "task"):
            nodes = np.asarray(table.column("node")).tolist()
            raw = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(nodes), -1)
            pairs: list[tuple[int, int]] = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = raw[a:b]
                found = spanning_forest(b - a, lambda i, rest, own=own: (own[rest] == own[i]).sum(axis=1) >= least)
                pairs += [(nodes[a + i], nodes[a + j]) for i, j in found]
            yield _edges(pairs)

    return run


class _Overlaps:
    """Exact test of one member's shingle set against those of others."""

    def __init__(self, sets: np.ndarray, at: np.ndarray, percent: int) -> None:
        codes = np.unique(sets, return_inverse=True)[1]
        self.own = np.split(codes, at[1:-1])
        self.sizes, self.percent = np.diff(at), percent
        self.mark = np.zeros(len(codes), bool)
        self.kept, self.flat, self.at = np.arange(len(self.sizes)), codes, at[:-1]

    def __call__(self, i: int, rest: np.ndarray) -> np.ndarray:
        if 2 * len(rest) < len(self.kept):
            self.kept, self.flat = rest, np.concatenate([self.own[j] for j in rest.tolist()])
            self.at = np.concatenate([[0], np.cumsum(self.sizes[rest])[:-1]])
        self.mark[self.own[i]] = True
        shared = np.add.reduceat(self.mark[self.flat], self.at, dtype=np.int64)
        self.mark[self.own[i]] = False
        shared = shared[np.searchsorted(self.kept, rest)]
        return 100 * shared >= self.percent * (self.sizes[i] + self.sizes[rest] - shared)


def _group_sets(group: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle sets of a group's texts, worked out slice by slice, and their offsets."""
    flat, sizes = [], [np.zeros(1, np.int64)]
    for batch in group.to_batches():
        for part in slices(batch, "text"):
            sets, at = shingle_sets(*utf8(part.column("text")), width)
            flat.append(sets)
            sizes.append(np.diff(at))
    return np.concatenate(flat), np.cumsum(np.concatenate(sizes))


def _exact_links(percent: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, "task"):
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                sets, at = _group_sets(table.slice(a, b - a), width)
                nodes = np.asarray(table.column("node").slice(a, b - a))
                full = np.flatnonzero(np.diff(at))
                nodes, at = nodes[full], np.append(at[full], at[-1])
                if len(nodes) > 1:
                    found = spanning_forest(len(nodes), _Overlaps(sets, at, percent))
                    yield _edges([(nodes[i], nodes[j]) for i, j in found])

    return run


def _deal(members: DataFrame, group: str, blocks: str) -> DataFrame:
    """(node, task, ...) for members (node, ``group``, ``blocks``, ...) of groups that are compared within.

    A group of one block is one task.  Of more blocks every two meet in a task, so that no task holds over two.
    """
    n = F.col(blocks)
    others = F.array_except(F.sequence(F.lit(0), n - 1), F.array("own"))
    return (
        members.withColumn("own", F.pmod(F.xxhash64("node"), n).cast("int"))
        .withColumn("other", F.explode(F.when(n < 2, F.array("own")).otherwise(others)))
        .withColumn("task", F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other"))).drop("own", "other"))


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> (doc_id, n_shingles, component_id, kept), one row for each row.

    A document's set is its distinct ``width``-word shingles (A-Z lower-cased, words between ASCII blanks);
    fewer words make one shingle.  Documents are linked if 100 * intersection >= percent * union on full sets,
    and ``component_id`` is the smallest id that links reach.

    1. One pass over the texts gives every document a digest of its set, minima under many universal hash
       functions, one byte each as its signature, and the keys of its bands.
    2. Equal sets collapse to the least id by their digest; all later steps see distinct sets only.
    3. Members of a band bucket are compared by signature, in blocks of at most about BUCKET, each task emitting a
       spanning forest of the pairs that may reach the threshold.
    4. The components of those links are candidate groups.  Their texts are read again and compared exactly,
       in blocks of bounded size, each task emitting a spanning forest of true links, never pairs.
    5. Components of the true links.

    Null texts and texts without words have no set and are linked with nothing; so are rows without an id
    (component null, kept).  Equal ids count as one document that is linked with whatever any of its rows is.
    Extra columns are ignored.  No rows give no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("octets"),
    )
    sketches = cut_lineage(bounded_batches(rows).mapInArrow(
        _sketch(percent, width),
        "doc_id long, text_hash long, octets long, n_shingles long, key binary, signature binary, buckets array<long>",
    ))
    classes = cut_lineage(
        sketches.where("n_shingles > 0 and doc_id is not null").groupBy("key")
        .agg(F.min(F.struct("doc_id", "text_hash", "octets", "signature", "buckets")).alias("one"))
        .select("key", F.col("one.doc_id").alias("node"), "one.text_hash", "one.octets", "one.signature", "one.buckets")
    )
    places = classes.select("node", F.explode("buckets").alias("bucket"))
    sizes = places.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("blocks"), F.count("*").alias("n"))
    shared = cut_lineage(places.join(sizes.where("n > 1").drop("n"), "bucket"))
    signed = _deal(shared, "bucket", "blocks").join(classes.select("node", "signature"), "node")
    near = (
        signed.select("task", "node", "signature").repartition("task").sortWithinPartitions("task", "node")
        .mapInArrow(_signature_links(least_agreement(percent, band_count(percent) * ROWS)), "u long, v long")
    )
    groups = cut_lineage(connected_components(near.distinct()))
    members = groups.join(classes.select("node", "text_hash", "octets"), "node")
    totals = members.groupBy("component").agg(F.ceil(F.sum("octets") / BLOCK).cast("int").alias("blocks"))
    dealt = _deal(members.join(totals, "component"), "component", "blocks").select("node", "text_hash", "task")
    texts = rows.select(F.col("doc_id").alias("node"), "text_hash", "text")
    links = (
        texts.join(dealt, ["node", "text_hash"]).select("task", "node", "text").repartition("task")
        .sortWithinPartitions("task", "node").mapInArrow(_exact_links(percent, width), "u long, v long")
    )
    linked = connected_components(links)
    found = classes.select("key", "node").join(linked, "node", "left").select(
        "key", F.coalesce("component", "node").alias("component"))
    joined = sketches.select("doc_id", "n_shingles", "key").join(found, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """Rows of ``docs`` without the near copies of a smaller id; one row of each id that stays.

    Rows without an id stay.
    """
    found = near_duplicates(docs.select("doc_id", "text"), percent, width)
    kept = found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("__n"))
    rows = docs.join(kept, "doc_id").select(*[docs[c] for c in docs.columns], "__n")
    once = rows.where("__n = 1").drop("__n")
    again = rows.where("__n > 1").drop("__n").dropDuplicates(["doc_id"])
    return once.union(again).union(docs.where("doc_id is null"))
