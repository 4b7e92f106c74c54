"""SimHash near-duplicates: fingerprints of word shingles, linked through sharded BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.components import connected_components
from mailsieve.llm.hot import join_spread
from mailsieve.llm.streams import bounded_batches, slices, whole_groups
from mailsieve.session import cut_lineage

WIDTH, SEED, RADIUS = 3, 42, 3
#: A shard over this size is dealt out again by further bits, down to the last level, where a mask leaves at most 16
#: bits open and so at most 65,536 fingerprints to a shard.
SHARD, OPEN_BITS = 4096, 16
#: Shingles that are hashed at once.
CHUNK = 1 << 16

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """64 votes of the XXH64 of all shingles, repeats included; a bit is set if over half of them have it."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], ends + 1])
    ends = np.append(ends, len(joined))
    span = min(width, len(words))
    starts, ends = starts[: len(words) - span + 1], ends[span - 1 :]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        pieces = [joined[a:b] for a, b in zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(seed)), np.dtype("<u8"), len(pieces))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(starts), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            values = np.array([fingerprint(t or b"") for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values)], ["doc_id", "print"])


class BKTree:
    """Fingerprints by Hamming distance: a child hangs on the edge that is its distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, int, dict] | None = None

    def add(self, value: int, place: int, radius: int = RADIUS) -> list[int]:
        """Insert ``value`` and return the places of those within ``radius`` that were there before."""
        if self.root is None:
            self.root = (value, place, {})
            return []
        found, todo = [], [self.root]
        while todo:
            other, at, children = todo.pop()
            d = (value ^ other).bit_count()
            if d <= radius:
                found.append(at)
            todo += [children[e] for e in range(d - radius, d + radius + 1) if e in children]
        _, _, children = self.root
        d = (value ^ self.root[0]).bit_count()
        while d in children:
            other, _, below = children[d]
            d, children = (value ^ other).bit_count(), below
        children[d] = (value, place, {})
        return found


def tree_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Pairs of places in ``values`` (distinct) that span all links within ``radius``, at most one less than values."""
    tree, root, out = BKTree(), list(range(len(values))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, value in enumerate(values):
        for j in tree.add(value, i, radius):
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                out.append((i, j))
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, bounds in whole_groups(batches, "shard"):
        signed = np.asarray(table.column("print"))
        plain = signed.view(np.uint64).tolist()
        pairs: list[tuple[int, int]] = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a > 1:
                pairs += [(a + i, a + j) for i, j in tree_links(plain[a:b])]
        ends = np.array(pairs, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(signed[ends[:, 0]]), pa.array(signed[ends[:, 1]])], ["u", "v"])


def finer_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """``mask`` with one of ``radius`` + 1 groups of its open bits each.

    Fingerprints that agree under ``mask`` and differ in at most ``radius`` bits agree under one of them too.
    """
    free = [b for b in range(64) if not mask >> b & 1]
    groups = np.array_split(free, radius + 1)
    return [mask | sum(1 << int(b) for b in g) for g in groups]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shard_prints(prints: DataFrame, shard: int = SHARD) -> DataFrame:
    """``prints`` (print long, distinct) -> (shard, print); any two within RADIUS share a shard.

    A shard holds the fingerprints that agree under a mask.  Four masks of 16 bits come first; the members of a
    shard over ``shard`` members go on to four finer masks each, until a mask leaves OPEN_BITS or fewer open.
    """
    spark = prints.sparkSession
    first = F.array(*[F.lit(_signed(m)).cast("long") for m in finer_masks(0)])
    placed = prints.select("print", F.explode(first).alias("mask"))
    out: DataFrame | None = None
    while True:
        placed = placed.withColumn("value", F.col("print").bitwiseAND(F.col("mask")))
        open_bits = 64 - F.bit_count("mask")
        wide = cut_lineage(placed.groupBy("mask", "value").agg(F.count("*").alias("n"))
                           .where((F.col("n") > shard) & (open_bits > OPEN_BITS)).select("mask", "value"))
        level = [r.mask for r in wide.select("mask").distinct().collect()]
        fine = placed.join(wide, ["mask", "value"], "left_anti") if level else placed
        fine = fine.select(F.xxhash64("mask", "value").alias("shard"), "print")
        out = fine if out is None else out.union(fine)
        if not level:
            return out
        # four rows for each mask of a level, 4 ** 6 at most
        finer = spark.createDataFrame(
            [(m, _signed(x)) for m in level for x in finer_masks(m & (2**64 - 1))], "mask long, finer long")
        placed = cut_lineage(placed.join(wide, ["mask", "value"], "left_semi").join(F.broadcast(finer), "mask")
                             .select("print", F.col("finer").alias("mask")))


def near_fingerprints(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> (doc_id, fingerprint, component_id), one row for each row.

    Words are runs of anything but ASCII blanks, A-Z lower-cased; a shingle is three of them (fewer make one), and
    all count, repeats included.  Fingerprints link at RADIUS or fewer differing bits; ``component_id`` is the
    smallest id that links reach.

    1. One pass over the texts gives fingerprints; equal ones collapse, so later steps see distinct ones.
    2. Distinct fingerprints are dealt into shards under masks such that two linked ones share a shard.  The shards
       are keyed rather than broadcast, because all trees together grow with the corpus.
    3. A task grows the BK-tree of a shard and searches it for each member, following only edges within RADIUS of
       its distance to the node.  It emits links that span the shard's links, fewer than members.
    4. Components by large-star and small-star over those links, then the least id of each.

    Null and empty texts and those without words have fingerprint zero and link like any other.  Rows without an id
    take part; their component is the least id reached, null if there is none.  Rows that repeat an id are rows
    of their own.  Extra columns are ignored.  No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = cut_lineage(bounded_batches(rows).mapInArrow(_fingerprints, "doc_id long, print long"))
    classes = cut_lineage(marked.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    sharded = shard_prints(classes.select("print"), shard).repartition("shard").sortWithinPartitions("shard", "print")
    groups = cut_lineage(connected_components(sharded.mapInArrow(_links, "u long, v long")))
    linked = classes.join(groups.withColumnRenamed("node", "print"), "print")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    reached = groups.join(least, "component").select(F.col("node").alias("print"), "component_id")
    named = cut_lineage(classes.join(reached, "print", "left").select(
        "print", "n", F.when(F.col("component_id").isNull(), F.col("least")).otherwise(F.col("component_id"))
        .alias("component_id")))
    return join_spread(marked, named.drop("n"), "print", classes.select("print", "n")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
