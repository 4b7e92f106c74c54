"""Near-duplicates over a whole corpus: an exact set-similarity join by prefix and sketch filter, then a greedy choice."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain, groupby, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from mailsieve.session import bounded_batches, cut_lineage, release

_TOKEN = re.compile(rb"[a-z0-9]+")
#: Token places are counted in so many slots by the token's CRC-32; only these counts are sent to every task.
SLOTS = 1 << 18
#: Longs of a sketch.
WORDS = 4
#: Tokens in a cell of sets, where a set counts as SET more; two cells meet in a task.
CELL, SET = 1 << 18, 128
#: Rounds in which a set takes over the least name that its neighbours know; more make fewer, larger groups.
ROUNDS = 3
#: Bits of the filter that keeps most texts without candidates out of the shuffle, in longs.
FILTER = 1 << 16


def _token_codes(text: bytes | None) -> tuple[set[bytes], np.ndarray]:
    """Distinct tokens of a lower-cased text and their CRC-32."""
    toks = set(_TOKEN.findall(text or b""))
    return toks, np.fromiter(map(crc32, toks), np.uint32, len(toks))


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            np.add.at(counts, _token_codes(text.as_py())[1] % SLOTS, 1)
    slots = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], ["slot", "n"])


def slot_counts(texts: DataFrame) -> np.ndarray:
    """How many texts have a token, added up over the tokens of a slot."""
    found = texts.select("text").mapInArrow(_count_slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS, np.int64)
    counts[found["slot"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def _signatures(counts, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = counts.value
        for batch in batches:
            digests, sizes, sketches, prefixes = [], [], [], []
            for text in batch.column("text"):
                toks, codes = _token_codes(text.as_py())
                n = len(toks)
                sizes.append(n)
                digests.append(hashlib.blake2b(b" ".join(sorted(toks)), digest_size=16).digest() if n else None)
                odd = np.bincount(codes >> np.uint32(24), minlength=64 * WORDS).astype(np.uint8) & 1
                sketches.append(np.packbits(odd).view(np.int64))
                order = np.lexsort((codes, places[codes % SLOTS]))
                prefixes.append(codes[order[: n - (percent * n + 99) // 100 + 1]].view(np.int32))
            at = np.concatenate([[0], np.cumsum([len(p) for p in prefixes], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int32)
            bits = np.array(sketches, np.int64).reshape(-1, WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("text_hash"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(WORDS)],
                 pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                ["key", "text_hash", "digest", "n", *[f"s{i}" for i in range(WORDS)], "prefix"])

    return run


def candidate_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """``classes`` (class_id, n, s0.., prefix) -> (a, b, na, nb): all pairs of sets that may reach ``percent``, each once.

    Two such sets share a token among the first n - ceil(percent n / 100) + 1 of each.  Those prefixes, rare tokens
    first, are joined by the token's code.  A pair goes on only while what is left after the shared token can still
    reach the threshold, and while their sketches (parity of the tokens by code) differ in no more bits than the sets may
    differ in tokens.  If the codes before are equal too, the pair is met there.
    """
    placed = classes.select(
        "class_id", "n", *[f"s{i}" for i in range(WORDS)], "prefix", F.posexplode("prefix").alias("pos", "tok")
    ).withColumn("prev", F.get("prefix", F.col("pos") - 1)).drop("prefix")
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    first = (x("n") < y("n")) | ((x("n") == y("n")) & (x("class_id") < y("class_id")))
    both = x("n") + y("n")
    long_enough = x("n") * 100 >= y("n") * percent
    reach = F.least(x("n") - x("pos"), y("n") - y("pos")) * (100 + percent) >= both * percent
    differ = sum((F.bit_count(x(f"s{i}").bitwiseXOR(y(f"s{i}"))) for i in range(1, WORDS)), F.bit_count(x("s0").bitwiseXOR(y("s0"))))
    alike = differ * (100 + percent) <= both * (100 - percent)
    new = F.coalesce(x("prev") != y("prev"), F.lit(True))
    met = placed.alias("x").join(placed.alias("y"), (x("tok") == y("tok")) & first & long_enough & reach & alike & new)
    return met.where(x("class_id") != y("class_id")).select(
        x("class_id").alias("a"), y("class_id").alias("b"), x("n").alias("na"), y("n").alias("nb")).distinct()


def deal_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b, na, nb) -> (class_id, cell, low, high): the tasks (low, high) in which a set is compared.

    A set belongs to a cell of the group that has the least name near it; a group has as many cells as it has CELL
    tokens.  The sets of a pair meet in the one task of their two cells, so a set of a tight group of any size goes out
    once for each cell of that group, and a task holds no more than two cells.
    """
    ends = pairs.select("a", "b", "na").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("nb").alias("na")))
    nodes = cut_lineage(ends.groupBy("a").agg(F.least("a", F.min("b")).alias("head"), F.max("na").alias("n")))
    for _ in range(ROUNDS - 1):
        last = nodes
        near = ends.join(last.select(F.col("a").alias("b"), "head"), "b").groupBy("a").agg(F.min("head").alias("near"))
        nodes = cut_lineage(last.join(near, "a").select("a", F.least("head", "near").alias("head"), "n"))
        release(last)
    sizes = nodes.groupBy("head").agg(F.ceil(F.sum(F.col("n") + SET) / CELL).alias("cells"))
    cells = cut_lineage(nodes.join(sizes, "head").select("a", F.xxhash64("head", F.pmod(F.xxhash64("a"), "cells")).alias("cell")))
    release(nodes)
    others = ends.select("a", "b").join(cells.select(F.col("a").alias("b"), F.col("cell").alias("other")), "b")
    return others.select("a", "other").distinct().join(cells, "a").select(
        F.col("a").alias("class_id"), "cell", F.least("cell", "other").alias("low"), F.greatest("cell", "other").alias("high"))


def _kept_sets(bits) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, text_hash, bit, text) -> (key, text_hash, toks) of those whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("bit").to_numpy()
            kept = batch.filter(pa.array((bits.value[at >> 6] >> (at & 63)) & 1 == 1))
            toks = [b" ".join(_token_codes(text.as_py())[0]) for text in kept.column("text")]
            yield pa.RecordBatch.from_arrays(
                [kept.column("key"), kept.column("text_hash"), pa.array(toks, pa.binary())], ["key", "text_hash", "toks"])

    return run


def sets_of(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    """Token sets of the rows that ``tasks`` (key, text_hash, ...) names, with its columns.

    Only texts that pass a filter of FILTER longs, one bit for each row of ``tasks``, are shuffled.
    """
    bit = F.pmod(F.xxhash64("key", "text_hash"), F.lit(64 * FILTER)).alias("bit")
    set_bits = tasks.select(bit).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toPandas()
    words = np.zeros(FILTER, np.int64)
    words[set_bits["word"].to_numpy(np.int64)] = set_bits["bits"].to_numpy(np.int64)
    kind = rows.schema["key"].dataType.simpleString()
    kept = rows.select("key", "text_hash", bit, "text").mapInArrow(
        _kept_sets(rows.sparkSession.sparkContext.broadcast(words)), f"key {kind}, text_hash long, toks binary")
    return kept.join(tasks, ["key", "text_hash"])


def _links(percent: int, kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (low, high, cell, class_id, toks), sorted by task -> all links (u, v) between its cells, or in its one cell."""

    schema = pa.schema([("u", kind), ("v", kind)])

    def compared(low: int, high: int, rows: Iterator[tuple]) -> Iterator[dict]:
        sets: dict[int, list[tuple]] = {low: [], high: []}
        for _, _, cell, node, toks in rows:
            own = set(toks.split())
            sets[cell].append((len(own), node, own))
        left, right = (sorted(sets[c], key=lambda r: r[:2]) for c in (low, high))
        start = 0
        for i, (n, u, own) in enumerate(left):
            while start < len(right) and right[start][0] * 100 < n * percent:
                start += 1
            for m, v, other in right[max(start, i + 1) if low == high else start :]:
                if n * 100 < m * percent:
                    break
                shared = len(own & other)
                if u != v and shared * 100 >= (n + m - shared) * percent:
                    yield {"u": min(u, v), "v": max(u, v)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)
        for (low, high), group in groupby(rows, key=lambda r: r[:2]):
            found = compared(low, high, group)
            while part := list(islice(found, 65_536)):
                yield pa.RecordBatch.from_pylist(part, schema)

    return run


def greedy_dropped(links: DataFrame) -> DataFrame:
    """(v): nodes that a greedy pass in ascending order drops, as some kept node below them is linked to them.

    In a round every node without a lower neighbour stays, what is linked to those goes, and links of nodes that are
    decided go too.  Rounds are as many as the longest chain of such decisions; each is a written table.
    """
    spark = links.sparkSession
    now = cut_lineage(links.select("u", "v").distinct())
    out = spark.createDataFrame([], links.select("v").schema)
    while not now.isEmpty():
        heads = now.select("u").distinct().join(now.select(F.col("v").alias("u")).distinct(), "u", "left_anti")
        gone = cut_lineage(now.join(heads, "u").select("v").distinct())
        out = out.union(gone)
        last = now
        now = cut_lineage(last.join(gone, "v", "left_anti").join(gone.select(F.col("v").alias("u")), "u", "left_anti"))
        release(last)
    return out


def corpus_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 90) -> DataFrame:
    """``df`` -> (key, class_id, n_links, kept): near-duplicates over the whole table, exact.

    ``class_id`` is the least key with the same set of tokens, ``n_links`` how many other sets have a Jaccard
    similarity of at least ``percent`` in 100, and ``kept`` whether a greedy pass by ascending key keeps the row: the
    least of its class, linked with no class kept before.  Texts without tokens have no links and stay.
    Rows without a key are left out; keys should be distinct.

    Sets are never shuffled for the search, only their signatures: digest, size, sketch, prefix.  Texts are read again for
    the sets that have candidates, and whole sets of tokens are compared, cell by cell.
    """
    kind = df.schema[key].dataType
    name = kind.simpleString()
    rows = bounded_batches(df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"),
        F.lower(F.coalesce(text, F.lit(""))).cast("binary").alias("text")))
    counts = df.sparkSession.sparkContext.broadcast(slot_counts(rows))
    marks = ", ".join(f"s{i} long" for i in range(WORDS))
    signed = cut_lineage(rows.mapInArrow(
        _signatures(counts, percent), f"key {name}, text_hash long, digest binary, n long, {marks}, prefix array<int>"))
    names = ["n", *[f"s{i}" for i in range(WORDS)], "prefix"]
    classes = cut_lineage(signed.where("n > 0").groupBy("digest").agg(F.min(F.struct("key", *names)).alias("one")).select(
        "digest", F.col("one.key").alias("class_id"), *[f"one.{c}" for c in names]))
    named = cut_lineage(signed.where("n > 0").select("key", "text_hash", "digest").join(classes.select("digest", "class_id"), "digest")
        .select("key", "text_hash", "class_id", F.lit(True).alias("full"))
        .unionByName(signed.where("n = 0").select("key", "text_hash", F.col("key").alias("class_id"), F.lit(False).alias("full"))))
    release(signed)
    counts.unpersist()
    pairs = cut_lineage(candidate_pairs(classes, percent))
    heads = named.where("full and key = class_id").select("class_id", "text_hash").distinct()
    tasks = cut_lineage(deal_pairs(pairs).join(heads, "class_id").withColumnRenamed("class_id", "key"))
    links = cut_lineage(
        sets_of(rows, tasks).select("low", "high", "cell", "key", "toks").repartition("low", "high")
        .sortWithinPartitions("low", "high").mapInArrow(_links(percent, to_arrow_type(kind)), f"u {name}, v {name}"))
    for used in (classes, pairs, tasks):
        release(used)
    ends = links.select(F.explode(F.array("u", "v")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    dropped = greedy_dropped(links).select(F.col("v").alias("class_id"), F.lit(True).alias("gone"))
    joined = named.select("key", "class_id").join(ends, "class_id", "left").join(dropped, "class_id", "left")
    return joined.select(
        F.col("key").alias(key), "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        ((F.col("key") == F.col("class_id")) & F.col("gone").isNull()).alias("kept"))
