"""Phrase collocations by vertical partitioning: groups of word prefixes, a depth-truncated suffix subtree for each."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.shingles import mix, powers
from mailsieve.llm.streams import bounded_batches, slices, utf8, whole_groups
from mailsieve.scale import top_per_key
from mailsieve.session import cut_lineage, release

DEPTH, LEAST, COVER = 4, 30, 80
#: Suffixes that a group of prefixes holds at most, unless the corpus needs more than CELLS groups for that.
BUDGET, CELLS = 1 << 16, 1 << 16
#: Bits of the two maps that say which words and pairs are frequent; they are as large for any corpus.
WORD_BITS, PAIR_BITS = 24, 25
#: Bytes of text whose suffixes are put together before they leave a task.
SLICE = 2 << 20
#: Words longer than this are hashed one by one.
LONG = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Kinds of bytes: 0 in a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.int8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

NO_LANGUAGE = "und"


def _number(value: bytes, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(value, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")


class Words:
    """Words of a slice of texts: key (of language and word), place in the bytes, and piece of each."""

    def __init__(self, part: pa.RecordBatch, seed: int) -> None:
        data, rows = utf8(part.column("text"))
        self.data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = rows[:-1][rows[:-1] < len(data)]
        begins[heads] = inside[heads]
        at = np.flatnonzero(inside)
        self.starts = np.flatnonzero(begins)
        first = np.searchsorted(at, self.starts)
        self.lengths = np.diff(np.append(first, len(at)))
        owner = np.searchsorted(rows, self.starts, side="right") - 1
        breaks = np.cumsum(kind == 2)
        self.pieces = owner + (breaks[self.starts] if len(breaks) else 0)
        languages = pc.fill_null(part.column("lang"), NO_LANGUAGE).dictionary_encode()
        names = languages.dictionary.to_pylist()
        salts = np.array([_number(n.encode(), seed) for n in names], np.uint64)
        self.languages, self.names = np.asarray(languages.indices)[owner], names
        if not len(self.starts):
            self.keys = np.empty(0, np.uint64)
            return
        codes = mix(np.arange(1, 257, dtype=np.uint64) * _ODD ^ np.uint64(_number(b"", seed)))
        place = np.minimum(np.arange(len(at)) - np.repeat(first, self.lengths), LONG)
        hashes = np.add.reduceat(codes[self.data[at]] * powers(LONG + 1)[place], first)
        for i in np.flatnonzero(self.lengths > LONG).tolist():
            hashes[i] = _number(self.data[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes(), seed)
        self.keys = mix(mix(hashes ^ self.lengths.astype(np.uint64)) ^ salts[self.languages])
        self.keys[self.keys == 0] = 1

    def texts(self, chosen: np.ndarray) -> pa.Array:
        """The words at ``chosen`` as strings."""
        sizes = self.lengths[chosen]
        ends = np.cumsum(sizes)
        flat = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[chosen] - (ends - sizes), sizes)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(self.data[flat].tobytes())]
        return pa.Array.from_buffers(pa.large_string(), len(chosen), buffers).cast(pa.string())


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64 bits of a pair of word keys; the prefix of a suffix is known by them where collisions do no harm."""
    return mix(first * _ODD ^ mix(second))


def _marked(bitmap: bytes, bits: int, keys: np.ndarray) -> np.ndarray:
    cells = keys >> np.uint64(64 - bits)
    return np.frombuffer(bitmap, np.uint8)[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8) & 1 == 1


def _frequent_pairs(words: Words, bitmap: bytes) -> np.ndarray:
    """Whether a word and the next stand in one piece and may both be frequent."""
    known = _marked(bitmap, WORD_BITS, words.keys)
    return known[:-1] & known[1:] & (words.pieces[:-1] == words.pieces[1:])


def _count_words(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(part, seed)
                keys, chosen, n = np.unique(words.keys, return_index=True, return_counts=True)
                names = pa.array(words.names, pa.string()).take(pa.array(words.languages[chosen]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), names, words.texts(chosen), pa.array(n)], ["key", "lang", "word", "n"])

    return run


def _pairs(seed: int, frequent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(part, seed)
                if len(words.keys) > 1:
                    at = np.flatnonzero(_frequent_pairs(words, frequent.value))
                    signed = words.keys.view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(signed[at]), pa.array(signed[at + 1])], ["k1", "k2"])

    return run


def _suffixes(seed: int, frequent, pairs, bounds: np.ndarray, heavy: np.ndarray):
    """Suffixes of three or four words that a candidate may begin, with their group and count.

    A suffix ends before the first pair that cannot be frequent: nothing below that node is read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(part, seed)
                keys = words.keys
                if len(keys) < 3:
                    continue
                prefix = pair_keys(keys[:-1], keys[1:])
                active = _frequent_pairs(words, frequent.value) & _marked(pairs.value, PAIR_BITS, prefix)
                at = np.flatnonzero(active[:-1] & active[1:])
                full = at + 2 < len(active)
                full[full] = active[at[full] + 2]
                path = np.zeros((len(at), DEPTH), np.uint64)
                for j in range(3):
                    path[:, j] = keys[at + j]
                path[full, 3] = keys[at[full] + 3]
                own = prefix[at]
                split = np.isin(own, heavy)
                own[split] = pair_keys(own[split], path[split, 2])
                order = np.lexsort(path.T[::-1])
                path, own = path[order], own[order]
                new = np.ones(len(at), bool)
                new[1:] = (path[1:] != path[:-1]).any(axis=1)
                heads = np.flatnonzero(new)
                n = np.diff(np.append(heads, len(at)))
                group = np.searchsorted(bounds, own[heads] >> np.uint64(48), side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group.astype(np.int32)), *[pa.array(path[heads, j].view(np.int64)) for j in range(DEPTH)],
                     pa.array(n)], ["tree", "k1", "k2", "k3", "k4", "n"])

    return run


def subtree_counts(path: np.ndarray, n: np.ndarray, least: int = LEAST) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nodes three and four words deep with at least ``least`` suffixes, of the suffix subtree over ``path``.

    ``path`` has a suffix a row, its words by key, ending in 0 if it has three only; ``n`` counts it.  Sorted
    suffixes are the leaves in order; a node is a range of leaves with a common beginning, its count
    the total of their counts.
    """
    order = np.lexsort(path.T[::-1])
    path, n = path[order], n[order]
    new = np.zeros(len(path), bool)
    new[:1] = True
    out = []
    for depth in range(DEPTH):
        new[1:] |= path[1:, depth] != path[:-1, depth]
        if depth >= 2 and len(path):
            heads = np.flatnonzero(new)
            totals = np.add.reduceat(n, heads)
            kept = (totals >= least) & (path[heads, depth] != 0)
            out.append((path[heads[kept], : depth + 1], totals[kept]))
    return out


def _grow(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, "tree"):
            path = np.stack([np.asarray(table.column(f"k{j + 1}")) for j in range(DEPTH)], axis=1)
            n = np.asarray(table.column("n"))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                for nodes, totals in subtree_counts(path[a:b], n[a:b], least):
                    size = nodes.shape[1]
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(nodes) + 1, dtype=np.int32) * size), pa.array(nodes.ravel()))
                    yield pa.RecordBatch.from_arrays([lists, pa.array(totals)], ["keys", "f"])

    return run


def _bitmap(cells: DataFrame, bits: int) -> bytes:
    """Bit map of ``cells`` (cell long) of 2 ** bits bits: the driver gets 64 cells a row, so never more than the map."""
    words = cells.select((F.col("cell") / 64).cast("long").alias("w"), F.expr("shiftleft(1L, cast(cell % 64 AS int))").alias("b"))
    table = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[np.asarray(table.column("w"))] = np.asarray(table.column("b"))
    return out.tobytes()


def _top_bits(key: str | Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits)


def _pair_hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.asarray(batch.column(c)).view(np.uint64) for c in ("k1", "k2"))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("k1", "k2", "f")], pa.array(pair_keys(a, b).view(np.int64))],
            ["k1", "k2", "f", "prefix"])


def word_counts(docs: DataFrame) -> tuple[DataFrame, int]:
    """(key, lang, word, n) of all words, and the seed under which no two words of a language share a key.

    Keys are 64-bit hashes; a collision would mix two words up, so it is looked for and another seed tried.
    """
    seed = 0
    while True:
        words = cut_lineage(docs.mapInArrow(_count_words(seed), "key long, lang string, word string, n long")
                            .groupBy("key", "lang", "word").agg(F.sum("n").alias("n")))
        shared = words.groupBy("key").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
        if shared < 2:
            return words, seed
        release(words)
        seed += 1


def phrase_counts(docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Words (key, lang, word, n) and phrases (keys, f) of one to four words that occur ``least`` times or more.

    1. Words are counted.  Nothing that holds a rarer word can be frequent, so a map of fixed size marks the frequent.
    2. Prefixes of two words are counted where both words are marked: their counts are the vertical partition.
       Ranges of prefix hashes are put together into groups of at most ``budget`` suffixes (more only if that took
       more than CELLS groups); a prefix over the budget is dealt out by its third word.
    3. Suffixes go to the group of their prefix, four words deep at most and no deeper than pairs are frequent, equal
       ones of a slice as one row with its count.  Each group's subtree is grown on its own.
    """
    spark = docs.sparkSession
    words, seed = word_counts(docs)
    known = words.where(F.col("n") >= least)
    marks = spark.sparkContext.broadcast(_bitmap(known.select(_top_bits("key", WORD_BITS).alias("cell")), WORD_BITS))
    pairs = cut_lineage(
        docs.mapInArrow(_pairs(seed, marks), "k1 long, k2 long").groupBy("k1", "k2").agg(F.count("*").alias("f"))
        .where(F.col("f") >= least).mapInArrow(_pair_hash_rows, "k1 long, k2 long, f long, prefix long"))
    open_pairs = spark.sparkContext.broadcast(
        _bitmap(pairs.select(_top_bits("prefix", PAIR_BITS).alias("cell")), PAIR_BITS))
    loads = {r.cell: r.f for r in pairs.groupBy(_top_bits("prefix", 16).alias("cell")).agg(F.sum("f").alias("f")).collect()}
    limit = max(budget, -(-sum(loads.values()) // CELLS))
    heavy = np.array([r.prefix for r in pairs.where(F.col("f") > limit).select("prefix").collect()], np.int64)
    bounds, held = [], 0
    for cell in sorted(loads):
        if held and held + loads[cell] > limit:
            bounds.append(cell)
            held = 0
        held += loads[cell]
    dealt = docs.mapInArrow(
        _suffixes(seed, marks, open_pairs, np.array(bounds, np.uint64), heavy.view(np.uint64)),
        "tree int, k1 long, k2 long, k3 long, k4 long, n long")
    deep = dealt.repartition("tree").sortWithinPartitions("tree").mapInArrow(_grow(least), "keys array<long>, f long")
    phrases = cut_lineage(
        known.select(F.array("key").alias("keys"), F.col("n").alias("f"))
        .union(pairs.select(F.array("k1", "k2"), "f")).union(deep))
    marks.destroy()
    open_pairs.destroy()
    release(pairs)
    return words, phrases


def collocations(docs: DataFrame, top: int | None = 2000, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """``docs`` (text, lang, ...) -> (lang, rank, phrase, a, l, r, n, score): the collocations of each language.

    Words are runs of anything but space and tab within pieces, which end at ``. , ; : ! ?`` and line ends; A-Z are
    lower-cased.  A candidate has two to four words and occurs ``least`` times or more within pieces, a times.  A
    cut after k words gives l and r, the counts of both sides, and floor(2000000 a / (l + r)); the lowest counts,
    ties to the smallest k.  A candidate is dropped if a longer one that contains it has 80 % of its
    count.  Ranks go by score, a (both descending) and phrase; ``top`` None gives all.  n counts the language's words.

    Both sides of a cut are as frequent as the candidate, so all counts needed are among the phrases.  Products are
    decimals.  A null language is ``und``, null and empty texts have no words, repeated rows count again, extra
    columns are ignored, no rows give no rows.
    """
    words, phrases = phrase_counts(bounded_batches(docs.select("text", "lang")), least, budget)
    longer = phrases.where(F.size("keys") > 1)
    cuts = longer.select("keys", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(keys) - 1)")).alias("k")).select(
        "keys", "a", "k", F.expr("slice(keys, 1, k)").alias("left"), F.expr("slice(keys, k + 1, size(keys) - k)").alias("right"))
    counts = phrases.select(F.col("keys").alias("side"), "f")
    split = (
        cuts.join(counts.select(F.col("side").alias("left"), F.col("f").alias("l")), "left")
        .join(counts.select(F.col("side").alias("right"), F.col("f").alias("r")), "right")
        .withColumn("score", F.expr("(cast(a AS decimal(38, 0)) * 2000000) div (cast(l AS decimal(38, 0)) + r)"))
    )
    scored = split.groupBy("keys").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr(
        "flatten(transform(sequence(2, size(keys) - 1), m ->"
        " transform(sequence(1, size(keys) - m + 1), p -> slice(keys, p, m))))")
    covers = longer.where(F.size("keys") > 2).select(F.explode(inner).alias("keys"), "f").groupBy("keys").agg(
        F.max("f").alias("cover"))
    covered = (F.col("cover").cast("decimal(38, 0)") * 100) >= (F.col("a").cast("decimal(38, 0)") * COVER)
    kept = scored.join(covers, "keys", "left").where(~F.coalesce(covered, F.lit(False))).select("keys", "a", "cut")
    named = (
        kept.select("keys", "a", "cut", F.posexplode("keys").alias("at", "key"))
        .join(words.where(F.col("n") >= least).select("key", "lang", "word"), "key")
        .groupBy("keys").agg(
            F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("cut").alias("cut"),
            F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
        .select("lang", F.array_join("parts.word", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = top_per_key(named, ["lang"], order, top if top is not None else 2**31 - 1)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
