"""Periodic runs of words: block convolutions at dyadic scales locate repeats, their distances seed extensions."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache, cmp_to_key
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.streams import bounded_batches, slices

#: A prime with roots of unity of order 2**20; 128 products of its residues add up exactly in a double.
PRIME, GENERATOR, RADIX = 7 * 2**20 + 1, 3, 128
#: Words of the smallest and the largest block; larger distances are looked for by several windows a block.
LEAST_BLOCK, TOP_BLOCK = 8, 1 << 15
LEAST_LENGTH, LEAST_PERIODS = 24, 3
#: Words that are transformed at once.
CHUNK = 1 << 15

Run = tuple[int, int, int]


def _reduced(x: np.ndarray) -> np.ndarray:
    """Residues of ``x`` (integers under 2**53), in place; one off either end at most."""
    x -= np.floor(x * (1 / PRIME)) * PRIME
    return x


@cache
def _powers(order: int, rows: int, columns: int, inverse: bool) -> np.ndarray:
    """w ** (i * j) of a primitive root w of unity of ``order``."""
    w = pow(GENERATOR, (PRIME - 1) // order, PRIME)
    w = pow(w, -1, PRIME) if inverse else w
    table = np.empty(order, np.int64)
    table[0] = 1
    size = 1
    while size < order:
        table[size : 2 * size] = table[:size] * pow(w, size, PRIME) % PRIME
        size *= 2
    return table[np.outer(np.arange(rows), np.arange(columns)) % order].astype(np.float64)


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row of ``x`` (the inverse without its factor 1/n).

    The length is a power of two.  Up to RADIX it is one matrix product; beyond, columns and rows of a matrix
    are transformed in turn, with twiddle factors in between.
    """
    n = x.shape[1]
    if n <= RADIX:
        return _reduced(x @ _powers(n, n, n, inverse))
    inner = n // RADIX
    columns = x.reshape(-1, RADIX, inner).transpose(0, 2, 1).reshape(-1, RADIX)
    y = _reduced(columns @ _powers(RADIX, RADIX, RADIX, inverse)).reshape(-1, inner, RADIX)
    y = _reduced(y * _powers(n, inner, RADIX, inverse)).transpose(0, 2, 1).reshape(-1, inner)
    return transform(y, inverse).reshape(-1, RADIX, inner).transpose(0, 2, 1).reshape(-1, n)


def zero_mismatches(seq: np.ndarray, block: int, windows: range) -> tuple[np.ndarray, np.ndarray]:
    """Aligned blocks of ``seq`` and distances at which the squared differences to what follows add up to zero.

    For a window w the distances are w * block to (w + 1) * block - 1.  The sum of squares is
    known from running sums, the products from a cyclic convolution of length 2 * block.  Sums are exact
    modulo PRIME: no occurrence is missed, and callers compare words.
    """
    blocks = len(seq) // block
    pad = np.zeros((blocks + windows[-1] + 2) * block, np.float64)
    pad[: len(seq)] = seq % PRIME
    grid = pad.reshape(-1, block)
    squares = np.concatenate([[0.0], np.cumsum(_reduced(pad * pad))])
    step = max(1, CHUNK // block) if block < TOP_BLOCK else 64
    flip = -np.arange(2 * block) % (2 * block)
    sign = np.where(np.arange(2 * block) % 2, -1.0, 1.0)
    scale = pow(2 * block, -1, PRIME)
    found_blocks, found_distances = [], []
    for a in range(0, blocks, step):
        b = min(a + step, blocks)
        wide = np.zeros((b - a + windows[-1] + 1, 2 * block))
        wide[:, :block] = grid[a : b + windows[-1] + 1]
        spectra = transform(wide)
        own = spectra[: b - a, flip]
        heads = np.arange(a, b) * block
        power = squares[heads + block] - squares[heads]
        for w in windows:
            other = spectra[w : w + b - a] + sign * spectra[w + 1 : w + 1 + b - a]
            products = transform(_reduced(own * other), inverse=True)[:, :block]
            products = _reduced(products * float(scale))
            at = heads[:, None] + w * block + np.arange(block)
            rest = _reduced(power[:, None] + squares[at + block] - squares[at] - 2 * products)
            hit, lag = np.nonzero((rest == 0) | (rest == PRIME))
            distance = lag + w * block
            real = (distance > 0) & (heads[hit] + distance + block <= len(seq))
            found_blocks.append(hit[real] + a)
            found_distances.append(distance[real])
    return np.concatenate(found_blocks), np.concatenate(found_distances)


def _stretches(same: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def find_runs(seq: np.ndarray, lengths: np.ndarray) -> list[Run]:
    """Sorted (start, length, period) of all runs in texts of ``lengths`` words that lie end to end in ``seq``.

    Words are numbers that no two texts share, so no run crosses a border.  A run of period q holds an aligned
    block of the largest scale up to q together with its repeat q words on; blocks in a row with one
    distance are one piece, whose ends lie less than a block away and are compared word by word.
    """
    best: dict[tuple[int, int], int] = {}
    block, longest = LEAST_BLOCK, int(lengths.max(initial=0))
    while LEAST_PERIODS * block <= longest:
        place = np.flatnonzero(np.repeat(lengths >= LEAST_PERIODS * block, lengths))
        now = seq[place]
        last = longest // LEAST_PERIODS // block if block == TOP_BLOCK else 1
        blocks, distances = zero_mismatches(now, block, range(0 if block == LEAST_BLOCK else 1, max(last, 1) + 1))
        order = np.lexsort((blocks, distances))
        blocks, distances = blocks[order], distances[order]
        breaks = np.flatnonzero((np.diff(blocks) != 1) | (np.diff(distances) != 0))
        heads = np.append(0, breaks + 1)[: len(blocks)]
        tails = np.append(breaks, len(blocks) - 1)[: len(blocks)]
        lo, hi, d = blocks[heads] * block, (blocks[tails] + 1) * block, distances[heads]
        least = np.maximum(LEAST_LENGTH, LEAST_PERIODS * d)
        open_ = hi - lo + 2 * block - 2 + d >= least
        by_start = np.argsort(lo, kind="stable")
        starts = lo[by_start]
        for (start, length), period in best.items():
            # multiples of a known period within its run
            a = int(np.searchsorted(place, start))
            if a < len(place) and place[a] == start:
                some = by_start[np.searchsorted(starts, a) : np.searchsorted(starts, a + length)]
                open_[some[(hi[some] + d[some] <= a + length) & (d[some] % period == 0)]] = False
        for u, v, q in zip(lo[open_].tolist(), hi[open_].tolist(), d[open_].tolist(), strict=True):
            a, b = max(0, u - block), min(len(now) - q, v + block)
            for s, e in _stretches(now[a:b] == now[a + q : b + q]):
                if e - s + q >= max(LEAST_LENGTH, LEAST_PERIODS * q):
                    key = (int(place[a + s]), e - s + q)
                    best[key] = min(q, best.get(key, q))
        if block == TOP_BLOCK:
            break
        block *= 2
    return sorted((s, n, q) for (s, n), q in best.items())


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words of a text in which a stretch is repeated for a tenth of the ids; None leaves it as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + np.arange(n - a) % p
    return at


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def _stronger(x: Run, y: Run) -> int:
    return y[1] * x[2] - x[1] * y[2] or x[0] - y[0] or x[2] - y[2]


def run_lists(texts: list[bytes], ids: list[int | None]) -> Iterator[tuple[list[bytes], list[Run]]]:
    """Words and runs of each text; a text with an id first has its stretch planted."""
    all_words, codes, fresh = [], [], 0
    for text, doc_id in zip(texts, ids, strict=True):
        words = text.split()
        at = planted(doc_id, len(words))
        numbers = dict(zip(dict.fromkeys(words), count(fresh), strict=False))
        fresh += len(numbers)
        own = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        if at is not None:
            words, own = [words[i] for i in at.tolist()], own[at]
        all_words.append(words)
        codes.append(own)
    lengths = np.array([len(c) for c in codes], np.int64)
    found = find_runs(np.concatenate(codes) if codes else np.empty(0, np.int64), lengths)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    owners = np.searchsorted(begins, [s for s, _, _ in found], side="right") - 1
    per_text: list[list[Run]] = [[] for _ in texts]
    for (start, length, period), owner in zip(found, owners.tolist(), strict=True):
        per_text[owner].append((start - int(begins[owner]), length, period))
    yield from zip(all_words, per_text, strict=True)


FIELDS = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs", pa.string()), ("collapsed", pa.large_binary()),
])


def _run_rows(plant: bool, digest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            ids = part.column("doc_id").to_pylist()
            texts = [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]
            rows = []
            for doc_id, (words, runs) in zip(ids, run_lists(texts, ids if plant else [None] * len(ids)), strict=True):
                start, length, period = min(runs, key=cmp_to_key(_stronger)) if runs else (None, None, None)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
                rest = b" ".join(collapsed(words, runs))
                if digest:
                    listed = hashlib.sha256(listed.encode()).hexdigest()
                    rest = hashlib.sha256(rest).hexdigest().encode()
                rows.append((doc_id, len(runs), start, length, period, 1000 * length // period if runs else None, listed, rest))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(FIELDS)], schema=FIELDS)


def periodic_runs(docs: DataFrame, plant: bool = False, digest: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> one row for each row: its runs and its text without their repeats.

    A run is a stretch of at least 24 words and three periods, of smallest period q, that no neighbour extends.
    (n_runs; start, length, period, exponent_milli of the run with most periods, ties to the smallest start, then
    period, null without runs; runs, a ``start,length,period`` line each; collapsed, UTF-8 of the words that no
    run holds after its first period, joined by a space.)  ``digest`` gives SHA-256 in place of the last two.
    ``plant`` first repeats a stretch of a tenth of the texts, by a hash of the id.

    Texts are searched in slices of about a megabyte, within the stage of the scan; a text is never split, and
    memory grows with the longest.  Null, empty and blank texts have no runs; a row without an id is never
    planted; repeated rows each give their row; extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return bounded_batches(rows).mapInArrow(
        lambda batches: _run_rows(plant, digest, batches),
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs string, collapsed binary")


def run_digest(docs: DataFrame) -> DataFrame:
    found = periodic_runs(docs, plant=True, digest=True)
    return found.withColumnRenamed("runs", "runs_sha256").withColumn(
        "collapsed_sha256", F.col("collapsed").cast("string")).drop("collapsed")
