"""Language identification by prediction by partial matching over bytes, with frozen per-language counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.streams import slices, utf8

#: Longest context in bytes; a gram (context and next byte) fits 32 bits.
ORDER = 3
#: Labelled texts learned from, about so many a language, chosen by a hash of the id.
SAMPLE_ROWS = 2_000
#: Most languages whose shares are broadcast; beyond them Spark joins as it sees fit.
LANGUAGES = 1_000
UNKNOWN = "und"
_BLOCK = 1 << 17


def _grams(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For every byte, itself and the ORDER bytes before it as one integer; zeros stand before a text."""
    out = data.astype(np.uint32)
    place = np.arange(len(data)) - np.repeat(rows[:-1], np.diff(rows))
    for back in range(1, ORDER + 1):
        before = np.zeros(len(data), np.uint32)
        before[back:] = data[:-back] if back < len(data) else 0
        before[place < back] = 0
        out |= before << np.uint32(8 * back)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, rows = utf8(part.column("text"))
            names = part.column("lang").cast(pa.string()).dictionary_encode()
            own = np.repeat(np.asarray(names.indices).astype(np.uint64) << np.uint64(32), np.diff(rows))
            found, n = np.unique(own | _grams(data, rows), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array((found >> np.uint64(32)).astype(np.int64))),
                 pa.array((found & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)],
                ["lang", "gram", "n"])


class _Sparse:
    """Numbers by integer key and language, from rows in the order of their keys; a key holds few languages."""

    def __init__(self, keys: np.ndarray, langs: np.ndarray, values: np.ndarray) -> None:
        self.keys, first = np.unique(keys.astype(np.uint32), return_index=True)
        self.at = np.append(first, len(keys))
        self.langs, self.values = langs.astype(np.uint16), values.astype(np.float32)

    def rows(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``wanted``, language, number) of all numbers that the wanted keys hold."""
        if not len(self.keys):
            return np.zeros(0, np.int64), self.langs, self.values
        i = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        place = np.flatnonzero(self.keys[i] == wanted)
        i = i[place]
        n = self.at[i + 1] - self.at[i]
        flat = np.arange(n.sum()) + np.repeat(self.at[i] - (np.cumsum(n) - n), n)
        return np.repeat(place, n), self.langs[flat], self.values[flat]


@dataclass(frozen=True)
class LanguageModel:
    """Per order the code lengths in bits of grams, and the escape lengths of contexts, in the languages that hold them."""

    langs: tuple[str, ...]
    codes: tuple[_Sparse, ...]
    escapes: tuple[_Sparse, ...]

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte in every language, built up from the shortest context.

        A language that holds the gram pays its code; one that does not pays its escape from the context, if it
        knows the context, and what the gram without its first byte costs.  Below order 0 all 256 bytes are alike.
        """
        out = np.full((len(grams), len(self.langs)), 8.0, np.float32)
        for order, (codes, escapes) in enumerate(zip(self.codes, self.escapes, strict=True)):
            own = grams & np.uint32((1 << 8 * (order + 1)) - 1)
            place, lang, value = escapes.rows(own >> np.uint32(8))
            out[place, lang] += value
            place, lang, value = codes.rows(own)
            out[place, lang] = value
        return out

    def totals(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Code length of each whole text in every language; a gram is looked up once a block."""
        grams = _grams(data, rows)
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        out = np.zeros((len(rows) - 1, len(self.langs)))
        for a in range(0, len(grams), _BLOCK):
            distinct, of = np.unique(grams[a : a + _BLOCK], return_inverse=True)
            bits, own = self.bits(distinct), owner[a : a + _BLOCK]
            for j in range(len(self.langs)):
                out[:, j] += np.bincount(own, bits[of, j], len(rows) - 1)
        return out


def build_model(lang: pa.Array, grams: np.ndarray, n: np.ndarray) -> LanguageModel:
    """Model from the counts ``n`` of longest grams in languages (each pair once).

    The counts of shorter grams follow from the longest, and nothing is dropped.  Escapes by method C: distinct
    next bytes against all counts.
    """
    names = lang.cast(pa.string()).dictionary_encode()
    langs = sorted(names.dictionary.to_pylist())
    place = np.array([langs.index(x) for x in names.dictionary.to_pylist()], np.uint64)
    own = place[np.asarray(names.indices)] if len(grams) else np.zeros(0, np.uint64)
    low, codes, escapes = np.uint64(16), [], []
    for order in range(ORDER + 1):
        keys = (grams.astype(np.uint64) & np.uint64((1 << 8 * (order + 1)) - 1)) << low | own
        found, of = np.unique(keys, return_inverse=True)
        count = np.bincount(of, n, len(found))
        who, gram = found & np.uint64(0xFFFF), found >> low
        contexts, of = np.unique((gram >> np.uint64(8)) << low | who, return_inverse=True)
        distinct = np.bincount(of, minlength=len(contexts))
        seen = np.bincount(of, count, len(contexts)) + distinct
        codes.append(_Sparse(gram, who, -np.log2(count / seen[of])))
        escapes.append(_Sparse(contexts >> low, contexts & np.uint64(0xFFFF), -np.log2(distinct / seen)))
    return LanguageModel(tuple(langs), tuple(codes), tuple(escapes))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row must not be learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def fit(docs: DataFrame, max_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Model from the whole texts of learnable rows with a language.

    About ``max_rows`` a language (a fixed share by hash of the id) are counted, by task and then by gram; all
    grams of those texts come to the driver as Arrow columns and go out as a broadcast.  Both are bounded by
    ``max_rows`` and the languages, whatever the corpus, and hold a number only where a language has the gram.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    shares = usable.groupBy(F.col("lang").alias("__lang")).agg((max_rows * 1_000_000 / F.count("*")).alias("__share"))
    if shares.count() <= LANGUAGES:
        shares = F.broadcast(shares)
    sample = usable.select("doc_id", "text", "lang").join(shares, F.col("lang") == F.col("__lang")).where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("__share"))
    counted = (
        sample.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().combine_chunks())
    return build_model(
        pa.concat_arrays(counted.column("lang").chunks) if counted.num_rows else pa.array([], pa.string()),
        counted.column("gram").to_numpy(), counted.column("n").to_numpy())


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, ...): (doc_id, held_out, lang_pred, score).

    The language with the least code length for the whole text; ties go to the first name.  ``score`` is its
    share of the probability that the languages give the text.  Null texts and texts without a letter, and
    every text if no language was learned, are ``und`` with score 0.  Rows never move; a slice of about a
    megabyte, or one text, is held at a time.  Extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                letters = np.asarray(pc.fill_null(pc.match_substring_regex(part.column("text"), r"\p{L}"), False))
                if own.langs:
                    bits = own.totals(*utf8(part.column("text")))
                    best = bits.argmin(axis=1)
                    odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                    names = [own.langs[j] if ok else UNKNOWN for j, ok in zip(best, letters, strict=True)]
                    score = np.where(letters, 1 / odds, 0.0)
                else:
                    names, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, rows.select("doc_id", "held_out").schema.add("lang_pred", "string").add("score", "double"))
