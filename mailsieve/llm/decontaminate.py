"""Benchmark decontamination by winnowed fingerprints, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.hot import join_spread
from mailsieve.session import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything between words: all of ASCII but digits and (lower-case) letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

WINDOW = 10
GRAM = 6
#: Cells that digests of texts with a fingerprint in common are marked in; the table of them has no more rows.
CELLS = 1 << 18


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; texts that are all ASCII take the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _gram_hashes(words: Column, size: int, salt: int) -> Column:
    """Hash of the ``size`` words from each place on."""
    places = F.slice(words, F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(0)))
    return F.transform(
        places, lambda w, i: F.xxhash64(F.lit(salt), w, *[F.get(words, i + j) for j in range(1, size)]))


def _winnowed(hashes: Column, span: int) -> Column:
    """Least hash of each run of ``span`` hashes, without repeats."""
    runs = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (span - 1), F.lit(0)))
    if span == 1:
        return F.array_distinct(runs)
    return F.array_distinct(
        F.transform(runs, lambda h, i: F.least(h, *[F.get(hashes, i + j) for j in range(1, span)])))


def _same_from_start(a: Column, b: Column, most: int) -> Column:
    """How many elements of two arrays agree before the first that doesn't."""
    out = F.lit(0)
    for j in reversed(range(most)):
        out = F.when(F.get(a, F.lit(j)) == F.get(b, F.lit(j)), 1 + out).otherwise(F.lit(0))
    return out


def _around(words: Column, at: Column, size: int, reach: int) -> list[Column]:
    """The words of a gram at 0-based place ``at``, those before it (nearest first) and those after it."""
    first = F.greatest(at - reach, F.lit(0))
    return [
        F.slice(words, at + 1, F.lit(size)).alias("gram"),
        F.reverse(F.slice(words, first + 1, at - first)).alias("left"),
        F.slice(words, at + size + 1, F.lit(reach)).alias("right"),
    ]


def benchmark_anchors(items: DataFrame, window: int, gram: int) -> tuple[DataFrame, list[int]]:
    """Fingerprints of ``items`` (item_id, text) with the words around them, and the lengths of short items.

    A short item (fewer words than ``window``) is one gram as long as itself.
    """
    listed = cut_lineage(
        items.select("item_id", words_of(F.col("text")).alias("words"))
        .withColumn("n", F.size("words")).where("n > 0"))
    short = sorted(r.n for r in listed.where(F.col("n") < window).select("n").distinct().collect())
    words, parts = F.col("words"), []
    hashed = listed.where(F.col("n") >= window).withColumn("hashes", _gram_hashes(words, gram, gram))
    picked = hashed.withColumn("wanted", _winnowed(F.col("hashes"), window - gram + 1))
    placed = picked.select("item_id", "words", "wanted", F.posexplode("hashes").alias("at", "hash"))
    parts.append(placed.where(F.array_contains("wanted", F.col("hash"))).select(
        "hash", "item_id", F.lit(window).alias("need"), *_around(words, F.col("at"), gram, window - gram)))
    for n in short:
        parts.append(listed.where(F.col("n") == n).select(
            F.get(_gram_hashes(words, n, -n), F.lit(0)).alias("hash"), "item_id", F.lit(n).alias("need"),
            words.alias("gram"), F.array().cast("array<string>").alias("left"),
            F.array().cast("array<string>").alias("right")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return cut_lineage(out.distinct()), short


def _matches(docs: DataFrame, items: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` its words' count and a digest of its text; per digest with hits, the hits."""
    anchors, short = benchmark_anchors(items, window, gram)
    words, reach = F.col("words"), window - gram
    # of equal texts one is worked on; keyed by its id too, copies of a text are never dealt to one task
    text = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("one")).withColumn(
        "key", F.unhex(F.md5("text")))
    prints = F.array_distinct(F.concat(
        _winnowed(F.col("hashes"), window - gram + 1),
        *[F.array_distinct(_gram_hashes(words, n, -n)) for n in short],
    ))
    rows = cut_lineage(
        text.select("doc_id", "one", "key", words_of(F.col("text")).alias("words"))
        .withColumn("hashes", _gram_hashes(words, gram, gram))
        .select("doc_id", "one", "key", F.size("words").cast("long").alias("n_words"), prints.alias("prints")))
    wanted = cut_lineage(anchors.select("hash").distinct())
    met = (
        rows.select("one", "key", F.explode("prints").alias("hash")).join(wanted, "hash")
        .groupBy("key").agg(F.collect_set("hash").alias("met"), F.min("one").alias("one")))
    met = cut_lineage(met)
    # most texts are told from those that met something by the cell of their digest and never shuffled
    cell = F.pmod(F.xxhash64("key"), F.lit(CELLS))
    cells = F.broadcast(met.select(cell.alias("cell")).distinct())
    opened = text.withColumn("cell", cell).join(cells, "cell", "left_semi").join(met, ["key", "one"]).select("key", "met", words_of(F.col("text")).alias("words"))
    found = None
    for size, salt in [(gram, gram), *((n, -n) for n in short)]:  # a short item can be as long as a gram
        hashed = opened.withColumn("hashes", _gram_hashes(words, size, salt))
        at = F.filter(
            F.transform("hashes", lambda h, i: F.when(F.array_contains("met", h), i)), lambda i: i.isNotNull())
        placed = hashed.select("key", "words", "hashes", F.explode(at).alias("at"))
        part = placed.select(
            "key", "at", F.get("hashes", F.col("at")).alias("hash"),
            *_around(words, F.col("at"), size, reach if salt > 0 else 0))
        found = part if found is None else found.union(part)
    a, b = found.distinct().alias("a"), anchors.alias("b")
    met_words = a.join(b, (F.col("a.hash") == F.col("b.hash")) & (F.col("a.gram") == F.col("b.gram")))
    before = _same_from_start(F.col("a.left"), F.col("b.left"), reach)
    after = _same_from_start(F.col("a.right"), F.col("b.right"), reach)
    spans = met_words.select(
        "a.key", "b.item_id", "b.need", (F.col("a.at") - before).alias("start"),
        (F.col("a.at") + F.size("a.gram") + after).alias("stop"),
    ).where("stop - start >= need")
    covered = F.flatten(F.transform(
        F.collect_set(F.struct("start", "stop")), lambda s: F.sequence(s["start"], s["stop"] - 1)))
    hits = spans.groupBy("key").agg(
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return rows, hits


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, ...) with its words inside windows of ``items``
    (item_id, text, ...).

    Words are runs of digits, letters a-z (A-Z lower-cased) and anything beyond ASCII.  A window is ``window``
    consecutive words of an item; an item with fewer words, but not none, is one window.  A document's word is
    hit if it lies in an occurrence of a window.

    Every text keeps the least hash of its ``gram``-word grams in each run of ``window - gram + 1``, so a
    document and an item that share ``window`` words share a fingerprint.  Fingerprints are joined; the join
    is broadcast only while the benchmark's file is under Spark's threshold, else both sides are shuffled.
    Texts that met one are read again, and each hit is checked word by word and extended to both sides by up
    to ``window - gram`` words: all that a window holding the fingerprint can reach.  Short items are met by a
    gram of their own length.

    Equal texts are worked on once from the fingerprints on.  Null or wordless texts have no words and no
    hits; a null item_id hits but is not listed; rows that repeat, and items that repeat an id, count once in
    ``items``.  Empty tables give no rows, or rows without hits.  Extra columns are ignored.
    """
    rows, hits = _matches(docs, items, window, gram)
    n_hit, ids = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return join_spread(rows.select("doc_id", "n_words", "key"), cut_lineage(hits), "key").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Rows of ``docs`` without those that hold a window of ``items``; repeated rows all stay or all go.

    The rows of one text may be any share of all: they are told by their digest, hot ones where they are.
    """
    rows, hits = _matches(docs, items, window, gram)
    keyed = docs.withColumn("__key", F.coalesce(F.unhex(F.md5("text")), F.lit(b"")))
    counts = rows.groupBy(F.coalesce("key", F.lit(b"")).alias("__key")).agg(F.count("*").alias("n"))
    found = cut_lineage(hits.select(F.col("key").alias("__key"), F.lit(True).alias("__hit")))
    return join_spread(keyed, found, "__key", counts).where(F.col("__hit").isNull()).select(docs.columns)
