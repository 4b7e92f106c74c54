from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from mailsieve.llm import langid

TEXTS = [("en", "the theatre of the thing"), ("en", "then they"), ("fr", "le théâtre de la chose"), ("fr", "les")]


def grams(text):
    data = b"\0\0\0" + text.encode()
    return [data[i : i + 4] for i in range(len(data) - 3)]


def longest(texts):
    """(language, gram, count) of the longest grams."""
    n = Counter((lang, int.from_bytes(g, "big")) for lang, t in texts for g in grams(t))
    return [(lang, g, k) for (lang, g), k in n.items()]


def counts(texts):
    """(order, language, gram, count) of the grams of all orders."""
    n = Counter()
    for lang, t in texts:
        for g in grams(t):
            for order in range(4):
                n[order, lang, int.from_bytes(g[3 - order :], "big")] += 1
    return [(*k, v) for k, v in n.items()]


def build(rows):
    return langid.build_model(
        pa.array([r[0] for r in rows], pa.string()), np.array([r[1] for r in rows], np.int64),
        np.array([r[2] for r in rows], np.int64))


def brute(rows, lang, text):
    """Bits of a text by walking the contexts of one language."""
    seen = defaultdict(Counter)
    for order, own, gram, n in rows:
        if own == lang:
            data = gram.to_bytes(order + 1, "big")
            seen[data[:-1]][data[-1]] += n
    bits = 0.0
    for g in grams(text):
        for order in range(3, -2, -1):
            if order < 0:
                bits += 8
                break
            own = seen.get(g[3 - order : 3])
            if not own:
                continue
            whole = sum(own.values()) + len(own)
            if own[g[3]]:
                bits -= math.log2(own[g[3]] / whole)
                break
            bits -= math.log2(len(own) / whole)
    return bits


PROBES = ("the chose", "then le", "zzz", "é", "", "théthé then le", "a\0b")


def lengths(model, text):
    data = np.frombuffer(text.encode(), np.uint8)
    return model.totals(data, np.array([0, len(data)]))[0]


def test_code_lengths_match_a_walk():
    model, rows = build(longest(TEXTS)), counts(TEXTS)
    for text in PROBES:
        assert lengths(model, text) == pytest.approx([brute(rows, x, text) for x in model.langs], rel=1e-5)


def test_all_counts_of_the_learned_texts_are_held(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in zip(ids, TEXTS)], "doc_id long, text string, lang string")
    for most in (langid.LANGUAGES, 0):
        model, rows = langid.fit(df), counts(TEXTS)
        langid.LANGUAGES, before = most, langid.LANGUAGES
        try:
            again = langid.fit(df)
        finally:
            langid.LANGUAGES = before
        for text in PROBES:
            want = pytest.approx([brute(rows, x, text) for x in model.langs], rel=1e-5)
            assert lengths(model, text) == want and lengths(again, text) == want


def test_many_languages_hold_only_their_own_grams():
    texts = [(f"l{i:02d}", f"{chr(0x400 + 5 * i)}{chr(0x401 + 5 * i)} {chr(97 + i % 26)}{i} " * 20) for i in range(60)]
    model, rows = build(longest(texts)), counts(texts)
    assert sum(len(t.values) for t in model.codes) == len(rows)
    for own, text in texts[::7]:
        bits = lengths(model, text[:40])
        assert bits == pytest.approx([brute(rows, x, text[:40]) for x in model.langs], rel=1e-5)
        assert model.langs[bits.argmin()] == own


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    got = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    rows = got.collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    learn = [(i, t, lang) for i, (lang, t) in enumerate(TEXTS * 6)]
    odd = [(100, None, "en"), (101, "", "en"), (102, "12 !", "fr"), (None, "the", "en"), (103, "théâtre " * 40_000, None),
           (103, "the\n", None), (103, "the\n", None)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in learn + odd],
                               "doc_id long, text string, lang string, gram int, n int, __share int")
    got = langid.identify(df, langid.fit(df)).collect()[len(learn):]
    assert [(r.lang_pred, r.score > 0) for r in got] == [
        ("und", False), ("und", False), ("und", False), ("en", True), ("fr", True), ("en", True), ("en", True)]
    assert got[3].held_out is True
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
    assert langid.identify(df.limit(0), none).collect() == []
