from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from mailsieve.llm import phrases

SCHEMA = "doc_id long, text string, lang string, keys long, f int"


def brute(rows, least=30, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    wanted = {p: f for p, f in counts.items() if len(p) > 2 and f >= least}
    cover = defaultdict(int)
    for (lang, *words), f in wanted.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                cover[lang, *words[i : i + n]] = max(cover[lang, *words[i : i + n]], f)
    out = defaultdict(list)
    for (lang, *words), a in wanted.items():
        if 100 * cover[lang, *words] >= 80 * a:
            continue
        cuts = [(counts[lang, *words[:k]], counts[lang, *words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, totals[lang], -s)
        for lang, rs in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rs)[:top]))


def run(df, **more):
    return sorted(tuple(r) for r in phrases.collocations(df, **more).collect())


def test_small_groups_and_split_prefixes(spark):
    rnd = random.Random(4)
    words = ["The", "of", "a\t", "x", "é", "ÉTÉ", "b.", "c,", "w" * 80, "W" * 81, "z\n"]
    rows = [(rnd.choice(["en", "de", None, ""]), " ".join(rnd.choices(words, weights=[9, 8, 7, 5, 4, 3, 2, 2, 1, 1, 1], k=60)))
            for _ in range(150)]
    df = spark.createDataFrame([(i, t, lang, 1, 2) for i, (lang, t) in enumerate(rows)], SCHEMA)
    expected = brute(rows)
    assert len(expected) > 50
    assert run(df) == expected
    assert run(df, budget=40) == expected
    assert run(df, top=7) == brute(rows, top=7) and run(df, least=200) == brute(rows, least=200)


def test_odd_rows(spark):
    rows = [("en", None), (None, None), ("en", ""), ("en", " \t\n.,"), ("en", "one two three " * 40_000), (None, "same words here. " * 31),
            (None, "same words here. " * 31)]
    df = spark.createDataFrame([(1, t, lang, None, None) for lang, t in rows], SCHEMA)
    assert run(df) == brute(rows) and run(df.limit(0)) == []


def test_colliding_keys_are_seen(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "a b"), ("de", "a c")], "lang string, text string")
    words, seed = phrases.word_counts(docs)
    assert seed == 0 and {(r.lang, r.word, r.n) for r in words.collect()} == {
        ("en", "a", 1), ("en", "b", 1), ("de", "a", 1), ("de", "c", 1)}
    assert words.select("key").distinct().count() == 4


def test_subtree_counts_are_leaf_totals():
    path = np.array([[1, 2, 3, 4], [1, 2, 3, 5], [1, 2, 3, 0], [1, 2, 4, 0], [2, 2, 3, 4], [1, 2, 3, 4]], np.int64)
    three, four = phrases.subtree_counts(path, np.array([5, 6, 7, 8, 9, 10]), least=7)
    assert dict(zip(map(tuple, three[0].tolist()), three[1].tolist(), strict=True)) == {(1, 2, 3): 28, (1, 2, 4): 8, (2, 2, 3): 9}
    assert dict(zip(map(tuple, four[0].tolist()), four[1].tolist(), strict=True)) == {(1, 2, 3, 4): 15, (2, 2, 3, 4): 9}


def test_heavy_prefix_goes_by_its_third_word(spark):
    rows = [("en", f"in the w{i % 50} box") for i in range(4000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert run(df, budget=100) == brute(rows)
    assert df.select(F.count("*")).first()[0] == 4000
