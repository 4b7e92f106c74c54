from __future__ import annotations

import hashlib
import re

from conftest import SF

from mailsieve.llm.decontaminate import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else []:
            windows.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    ids |= own
        listed = sorted(str(i) for i in ids if i is not None)
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(listed), digest, bool(hit)))
    return sorted(out, key=str)


def run(docs, items):
    return sorted((tuple(r) for r in contamination(docs, items).collect()), key=str)


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = run(docs, items)
    assert got == brute([tuple(r)[:2] for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert any(r[-1] for r in got)


def test_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    near = passage.replace("w9 ", "zz ").replace("w19 ", "zz ")
    items = [
        (1, passage), (2, None), (3, "  "), (4, "Short one"), (4, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (None, "solo"),
        (5, passage), (6, "É É É É É É É É É É É É"), (7, "three word item"),
    ]
    docs = [
        (1, None), (2, ""), (3, "short, ONE. short one"), (4, passage.upper()), (5, near), (6, passage), (6, passage),
        (None, passage), (7, "so solo so"), (8, "é " * 11), (9, "É " * 11), (10, "x " * 30_000 + passage[4:]),
        (11, "a w0 w1 w2 w3 w4 w5 w6 w7 w8 b w10 w11 w12 w13 w14 w15 w16 w17 w18 w19"), (12, "three word itemx"),
        (13, " ".join(f"w{i}" for i in range(9))),
    ]
    d = spark.createDataFrame([(*r, 1, 2, "k") for r in docs], "doc_id long, text string, key long, n int, hash string")
    i = spark.createDataFrame([(*r, 3, "m") for r in items], "item_id long, text string, n int, words string")
    got = run(d, i)
    assert got == brute(docs, items)
    dirty = [r[0] for r in got if r[-1]]
    left = decontaminate(d, i)
    assert left.columns == d.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r[0]) for r in docs if r[0] not in dirty)


def test_short_item_as_long_as_a_gram(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    items = [(1, passage), (2, "g0 g1 g2 g3 g4 g5"), (3, "w3 w4 w5 w6 w7 w8"), (4, "five words are not six")]
    docs = [
        (1, "x " + passage + " y"), (2, "see g0 g1 g2 g3 g4 g5 here"), (3, "a w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 b"),
        (4, "a w10 w11 w12 w13 w14 w15 w16 w17 w18 b"), (5, "w3 w4 w5 w6 w7 w8"), (6, "g1 g2 g3 g4 g5 g0"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert run(d, i) == brute(docs, items)
    assert sorted(r.doc_id for r in decontaminate(d, i).collect()) == [4, 6]


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    i = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert contamination(d, i).collect() == []
    assert [tuple(r)[:4] for r in contamination(some, i).collect()] == [(1, 2, 0, 0)]
    assert decontaminate(some, i).count() == 1
