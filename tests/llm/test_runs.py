from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF

from mailsieve.llm import runs

SCHEMA = "doc_id long, text string, lang string, runs string, n_runs int"


def brute(words):
    best = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in best.items())


def digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = sorted(brute(words), key=lambda r: (r[0], r[2]))
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc_id, len(found), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def run(df):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r) for r in runs.run_digest(df).select(columns).collect()), key=str)


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = sorted((digest(r.doc_id, r.text) for r in docs.collect()), key=str)
    assert run(docs) == expected and sum(r[1] for r in expected) > 20


@pytest.mark.parametrize("size", [16, 128, 256, 1 << 14, 1 << 16])
def test_transform_comes_back(size):
    x = np.random.default_rng(size).integers(0, runs.PRIME, (2, size)).astype(float)
    y = runs.transform(runs.transform(x.copy()), inverse=True)
    assert (np.mod(y * pow(size, -1, runs.PRIME), runs.PRIME) == x).all()


def made(rnd):
    n, kinds = rnd.choice([0, 5, 23, 24, 25, 60, 200, 700]), rnd.choice([1, 2, 3, 40])
    words = [str(rnd.randrange(kinds)) for _ in range(n)]
    for _ in range(rnd.randint(0, 3) if n > 30 else 0):
        q, s = rnd.randint(1, n // 4), rnd.randrange(n)
        for i in range(s + q, min(n, s + rnd.randint(0, 6 * q + 30))):
            words[i] = words[i - q]
    return words


def test_made_up_texts_match_brute_force():
    rnd = random.Random(1)
    for _ in range(150):
        texts = [made(rnd) for _ in range(rnd.randint(1, 4))]
        got = runs.run_lists([" ".join(t).encode() for t in texts], [None] * len(texts))
        assert [sorted(r) for _, r in got] == [brute(t) for t in texts]


def test_distances_over_the_largest_block(monkeypatch):
    rnd = random.Random(2)
    monkeypatch.setattr(runs, "TOP_BLOCK", 16)
    for q in (16, 31, 32, 33, 47, 48, 100, 170):
        words = [str(rnd.random()) for _ in range(q)] * 4
        words = ["x"] * rnd.randint(0, 40) + words[: 3 * q + rnd.randint(0, q)] + ["y"] * rnd.randint(0, 40)
        assert next(iter(runs.run_lists([" ".join(words).encode()], [None])))[1] == brute(words)


def test_long_texts_stay_fast():
    unique = [str(i * i) for i in range(100_000)]
    began = time.time()
    for words, expected in (
        (["a"] * 200_000, [(0, 200_000, 1)]), (unique * 3, [(0, 300_000, 100_000)]), (unique * 2, []),
        ((["a"] * 100 + ["b"]) * 500, None),
    ):
        found = next(iter(runs.run_lists([" ".join(words).encode()], [None])))[1]
        assert found == expected if expected is not None else (0, 50_500, 101) in found and len(found) == 501
    assert time.time() - began < 40


def test_odd_rows(spark):
    planted = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(1, None), (2, ""), (3, " \t\n"), (planted, "one"), (planted, "a B c " * 50), (None, "a b " * 20), (5, "A a " * 12),
            (5, "x\x0by\x0cz q " * 30), (7, "w " * 23), (8, ("a " * 30 + "b ") * 5)]
    df = spark.createDataFrame([(*r, None, "r", 0) for r in rows], SCHEMA)
    assert run(df) == sorted((digest(*r) for r in rows), key=str)
    assert run(df.limit(0)) == []
    plain = {r.doc_id: r for r in runs.periodic_runs(df.where("doc_id = 8")).collect()}[8]
    assert plain.runs.startswith("0,30,1\n0,155,31\n") and plain.collapsed == b"a b"
