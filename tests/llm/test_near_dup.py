from __future__ import annotations

import re
from collections import defaultdict

import pytest
from conftest import SF
from pyspark.sql import functions as F

from mailsieve.llm import near_dup
from mailsieve.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, u long, component long, bucket string"


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent):
    """rows of (doc_id, text) -> sorted (doc_id, n, component, kept)."""
    sets = [shingles(t) for _, t in rows]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    places = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            places[x].append(i)
    pairs = {(a, b) for p in places.values() for i, a in enumerate(p) for b in p[i + 1 :]}
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(rows[a][0]), find(rows[b][0])))
            root[y] = x
    return sorted((d, len(s), find(d), find(d) == d) for (d, _), s in zip(rows, sets, strict=True))


def run(df, percent=85):
    return sorted(tuple(r) for r in near_dup.near_duplicates(df, percent).collect())


@pytest.mark.parametrize("percent", [80, 85])
def test_whole_table_matches_brute_force(spark, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert run(docs, percent) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], percent)


def variants(n):
    base = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        own = list(base)
        for k in range(i % 7):
            own[(i * 13 + k * 17) % 60] = f"x{i}-{k}"
        out.append((1000 - i, " ".join(own).upper() if i % 2 else "\t".join(own)))
    return out


def test_large_group_in_blocks_and_wide_buckets(spark, monkeypatch):
    rows = variants(90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows, 85)
    assert run(df) == expected
    monkeypatch.setattr(near_dup, "BLOCK", 3000)
    monkeypatch.setattr(near_dup, "BUCKET", 4)
    assert run(df) == expected


def test_odd_rows(spark):
    long = " ".join(f"v{i % 997}x{i}" for i in range(40_000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b"), (None, "a b"), (7, long), (8, long + " z"),
        (8, long + " z"), (9, "a"), (9, "c d e f g"), (10, "C d e f g"),
    ]
    df = spark.createDataFrame([(*r, None, 1, 2, "b") for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in near_dup.near_duplicates(df, 85).collect()), key=str)
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 4, False),
        (None, 1, None, True), (7, 39996, 7, True), (8, 39997, 7, False), (8, 39997, 7, False), (9, 1, 9, True),
        (9, 1, 9, True), (10, 1, 9, False),
    ], key=str)
    assert sorted(r.doc_id or 0 for r in near_dup.deduplicate(df).collect()) == [0, 1, 2, 3, 4, 7, 9]
    assert near_dup.deduplicate(df).columns == df.columns


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert run(df) == [] and near_dup.deduplicate(df).collect() == []


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (5, 4)]
    got = {tuple(r) for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(31)} | {(i, 100) for i in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    top = 2**63 - 1
    far = spark.createDataFrame([(top, top - 1), (-top, -5), (top, None)], "u long, v long")
    assert {tuple(r) for r in connected_components(far).collect()} == {
        (top, top - 1), (top - 1, top - 1), (-top, -top), (-5, -top)}


def test_least_agreement_is_a_tail():
    assert near_dup.least_agreement(85, 130) < 0.75 * 130 and near_dup.band_count(85) == 24
