"""Exact set-similarity join over a corpus and the greedy choice."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from conftest import SF

from mailsieve.operators import similarity

SCHEMA = "doc_id long, text string"


def brute(rows, percent):
    sets = {d: frozenset(re.findall("[a-z0-9]+", (t or "").lower())) for d, t in rows if d is not None}
    least = {}
    for d in sorted(sets):
        least.setdefault(sets[d] or d, d)
    classes = sorted({least[s or d] for d, s in sets.items()})
    links = {c: set() for c in classes}
    for i, a in enumerate(classes):
        for b in classes[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                links[a].add(b)
                links[b].add(a)
    kept = []
    for c in classes:
        if not any(k in links[c] for k in kept):
            kept.append(c)
    return sorted((d, c, len(links[c]), d == c and c in kept) for d, s in sets.items() for c in [least[s or d]])


def run(df, percent=90):
    return sorted(tuple(r) for r in similarity.corpus_near_duplicates(df, percent=percent).collect())


@pytest.mark.parametrize("percent", [50, 90])
def test_whole_table_matches_brute_force(spark, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert run(docs, percent) == brute(rows, percent)


@pytest.mark.parametrize("percent", [34, 60, 80, 100])
def test_small_sets_at_the_threshold(spark, percent):
    rnd = random.Random(percent)
    rows = [(i, " ".join(rnd.sample("abcdefghijkl", rnd.randint(0, 11)))) for i in range(150)]
    assert run(spark.createDataFrame(rows, SCHEMA), percent) == brute(rows, percent)


def test_odd_rows(spark):
    rows = [(5, None), (4, ""), (3, "!?"), (9, "A b c"), (2, "c B a a"), (None, "a b c"), (7, " ".join(map(str, range(30_000)))),
            (8, " ".join(map(str, range(1, 30_001))))]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 90)
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_chain_is_kept_alternately(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(9)], "u long, v long")
    assert sorted(r.v for r in similarity.greedy_dropped(links).collect()) == [1, 3, 5, 7, 9]


def test_sets_are_not_written_or_shuffled_whole(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(i, " ".join(f"{rnd.getrandbits(40):x}" for _ in range(500))) for i in range(600)]
    held, cut = [], similarity.cut_lineage

    def measured(df):
        out = cut(df)
        held.append(sum(p.stat().st_size for p in Path(out._cut_path.removeprefix("file:")).rglob("*.parquet")))
        return out

    monkeypatch.setattr(similarity, "cut_lineage", measured)
    assert run(spark.createDataFrame(rows, SCHEMA)) == [(i, i, 0, True) for i, _ in rows]
    assert sum(held) < sum(len(t) for _, t in rows) / 4


def test_groups_of_many_cells(spark, monkeypatch):
    monkeypatch.setattr(similarity, "CELL", 600)
    rnd = random.Random(4)
    bases = [[f"{b}w{j}" for j in range(30)] for b in range(3)]
    rows = [(i, " ".join(w if rnd.random() > 0.05 else f"x{rnd.getrandbits(20)}" for w in bases[i % 3])) for i in range(90)]
    assert run(spark.createDataFrame(rows, SCHEMA), 80) == brute(rows, 80)
    named = spark.createDataFrame([(f"k{i:03}", t) for i, t in rows], "doc_id string, text string")
    assert run(named, 80) == [(f"k{d:03}", f"k{c:03}", n, kept) for d, c, n, kept in brute(rows, 80)]
