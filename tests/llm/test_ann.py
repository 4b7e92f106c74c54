from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from mailsieve.llm import ann

def asks():
    return F.col("vec_id") % 50 == 0


def brute(rows, asks, k=5):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = []
    for q, v in rows:
        if not asks(q):
            continue
        scores = {}
        for i, w in rows:
            if i != q:
                s = float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w)))
                scores[i] = max(s, scores.get(i, -9))
        near = sorted(scores.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
        out += [(q, r, i, s) for r, (i, s) in enumerate(near, 1)]
    return sorted(set(out))


def same(got, expected):
    got = sorted(tuple(r) for r in got)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected], rel=1e-12)


def test_small_tables_are_exact(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    same(ann.nearest_neighbours(table, asks()).collect(), brute(rows, lambda q: q % 50 == 0))


@pytest.mark.parametrize("copies", [0.0, 1 / 3, 0.6])
def test_recall_and_work(spark, copies, monkeypatch):
    """Random directions have no structure, the hardest case; some vectors have many copies."""
    n, rng = 50_000, np.random.default_rng(11)
    vectors = rng.normal(size=(n, 64))
    vectors[rng.random(n) < copies] = vectors[0]
    schema = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64()))])
    table = spark.createDataFrame(pa.table([pa.array(range(n)), pa.array(list(vectors))], schema=schema)).repartition(8)
    got = {}
    for r in ann.nearest_neighbours(table, F.col("vec_id") % 500 == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, n, 500):
        score = np.round(unit @ unit[q], 12)
        score[q] = -9
        true = np.lexsort((np.arange(n), -score))[:5].tolist()
        hits += len(set(got[q]) & set(true))
        total += 5
    print("recall", copies, hits / total)
    assert hits / total >= 0.92


@pytest.mark.parametrize("n", [3000, 20_000])
def test_candidates_are_less_than_seven_tenths(n):
    rng = np.random.default_rng(n)
    data = rng.normal(size=(n, 64))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    forest = ann.Forest.fit(data, n)
    members = forest.members(data)
    per_tree = 2**forest.depth
    block = ann.Block([[i] for i in range(n)], data, forest.leaves(data) + per_tree * np.arange(ann.TREES))
    visited = np.zeros((20, ann.TREES * per_tree), bool)
    for i, m in enumerate(forest.margins(data[:20])):
        visited[i, [t * per_tree + x for t, x in forest.visit(m, members, ann.SHARE * n)]] = True
    assert ann.SHARE <= block.candidates(visited).mean() < 0.72


def test_forest_visits_near_leaves_first_and_all_in_the_end():
    rng = np.random.default_rng(3)
    data = rng.normal(size=(600, 8))
    forest = ann.Forest.fit(data, 600, trees=3, leaf_rows=40)
    members, leaves = forest.members(data), forest.leaves(data)
    assert forest.depth == 3 and all(sum(map(len, own)) == 600 for own in members)
    for m, own in zip(forest.margins(data[:20]), leaves[:20], strict=True):
        seen = forest.visit(m, members, 600)
        assert len(set.union(*[set(members[t][x].tolist()) for t, x in seen])) == 600
        assert seen[0][1] == own[seen[0][0]] and len(set(seen)) == len(seen)


def test_huge_and_tiny_components(spark):
    rows = [(0, [1e200, 1e200]), (50, [3e300, 0.0]), (1, [1e-200, 2e-200]), (2, [-1e308, 1e308]), (3, [5e-324, 5e-324])]
    got = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), asks(), k=4).collect()
    small = [(i, [x / max(map(abs, v)) for x in v]) for i, v in rows]
    same(got, brute(small, lambda q: q % 50 == 0, k=4))


def test_odd_rows(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, float(i % 7), 0.5]) for i in range(40)] + [
        (50, [1.0, 0.0, 0.5]), (51, None), (52, [0.0, 0.0, 0.0]), (53, [1.0, nan, 1.0]), (54, [inf, 0.0, 0.0]),
        (55, [1.0, None, 2.0]), (56, [1.0, 2.0]), (57, []), (None, [1.0, 0.0, 0.5]), (100, [2.0, 0.0, 1.0]),
        (100, [0.0, 1.0, 0.0]), (1, [1.0, 1.0, 0.5]),
    ]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows],
                               "vec_id long, embedding array<float>, rank int, score double")
    sound = [r for r in rows if r[0] is not None and r[0] not in range(51, 58)]
    got = ann.nearest_neighbours(df.where("vec_id is null or vec_id != 100"), asks()).collect()
    same(got, brute([r for r in sound if r[0] != 100], lambda q: q % 50 == 0))
    monkeypatch.setattr(ann, "BLOCK_ROWS", 6)
    again = ann.nearest_neighbours(df.where("vec_id is null or vec_id != 100"), asks()).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    few = spark.createDataFrame([(0, [1.0]), (50, [-1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.nearest_neighbours(few, asks()).orderBy("query_id").collect()] == [
        (0, 1, 50, -1.0), (50, 1, 0, -1.0)]
    assert ann.nearest_neighbours(few.limit(0), asks()).collect() == []
    assert len({r.vec_id for r in ann.nearest_neighbours(df, asks()).where("query_id = 0").collect()}) == 5
