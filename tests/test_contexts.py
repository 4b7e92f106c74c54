"""Vector search, ordering and packing against brute force; plan shape checks."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF
from mailsieve.operators import contexts as C
from mailsieve.operators import distribution as D
from mailsieve.operators import graph as G
from mailsieve.operators import vectors as V


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 8)))]
    rows += [(300 + i, rows[i][1]) for i in range(20)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_search_in_blocks_is_exact(vectors):
    rows, df = vectors
    mat = np.array([v for _, v in rows])
    mat /= np.linalg.norm(mat, axis=1, keepdims=True)
    cos = np.round(mat @ mat.T, 12)
    queries = df.where("vec_id < 30").select(F.col("vec_id").alias("q"), "embedding")
    want = {q: sorted(range(len(rows)), key=lambda j: (-cos[q, j], j))[:7] for q in range(30)}
    for cap in (4096, 8):
        hits = V.nearest(queries, df, 7, "q", "vec_id", query_block=cap).collect()
        got: dict[int, list] = {}
        for r in sorted(hits, key=lambda r: r["rank"]):
            got.setdefault(r["q"], []).append(r["vec_id"])
        assert got == want


def test_similarity_forms(spark):
    d = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([1.0], [1.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    rows = d.select(V.similarity(F.col("a"), F.col("b")).alias("c"), V.similarity(F.col("a"), F.col("b"), "euclidean", False).alias("e")).collect()
    assert rows[0]["c"]["score"] == 0.96 and rows[0]["c"]["level"] == "high" and rows[0]["c"]["percentage"] == 96.0
    assert rows[0]["e"]["score"] == round(1 / (1 + math.sqrt(2)), 6)
    assert rows[1]["c"]["error"] == "vectors must be the same length" and rows[1]["c"]["score"] is None
    assert rows[2]["c"]["score"] == 0.0


def test_retrieve_options(vectors):
    _, df = vectors
    q = df.where("vec_id = 0").select(F.lit("q0").alias("query_id"), "embedding")
    with pytest.raises(ValueError):
        V.retrieve(q, df, min_similarity=0.5, max_distance=0.5)
    assert V.retrieve(q, df, ids=[5, 6], min_similarity=-1.0).count() == 2
    assert V.retrieve(q, df, min_similarity=2.0, on_empty="placeholder").count() == 1


def test_distribution_example(spark):
    d = spark.createDataFrame([("q", "a", 0.86), ("q", "b", 0.10), ("q", "c", 0.04)], "q string, c string, p double")
    r = D.distribution_stats(d, "q", "p").first()
    entropy = -sum(p * math.log(p) for p in (0.86, 0.10, 0.04))
    assert r["entropy"] == round(entropy, 4) == 0.4887 and r["max_prob"] == 0.86
    assert r["concentration"] == round(1 - entropy / math.log(3), 4)


def test_coverage_bands(spark):
    d = spark.createDataFrame([(1.2,), (1.0,), (0.85,), (0.7,), (0.5,), (0.1,)], "s double").select(D.coverage(F.col("s")).alias("c"))
    assert [r["c"] for r in d.collect()] == ["gap", "strong", "strong", "moderate", "weak", "gap"]


ITEMS = [("q", "a", "red apple pie", 0.9, "s1"), ("q", "b", "red apple pie", 0.89, "s1"), ("q", "c", "green pear", 0.5, "s1"),
         ("q", "d", "blue plum", 0.4, "s1"), ("q", "e", "red apple tart", 0.8, "salience"), ("q", "f", "", 0.7, "s2")]


def brute_mmr(items, alpha, cap):
    toks = {i[1]: set(i[2].split()) for i in items}
    pool, kept, used = sorted(items, key=lambda i: (-i[3], i[1])), [], {}
    while pool:
        best = None
        for c in pool:
            if cap is not None and used.get(c[4], 0) >= cap and c[4] != "salience":
                continue
            over = max((len(toks[c[1]] & toks[k]) / len(toks[c[1]] | toks[k]) if toks[c[1]] and toks[k] else 0.0 for k in kept), default=0.0)
            adj = alpha * c[3] - (1 - alpha) * over
            if best is None or adj > best[0]:
                best = (adj, c)
        if best is None:
            return kept
        kept.append(best[1][1])
        used[best[1][4]] = used.get(best[1][4], 0) + 1
        pool.remove(best[1])
    return kept


@pytest.mark.parametrize("cap", [3, None, 1])
def test_mmr_matches_brute_force(spark, cap):
    d = spark.createDataFrame(ITEMS, "query_id string, id string, text string, score double, source string")
    got = [r["id"] for r in C.mmr_order(d, "query_id", per_source_cap=cap).orderBy("mmr_rank").collect()]
    assert got == brute_mmr(ITEMS, 0.7, cap)


def test_near_duplicates_keep_empty_texts(spark):
    d = spark.createDataFrame(ITEMS, "query_id string, id string, text string, score double, source string")
    got = [r["id"] for r in C.drop_near_duplicates(d, "query_id", ["id"]).orderBy("id").collect()]
    assert got == ["a", "c", "d", "e", "f"]


def test_packing_skips_and_stops(spark):
    rows = [("q", "a", "x" * 40, 0.9), ("q", "b", "x" * 400, 0.8), ("q", "c", "x" * 20, 0.7), ("r", "d", "x" * 4000, 0.9), ("r", "e", "x", 0.1)]
    d = spark.createDataFrame(rows, "query_id string, id string, text string, score double")
    got = sorted((r["query_id"], r["id"], r["slot"]) for r in C.pack_contexts(d, "query_id", max_tokens=20).collect())
    assert got == [("q", "a", 1), ("q", "c", 2)]


def test_prompt_template_forms(spark):
    qs = spark.createDataFrame([("q", "Why $1 \\d?")], "query_id string, query string")
    ctx = spark.createDataFrame([("q", "a", "text", 0.9)], "query_id string, id string, text string, score double")
    std = C.build_prompts(qs, ctx, "query_id").first()
    assert std["prompt"] == "Context:\ntext\n\nQuery: Why $1 \\d?\n\nAnswer:" and not std["truncated"]
    own = C.build_prompts(qs, ctx, "query_id", custom="Use {{ CONTEXT }} only").first()
    assert own["prompt"] == "Use text only"
    bare = C.build_prompts(qs, ctx, "query_id", custom="Be nice").first()
    assert bare["prompt"].startswith("Be nice\n\nContext:\ntext")


def brute_components(edges):
    nodes = {n for e in edges for n in e}
    reach = {n: {d for s, d in edges if s == n} for n in nodes}
    for k in nodes:
        for i in nodes:
            if k in reach[i]:
                reach[i] |= reach[k]
    return {n: min(m for m in reach[n] if n in reach[m]) for n in nodes if n in reach[n]}


def test_cycles_match_brute_force(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 6), (7, 1), (5, 8), (2, 2), (9, 10)]
    d = spark.createDataFrame(edges, "src long, dst long")
    assert {r["node"]: r["component"] for r in G.call_cycles(d).collect()} == brute_components(edges)


# --- plans ------------------------------------------------------------------------------------


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", ["p7_deterministic_filter", "f9_clean_email", "f19_document_metadata", "p12_default_rulepack", "f23a_chunk_fixed"])
def test_row_work_does_not_shuffle_by_key(spark, name):
    text = plan(spark, name)
    assert "hashpartitioning" not in text and "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["a1_compute_metrics", "w9_trace_steps", "w7_budget_gate", "a20_hot_paths", "j10_detect_changes_hash", "a38_contractor_metrics"])
def test_no_product_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(spark, "a13_latency_percentiles")
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]


def test_filters_reach_the_scan(spark):
    text = plan(spark, "a15_zero_hit_rate")
    assert "PushedFilters" in text or "event_type" in text


def test_ranking_from_a_referee(spark):
    rows = [
        (1, ["a", "b", "c"], ("b", 0.9, [("b", 3.0), ("c", 1.0)])), (2, ["a", "b"], ("b", 0.8, [])), (3, ["a", "b", "c"], (None, None, None)),
        (4, ["a"], None), (5, ["a", "b", "c"], (None, 0.2, [("c", 0.0), ("z", 1.0)])), (6, ["a", "b"], ("a", 0.7, [("a", None)])),
    ]
    d = spark.createDataFrame(
        rows, "id int, names array<string>, r struct<category:string,confidence:double,distribution:array<struct<category:string,prob:double>>>")
    got = {x["id"]: (x["distribution_source"], [tuple(y) for y in x["ranking"]]) for x in D.with_ranking(d, "names", "r").collect()}
    assert got[1] == ("llm", [("b", 0.75, "llm"), ("c", 0.25, "llm"), ("a", 0.01, "added_missing")])
    assert got[2] == ("fallback", [("b", 0.8, "fallback"), ("a", 0.2, "fallback")])
    assert got[3] == ("fallback", [("a", 0.5, "fallback"), ("b", 0.25, "fallback"), ("c", 0.25, "fallback")])
    assert got[4] == ("fallback", [("a", 1.0, "fallback")])
    assert [x[0] for x in got[5][1]] == ["z", "a", "b", "c"] and got[6][0] == "fallback"


def test_categories_by_words_of_the_text(spark):
    from mailsieve.plans import answers as A

    cats = spark.createDataFrame([("pay slip", [1.0, 0.0]), ("sick leave", [0.0, 1.0]), ("travel", [-1.0, 0.0])], "category string, embedding array<double>")
    mails = spark.createDataFrame(
        [(1, "My pay slip is wrong", [0.1, 0.9]), (2, None, [0.1, 0.9]), (3, "", [1.0, 0.1])], "id int, text string, embedding array<double>")
    got = {r["id"]: r for r in A.categorize(mails, cats, "id", k=2, text="text", preset=0.3).collect()}
    assert got[1]["chosen"] == "pay slip" and got[1]["distribution_source"] == "llm" and got[1]["shortlist"] == ["sick leave", "pay slip"]
    assert got[2]["chosen"] == "sick leave" and got[2]["distribution_source"] == "fallback" and got[3]["chosen"] == "pay slip"
    assert A.categorize(mails.limit(0), cats, "id", text="text").collect() == []


def test_system_prompt_is_composed(spark):
    from mailsieve.operators import intents as I
    from mailsieve.plans import answers as A

    q = spark.createDataFrame(
        [("it_support", None, "Payroll", "action_request", 0.9), ("custom", "Mine", " ", "complaint", None), ("custom", " ", None, None, None), (None, None, None, None, 0.1)],
        "t string, own string, cat string, intent string, conf double")
    p = A.Prompting(F.col("t"), F.col("own"), F.col("cat"), F.col("intent"), F.col("conf"), I.channel_block("hr@x.org"))
    got = [tuple(r) for r in q.select(p.system(F.lit("\n Base")), p.applied()).collect()]
    channel = "\n\n" + I.channel_block("hr@x.org")
    tone = I.SYSTEM_TEMPLATES["it_support"].rstrip()
    assert got[0] == (
        f"{tone}\n\nBase{channel}\n\nDomain context: This is a Payroll inquiry.\nResponse style: Focus on actionable steps or procedures.",
        ["category", "intent", "confidence"])
    assert got[1:] == [("Mine" + channel, []), ("\n Base" + channel, []), ("\n Base" + channel, ["confidence"])]
    assert [tuple(r) for r in q.limit(1).select(A.Prompting().system(F.lit("Base")), A.Prompting().applied()).collect()] == [("Base", [])]
