from __future__ import annotations

import math
import re
import zlib

import pytest
import regex
from conftest import SF
from pyspark.sql import functions as F

from mailsieve.llm import quality
from mailsieve.llm.quality import QualityModel, tree_rules

BIG = SF.replace("0.001", "0.1")


def test_held_out_accuracy_and_folds(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    assert 0 < len(model.rules) < 150
    rows = quality.quality_scores(docs, model).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    own = [r for r in rows if r.held_out]
    good = [r for r in own if r.quality == 1]
    bad = [r for r in own if r.quality == 0]
    print(sum(r.predicted for r in good) / len(good), sum(1 - r.predicted for r in bad) / len(bad))
    assert sum(r.predicted for r in good) / len(good) > 0.95
    assert sum(1 - r.predicted for r in bad) / len(bad) > 0.8


def test_rules_of_a_tree():
    text = """Tree with 5 nodes
  If (feature 0 <= 1.5)
   If (feature 1 > 2.0)
    Predict: 1.0
   Else (feature 1 <= 2.0)
    If (feature 0 <= 0.5)
     Predict: 0.0
    Else (feature 0 > 0.5)
     Predict: 1.0
  Else (feature 0 > 1.5)
   Predict: 0.0
"""
    assert tree_rules(text, ("a", "b")) == {
        (("a", "<=", 1.5),), (("a", ">", 1.5),), (("a", "<=", 1.5), ("b", ">", 2.0)),
        (("a", "<=", 1.5), ("b", "<=", 2.0)), (("a", "<=", 0.5), ("b", "<=", 2.0)),
        (("a", "<=", 1.5), ("a", ">", 0.5), ("b", "<=", 2.0)),
    }


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "word " * 100_000), (4, "x\n"), (4, "x\n")]
    df = spark.createDataFrame([(*r, 0.5, "w") for r in rows], "doc_id long, text string, chars double, score string")
    model = QualityModel((((("chars", ">", 1.0),), 2.0), ((("distinct_words", "<=", 0.5),), -4.0)), 0.0)
    got = quality.quality_scores(df, model).collect()
    assert [r.predicted for r in got] == [0, 0, 1, 0, 1, 1] and [r.held_out for r in got][2] is True
    assert got[0].score == got[1].score == pytest.approx(0.017986, abs=1e-5)
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [None, 4, 4]
    assert quality.keep_good(df.limit(0), model).collect() == []


def test_too_few_labels(spark):
    df = spark.createDataFrame([(i, f"t {i}") for i in range(1, 9)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    ones = df.select("doc_id", F.lit(1).alias("quality"))
    nulls = df.select("doc_id", F.lit(None).cast("int").alias("quality"))
    assert quality.fit(df, none) == quality.fit(df, nulls) == quality.fit(df.limit(0), ones) == QualityModel((), 0.0)
    assert quality.fit(df, ones).intercept > 1 and quality.fit(df, ones).rules == ()


def plain_statistics(text):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]
    lines, n = text.split("\n"), max(len(text), 1)

    def share(pattern):
        return len(regex.findall(pattern, text)) / n

    return {
        "chars": math.log1p(len(text)), "word_chars": len(text) / max(len(words), 1),
        "distinct_words": len(set(words)) / max(len(words), 1), "distinct_lines": len(set(lines)) / max(len(lines), 1),
        "line_words": len(words) / max(len(lines), 1), "upper_share": share(r"\p{Lu}"), "digit_share": share(r"\p{Nd}"),
        "symbol_share": share(r"[^\p{L}\p{N} \t\n\x0b\f\r.,;:'\-]"), "stop_share": share(r"[.,;:]"),
    }


def test_every_score_matches_plain_python(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet"))
    assert model.rules
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = quality.quality_scores(docs, model).collect()
    assert len(got) == len(texts)
    for r in got:
        own = plain_statistics(texts[r.doc_id] or "")
        total = model.intercept + sum(
            weight for rule, weight in model.rules if all(own[n] <= b if s == "<=" else own[n] > b for n, s, b in rule))
        score = 1 / (1 + math.exp(-total))
        assert abs(r.score - score) < 1e-9 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
