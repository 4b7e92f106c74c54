from __future__ import annotations

import hashlib
import re

import pytest
from conftest import SF
from test_decontaminate import brute as contaminated
from test_near_dup import brute as near_copies

import __spark_entry__
import corpus_pipeline
from mailsieve.llm.bpe import Coder
from mailsieve.llm.secrets import find_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows that each stage read and gave, each written and read again."""
    base = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(base / name))
        made = spark.read.parquet(str(base / name))
        out[name] = (docs.collect(), made.collect(), made.columns)
        docs = made
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(columns == COLUMNS for _, _, columns in list(stages.values())[:-1])


def test_quality_drops_what_is_bad(spark, stages):
    given, made, _ = stages["quality_classifier"]
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    left = {r.doc_id for r in made}
    assert len(bad & left) <= 0.1 * len(bad) and len(good & left) >= 0.95 * len(good)
    assert {tuple(r) for r in made} <= {tuple(r) for r in given}


def test_near_copies_match_brute_force(stages):
    given, made, _ = stages["minhash_near_dedup"]
    kept = {d for d, _, _, stays in near_copies([(r.doc_id, r.text) for r in given], 80) if stays}
    assert {tuple(r) for r in made} == {tuple(r) for r in given if r.doc_id in kept}


def test_contamination_matches_brute_force(spark, stages):
    given, made, _ = stages["benchmark_decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in contaminated([(r.doc_id, r.text) for r in given], items) if not r[-1]}
    assert {tuple(r) for r in made} == {tuple(r) for r in given if r.doc_id in clean} and len(made) < len(given)


def test_secrets_are_gone_and_nothing_else(stages):
    given, made, _ = stages["secret_scans"]
    after = {r.doc_id: r for r in made}
    assert len(after) == len(given)
    for r in given:
        spans = find_spans(r.text)
        assert not find_spans(after[r.doc_id].text) and after[r.doc_id].n_chars == len(after[r.doc_id].text)
        if not spans:
            assert after[r.doc_id] == r
        else:
            parts = re.split("<redacted>", after[r.doc_id].text)
            assert r.text.startswith(parts[0]) and r.text.endswith(parts[-1])


def test_tokens_decode_to_the_text(stages):
    given, made, _ = stages["byte_bpe"]
    with open(corpus_pipeline.RANKS, "rb") as file:
        coder = Coder(file.read(), corpus_pipeline.PATTERN)
    texts = {r.doc_id: r.text for r in given}
    assert len(made) == len(texts)
    for r in made:
        assert coder.decode(bytes(r.ids)).decode() == texts[r.doc_id] and r.n_tokens == len(r.ids) // 4
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_registered_run_gives_the_last_stage(spark, stages):
    got = __spark_entry__.queries()["pipeline"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in stages["byte_bpe"][1])


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (None, "Some text here.", None, "s", 5, "x"),
            (3, "word. " * 30_000, "en", None, 1, "x"), (4, "same text", "en", "s", 9, "x"), (4, "same text", "en", "s", 9, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = spark.createDataFrame(rows, schema)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, frame, SF)
            assert "doc_id" in out.columns and out.count() <= frame.count()
        corpus_pipeline.STAGES[0][1](spark, frame, SF).count()
