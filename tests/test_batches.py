"""Python steps hold a bounded part of their task's rows, however many a file has."""

from __future__ import annotations

import pyarrow as pa
import pytest

from mailsieve.functions import models
from mailsieve.operators import chunking

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("chunk", [
    lambda d: chunking.chunk_smart(d, size=10, overlap=2), lambda d: chunking.chunk_words(d, size=40, overlap_tokens=2)])
def test_chunks_leave_in_bounded_batches(spark, monkeypatch, chunk):
    rows = [(i, "One two three. Four five six seven. " * 20) for i in range(400)] + [(None, None), (400, "")]
    df, steps = spark.createDataFrame(rows, "doc_id long, text string"), []
    plain = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a: steps.append(f) or plain(self, f, *a))
    spark.conf.unset(SETTING)
    found = chunk(df).select("doc_id", "chunk_index", "text").collect()
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows])
    made = list(steps[0](iter([batch])))
    assert max(b.num_rows for b in made) <= 1024 < sum(b.num_rows for b in made) == len(found)
    assert int(spark.conf.get(SETTING)) <= 4 << 20


def test_embedding_gets_bounded_batches(spark):
    spark.conf.unset(SETTING)
    df = spark.range(0, 400, 1, 1).selectExpr("id", "repeat('word ', 10000) AS text")
    out = models.embed(df, "text", embedder=lambda s: [[float(s.str.len().sum())]] * len(s), batch=10_000)
    sizes = [r.embedding[0] for r in out.collect()]
    assert len(sizes) == 400 and max(sizes) <= 8 << 20
