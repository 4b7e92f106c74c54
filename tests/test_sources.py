"""File scans, sinks and streams over several micro-batches."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mailsieve.operators import vectors as V
from mailsieve.operators.schedule import dedupe_alerts
from mailsieve.sources import files, json_csv, sinks
from mailsieve.sources.tables import load_categories
from mailsieve.streaming import flows


def test_scan_and_read(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.txt").write_bytes(b"\xef\xbb\xbfcaf\xc3\xa9 \xff end")
    (tmp_path / "two.bin").write_bytes(b"\x00")
    found = files.scan_files(spark, str(tmp_path), "*.txt").withColumn("mime", F.lit("text/plain; charset=utf-8"))
    r = files.read_content(found, "content").first()
    assert r["text_content"] == "café � end" and r["status"] == 200 and not r["content_truncated"]
    cut = files.read_content(found, "content", max_bytes=7).first()
    assert cut["content_truncated"] and cut["fetched_bytes"] == 7
    other = files.read_content(found.withColumn("mime", F.lit("image/png")), "content").first()
    assert other["status"] == 415 and other["text_content"] is None and other["checksum_md5"] is None


def test_transfer_stops_after_first_failure(spark):
    items = spark.createDataFrame([(i, i) for i in range(6)], "pos long, file_id long")
    known = spark.createDataFrame([(i, f"f{i}", "text/plain", i == 3) for i in range(6)], "file_id long, name string, mime string, fails boolean")
    t = files.transfer(items, known, prefix="p", stop_on_error=True)
    assert t.summary.first().asDict() == {"total": 4, "success": 3, "failed": 1, "status": 207}
    assert t.lanes.where("pos = 0").first()["object_name"] == "p/f0.txt"
    clean = files.transfer(items.where("pos < 3"), known, stop_on_error=True)
    assert clean.summary.first()["status"] == 200


def test_jsonl_round_trip(spark, tmp_path):
    c = spark.createDataFrame([("c1", 0, "a"), ("c2", 1, "b")], "chunk_id string, chunk_index long, text string").withColumn("doc_id", F.lit(7))
    sinks.write_jsonl(c, str(tmp_path / "out"), id_strategy="chunk_id", include_metadata=True)
    rows = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(r["id"] for r in rows) == ["c1", "c2"] and rows[0]["metadata"]["chunk_id"] == rows[0]["id"]


def test_csv_writer(spark, tmp_path):
    d = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"b": [2]}')], "k int, j string")
    json_csv.write_csv(json_csv.json_to_csv(d, "k", "j"), str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t_header")).first()["value"] == "a,b[0]"
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()) == [",2", "1,"]


def test_too_few_categories(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"data": ["only", " "]}')
    with pytest.raises(ValueError):
        load_categories(spark, str(tmp_path / "c.json"))


def test_spread_follows_the_session(spark):
    from mailsieve.fixtures import spread
    from mailsieve.session import SPREAD

    d, n = spark.range(10), spark.conf.get(SPREAD)
    assert spread(d).rdd.getNumPartitions() == int(n)
    spark.conf.unset(SPREAD)
    try:
        assert spread(d) is d
    finally:
        spark.conf.set(SPREAD, n)


def test_scratch_needs_a_shared_folder_off_one_machine():
    from types import SimpleNamespace

    from mailsieve.session import scratch_dir

    unset = SimpleNamespace(isDefined=lambda: False)
    far = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(
            master="yarn", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset))))
    with pytest.raises(RuntimeError):
        scratch_dir(far)


def test_listings_have_no_cap_and_pages_join_up(spark):
    from mailsieve.operators.graph import list_tree
    from mailsieve.sources.files import list_files

    files = spark.range(2500).selectExpr("id", "'m' AS mime", "id % 7 AS modified", "0L AS parent_id")
    every = list_files(files)
    assert every.count() == 2500
    seen, after = [], None
    while rows := list_files(files, limit=999, after=after).collect():
        seen += [r.id for r in rows]
        after = (rows[-1].modified, rows[-1].id)
    assert seen == [r.id for r in every.orderBy(F.desc("modified"), "id").collect()]
    tree = spark.range(12_000).selectExpr("id + 1 AS id", "id DIV 100 AS parent_id")
    listed = list_tree(tree, tree, 0)
    assert listed.count() == 12_000
    page = list_tree(tree, tree, 0, limit=11_000).collect()
    last = page[-1]
    assert len(page) == 11_000
    assert list_tree(tree, tree, 0, after=(last.depth, last.folder, last.id)).count() == 1000


def test_retrieval_error_mode(spark):
    d = spark.createDataFrame([(0, [1.0, 0.0])], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([("q", [0.0, 1.0])], "query_id string, embedding array<double>")
    with pytest.raises(PySparkException):
        V.retrieve(q, d, on_empty="error").collect()


def test_stream_dedupe_over_many_batches(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, f"k{i % 3}", start + dt.timedelta(minutes=7 * i)) for i in range(120)]
    all_rows = spark.createDataFrame(rows, "event_id long, key string, ts timestamp")
    for b in range(6):
        all_rows.where(f"event_id >= {b * 20} AND event_id < {b * 20 + 20}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = flows.stream_source(spark, str(tmp_path / "in"), all_rows.schema, files_per_trigger=1)
    got = flows.run_available(flows.stream_dedupe(s, "key", 3600), str(tmp_path / "out"))
    want = dedupe_alerts(all_rows, "key", 3600)
    assert sorted(map(tuple, got.select("key", "event_id").collect())) == sorted(map(tuple, want.select("key", "event_id").collect()))


def test_stream_spikes_over_many_batches(spark, tmp_path):
    from mailsieve.operators.metrics import spikes

    start = dt.datetime(2024, 1, 1)
    rows = [(i, "k", start + dt.timedelta(minutes=11 * i - (i % 4))) for i in range(200)]
    all_rows = spark.createDataFrame(rows, "event_id long, key string, ts timestamp")
    for b in range(4):
        all_rows.where(f"event_id >= {b * 50} AND event_id < {b * 50 + 50}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = flows.stream_source(spark, str(tmp_path / "in"), all_rows.schema, files_per_trigger=1)
    got = {r["bucket"]: round(r["ewma"], 9) for r in flows.run_available(flows.stream_spikes(s, "key"), str(tmp_path / "out")).collect()}
    want = {int(r["u"]): round(r["ewma"], 9) for r in spikes(all_rows, "key", unit="hour").withColumn("u", F.unix_micros("bucket")).collect()}
    assert len(got) == len(want) - 1 and all(want[k] == v for k, v in got.items())
