"""Late rows, closing units and state of the streaming operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from mailsieve.streaming import flows

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def hours(*numbers):
    return [(START + dt.timedelta(hours=h, minutes=m), k) for h, m, k in numbers]


def test_spikes_drop_late_rows_and_close_units(spark, tmp_path):
    batches = [
        hours((0, 1, "a"), (0, 2, "a"), (1, 5, "a"), (0, 9, "b")),
        hours((5, 0, "a"), (5, 1, "a"), (5, 2, "a"), (5, 3, "a"), (5, 4, "a")),
        hours((0, 30, "a"), (5, 30, "a"), (6, 0, "a")),
        hours((99, 0, "end")),
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "ts timestamp, k string").coalesce(1).write.parquet(str(tmp_path / "in" / f"b={i}"))
    schema = spark.createDataFrame([], "ts timestamp, k string").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(
        str(tmp_path / "in"))
    out = flows.run_available(flows.stream_spikes(stream, "k"), str(tmp_path / "out"))
    got = [(r.k, r.h, r.n, r.is_spike) for r in out.select(
        "k", F.hour(F.timestamp_micros("bucket")).alias("h"), "n", "is_spike").orderBy("k", "bucket").collect()]
    assert got == [("a", 0, 2, False), ("a", 1, 1, False), ("a", 5, 6, True), ("a", 6, 1, False), ("b", 0, 1, False)]


def read_back(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(str(path)).select("doc_id", "status", "batch").collect())


def test_reindex_reports_each_change_once_and_replays(spark, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    schema = "doc_id long, text string"
    flows.create_store(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], schema), store)
    batches = [
        [(1, "a"), (2, "c"), (4, "new")],
        [(2, "d"), (4, "new"), (3, ""), (None, "x"), (5, "y"), (5, "y")],
        [(2, "d"), (1, "z"), (5, "y")],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(
        str(tmp_path / "in"))
    got = flows.stream_reindex(stream, store, out, checkpoint=str(tmp_path / "cp"))
    expected = [(1, "kept", 2), (2, "kept", 0), (2, "kept", 1), (4, "added", 0), (5, "added", 1)]
    assert sorted(tuple(r) for r in got.select("doc_id", "status", "batch").collect()) == expected
    for i in (2, 1, 2, 0):
        flows.reindex_batch(spark.createDataFrame(batches[i], schema), i, store, out)
        assert read_back(spark, out) == expected


def test_reindex_touches_only_the_buckets_of_a_batch(spark, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    flows.create_store(rows, store)
    flows.reindex_batch(rows.where("doc_id = 7").withColumn("text", F.lit("other")), 0, store, out)
    assert len(list((tmp_path / "store" / "version=0").glob("bucket=*"))) == 1
    versions = spark.read.parquet(store + "/manifest").where("batch = 0").groupBy("version").count().collect()
    assert sorted((r.version, r["count"]) for r in versions) == [(-1, flows.STORE_BUCKETS - 1), (0, 1)]
    assert read_back(spark, out) == [(7, "kept", 0)]
