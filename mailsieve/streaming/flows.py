"""Structured Streaming forms of triage, volume, alerts, traces and re-indexing.

Each function maps a streaming DataFrame to a streaming DataFrame.  ``run_available`` drives one to the
end of the available input into a parquet sink with a checkpoint in the shared scratch folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mailsieve.operators import triage
from mailsieve.operators.rules import RulePack
from mailsieve.session import cut_lineage, release, scratch_dir


def stream_source(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet", files_per_trigger: int = 64) -> DataFrame:
    """Parquet folder as a stream; the trigger limit bounds each micro-batch and its state work."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def run_available(stream: DataFrame, out: str | None = None) -> DataFrame:
    """Process everything that is there, then return the sink's table."""
    spark = stream.sparkSession
    base = out or f"{scratch_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    q = (
        stream.writeStream.format("parquet").option("path", f"{base}/data")
        .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/data")


def stream_triage(emails: DataFrame, pack: RulePack) -> DataFrame:
    """The deterministic filter is stateless, so it applies to a stream as it is."""
    return triage.deterministic_filter(emails, pack)


def stream_volume(events: DataFrame, watermark: str = "10 minutes", size: str = "1 minute", by: str = "event_type") -> DataFrame:
    w = events.withWatermark("ts", watermark).groupBy(F.window("ts", size), by).agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("start"), by, "n")


def stream_sliding_avg(
    events: DataFrame, size: str = "1 hour", slide: str = "15 minutes", watermark: str = "10 minutes", value: str = "value",
    by: str = "event_type",
) -> DataFrame:
    w = events.withWatermark("ts", watermark).groupBy(F.window("ts", size, slide), by).agg(
        F.avg(value).alias("average"), F.count("*").alias("n")
    )
    return w.select(F.col("window.start").alias("start"), by, "average", "n")


def stream_traces(logs: DataFrame, key: str, gap: str = "30 minutes", watermark: str = "10 minutes") -> DataFrame:
    """One row per closed session of a correlation id."""
    s = logs.withWatermark("ts", watermark).groupBy(F.session_window("ts", gap).alias("s"), key).agg(
        F.count("*").alias("stages"), F.sum("latency_ms").alias("total_ms")
    )
    return s.select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "stages", "total_ms")


def _rows(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """One key's rows of a micro-batch (bounded by the trigger limit) in time order."""
    return pd.concat(list(parts)).sort_values(["t", "tie"], ignore_index=True)


def stream_dedupe(
    alerts: DataFrame, key: str, ttl_seconds: int, ts: str = "ts", tie: str = "event_id", watermark: str = "1 hour"
) -> DataFrame:
    """Alerts that fire: the first of a key, then the first at least ``ttl`` after the last that fired.

    The state of a key is its last firing time.  It expires once the watermark is past firing time plus
    ``ttl``: from then on the next alert fires with or without it, so state stays as small as the set of
    recently active keys.
    """
    thin = alerts.withWatermark(ts, watermark).select(
        key, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.col(tie).alias("tie")
    )
    out = T.StructType([thin.schema[key], T.StructField(tie, T.LongType())])
    state = T.StructType([T.StructField("last", T.LongType())])
    ttl = ttl_seconds * 1_000_000

    def run(k, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        rows = _rows(parts)
        last, fired = (held.get[0] if held.exists else None), []
        for i, t in enumerate(rows["t"].to_numpy()):
            if last is None or t - last >= ttl:
                last = int(t)
                fired.append(i)
        held.update((last,))
        held.setTimeoutTimestamp(max((last + ttl) // 1000, held.getCurrentWatermarkMs() + 1))
        yield rows.iloc[fired][["tie"]].rename(columns={"tie": tie}).assign(**{key: k[0]})[out.names]

    return thin.groupBy(key).applyInPandasWithState(run, out, state, "append", GroupStateTimeout.EventTimeTimeout)


def stream_debounce(runs: DataFrame, key: str, gap_seconds: int, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Monitor runs that are processed: a run too soon after the last processed one is skipped."""
    return stream_dedupe(runs, key, gap_seconds, ts, tie)


def stream_spikes(
    events: DataFrame, key: str, unit_seconds: int = 3600, alpha: float = 0.3, k: float = 3.0, watermark: str = "10 minutes",
    idle_units: int = 24 * 30,
) -> DataFrame:
    """Closed time units with their weighted mean, and whether a unit has over ``k`` times the mean before it.

    The state of a key is its mean and the counts of its open units.  A unit closes when the watermark passes
    its end; rows for a closed unit are dropped.  The state goes after ``idle_units`` without events.
    """
    size = unit_seconds * 1_000_000
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    thin = events.withWatermark("ts", watermark).select(key, "ts", (t - F.pmod(t, F.lit(size))).alias("t"))
    out = T.StructType([
        thin.schema[key], T.StructField("bucket", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("ewma", T.DoubleType()), T.StructField("is_spike", T.BooleanType()),
    ])
    state = T.StructType([
        T.StructField("ewma", T.DoubleType()), T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
    ])

    def run(key_, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        mean, starts, counts = held.get if held.exists else (None, [], [])
        units, now = dict(zip(starts, counts, strict=True)), held.getCurrentWatermarkMs() * 1000
        if held.hasTimedOut and not units:
            held.remove()
            return
        if not held.hasTimedOut:
            for part in parts:
                for start, n in part["t"].value_counts().items():
                    if start + size > now:
                        units[int(start)] = units.get(int(start), 0) + int(n)
        rows = []
        for start in sorted(s for s in units if s + size <= now):
            n = units.pop(start)
            new = float(n) if mean is None else alpha * n + (1 - alpha) * mean
            rows.append((start, n, new, mean is not None and n > k * mean))
            mean = new
        held.update((mean, list(units), list(units.values())))
        due = min(units) + size if units else now + idle_units * size
        held.setTimeoutTimestamp(max(due // 1000, held.getCurrentWatermarkMs() + 1))
        made = pd.DataFrame(rows, columns=["bucket", "n", "ewma", "is_spike"])
        yield made.assign(**{key: key_[0]})[out.names]

    return thin.groupBy(key).applyInPandasWithState(run, out, state, "append", GroupStateTimeout.EventTimeTimeout)


#: Buckets of keys in a hash store; a batch reads and rewrites only those it touches.
STORE_BUCKETS = 64
#: Version of the store before any batch.
FIRST_VERSION = -1


def _hashed(snapshot: DataFrame, key: str) -> DataFrame:
    """(key, hash, bucket), one row a key: of several texts of a key the one of largest hash, so that replays agree."""
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return (
        snapshot.where(F.col(key).isNotNull()).select(key, digest.alias("hash")).groupBy(key).agg(F.max("hash").alias("hash"))
        .withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(STORE_BUCKETS)).cast("int")))


def _store_versions(spark: SparkSession, store: str, batch_id: int) -> dict[int, int]:
    """Version that each bucket had before batch ``batch_id``: at most STORE_BUCKETS rows."""
    manifest = spark.read.schema("bucket int, version long, batch long").parquet(f"{store}/manifest")
    earlier = manifest.where(F.col("batch") < batch_id)
    last = earlier.agg(F.max("batch")).first()[0]
    return {r.bucket: r.version for r in earlier.where(F.col("batch") == last).collect()} if last is not None else {}


def _write_version(hashes: DataFrame, versions: dict[int, int], touched: list[int], store: str, batch_id: int) -> None:
    """Hashes of the touched buckets as version ``batch_id``, then the manifest that names it."""
    spark = hashes.sparkSession
    hashes.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/version={batch_id}")
    rows = sorted({**versions, **dict.fromkeys(touched, batch_id)}.items())
    listed = spark.createDataFrame(rows, "bucket int, version long")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{store}/manifest/batch={batch_id}")


def create_store(snapshot: DataFrame, store: str, key: str = "doc_id") -> None:
    """A hash store of ``snapshot`` (key, text): no text is kept, only a hash for each key."""
    hashes = _hashed(snapshot, key)
    touched = [r.bucket for r in hashes.select("bucket").distinct().collect()]
    _write_version(hashes, {}, touched, store, FIRST_VERSION)


def reindex_batch(batch: DataFrame, batch_id: int, store: str, out: str, key: str = "doc_id") -> None:
    """Compare one batch with the store as it was before, write what changed and the store's next version.

    Everything is written under ``batch_id``, and only versions of earlier batches are read, so a repeated batch
    writes the same again.  Of the store only the buckets that the batch touches are read and rewritten;
    earlier versions stay until they are cleared away.
    """
    spark = batch.sparkSession
    now = cut_lineage(_hashed(batch, key))
    touched = sorted(r.bucket for r in now.select("bucket").distinct().collect())
    versions = _store_versions(spark, store, batch_id)
    paths = [f"{store}/version={versions[b]}/bucket={b}" for b in touched if b in versions]
    schema = now.select(key, "hash").schema
    known = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    known = known.withColumnRenamed("hash", "old")
    both = cut_lineage(now.select(key, "hash").join(known, key, "full"))
    changed = both.where(F.col("hash").isNotNull() & ~F.col("hash").eqNullSafe(F.col("old")))
    changed.select(key, F.when(F.col("old").isNull(), "added").otherwise("kept").alias("status")).write.mode(
        "overwrite").parquet(f"{out}/batch={batch_id}")
    merged = both.select(key, F.coalesce("hash", "old").alias("hash")).withColumn(
        "bucket", F.pmod(F.xxhash64(key), F.lit(STORE_BUCKETS)).cast("int"))
    _write_version(merged, versions, touched, store, batch_id)
    release(now)
    release(both)


def stream_reindex(snapshots: DataFrame, store: str, out: str, key: str = "doc_id", checkpoint: str | None = None) -> DataFrame:
    """Changed documents only, of snapshots (key, text): (key, status, batch).

    ``store`` is made by ``create_store``; every batch brings it up to date, so a document that changes twice is
    reported twice and one that stays as it was never.  With the same ``checkpoint`` a later run goes on where
    this one ended.
    """
    spark = snapshots.sparkSession
    place = checkpoint or f"{scratch_dir(spark).rstrip('/')}/cp-{uuid.uuid4().hex}"
    q = (
        snapshots.writeStream.foreachBatch(lambda batch, batch_id: reindex_batch(batch, batch_id, store, out, key))
        .option("checkpointLocation", place).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    key_type = snapshots.schema[key].dataType.simpleString()
    return spark.read.schema(f"{key} {key_type}, status string, batch long").parquet(out)
