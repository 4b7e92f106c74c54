"""One query for each operator, with production parameters over its whole table, and its SQL where it has one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsieve.llm import bpe, chat, langid, licenses, oracles, quality, secrets, warc
from mailsieve.llm.ann import nearest_neighbours
from mailsieve.llm.decontaminate import contamination
from mailsieve.llm.near_dup import near_duplicates
from mailsieve.llm.phrases import collocations
from mailsieve.llm.runs import run_digest
from mailsieve.llm.simhash import near_fingerprints

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_random_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_ppm_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(_table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(_table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.format_digest(rows.union(more), RANKS, PATTERN)


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisit_digest(warc.page_records(_table(spark, sf_dir, "pages")))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), top=2000)


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_fingerprints(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_random_projection_forest, op2_ppm_language_id, op3_license_scan, op4_byte_bpe, op5_secret_scan,
    op6_decontamination, op7_quality_rules, op8_chat_format, op9_warc_revisits, op10_minhash_near_dedup,
    op11_phrase_collocations, op12_simhash_near_dedup, op13_periodic_runs,
)}

ORACLES = {
    "op6_decontamination": oracles.OP6, "op8_chat_format": oracles.OP8, "op9_warc_revisits": oracles.OP9,
    "op10_minhash_near_dedup": oracles.OP10, "op11_phrase_collocations": oracles.OP11,
}
