"""Nested JSON to flat CSV lines."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.functions.mime import csv_field

# a table wider than this is refused: the header is metadata and must stay small
MAX_HEADERS = 10_000


@dataclass(frozen=True)
class CsvTable:
    """Header, lines, and the rows that are no object: (key, pos, error)."""

    header: list[str]
    lines: DataFrame
    errors: DataFrame


def flatten(value, prefix: str, out: dict[str, str], empty_as_blank: bool) -> None:
    """Objects become ``a.b``, lists ``a[0]``; an empty container is blank or absent."""
    if isinstance(value, dict) and value:
        for k, v in value.items():
            flatten(v, f"{prefix}.{k}" if prefix else str(k), out, empty_as_blank)
    elif isinstance(value, list) and value:
        for i, v in enumerate(value):
            flatten(v, f"{prefix}[{i}]", out, empty_as_blank)
    elif isinstance(value, (dict, list)):
        if empty_as_blank:
            out[prefix] = ""
    elif value is None:
        out[prefix] = ""
    elif isinstance(value, bool):
        out[prefix] = "true" if value else "false"
    else:
        out[prefix] = str(value)


def flatten_rows(df: DataFrame, key: str, json_col: str, empty_as_blank: bool = True) -> DataFrame:
    """(key, pos, paths, values) per row; an array of objects gives one row per element, and text that is
    no object or array of objects gives an error."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, text in zip(pdf[key], pdf[json_col]):
                try:
                    doc = json.loads(text)
                except (TypeError, ValueError):
                    doc = None
                items = doc if isinstance(doc, list) else [doc]
                for i, item in enumerate(items):
                    if not isinstance(item, dict):
                        rows.append((k, i, [], [], "element is not an object"))
                        continue
                    flat: dict[str, str] = {}
                    flatten(item, "", flat, empty_as_blank)
                    rows.append((k, i, list(flat), list(flat.values()), None))
            yield pd.DataFrame(rows, columns=["key", "pos", "paths", "cells", "error"])

    ddl = f"key {kind}, pos int, paths array<string>, cells array<string>, error string"
    return df.select(key, json_col).mapInPandas(run, ddl)


def first_seen(flat: DataFrame) -> DataFrame:
    """Paths with the first (row, position) at which each occurs; partial minima precede the shuffle."""
    p = flat.select("key", "pos", F.posexplode("paths").alias("col", "path"))
    return p.groupBy("path").agg(F.min(F.struct("key", "pos", "col")).alias("first"))


def json_to_csv(df: DataFrame, key: str, json_col: str, empty_as_blank: bool = True) -> CsvTable:
    """Header in first-seen order and one quoted line per row.

    Only the distinct paths (column names) reach the driver.
    """
    every = flatten_rows(df, key, json_col, empty_as_blank)
    flat = every.where(F.col("error").isNull())
    head = first_seen(flat).orderBy("first").limit(MAX_HEADERS + 1).collect()
    if len(head) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} columns")
    names = [r["path"] for r in head]
    d = flat.withColumn("__m", F.map_from_arrays("paths", F.transform("cells", csv_field)))
    header = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    line = F.array_join(F.transform(header, lambda n: F.coalesce(F.try_element_at("__m", n), csv_field(F.lit(None)))), ",")
    errors = every.where(F.col("error").isNotNull()).select("key", "pos", "error")
    return CsvTable(names, d.select("key", "pos", line.alias("line")), errors)


def write_csv(table: CsvTable, path: str) -> None:
    """Lines in key order within each file; the header goes to its own ``_header`` folder beside them."""
    table.lines.sortWithinPartitions("key", "pos").select("line").write.mode("overwrite").text(path)
    spark = table.lines.sparkSession
    spark.createDataFrame([(",".join(table.header),)], "line string").write.mode("overwrite").text(path.rstrip("/") + "_header")
