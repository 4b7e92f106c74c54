"""Connected components by alternating large-star and small-star over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.session import cut_lineage, release


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; ``edges`` have u < v."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    inner = edges.join(least, "v").where("u > m").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return inner.union(least.select(F.col("m").alias("u"), "v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u long, v long) -> (node, component), one row for every node that has an edge.

    The component is its smallest node.  Loops, repeated edges and either direction are fine; edges with a
    null end are left out; no edges give no rows.  Both steps aggregate before they shuffle and join by
    node, so a hub is split by skew joins.  Rounds go on until the edges stay as they are; each is written
    to the shared folder, so a lost executor repeats one round at most.
    """
    tidy = edges.where("u is not null and v is not null").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    now = cut_lineage(tidy.where("u < v").distinct())
    mark = _fingerprint(now)
    while mark[0]:
        last, now = now, cut_lineage(_small_star(_large_star(now)))
        release(last)
        before, mark = mark, _fingerprint(now)
        if mark == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
