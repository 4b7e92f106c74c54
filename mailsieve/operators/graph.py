"""Edge-table analyses: tree listing, undefined calls, counts and cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.session import cut_lineage, release


def undefined_calls(edges: DataFrame, defined: DataFrame) -> DataFrame:
    """Callees nobody defines, with their call sites."""
    missing = edges.join(defined.select(F.col("id").alias("dst")), "dst", "left_anti")
    return missing.groupBy("dst").agg(F.count("*").alias("call_sites"), F.min("src").alias("first_caller"))


def unused(defined: DataFrame, edges: DataFrame) -> DataFrame:
    return defined.join(edges.select(F.col("dst").alias("id")).distinct(), "id", "left_anti")


def graph_stats(edges: DataFrame) -> DataFrame:
    """Calls, callers, callees and nodes per kind."""
    ends = F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("calls")),
                             F.struct(F.col("dst").alias("node"), F.lit(0).alias("calls")))).alias("end")
    d = edges.select("kind", ends).groupBy("kind", "end.node").agg(
        F.sum("end.calls").alias("calls"), F.count_if(F.col("end.calls") == 0).alias("called"))
    return d.groupBy("kind").agg(
        F.sum("calls").alias("edges"), F.count_if(F.col("calls") > 0).alias("callers"),
        F.count_if(F.col("called") > 0).alias("callees"), F.count("*").alias("nodes"),
    )


def owner_surface(calls: DataFrame, owner: str, endpoint: str, verb: str) -> DataFrame:
    """Endpoints, verbs and calls of each owner."""
    return calls.groupBy(owner).agg(
        F.countDistinct(endpoint).alias("endpoints"), F.countDistinct(verb).alias("verbs"), F.count("*").alias("calls"))


def issue_counts(issues: DataFrame, severity: str, code: str, owner: str) -> DataFrame:
    """Issues and owners by severity and code."""
    return issues.groupBy(severity, code).agg(F.count("*").alias("issues"), F.countDistinct(owner).alias("owners"))


def call_cycles(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on a cycle; a component is named by its smallest node.

    Leaves and roots are trimmed first, then forward and backward reachable minimum labels are
    propagated.  A node whose two labels agree shares a component with that label; settled components
    leave and the rest repeats until no edge is left (each round settles at least the smallest label's
    component).  State is one row per node, never per pair; every round is written to the shared scratch folder.
    """
    loops = edges.where(F.col("src") == F.col("dst")).select(F.col("src").alias("node")).distinct()
    e = cut_lineage(edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct())
    done = loops.select("node", F.col("node").alias("component"), F.lit(1).alias("size"))
    while True:
        e = _trim(e)
        if e.isEmpty():
            break
        nodes = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()
        fwd = _min_label(nodes, e.select("src", "dst"))
        # only nodes reached from the label can share its component
        bwd = _same_label_reach(fwd, e)
        settled = cut_lineage(bwd)
        big = settled.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") > 1)
        done = done.unionByName(settled.join(big, "component").select("node", "component", F.col("size").cast("int").alias("size")))
        gone = settled.select("node")
        e = e.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(
            gone.withColumnRenamed("node", "dst"), "dst", "left_anti"
        )
        e = cut_lineage(e.select("src", "dst"))
    # a self loop inside a larger component belongs to that component
    return done.groupBy("node").agg(F.max_by("component", "size").alias("component"), F.max("size").alias("size"))


# propagation steps between two materialised states
STEPS = 4


def _trim(e: DataFrame) -> DataFrame:
    """Drop edges whose ends cannot lie on a cycle until nothing changes."""
    before = e.count()
    while before:
        last, e = e, cut_lineage(
            e.join(e.select(F.col("dst").alias("src")).distinct(), "src", "left_semi")
            .join(e.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst")
        )
        release(last)
        after = e.count()
        if after == before:
            break
        before = after
    return e


def _min_label(nodes: DataFrame, e: DataFrame) -> DataFrame:
    """Smallest node that reaches each node."""
    labels = cut_lineage(nodes.select("node", F.col("node").alias("label"), F.lit(True).alias("moved")))
    while not labels.where("moved").isEmpty():
        new = labels.select("node", "label", F.col("label").alias("old"))
        for _ in range(STEPS):
            sent = new.join(e, new["node"] == e["src"]).select(
                F.col("dst").alias("node"), "label", F.lit(None).cast(new.schema["old"].dataType).alias("old")
            )
            new = new.unionByName(sent).groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        last, labels = labels, cut_lineage(new.select("node", "label", (F.col("label") < F.col("old")).alias("moved")))
        release(last)
    return labels.select("node", "label")


def _same_label_reach(fwd: DataFrame, e: DataFrame) -> DataFrame:
    """Nodes that reach back to their own label through nodes of the same label: one component per label."""
    f = fwd.withColumnRenamed("label", "component")
    inner = e.join(f.withColumnRenamed("node", "src").withColumnRenamed("component", "cs"), "src").join(
        f.withColumnRenamed("node", "dst").withColumnRenamed("component", "cd"), "dst"
    ).where(F.col("cs") == F.col("cd")).select("src", "dst")
    inner = cut_lineage(inner)
    reached = cut_lineage(f.where(F.col("node") == F.col("component")))
    size = reached.count()
    while True:
        last = reached
        for _ in range(STEPS):
            step = reached.join(inner, reached["node"] == inner["dst"]).select(F.col("src").alias("node"), "component")
            reached = reached.unionByName(step).distinct()
        reached = cut_lineage(reached)
        release(last)
        grown = reached.count()
        if grown == size:
            return reached
        size = grown


def list_tree(
    folders: DataFrame, files: DataFrame, root, max_depth: int = 0, keep: Column | None = None,
    limit: int | None = None, after: tuple[int, int, int] | None = None,
) -> DataFrame:
    """Children of every folder under ``root`` level by level (``max_depth`` <= 0: all; 1: the root only).

    ``folders`` holds (id, parent_id) edges and ``files`` everything listed, with parent_id.  Folders are
    discovered regardless of ``keep``, which filters what is listed.  Loops end on an empty frontier.  With a
    ``limit`` a page comes out, in the order (depth, folder, id); ``after`` is the last row of the page before.
    """
    spark = folders.sparkSession
    seen = spark.createDataFrame([(root, 1)], "folder bigint, depth int")
    frontier, depth = seen, 1
    while max_depth <= 0 or depth < max_depth:
        step = folders.join(frontier, folders["parent_id"] == frontier["folder"]).select(folders["id"].alias("folder"))
        frontier = cut_lineage(
            step.distinct().join(seen.select("folder"), "folder", "left_anti").withColumn("depth", F.lit(depth + 1))
        )
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        depth += 1
    listed = files.where(keep) if keep is not None else files
    out = listed.join(seen, listed["parent_id"] == seen["folder"])
    if after is not None:
        last = F.struct(*[F.lit(x).cast(t).alias(n) for n, t, x in zip(
            ("depth", "folder", "id"), ("int", "bigint", out.schema["id"].dataType), after, strict=True)])
        out = out.where(F.struct("depth", "folder", "id") > last)
    return out if limit is None else out.orderBy("depth", "folder", "id").limit(limit)
