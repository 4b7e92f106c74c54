"""Workspace inventory, project resolution, key usage and access matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def named_folders(folders: DataFrame, projects: DataFrame) -> DataFrame:
    """Folders (id, name, parent_id, project_id) with parent and project names or a visible placeholder."""
    parent = folders.select(F.col("id").alias("parent_id"), F.col("name").alias("__parent"))
    proj = projects.select(F.col("id").alias("project_id"), F.col("name").alias("__project"))
    d = folders.join(parent, "parent_id", "left").join(proj, "project_id", "left")
    missing = F.concat(F.lit("[ID: "), F.col("parent_id").cast("string"), F.lit("] (not found)"))
    label = F.when(F.col("parent_id").isNull(), "TOP LEVEL").otherwise(F.coalesce("__parent", missing))
    project = F.coalesce("__project", F.concat(F.lit("[ID: "), F.col("project_id").cast("string"), F.lit("]")))
    return d.select("id", "name", label.alias("parent_folder"), project.alias("project_name"))


def named_recipes(recipes: DataFrame, folders: DataFrame, projects: DataFrame) -> DataFrame:
    """Recipes with status, project, folder and last run."""
    f = folders.select(F.col("id").alias("folder_id"), F.col("name").alias("__folder"))
    p = projects.select(F.col("id").alias("project_id"), F.col("name").alias("__project"))
    d = recipes.join(f, "folder_id", "left").join(p, "project_id", "left")
    return d.select(
        "id", "name", F.when(F.col("running"), "ACTIVE").otherwise("STOPPED").alias("status"),
        F.coalesce("__project", F.col("project_id").cast("string")).alias("project"),
        F.coalesce("__folder", F.col("folder_id").cast("string")).alias("folder"),
        F.coalesce(F.col("last_run").cast("string"), F.lit("NEVER")).alias("last_run"),
    )


def resolve_project(recipes: DataFrame, folders: DataFrame, projects: DataFrame) -> DataFrame:
    """Project of a recipe through its folder: a project folder owns its project, others name it by id."""
    f = folders.select(
        F.col("id").alias("folder_id"), F.col("name").alias("folder_name"), "is_project", F.col("project_id").alias("__pid"),
    )
    by_folder = projects.groupBy("folder_id").agg(F.min_by(F.struct("id", "name"), "id").alias("__own"))
    by_id = projects.select(F.col("id").alias("__pid"), F.col("name").alias("__name"), F.col("folder_id").alias("__pf"))
    d = recipes.select(F.col("id").alias("recipe_id"), "folder_id").join(f, "folder_id", "left")
    d = d.join(by_folder, "folder_id", "left").join(by_id, "__pid", "left")
    own = F.coalesce(F.col("is_project"), F.lit(False))
    return d.select(
        "recipe_id", "folder_id", "folder_name", own.alias("is_project_folder"),
        F.when(own, F.col("__own.id")).otherwise(F.col("__pid")).alias("project_id"),
        F.when(own, F.col("__own.name")).otherwise(F.col("__name")).alias("project_name"),
        F.when(own, F.col("folder_id")).otherwise(F.col("__pf")).alias("project_folder_id"),
        F.when(F.col("folder_name").isNull() & F.col("is_project").isNull(), "folder not found").alias("error"),
    )


def sync_inventory(projects: DataFrame, folders: DataFrame, recipes: DataFrame, out: str) -> None:
    """Rebuild the three inventory tables."""
    for name, d in (
        ("projects", projects), ("folders", named_folders(folders, projects)),
        ("recipes", named_recipes(recipes, folders, projects)),
    ):
        d.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")


def key_usage(keys: DataFrame, activity: DataFrame) -> DataFrame:
    """Last use per key; keys without activity say so.  Activity names a key by its resource path."""
    used = activity.select(F.element_at(F.split("resource", "/keys/"), -1).alias("__id"), "last_used")
    used = used.groupBy("__id").agg(F.max("last_used").alias("last_used"))
    d = keys.join(used, F.col("key_id").cast("string") == F.col("__id"), "left")
    return d.select("key_id", "account", F.coalesce(F.col("last_used").cast("string"), F.lit("no_recent_usage")).alias("last_used"))


def access_matrix(
    accounts: DataFrame, in_bindings: DataFrame, out_bindings: DataFrame, in_roles: Sequence[str], out_roles: Sequence[str],
) -> DataFrame:
    """Per account: any reading role on the input side, any writing role on the output side, notes, candidacy.

    Bindings are (role, members) rows; ``members`` is a list.
    """
    def holders(b: DataFrame, roles: Sequence[str], flag: str) -> DataFrame:
        m = b.where(F.col("role").isin(list(roles))).select(F.explode("members").alias("account")).distinct()
        return m.withColumn(flag, F.lit(True))

    d = accounts.join(holders(in_bindings, in_roles, "can_read"), "account", "left")
    d = d.join(holders(out_bindings, out_roles, "can_write"), "account", "left")
    read, write = (F.coalesce(c, F.lit(False)) for c in ("can_read", "can_write"))
    notes = F.concat_ws("; ", F.when(~read, "no input access"), F.when(~write, "no output access"))
    return d.select("account", read.alias("can_read"), write.alias("can_write"), notes.alias("notes"), (read & write).alias("candidate"))
