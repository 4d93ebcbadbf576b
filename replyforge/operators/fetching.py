"""Fetch plans over manifests: what to fetch, what is there already, how a run went."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.functions.render import render
from replyforge.functions.text import basename, dirname, stem
from replyforge.operators.skew import with_running
from replyforge.sources.files import list_folder

RAW_URL = "https://raw.githubusercontent.com/{}/{}/{}"
FILES_PER_GROUP = 50
KEYS = ("repo", "commit_id", "rel_path")


def file_groups(files: DataFrame, per_group: int = FILES_PER_GROUP, path: str = "file") -> DataFrame:
    """Sorted file list cut into groups of ``per_group``, numbered from 0."""
    numbered = with_running(files.select(path).distinct(), [], [path], row_number="_n")
    return numbered.select(path, F.floor((F.col("_n") - 1) / per_group).alias("group_id"))


def group_of(groups: DataFrame, group_id: int) -> DataFrame:
    """Files of one group; raises when there is no such group."""
    chosen = groups.where(F.col("group_id") == group_id)
    if chosen.isEmpty():
        raise ValueError(f"no file group {group_id}")
    return chosen


def remaining_files(files: DataFrame, ledger: DataFrame, path: str = "file", done: str = "parquet_filename") -> DataFrame:
    """Files whose base name the ledger does not list."""
    named = files.withColumn("_base", basename(path))
    listed = ledger.select(F.col(done).alias("_base")).distinct()
    return named.join(listed, ["_base"], "left_anti").drop("_base")


def fetch_plan(manifest: DataFrame, root: str, url_template: str = RAW_URL, source: str = "manifest") -> DataFrame:
    """``url`` and ``target`` per manifest row.

    The target holds repository and commit, so equal relative paths of two repositories do not collide.
    """
    target = F.concat_ws("/", F.lit(root.rstrip("/")), stem(source), "repo", "commit_id", "rel_path")
    return manifest.select(
        source,
        *KEYS,
        render(url_template, *KEYS).alias("url"),
        target.alias("target"),
        dirname("rel_path").alias("dir_name"),
        basename("rel_path").alias("file_name"),
    )


def skip_fetched(plan: DataFrame, existing: DataFrame | str, keys: Sequence[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Rows still to fetch, and outcome rows (success, skipped, size) for targets that exist.

    ``existing`` has the keys and the ``size``; of several rows of a key the greatest size counts. It may also be the
    folder the targets lie in, which is then listed in tasks, level by level, and compared with the targets' paths.
    """
    if isinstance(existing, str):
        found = list_folder(plan.sparkSession, existing, recursive=True)
        existing, keys = found.select(F.col("path").alias("target"), "size"), ["target"]
    keys = list(keys)
    have = existing.groupBy(*keys).agg(F.max("size").alias("size"))
    there = plan.join(have, keys).select(
        *plan.columns,
        F.lit(True).alias("success"),
        F.lit(True).alias("skipped"),
        "size",
        F.lit(None).cast("string").alias("error"),
    )
    return plan.join(have.drop("size"), keys, "left_anti").select(plan.columns), there


def fetch_stats(outcomes: DataFrame, source: str = "manifest", manifests: DataFrame | None = None) -> DataFrame:
    """Figures per manifest; ``success`` only when nothing failed.

    ``manifests`` lists the manifests of the run: one without rows is done as well.
    """
    ok = F.coalesce(F.col("success"), F.lit(False))
    skipped = F.coalesce(F.col("skipped"), F.lit(False))
    rows = outcomes.withColumn("_row", F.lit(1))
    if manifests is not None:
        rows = rows.unionByName(manifests.select(source), allowMissingColumns=True)
    ok, skipped, row = ok & F.col("_row").isNotNull(), skipped & F.col("_row").isNotNull(), F.col("_row").isNotNull()
    return (
        rows.groupBy(source)
        .agg(
            F.count("_row").alias("total_files"),
            F.count_if(ok).alias("successful"),
            F.count_if(ok & ~skipped).alias("new_files"),
            F.count_if(ok & skipped).alias("skipped_files"),
            F.count_if(row & ~ok).alias("failed"),
            F.coalesce(F.sum(F.when(ok, F.col("size"))), F.lit(0)).alias("total_size"),
        )
        .withColumn("success", F.col("failed") == 0)
    )


def ledger_entries(stats: DataFrame, source: str = "manifest") -> DataFrame:
    """Manifests that may be marked as done."""
    return stats.where("success").select(F.col(source).alias("parquet_filename"))
