"""Fetching the files a group of manifests names."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyforge.functions.text import basename
from replyforge.operators.calls import fetch
from replyforge.operators.fetching import (
    fetch_plan,
    fetch_stats,
    file_groups,
    group_of,
    ledger_entries,
    remaining_files,
    skip_fetched,
)
from replyforge.plans.ledger import Ledger
from replyforge.sources.files import list_folder
from replyforge.sources.storage import materialize
from replyforge.sources.tables import read_manifest


def list_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the Parquet manifests of a folder; listed in a task, contents are not read."""
    return list_folder(spark, folder, "*.parquet").select(F.col("path").alias("file"))


def acquire(
    manifest: DataFrame,
    root: str,
    fetcher: Callable[[], Callable[[str, str], int]],
    existing: DataFrame | str | None = None,
    partitions: int | None = None,
    manifests: DataFrame | None = None,
    run_path: str | None = None,
    chunks: int = 100,
    parallel: int = 4,
    **limits,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Outcome rows, figures per manifest and the ledger entries of the manifests that are done.

    ``existing`` tells what need not be fetched, as a table or as the folder to look in. With a ``run_path`` the plan is written there in ``chunks`` pieces, fetched ``parallel`` at a time, and a run that was
    cut off goes on with the pieces that are not done. ``limits`` are those of ``operators.calls.fetch``.
    """
    plan = fetch_plan(manifest, root)
    there = None
    if existing is not None:
        plan, there = skip_fetched(plan, existing)
    if run_path is None:
        fetched = fetch(plan, fetcher, partitions, **limits)
    else:
        tasks = -(-(partitions or plan.sparkSession.sparkContext.defaultParallelism) // parallel)
        fetched = Ledger(plan, run_path, chunks, parallel).run(partial(fetch, fetcher=fetcher, partitions=tasks, **limits))
    outcomes = materialize(fetched if there is None else fetched.unionByName(there), "fetched")
    stats = fetch_stats(outcomes, manifests=manifests)
    return outcomes, stats, ledger_entries(stats)


def acquire_group(
    spark: SparkSession, folder: str, group_id: int, root: str, fetcher, ledger: DataFrame | None = None, **options
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The manifests of one file group that the ledger does not list yet, read and fetched in one job."""
    chosen = group_of(file_groups(list_manifests(spark, folder)), group_id)
    if ledger is not None:
        chosen = remaining_files(chosen, ledger)
    wanted = chosen.select(basename("file").alias("manifest"))
    # A group holds at most 50 files, so this table is small by construction.
    rows = read_manifest(spark, folder).join(F.broadcast(wanted), "manifest", "left_semi")
    return acquire(rows, root, fetcher, manifests=wanted, **options)
