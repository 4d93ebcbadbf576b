"""Finding the newest snapshot of a growing result file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyforge.functions.text import dirname
from replyforge.sources.files import list_folder
from replyforge.sources.jsonl import Lines, read_jsonl


def snapshot_files(spark: SparkSession, folder: str, pattern: str = "snapshot_*.jsonl") -> DataFrame:
    """Path, part folder and modification time of every snapshot below a folder; listed in tasks, contents are not read."""
    listing = list_folder(spark, folder, pattern, recursive=True)
    return listing.select("path", dirname("path").alias("part"), F.col("modified").alias("modificationTime"))


def latest_snapshot(files: DataFrame) -> DataFrame:
    """Newest snapshot of each part; the greater path decides between equal times."""
    return files.groupBy("part").agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path"),
        F.max("modificationTime").alias("modificationTime"),
    )


def restore_latest(spark: SparkSession, folder: str, schema=None) -> Lines:
    """Read the newest snapshot of one part as the checkpoint to resume from."""
    newest = latest_snapshot(snapshot_files(spark, folder)).select("path").first()
    if newest is None:
        raise FileNotFoundError(f"no snapshot in {folder}")
    return read_jsonl(spark, newest["path"], schema)
