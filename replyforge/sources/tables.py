"""Parquet sources and any other installed Spark format."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyforge.functions.text import basename
from replyforge.operators.skew import with_running


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """``uuid`` and ``formal_statement``; ``id`` stands in for a missing ``uuid`` column."""
    table = spark.read.parquet(path)
    if "uuid" not in table.columns and "id" in table.columns:
        table = table.withColumnRenamed("id", "uuid")
    missing = [c for c in ("uuid", "formal_statement") if c not in table.columns]
    if missing:
        raise ValueError(f"missing columns {missing}, found {table.columns}")
    return table.select("uuid", "formal_statement")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``repo``, ``commit_id``, ``rel_path`` and the manifest file each row came from."""
    return spark.read.parquet(path).select(
        "repo", "commit_id", "rel_path", F.col("_metadata.file_name").alias("manifest")
    )


@contextmanager
def case_sensitive(spark: SparkSession):
    """Column names are told apart by case while the block runs; run the actions inside it too."""
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet", name_col: str = "lance_dataset") -> DataFrame:
    """Load a dataset; add ``_rowid`` and the dataset's base name.

    Formats that expose ``_rowid`` keep theirs. For Parquet the id is the file's position in the
    sorted listing (upper 32 bits) and the row's position in that file (lower 32 bits).
    """
    clean = path.rstrip("/")
    with case_sensitive(spark):
        table = spark.read.format(fmt).load(path)
        if "_rowid" not in table.columns and fmt == "parquet":
            table = _with_parquet_row_id(table)
        return table.withColumn(name_col, basename(F.lit(clean)))


def _with_parquet_row_id(table: DataFrame) -> DataFrame:
    # One row per file; no data column is read for it, and Spark decides whether to broadcast it.
    files = table.select(F.col("_metadata.file_path").alias("_file")).distinct()
    listing = with_running(files, [], ["_file"], row_number="_ordinal")
    marked = table.select("*", F.col("_metadata.row_index").alias("_row"), F.col("_metadata.file_path").alias("_file"))
    return (
        marked.join(listing, ["_file"])
        .withColumn("_rowid", F.shiftleft(F.col("_ordinal") - 1, 32) + F.col("_row"))
        .select(*table.columns, "_rowid")
    )


def with_position(table: DataFrame, name: str = "_position") -> DataFrame:
    """Number the rows of a Parquet table from 0, file after file in the order of the paths.

    Counting the rows of each file reads no data column; the rows themselves are not shuffled to be numbered.
    """
    sizes = table.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count("*").alias("_n"))
    upto = with_running(sizes, [], ["_file"], {"_upto": "_n"})
    before = upto.select("_file", (F.col("_upto") - F.col("_n")).alias("_before"))
    marked = table.select("*", F.col("_metadata.row_index").alias("_row"), F.col("_metadata.file_path").alias("_file"))
    return (
        marked.join(before, ["_file"])
        .withColumn(name, F.col("_before") + F.col("_row"))
        .select(*table.columns, name)
    )
