"""JSONL outputs and small report files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", save_prompt: bool = True, prompt: str = "prompt"):
    """One JSON object per line in UTF-8, null fields kept; the prompt column goes unless asked for."""
    out = df if save_prompt else df.drop(prompt)
    out.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_by_source(df: DataFrame, path: str, source: str = "source_file", max_rows_per_file: int = 5_000_000):
    """One output folder per input file.

    Rows are not shuffled by file: a scan task holds a run of one or a few files anyway, and a file with a
    third of all rows must not end up in one task.
    """
    (
        df.write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(source)
        .json(path)
    )
