"""Filtering a folder of JSONL files with a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyforge.functions.flags import variant_string
from replyforge.functions.jsontext import strict_json
from replyforge.functions.text import is_blank, round_even
from replyforge.operators.classify import add_confidence, retention_by_file, write_filter_report
from replyforge.sources.jsonl import list_files, part_failed, scan_files
from replyforge.sources.storage import materialize


def with_score(record: Column, score: Column) -> Column:
    """JSON text of a VARIANT object with ``score`` set; an existing one is replaced."""
    fields = F.map_filter(record.cast("map<string,variant>"), lambda k, _: k != "score")
    return F.to_json(F.map_concat(fields, F.create_map(F.lit("score"), F.parse_json(score.cast("string")))))


def mark_lines(lines: DataFrame, model: DataFrame, min_confidence: float = 0.0) -> DataFrame:
    """Every line's ``source_file``, whether it is ``blank``, and its ``value`` with the new ``score`` if it is retained.

    The value of other lines is null; an ``error`` of the lines stays. One narrow pass: a line is parsed and scored
    where it is read.
    """
    carried = ["source_file", *[c for c in lines.columns if c == "error"]]
    parsed = lines.select(*carried, "value", F.explode(F.array(strict_json("value"))).alias("record"))
    texts = parsed.select(*carried, "value", is_blank("value").alias("blank"), variant_string("record", "text").alias("text"))
    scored = add_confidence(texts, model)
    good = F.coalesce((F.col("label") == 1) & (F.col("confidence") >= min_confidence), F.lit(False))
    written = with_score(F.parse_json("value"), round_even("confidence", 4))
    return scored.select(*carried, "blank", F.when(good, written).alias("value"))


def filter_lines(
    lines: DataFrame, model: DataFrame, min_confidence: float = 0.0, files: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Retained lines (``source_file``, ``value`` with its new ``score``) and retention per file.

    ``lines`` has ``value`` and ``source_file``; ``files`` adds the files without lines to the figures.
    """
    return split_marked(mark_lines(lines, model, min_confidence), files)


def split_marked(marked: DataFrame, files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The two results of :func:`filter_lines` from marked lines."""
    found = F.col("value").isNotNull()
    return marked.where(found).select("source_file", "value"), retention_by_file(marked.where("NOT blank"), found, files=files)


def filter_folder(
    spark: SparkSession, src: str, out: str, model: DataFrame, min_confidence: float = 0.0, pattern: str = "*.jsonl"
) -> DataFrame:
    """Filter the ``*.jsonl`` files of a folder; write the lines by source and the report; return the figures.

    The input is read and scored once; records and figures come from what that pass has written. A file that could not
    be read to its end is set apart as failed: it gives no record and no figure, however much of it was read.
    """
    lines = scan_files(spark, src, pattern)
    marked, failed = part_failed(materialize(mark_lines(lines, model, min_confidence), "filtered"))
    files = list_files(spark, src, pattern).join(failed.select("source_file"), "source_file", "left_anti")
    kept, per_file = split_marked(marked, files)
    kept.write.mode("overwrite").partitionBy("source_file").text(f"{out}/records")
    figures = materialize(per_file, "retention")
    write_filter_report(figures, f"{out}/report", failed)
    return figures
