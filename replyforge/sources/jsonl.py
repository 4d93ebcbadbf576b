"""JSON and JSONL sources."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyforge.functions.flags import variant_boolean, variant_string
from replyforge.functions.ids import parse_attempt_id
from replyforge.functions.jsontext import OBJECT_START, json_path, strict_json
from replyforge.functions.text import is_blank
from replyforge.operators.checkpoints import last_wins
from replyforge.sources.files import PACKED, PART_BYTES, lines_of, list_folder, open_folder
from replyforge.sources.storage import path_exists


class Lines(NamedTuple):
    """Usable rows and the lines that were dropped."""

    rows: DataFrame
    rejects: DataFrame


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Drop blank lines; add ``record`` (VARIANT) and ``is_object`` to the rest.

    A narrow step, so it also runs on a stream. A line that is no JSON, or JSON but not an
    object, keeps ``is_object = false``.
    """
    # Generated instead of projected: a filter on the record then stays above it, and no line is parsed twice.
    parsed = lines.where(~is_blank(column)).select("*", F.explode(F.array(strict_json(column))).alias("record"))
    return parsed.withColumn(
        "is_object", F.col("record").isNotNull() & F.regexp_like(F.col(column), F.lit(OBJECT_START))
    )


def typed_field(record: Column, name: str, kind: T.DataType) -> Column:
    """A field in its own JSON type: text stays text, only real booleans are booleans."""
    if isinstance(kind, T.StringType):
        return variant_string(record, name)
    if isinstance(kind, T.BooleanType):
        return variant_boolean(record, name)
    return F.try_variant_get(record, json_path(name), kind.simpleString())


def typed_rows(parsed: DataFrame, schema: T.StructType | str, keep: list[str] | None = None) -> DataFrame:
    """Project parsed objects to a schema; ``keep`` names further columns to carry along."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    typed = [typed_field(F.col("record"), f.name, f.dataType).alias(f.name) for f in fields]
    return parsed.where("is_object").select(*(keep or []), *typed)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> Lines:
    """Tolerant JSONL: malformed lines are set apart, the rest is kept.

    Without a schema the rows carry the whole record as VARIANT, so an absent key, a JSON null and
    a value of an unexpected type can still be told apart.
    """
    parsed = parse_lines(spark.read.text(path))
    rows = typed_rows(parsed, schema) if schema is not None else parsed.where("is_object").select("record")
    return Lines(rows, parsed.where("NOT is_object").select("value"))


def read_verdicts(spark: SparkSession, path: str) -> Lines:
    """Attempt verdicts: ``query_id``, ``response_idx``, ``success``.

    A line is rejected when it is no object, its id is no text of the form ``<query>_<integer>``, or its success is no
    boolean.
    """
    return verdict_rows(parse_lines(spark.read.text(path)))


def verdict_rows(parsed: DataFrame, column: str = "value") -> Lines:
    """:func:`read_verdicts` over lines that :func:`parse_lines` has seen."""
    record = F.col("record")
    typed = parsed.select("*", variant_string(record, "id").alias("id"), variant_boolean(record, "success").alias("success"))
    marked = parse_attempt_id(typed)
    good = F.col("is_object") & F.col("response_idx").isNotNull() & F.col("success").isNotNull()
    rows = marked.where(good).select("query_id", "response_idx", "success")
    return Lines(rows, marked.where(~F.coalesce(good, F.lit(False))).select(column))


def resolve_json_path(spark: SparkSession, path: str) -> str:
    """``<path>.json``, then ``<path>.jsonl``, then the path itself if it has such an ending."""
    for ending in (".json", ".jsonl"):
        if path_exists(spark, path + ending):
            return path + ending
    if path.endswith((".json", ".jsonl")) and path_exists(spark, path):
        return path
    raise FileNotFoundError(f"no JSON or JSONL file at {path}")


def read_json_table(
    spark: SparkSession,
    path: str,
    key: str | None = None,
    schema: T.StructType | str | None = None,
    seq: str | None = None,
) -> DataFrame:
    """Strict reader: one bad line fails the job that reads it.

    ``.json`` holds one document, ``.jsonl`` one record per line. With ``key`` the last row per key is
    kept and rows without the key are dropped; ``seq`` names the column that tells which row is last,
    by default the file and the position in it.
    """
    found = resolve_json_path(spark, path)
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", found.endswith(".json"))
    if schema is not None:
        reader = reader.schema(schema)
    table = reader.json(found)
    places = ["_file", "_block", "_row"]
    if found.endswith(".jsonl"):
        lines = spark.read.text(found).select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        table = _strict_lines(lines, table.schema, places)
    else:
        table = table.withColumns({"_file": F.lit(""), "_block": F.lit(0), "_row": F.monotonically_increasing_id()})
    if key is None:
        return table.drop(*places)
    keyed = table.where(F.col(key).isNotNull())
    # Splits of several files are dealt out by size, so file and place in it come first; rows of a split follow in order.
    return last_wins(keyed, [key], places if seq is None else [seq]).drop(*places)


def _strict_lines(lines: DataFrame, schema: T.StructType, carry: list[str]) -> DataFrame:
    """Records of lines that must each be one JSON value; a blank line or text after the value fails the read."""
    complaint = F.raise_error(F.concat(F.lit("not one JSON value: "), F.substring("value", 1, 200))).cast("string")
    checked = F.when(strict_json("value").isNotNull(), F.col("value")).otherwise(complaint)
    return lines.select(F.from_json(checked, schema, {"mode": "FAILFAST"}).alias("record"), *carry).select("record.*", *carry)


def join_base_dir(base_dir: str, name: str) -> str:
    """A name with a slash is a path of its own."""
    return name if "/" in name or not base_dir else f"{base_dir.rstrip('/')}/{name}"


def lookup_idx(df: DataFrame, idx=None, order: str | None = None) -> DataFrame:
    """The first row with ``idx``; all rows without one. Raises when there is no such row."""
    if idx is None:
        return df
    hits = df.where(F.col("idx") == F.lit(idx))
    hit = (hits.orderBy(order) if order else hits).limit(1)
    if hit.isEmpty():
        raise ValueError(f"no entry for idx {idx}")
    return hit


def list_files(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """``source_file`` of every matching file directly in a folder, files of no bytes included; nothing is read."""
    return list_folder(spark, path, pattern).select(F.col("name").alias("source_file"))


def scan_dir(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """Raw lines of every ``*.jsonl`` directly in a folder, with the file name of each line.

    A folder without such files gives an empty table. A file that cannot be read ends the job; :func:`scan_files` sets
    it apart.
    """
    return spark.read.option("pathGlobFilter", pattern).text(path).select("value", F.col("_metadata.file_name").alias("source_file"))


def scan_files(spark: SparkSession, path: str, pattern: str = "*.jsonl", part_bytes: int = PART_BYTES) -> DataFrame:
    """:func:`scan_dir` with each file's failure as a row of its own: ``source_file``, ``value``, ``error``.

    Rows with an ``error`` say that a file, or a part of it, could not be read; lines of the same file that were read before
    may be there, too. Large files are read in parts by several tasks, packed ones (``.gz`` and the like) from their start.
    Write the rows once and part them with :func:`part_failed`.
    """
    known = list_folder(spark, path, pattern)
    whole = reduce(lambda a, b: a | b, [F.endswith("name", F.lit(e)) for e in PACKED])
    begins = F.when(whole | (F.col("size") <= part_bytes), F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(part_bytes).cast("long"))
    )
    parts = known.select("path", "name", "size", whole.alias("whole"), F.explode(begins).alias("begin"))
    cores = spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                end = None if part["whole"] else min(part["begin"] + part_bytes, part["size"])
                try:
                    files, place = open_folder(part["path"])
                    for _, texts in lines_of(files, place, part["begin"], end, part["begin"] == 0):
                        yield _rows(part["name"], texts, None)
                except Exception as failure:  # noqa: BLE001 - a file that cannot be read is data, not a failed job
                    yield _rows(part["name"], [None], str(failure) or type(failure).__name__)

    return parts.repartition(4 * cores).mapInArrow(run, "source_file string, value string, error string")


def _rows(name: str, texts: list, error: str | None) -> pa.RecordBatch:
    columns = [[name] * len(texts), texts, [error] * len(texts)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["source_file", "value", "error"])


def part_failed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that were read to their end, and ``source_file, error`` of the others.

    ``rows`` are those of :func:`scan_files`, written once, with ``error`` among their columns.
    """
    failed = rows.where(F.col("error").isNotNull()).groupBy("source_file").agg(F.min("error").alias("error"))
    good = rows.where(F.col("error").isNull()).join(failed.select("source_file"), "source_file", "left_anti")
    return good.drop("error"), failed
