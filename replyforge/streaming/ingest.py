"""Copying new result lines to durable storage as they appear, none lost and none twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from replyforge.sources.growing import SCHEMA, GrowingFiles
from replyforge.sources.jsonl import parse_lines, typed_rows

# Pause between looks at the source folder, and new lines from which on a look takes them (fixed values).
INTERVAL = "300 seconds"
SNAPSHOT_LINES = 1000


def open_stream(
    spark: SparkSession,
    src: str,
    fmt: str = "text",
    schema=None,
    pattern: str = "*.jsonl",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A folder of result files as a stream. Every format but ``text`` needs its schema."""
    reader = spark.readStream.format(fmt).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(src)


def jsonl_stream(spark: SparkSession, src: str, schema, **options) -> DataFrame:
    """Tolerant JSONL rows; all steps are stateless."""
    return typed_rows(parse_lines(open_stream(spark, src, **options)), schema)


def ingest_stream(
    rows: DataFrame, sink: str, checkpoint: str, once: bool = True, interval: str = INTERVAL, fmt: str = "parquet"
) -> StreamingQuery:
    """Append new rows to ``sink``.

    ``once`` takes everything that is there and stops, otherwise the source is looked at every ``interval``. The
    checkpoint remembers which files were taken, and the file sink's log makes a repeated batch count once. A file has
    to be complete when it appears; :func:`ingest_appended` is for files that grow.
    """
    writer = rows.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start(sink)


def growing_stream(spark: SparkSession, src: str, pattern: str = "*.jsonl", min_lines: int = 1, checkpoint: str | None = None, **options) -> DataFrame:
    """The lines appended to the files of a folder as a stream: ``source_file``, ``start`` (first byte), ``value``."""
    spark.dataSource.register(GrowingFiles)
    reader = spark.readStream.format(GrowingFiles.name()).options(pattern=pattern, min_lines=min_lines, path=src, **options)
    return (reader.option("checkpoint", checkpoint) if checkpoint else reader).load()


def ingest_appended(spark: SparkSession, src: str, sink: str, pattern: str = "*.jsonl", min_lines: int = 1) -> int:
    """Take the lines that were appended to the files of ``src`` since the last look; answers their number.

    For result files that grow while they are looked at, which the file stream would count once only. A look reads the
    appended bytes alone, up to the last newline, and takes nothing while there are fewer than ``min_lines`` new lines.
    ``sink/checkpoint`` is the stream's checkpoint, ``sink/lines`` its file sink, whose log makes a batch that was cut
    off count once; the next look repeats that batch alone. Files must only grow; their names tell them apart.
    :func:`watch_appended` looks at intervals.
    """
    query = ingest_stream(growing_stream(spark, src, pattern, min_lines, f"{sink}/checkpoint"), f"{sink}/lines", f"{sink}/checkpoint")
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def watch_appended(
    spark: SparkSession, src: str, sink: str, pattern: str = "*.jsonl", min_lines: int = SNAPSHOT_LINES, interval: str = INTERVAL
) -> StreamingQuery:
    """:func:`ingest_appended` at every ``interval``, until the query is stopped."""
    rows = growing_stream(spark, src, pattern, min_lines, f"{sink}/checkpoint")
    return ingest_stream(rows, f"{sink}/lines", f"{sink}/checkpoint", once=False, interval=interval)


def appended_lines(spark: SparkSession, sink: str) -> DataFrame:
    """All lines that finished looks have taken."""
    return spark.read.schema(SCHEMA).parquet(f"{sink}/lines")
