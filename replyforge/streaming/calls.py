"""Model calls for the rows of a stream, each made once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from replyforge.plans.once import call_once, with_answers
from replyforge.sources.storage import path_exists
from replyforge.streaming.ingest import INTERVAL

#: What ``infer_batch`` and ``ask_for_json`` add.
INFERRED = "response string, error string, meta_response string"
TAGGED = "status string, data string, response string, error string"


def call_stream(
    rows: DataFrame,
    call: Callable[..., DataFrame],
    sink: str,
    ids: Sequence[str],
    added: str = INFERRED,
    once: bool = True,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Call for every row of a stream whose id has not been asked for.

    ``call`` is ``infer_batch`` or ``ask_for_json`` with all but the rows and ``log`` given, ``added`` what it adds. Below
    ``sink``, ``texts`` and ``log`` have a partition for each batch of the stream, named by its number: the rows it asks for,
    and the answers as they come. A batch that Spark repeats after a failure finds its rows and answers there and makes only the
    calls that are missing. Rows are left out when an earlier batch holds their id, and of the rows of a batch with
    one id one is asked for; a row with a null id is asked for whenever it appears. ``answered`` reads the result.
    """

    def work(batch: DataFrame, number: int) -> None:
        call_once(_fresh(batch, sink, list(ids), number), call, sink, added, piece=f"/batch={number}")

    writer = rows.writeStream.option("checkpointLocation", f"{sink}/checkpoint").foreachBatch(work)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def _fresh(batch: DataFrame, sink: str, ids: list[str], number: int) -> DataFrame:
    """The rows of a batch that no earlier one has asked for."""
    spark = batch.sparkSession
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids])
    named = batch.where(known).dropDuplicates(ids)
    if number and path_exists(spark, f"{sink}/texts"):
        kept = T.StructType([*[batch.schema[c] for c in ids], T.StructField("batch", T.LongType())])
        earlier = spark.read.schema(kept).parquet(f"{sink}/texts").where(F.col("batch") < number).select(*ids)
        named = named.join(earlier, ids, "left_anti")
    return named.select(*batch.columns).unionByName(batch.where(~known))


def answered(spark: SparkSession, sink: str, schema: str | T.StructType, added: str = INFERRED) -> DataFrame:
    """All rows with answers; ``schema`` is that of the stream's rows."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    numbers = [T.StructField(c, T.LongType()) for c in ("_sample", "batch")]
    if not path_exists(spark, f"{sink}/log"):
        return spark.createDataFrame([], T.StructType([*fields.fields, *T.StructType.fromDDL(added).fields]))
    texts = spark.read.schema(T.StructType([*fields.fields, *numbers])).parquet(f"{sink}/texts")
    rows = spark.read.schema(f"_sample long, {added}, batch long, part long").parquet(f"{sink}/log")
    return with_answers(texts, rows, ["batch", "_sample"], T.StructType.fromDDL(added).names)
