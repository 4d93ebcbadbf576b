"""Model calls that are made once per row, whatever happens to the run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyforge.sources.storage import path_exists


def write_texts(rows: DataFrame, path: str, tasks: int | None = None) -> DataFrame:
    """The rows with ``_sample``, a number that also tells the part of the table; written once, then read back."""
    spark = rows.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        dealt = rows.repartition(tasks or spark.sparkContext.defaultParallelism)
        dealt.withColumn("_sample", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField("_sample", T.LongType())])
    return spark.read.schema(schema).parquet(path)


def call_once(rows: DataFrame, call: Callable[..., DataFrame], path: str, added: str, tasks: int | None = None, piece: str = "") -> DataFrame:
    """``rows`` with the columns that ``call`` adds.

    ``call`` is ``infer_batch`` or ``ask_for_json`` with all but the rows and ``log`` given; ``added`` names the columns it
    adds and their types. Tasks write each batch's answers to ``path/log`` as soon as they have them; a task or run that
    is started again asks only for the rows that are not there. Rows are written once, to ``path/texts``. ``piece`` is a
    sub-folder of each for runs that share a ``path``.
    """
    spark = rows.sparkSession
    texts = write_texts(rows, f"{path}/texts{piece}", tasks)
    if not path_exists(spark, f"{path}/calls{piece}/_SUCCESS"):
        call(texts, log=f"{path}/log{piece}").write.mode("overwrite").parquet(f"{path}/calls{piece}")
    fields = T.StructType.fromDDL(added)
    if not path_exists(spark, f"{path}/log{piece}"):  # no rows
        return spark.createDataFrame([], T.StructType([*rows.drop(*fields.names).schema.fields, *fields.fields]))
    log = spark.read.schema(f"_sample long, {added}, part long").parquet(f"{path}/log{piece}")
    return with_answers(texts, log, ["_sample"], fields.names)


def with_answers(texts: DataFrame, log: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Texts with what the log has for them; a row that two attempts of a task have logged counts once."""
    return texts.drop(*names).join(log.select(*keys, *names).dropDuplicates(list(keys)), list(keys)).drop(*keys)
