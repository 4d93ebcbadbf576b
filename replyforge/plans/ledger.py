"""Costly steps over rows that are written once and worked on chunk by chunk."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import count

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyforge.sources.storage import path_exists

COMMIT = "folder string, chunk int"


class Ledger:
    """The work of a run below ``path``, and which of it is done.

    ``work`` holds the rows, one partition per chunk; it is written once, and when it is there, ``rows`` are not looked
    at again. ``results`` holds a folder per attempt at a chunk. ``commits`` names, for every finished chunk, the
    attempt that counts; it is written after that attempt, so one that was cut off leaves only a folder nobody reads.
    Rows are dealt evenly, whatever their keys are, over ``chunks`` chunks of as many tasks as keep all cores at work
    with ``parallel`` chunks under way. A run that goes on keeps the chunks of the first one.
    """

    def __init__(self, rows: DataFrame, path: str, chunks: int = 100, parallel: int = 4):
        self.spark: SparkSession = rows.sparkSession
        self.path, self.parallel = path.rstrip("/"), parallel
        if not path_exists(self.spark, f"{self.path}/work/_SUCCESS"):
            tasks = -(-self.spark.sparkContext.defaultParallelism // parallel)
            dealt = rows.repartition(chunks * tasks)
            numbered = dealt.withColumn("_chunk", F.pmod(F.spark_partition_id(), F.lit(chunks)))
            numbered.write.mode("overwrite").partitionBy("_chunk").parquet(f"{self.path}/work")
        stored = T.StructType([*rows.schema.fields, T.StructField("_chunk", T.IntegerType())])
        # Listed once; a chunk's read is cut to its own partition.
        self.work = self.spark.read.schema(stored).parquet(f"{self.path}/work")

    def chunk(self, number: int) -> DataFrame:
        """The rows of one chunk; only the files of its partition are read."""
        return self.work.where(F.col("_chunk") == number).drop("_chunk")

    def chunks(self) -> list[int]:
        """The chunks that have rows."""
        folder = f"{self.path}/chunks"
        if not path_exists(self.spark, f"{folder}/_SUCCESS"):
            self.work.select("_chunk").distinct().coalesce(1).write.mode("overwrite").parquet(folder)
        return sorted(r[0] for r in self.spark.read.schema("_chunk int").parquet(folder).collect())

    def finished(self) -> dict[int, str]:
        """The folder that counts for each finished chunk."""
        folder = f"{self.path}/commits"
        if not path_exists(self.spark, folder):
            return {}
        # A row per chunk; a commit that was cut off has no file yet.
        return {r["chunk"]: r["folder"] for r in self.spark.read.schema(COMMIT).parquet(folder).collect()}

    def run(self, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``step`` of all rows. Several chunks are under way at a time, so a slow batch holds up its chunk alone.

        The chunks share the executors through one scheduler pool each (see ``session.configure``). When one fails, those
        under way are finished, no other is begun, and the failure is raised.
        """
        done = self.finished()
        waiting = [c for c in self.chunks() if c not in done]
        slots = count()

        def work(number: int) -> None:
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"ledger-{next(slots) % self.parallel}")
            folder = f"{self.path}/results/{number:06d}-{uuid.uuid4().hex}"
            step(self.chunk(number)).write.parquet(folder)
            commit = self.spark.createDataFrame([(folder, number)], COMMIT).coalesce(1)
            commit.select("folder").write.mode("overwrite").parquet(f"{self.path}/commits/chunk={number}")

        failure = None
        with ThreadPoolExecutor(self.parallel) as pool:
            runs = [pool.submit(inheritable_thread_target(self.spark)(work), c) for c in waiting]
            for under_way in runs:
                try:
                    if not under_way.cancelled():
                        under_way.result()
                except Exception as problem:  # noqa: BLE001
                    failure = failure or problem
                    for other in runs:
                        other.cancel()
        if failure:
            raise failure
        schema = step(self.chunk(0)).schema
        folders = sorted(self.finished().values())
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
