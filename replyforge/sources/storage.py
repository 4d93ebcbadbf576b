"""Shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``.

    A session without that setting, such as a test's, may name one with ``setCheckpointDir``. Only in local mode, where
    driver and executors are one process on one machine, is a folder made when nothing is named.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="replyforge-"))
    return context.getCheckpointDir().rstrip("/")


# Sub-folder of the run under way, by session.
_RUNS: WeakKeyDictionary = WeakKeyDictionary()


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{work_dir(spark)}/replyforge/{_RUNS.get(spark, '')}{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A run whose intermediate tables go when the block ends; answers their folder.

    What is to stay has to be written elsewhere, and DataFrames over such tables read inside the block. Without such a block
    intermediate tables stay, as a lazy result may still need them.
    """
    from replyforge.sources.files import open_folder  # files are written with this module's help, too

    outer = _RUNS.get(spark, "")
    _RUNS[spark] = f"{outer}run-{uuid.uuid4().hex}/"
    folder = f"{work_dir(spark)}/replyforge/{_RUNS[spark]}".rstrip("/")
    try:
        yield folder
    finally:
        _RUNS[spark] = outer
        files, place = open_folder(folder)
        if files.get_file_info(place).type == fs.FileType.Directory:
            files.delete_dir(place)


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back; ``options`` are those of the writer.

    Cuts the lineage, and a lost executor never makes a costly or order-dependent plan run again
    for rows that later steps have already used.
    """
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check that works on any file system Spark can read; no file content is read."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """Give every core a piece of a table that comes in fewer pieces than there are cores.

    For costly work per row, such as a model call, on a table as it was read. What is shuffled is bounded by one
    input split per core; a table with enough pieces is left alone.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(cores, *keys)
