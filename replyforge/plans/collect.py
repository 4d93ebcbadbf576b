"""Best-of-N against a live model: one table of texts, and a log of answers that grows by one row per call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyforge.operators.bestofn import MODES
from replyforge.operators.calls import ask_repeatedly, infer_batch
from replyforge.plans.once import write_texts
from replyforge.sources.storage import new_path, path_exists

LOG = "_sample long, turn int, response string, error string, part long"


def best_of_n_loop(
    samples: DataFrame,
    predictor: Callable[[], Callable],
    n: int,
    max_rounds: int,
    batch_size: int = 1500,
    run_path: str | None = None,
    tasks: int | None = None,
    **limits,
) -> DataFrame:
    """Call the model until every sample has ``n`` responses or gives up.

    ``samples`` has ``prompt``, optionally ``history``, ``status`` and the ``response_n`` of an earlier run; a
    missing status or ``resume`` starts the error count at 0, kept responses stay.
    Result: every sample row with ``response_n``, ``round`` and ``status``.

    Below the run's folder, ``texts`` holds the sample rows, written once in ``tasks`` parts (by default one per core),
    which number them; rows need no id of their own. One narrow job reads ``prompt`` and ``history`` once: a task
    asks for its samples until they are decided, and each call's answers are in ``log`` before the next one is made.
    A task that is run again, or a run that goes on in a ``run_path`` of its own, reads the log and makes no call
    twice but the one that was under way. Prompts are never written again and nothing is shuffled until the end,
    when the at most ``n`` responses of a sample meet its row. The extra call whose answer the rules would throw away
    in any case is not made. ``limits`` are ``timeout`` and ``kept`` of ``operators.calls.infer_batch``.
    """
    spark = samples.sparkSession
    path = run_path or new_path(spark, "bestofn")
    carried = [c for c in samples.columns if c not in ("response_n", "round", "status", "response", "error", "meta_response")]
    start = _starting_state(samples).select(*carried, "_kept", "_ok", "round")
    texts = write_texts(start, f"{path}/texts", tasks)
    if not path_exists(spark, f"{path}/calls/_SUCCESS"):
        asked = ask_repeatedly(texts, predictor, f"{path}/log", n, max_rounds, batch_size, **limits)
        asked.write.mode("overwrite").parquet(f"{path}/calls")
    return _summarise(spark, texts, f"{path}/log", n, max_rounds, carried)


def _starting_state(samples: DataFrame) -> DataFrame:
    has = set(samples.columns)
    empty = F.array().cast("array<string>")
    kept = F.coalesce("response_n", empty) if "response_n" in has else empty
    fresh = F.col("status").isNull() | (F.col("status") == "resume") if "status" in has else F.lit(True)
    rounds = F.when(fresh, F.lit(0)).otherwise(F.coalesce("round", F.lit(0))) if "round" in has else F.lit(0)
    return samples.withColumn("_kept", kept).withColumn("_ok", F.size("_kept")).withColumn("round", rounds.cast("int"))


def _status(accepted: Column, failed: Column, n: int, max_rounds: int) -> Column:
    gave_up = F.lit(max_rounds != -1) & (failed >= max_rounds)
    return F.when(accepted >= n, F.lit("completed")).when(gave_up, F.lit("max_rounds")).otherwise(F.lit("processing"))


def _summarise(spark: SparkSession, texts: DataFrame, log: str, n: int, max_rounds: int, carried: list[str]) -> DataFrame:
    """Every sample with the answers of its turns and the state they leave it in."""
    rows = spark.read.schema(LOG).parquet(log) if path_exists(spark, log) else spark.createDataFrame([], LOG)
    turns = rows.groupBy("_sample").agg(F.array_sort(F.collect_list(F.struct("turn", "response", "error"))).alias("_turns"))
    # A turn that two attempts of a task have logged counts once.
    once = F.filter("_turns", lambda t, i: (i == 0) | (t["turn"] != F.get("_turns", i - 1)["turn"]))
    asked = texts.select(*carried, "_sample", "_kept", "_ok", "round").join(turns.select("_sample", once.alias("_turns")), "_sample", "left")
    good = F.filter("_turns", lambda t: t["error"].isNull())
    none = F.array().cast("array<string>")
    new = F.coalesce(F.transform(good, lambda t: t["response"]), none)
    failed = F.col("round") + F.coalesce(F.size("_turns") - F.size(good), F.lit(0))
    return asked.select(
        *carried,
        F.concat("_kept", new).alias("response_n"),
        failed.alias("round"),
        _status(F.col("_ok") + F.size(new), failed, n, max_rounds).alias("status"),
    )


def collect_responses(
    samples: DataFrame, predictor: Callable[[], Callable], mode: str, n: int = 1, max_rounds: int = 30, **options
) -> DataFrame:
    """Best-of-N for the modes that keep state, a single call per row for all others."""
    if mode in MODES:
        return best_of_n_loop(samples, predictor, n, max_rounds, **options)
    return infer_batch(samples, predictor, **options)
