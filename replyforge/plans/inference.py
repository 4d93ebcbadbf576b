"""One resumable inference run: reuse, requeue, call, keep what may be written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.operators.bestofn import MODES
from replyforge.operators.checkpoints import (
    finalize_output,
    limit_inputs,
    merge_checkpoints,
    resume_inputs,
    split_empty_prompts,
)
from replyforge.plans.collect import collect_responses
from replyforge.plans.ledger import Ledger
from replyforge.sources.storage import materialize, spread


def run_inference(
    inputs: DataFrame,
    predictor: Callable[[], Callable],
    mode: str,
    checkpoints: Sequence[DataFrame] = (),
    n: int = 1,
    max_rounds: int = 30,
    infer_limit: int | None = None,
    id_col: str = "id",
    batch_size: int = 1500,
    run_path: str | None = None,
    chunks: int = 100,
    parallel: int = 4,
    **limits,
) -> DataFrame:
    """``inputs`` has the id and ``prompt``; ``checkpoints`` come from lowest to highest precedence.

    Completed ids give their saved record; of the others, empty prompts of the input are answered with an empty
    response, unfinished ids go on from their record, and only the rest reaches the model afresh. The limit counts model rows; finished
    rows are always kept. With a ``run_path`` a run that was cut off goes on after what it has written there: the answers
    of a best-of-N mode, or those of ``chunks`` pieces of the calls that are done; ``parallel`` are under way at a time.
    ``limits`` are ``timeout`` and ``kept`` of ``operators.calls.infer_batch``.
    """
    has_processor = mode in MODES
    done: list[DataFrame] = []
    todo = inputs
    if checkpoints:
        saved = merge_checkpoints(checkpoints, id_col, has_processor=has_processor)
        # Read once for the finished rows and once per model round, so the join runs only here.
        rows = materialize(resume_inputs(inputs, saved, id_col), "resume")
        done.append(rows.where(F.col("action") == "reuse").drop("action"))
        # Only a prompt of the input is answered when empty; an unfinished record goes on with what it has saved.
        todo = rows.where(F.col("action") == "resume").drop("action")
        fresh, empty = split_empty_prompts(rows.where(F.col("action") == "fresh").drop("action"))
        todo = todo.unionByName(fresh)
    else:
        todo, empty = split_empty_prompts(todo)
    done.append(empty)
    todo = limit_inputs(todo, infer_limit, [id_col])
    if checkpoints and not has_processor and infer_limit is None:
        todo = spread(todo)  # a table as written above; the best-of-N loop does this for its own
    if has_processor:
        result = collect_responses(todo, predictor, mode, n, max_rounds, batch_size=batch_size, run_path=run_path, **limits)
    elif run_path is None:
        result = materialize(collect_responses(todo, predictor, mode, batch_size=batch_size, **limits), "inference")
    else:
        call = partial(collect_responses, predictor=predictor, mode=mode, batch_size=batch_size, **limits)
        result = Ledger(todo, run_path, chunks, parallel).run(call)
    for part in done:
        result = result.unionByName(part, allowMissingColumns=True)
    if "status" not in result.columns:
        result = result.withColumn("status", F.lit(None).cast("string"))
    return finalize_output(result, has_processor)
