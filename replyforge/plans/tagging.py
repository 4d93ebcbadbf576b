"""Difficulty tagging of a statement table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.functions.render import render_difficulty
from replyforge.functions.text import is_blank
from replyforge.operators.calls import ask_for_json
from replyforge.operators.checkpoints import limit_inputs, skip_done
from replyforge.operators.tagging import prepare_statements, tag_rows
from replyforge.plans.ledger import Ledger


def tag_statements(
    statements: DataFrame,
    predictor: Callable[[], Callable[[str], str]],
    template: str,
    earlier: DataFrame | None = None,
    max_items: int | None = None,
    tries: int = 3,
    delay: float = 1.5,
    threads: int = 8,
    run_path: str | None = None,
    chunks: int = 100,
    parallel: int = 4,
) -> DataFrame:
    """Tagged rows of the statements that have no success in ``earlier``.

    Skipping and limiting happen before the model call. Append the result to the output and write it
    once; the reader's view of that output is ``best_tag_per_uuid``. With a ``run_path`` the calls are made and written
    in ``chunks`` pieces, ``parallel`` at a time, and a run that was cut off goes on with the pieces that are not done.
    """
    todo = prepare_statements(statements)
    if earlier is not None:
        todo = skip_done(todo, earlier)
    todo = limit_inputs(todo, max_items, ["uuid"], zero_means_all=True)
    asked = render_difficulty(todo, template).withColumn(
        "prompt", F.when(~is_blank("formal_statement"), F.col("prompt"))
    )
    def tag(rows: DataFrame) -> DataFrame:
        return tag_rows(ask_for_json(rows, predictor, tries=tries, delay=delay, threads=threads))

    if run_path is None:
        return tag(asked)
    return Ledger(asked, run_path, chunks, parallel).run(tag)
