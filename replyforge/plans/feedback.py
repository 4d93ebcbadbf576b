"""Rounds of infer, verify, and ask again with the errors for what failed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.functions.flags import unsolved
from replyforge.functions.render import render_feedback
from replyforge.operators.attempts import round_summary
from replyforge.operators.calls import verify
from replyforge.plans.collect import best_of_n_loop
from replyforge.sources.storage import new_path, path_exists

# ``sample`` is unique per row: a failed attempt is a sample of its own in the next round, while ``id`` goes
# back to the base id of its statement.
VERDICT = "sample string, id string, success boolean, lean_code string, proof_of_last_round string, error_messages string"


def feedback_rounds(
    statements: DataFrame,
    predictor: Callable[[], Callable],
    verifier: Callable[[], Callable],
    template: str,
    max_rounds: int = 3,
    n: int = 1,
    max_errors: int = 30,
    run_path: str | None = None,
    timeout: float | None = None,
    verify_timeout: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All verdicts, partitioned by ``round``, and the per-round figures.

    ``statements`` has ``id`` and ``lean_code``. Round r takes the failed verdicts of round r-1; the loop ends
    when none is left. Every round is one written folder, which is also the input of the next.
    A statement the model gave no response for stays open as a failed verdict without a proof.
    The accuracy of a round is over the rows that were still open. With a ``run_path`` of its own a run that was cut
    off makes no model call again and goes on after its last complete step. ``timeout`` limits the seconds of a model
    call, ``verify_timeout`` those of a verifier's.
    """
    spark = statements.sparkSession
    path = run_path or new_path(spark, "feedback")
    text = F.lit(None).cast("string")
    current = statements.select(
        F.col("id").cast("string").alias("sample"),
        F.col("id").cast("string").alias("id"),
        F.lit(None).cast("boolean").alias("success"),
        "lean_code",
        text.alias("proof_of_last_round"),
        text.alias("error_messages"),
    )
    names = current.columns
    for turn in range(1, max_rounds + 1):
        target = f"{path}/round={turn}"
        asked = render_feedback(current, template).select("sample", "id", "lean_code", "prompt")
        answered = best_of_n_loop(asked, predictor, n, max_errors, run_path=f"{path}-calls/round={turn}", timeout=timeout)
        tried = answered.select("id", "sample", "lean_code", F.posexplode("response_n").alias("_pos", "response"))
        verdicts = verify(tried, verifier, timeout=verify_timeout).withColumnRenamed("response", "proof_of_last_round")
        silent = answered.where(F.size("response_n") == 0).select(
            "id",
            "sample",
            "lean_code",
            F.lit(0).alias("_pos"),
            F.lit(False).alias("success"),
            text.alias("proof_of_last_round"),
            F.lit("no response").alias("error_messages"),
        )
        numbered = verdicts.unionByName(silent).withColumns(
            {c: F.concat_ws("_", F.col(c), F.col("_pos").cast("string")) for c in ("id", "sample")}
        )
        if not path_exists(spark, f"{target}/_SUCCESS"):
            numbered.select(*names).write.mode("overwrite").parquet(target)
        current = spark.read.schema(VERDICT).parquet(target)
        if unsolved(current).isEmpty():
            break
    everything = spark.read.schema(VERDICT + ", round int").parquet(path)
    return everything, round_summary(everything)
