"""Best-of-N over a recorded attempt table.

Per sample, with ``ok`` and ``err`` the accepted and failed attempts before the current one: at ``ok >= N``
the sample is completed, at ``err >= max_rounds`` it gives up (``max_rounds = -1``: never), and either way
the current attempt is discarded even if it succeeded. Otherwise an error raises ``err`` and a response
is accepted. Only errors count as rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replyforge.operators.skew import first_rows

MODES = (
    "BoN",
    "zero-shot-bon",
    "proof-bon",
    "proof_cot-bon",
    "proof_kimina-bon",
    "proof_cot_feedback-bon",
)


def step_attempts(
    attempts: DataFrame,
    n: int,
    max_rounds: int,
    id_col: str = "id",
    order: Sequence[str] = ("attempt",),
    err: str = "err",
    start_ok: str | None = None,
) -> DataFrame:
    """The attempts that can still change something, with ``prev_ok``, ``prev_err`` and ``accepted``.

    An attempt that is not discarded raises ``ok`` or ``err``, so a sample is decided within its first
    ``n + max_rounds + 1`` attempts and later ones are cut before the shuffle. With ``max_rounds = -1``
    errors decide nothing, and the first ``n`` error-free attempts are enough. ``start_ok`` names the
    number of responses a resumed sample already has.
    """
    failed = F.coalesce(F.col(err), F.lit(False))
    if max_rounds == -1:
        deciding = first_rows(attempts.where(~failed), [id_col], order, max(n, 1))
    else:
        deciding = first_rows(attempts, [id_col], order, n + max_rounds + 1)
    before = Window.partitionBy(id_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    kept = F.col(start_ok) if start_ok else F.lit(0)
    counted = deciding.withColumns(
        {
            "prev_ok": F.coalesce(F.count_if(~failed).over(before), F.lit(0)) + kept,
            "prev_err": F.coalesce(F.count_if(failed).over(before), F.lit(0)),
        }
    )
    open_ = (F.col("prev_ok") < n) & (F.lit(max_rounds == -1) | (F.col("prev_err") < max_rounds))
    return counted.withColumn("accepted", open_ & ~failed).withColumn("used", open_).drop("rank")


def accepted_attempts(attempts: DataFrame, n: int, max_rounds: int, **names) -> DataFrame:
    """The attempts whose response is kept, at most ``n`` per sample."""
    return step_attempts(attempts, n, max_rounds, **names).where("accepted").drop("prev_ok", "prev_err", "accepted", "used")


def best_of_n(
    attempts: DataFrame,
    n: int,
    max_rounds: int,
    id_col: str = "id",
    order: Sequence[str] = ("attempt",),
    err: str = "err",
    response: str | None = None,
    start_ok: str | None = None,
) -> DataFrame:
    """One row per sample: ``accepted``, ``round`` (errors used up), ``status`` and, with ``response``, ``response_n``.

    ``response_n`` holds at most ``n`` responses in attempt order.
    """
    steps = step_attempts(attempts, n, max_rounds, id_col, order, err, start_ok)
    failed = F.coalesce(F.col(err), F.lit(False))
    kept = F.coalesce(F.max(F.col(start_ok)), F.lit(0)) if start_ok else F.lit(0)
    aggregates = [
        (F.count_if("accepted") + kept).alias("accepted"),
        F.count_if(F.col("used") & failed).alias("round"),
        F.bool_or(F.lit(max_rounds != -1) & (F.col("prev_err") >= max_rounds)).alias("_gave_up"),
    ]
    if response:
        pairs = F.array_sort(F.collect_list(F.when(F.col("accepted"), F.struct(*order, response))))
        aggregates.append(F.transform(pairs, lambda p: p[response]).alias("response_n"))
    summary = steps.groupBy(id_col).agg(*aggregates)
    if max_rounds == -1:
        have = F.col(start_ok) if start_ok else F.lit(0)
        summary = _add_unbounded_errors(attempts, steps, summary, n, id_col, order, failed, have)
    status = (
        F.when(F.col("accepted") >= n, F.lit("completed"))
        .when(F.col("_gave_up"), F.lit("max_rounds"))
        .otherwise(F.lit("processing"))
    )
    return summary.withColumn("status", status).drop("_gave_up")


def _add_unbounded_errors(attempts, steps, summary, n, id_col, order, failed, have) -> DataFrame:
    """Count the errors before a sample's last accepted response, or all of them while it is open."""
    closed = (
        steps.where("accepted")
        .groupBy(id_col)
        .agg(F.max(F.struct(*order)).alias("_end"), F.max("prev_ok").alias("_ok"))
        .where(F.col("_ok") + 1 >= n)
        .select(id_col, "_end")
    )
    # One marker per attempt travels, not the attempt.
    marks = attempts.select(id_col, F.struct(*order).alias("_at"), (failed & (have < n)).alias("_failed"), have.alias("_have"))
    errors = (
        marks.join(closed, [id_col], "left")
        .groupBy(id_col)
        .agg(
            F.count_if(F.col("_failed") & (F.col("_end").isNull() | (F.col("_at") < F.col("_end")))).alias("round"),
            F.max("_have").alias("_have"),
        )
    )
    joined = errors.join(summary.drop("round"), id_col, "left")
    joined = joined.withColumn("accepted", F.coalesce("accepted", "_have"))
    if "response_n" in joined.columns:
        none = F.array().cast(joined.schema["response_n"].dataType)
        joined = joined.withColumn("response_n", F.coalesce("response_n", none))
    return joined.select(summary.columns)
