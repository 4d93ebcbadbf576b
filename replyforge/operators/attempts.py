"""Metrics over attempts: one row per (query, attempt) with a success flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyforge.functions.text import round_even
from replyforge.operators.skew import HOT_ROWS, first_rows, with_running

# Tries scored and the steps compared (fixed values).
K_VALUES = (1, 2, 4, 8, 16, 32)
K_STEPS = ((1, 2), (2, 4), (4, 8), (8, 16), (16, 32))


def _solved() -> Column:
    return F.coalesce(F.col("success"), F.lit(False))


def rank_attempts(
    attempts: DataFrame,
    query: str = "query_id",
    order: Sequence[str] = ("response_idx", "seq"),
    max_group: int = HOT_ROWS,
) -> DataFrame:
    """Add ``rank``: the position of an attempt in its query by index. Equal indexes all stay."""
    return with_running(attempts, [query], order, row_number="rank", max_group=max_group)


def pass_at_k(
    attempts: DataFrame,
    ks: Sequence[int] = K_VALUES,
    query: str = "query_id",
    order: Sequence[str] = ("response_idx", "seq"),
) -> DataFrame:
    """``k, total, successful, pass_rate``: share of queries solved by one of their first k attempts.

    A query with fewer than k attempts uses all of them. Only the first max(k) attempts of a query can
    matter, so the others are cut before the shuffle; one pass serves every k.
    """
    needed = attempts.select(query, *order, _solved().alias("success"))
    solved = (
        first_rows(needed, [query], order, max(ks))
        .groupBy(query)
        .agg(F.min(F.when(F.col("success"), F.col("rank"))).alias("solved_at"))
    )
    counted = solved.agg(
        F.count("*").alias("total"), *[F.count_if(F.col("solved_at") <= k).alias(f"k{k}") for k in ks]
    )
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("successful")) for k in ks])
    return (
        counted.select("total", F.inline(rows))
        .select("k", "total", "successful")
        .withColumn(
            "pass_rate",
            F.when(F.col("total") > 0, F.col("successful") / F.col("total") * 100).otherwise(F.lit(0.0)),
        )
    )


def pass_at_k_gain(rates: DataFrame, steps: Sequence[tuple[int, int]] = K_STEPS) -> DataFrame:
    """``transition, gain``: rate gained per extra try, for each step whose two k are present.

    ``rates`` has one row per k, so everything here is a handful of values.
    """
    by_k = rates.agg(*[F.max(F.when(F.col("k") == k, F.col("pass_rate"))).alias(f"r{k}") for k in _step_ks(steps)])
    rows = F.array(
        *[
            F.struct(
                F.lit(f"{a}→{b}").alias("transition"),
                F.lit(b).alias("k"),
                ((F.col(f"r{b}") - F.col(f"r{a}")) / (b - a)).alias("gain"),
            )
            for a, b in steps
        ]
    )
    return by_k.select(F.inline(rows)).where(F.col("gain").isNotNull())


def _step_ks(steps: Sequence[tuple[int, int]]) -> list[int]:
    return sorted({k for step in steps for k in step})


def average_gain(gains: DataFrame) -> DataFrame:
    """Mean of the unrounded gains; 0 when no step could be compared."""
    return gains.agg(F.coalesce(F.avg("gain"), F.lit(0.0)).alias("average_improvement"))


def per_query_counts(attempts: DataFrame, query: str = "query_id") -> DataFrame:
    """``responses`` and ``successes`` of each query, combined map-side."""
    return attempts.groupBy(query).agg(F.count("*").alias("responses"), F.count_if(_solved()).alias("successes"))


def response_count_distribution(attempts: DataFrame, query: str = "query_id") -> DataFrame:
    """How many queries have how many attempts."""
    return per_query_counts(attempts, query).groupBy("responses").agg(F.count("*").alias("queries"))


def success_count_distribution(attempts: DataFrame, query: str = "query_id") -> DataFrame:
    """How many queries have how many successes."""
    return per_query_counts(attempts, query).groupBy("successes").agg(F.count("*").alias("queries"))


def overall_success(attempts: DataFrame, query: str = "query_id") -> DataFrame:
    """Queries, queries with a success, and their share in percent (null when there is no query)."""
    return (
        per_query_counts(attempts, query)
        .agg(F.count("*").alias("queries"), F.count_if(F.col("successes") > 0).alias("solved"))
        .withColumn("success_rate", F.try_divide(F.col("solved"), F.col("queries")) * 100)
    )


def pass_at_k_report(
    attempts: DataFrame, ks: Sequence[int] = K_VALUES, query: str = "query_id", order=("response_idx", "seq")
) -> DataFrame:
    """One nested row: results by k, gains by step, summary; figures rounded to two digits.

    The arrays hold one entry per k, never one per query.
    """
    rates = pass_at_k(attempts, ks, query, order)
    packed = rates.agg(
        F.array_sort(F.collect_list(F.struct("k", "total", "successful", "pass_rate"))).alias("raw"),
        F.max("total").alias("total_unique_queries"),
    )
    by_k = F.map_from_entries(F.transform("raw", lambda r: F.struct(r["k"], r["pass_rate"])))
    steps = [(a, b) for a, b in K_STEPS if a in ks and b in ks]
    gains = (
        F.array(
            *[
                F.struct(
                    F.lit(f"{a}→{b}").alias("transition"),
                    ((F.element_at(by_k, F.lit(b)) - F.element_at(by_k, F.lit(a))) / (b - a)).alias("gain"),
                )
                for a, b in steps
            ]
        )
        if steps
        else F.array().cast("array<struct<transition:string,gain:double>>")
    )
    mean = F.aggregate(gains, F.lit(0.0), lambda acc, g: acc + g["gain"]) / max(len(steps), 1)
    return packed.select(
        F.transform(
            "raw",
            lambda r: F.struct(
                r["k"].alias("k"),
                r["total"].alias("total_queries"),
                r["successful"].alias("successful_queries"),
                round_even(r["pass_rate"], 2).alias("pass_rate"),
            ),
        ).alias("results"),
        F.transform(gains, lambda g: F.struct(g["transition"].alias("transition"), round_even(g["gain"], 2).alias("gain"))).alias(
            "improvements"
        ),
        F.struct(
            F.col("total_unique_queries"),
            F.array(*[F.lit(k) for k in ks]).alias("k_values"),
            round_even(mean, 2).alias("average_improvement"),
        ).alias("summary"),
    )


def explode_attempts(samples: DataFrame, id_col: str = "id", responses: str = "response_n") -> DataFrame:
    """One row per collected response, its id being ``<id>_<position>`` from 0."""
    spread = samples.select("*", F.posexplode(responses).alias("_pos", "_response")).drop(responses)
    return spread.withColumns(
        {id_col: F.concat_ws("_", F.col(id_col).cast("string"), F.col("_pos").cast("string")), "response": F.col("_response")}
    ).drop("_pos", "_response")


def still_open(verdicts: DataFrame, id_col: str = "id", round_col: str = "round") -> DataFrame:
    """Rows of a round whose id was not solved in an earlier round.

    Only one number per id, its first solved round, is brought back to the rows.
    """
    solved = (
        verdicts.where(_solved()).groupBy(id_col).agg(F.min(round_col).alias("_solved_in"))
    )
    return (
        verdicts.join(solved, [id_col], "left")
        .where(F.col("_solved_in").isNull() | (F.col(round_col) <= F.col("_solved_in")))
        .select(verdicts.columns)
    )


def round_summary(verdicts: DataFrame, round_col: str = "round") -> DataFrame:
    """Successes, failures, total and accuracy in percent of each round that has rows."""
    return (
        verdicts.groupBy(round_col)
        .agg(F.count_if(_solved()).alias("success"), F.count_if(~_solved()).alias("failed"), F.count("*").alias("total"))
        .withColumn("accuracy", F.col("success") / F.col("total") * 100)
    )


def avg_responses(samples: DataFrame, responses: str = "response_n") -> DataFrame:
    """Rows that carry a response list, elements in all, mean per row (null when there is none)."""
    listed = F.col(responses).isNotNull()
    return samples.agg(
        F.count_if(listed).alias("records"),
        F.coalesce(F.sum(F.when(listed, F.size(responses))), F.lit(0)).alias("elements"),
        F.avg(F.when(listed, F.size(responses))).alias("average"),
    )
