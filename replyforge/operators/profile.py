"""A first look at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame, max_cols: int | None = None) -> DataFrame:
    """``column_name, non_null, total`` of all columns, or of the first ``max_cols``, in one pass."""
    names = df.columns[:max_cols]
    counts = df.agg(F.count("*").alias("total"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(names)])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("non_null")) for i, c in enumerate(names)]
    )
    return counts.select("total", F.inline(rows)).select("column_name", "non_null", "total")


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in a stated order; without one any ``n`` rows, and Spark stops reading once it has them."""
    return (df.orderBy(*order) if order else df).limit(n)


def sample_rows(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Up to ``rows`` rows of a table of any size."""
    return df.limit(rows)


def save_sample(df: DataFrame, path: str, rows: int = 5) -> None:
    df.limit(rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
