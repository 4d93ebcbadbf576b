"""Identifiers: composite keys, ``<query>_<index>`` attempt ids and their base ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyforge.functions.text import _col, strip


def composite_id(key: str | Sequence[str], nulls: str | None = None) -> Column:
    """One column is taken as it is; several are joined with ``_``.

    A typed null counts as an absent key and is skipped. Pass ``nulls="None"`` when a null is
    known to be a JSON null that was present in the record.
    """
    if isinstance(key, str):
        return F.col(key)
    parts = [F.col(k).cast("string") for k in key]
    if nulls is not None:
        parts = [F.coalesce(p, F.lit(nulls)) for p in parts]
    return F.concat_ws("_", *parts)


def base_id(c: Column | str) -> Column:
    """``63_0`` becomes ``63``; an id without ``_`` is unchanged."""
    return F.substring_index(_col(c), "_", 1)


def parse_attempt_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Add ``query_id`` and ``response_idx``; both are null unless the id is ``<query>_<integer>``.

    Whitespace around the integer and a sign are allowed.
    """
    whole = F.col(id_col)
    head, tail = F.substring_index(whole, "_", 1), F.substring_index(whole, "_", -1)
    # Equal only when there is exactly one underscore.
    two = F.concat_ws("_", head, tail) == whole
    # The plain cast already trims blanks; other whitespace is looked at only where it fails.
    number = F.coalesce(tail.try_cast("bigint"), strip(tail).try_cast("bigint"))
    return df.withColumn("response_idx", F.when(two, number)).withColumn(
        "query_id", F.when(F.col("response_idx").isNotNull(), head)
    )


def attempt_rows(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id parses."""
    return parse_attempt_id(df, id_col).where(F.col("response_idx").isNotNull())


def rejected_attempt_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id does not parse; count them for the reject report."""
    return parse_attempt_id(df, id_col).where(F.col("response_idx").isNull()).drop("query_id", "response_idx")
