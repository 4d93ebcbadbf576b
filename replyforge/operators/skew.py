"""Per-group orderings that hold when one key owns a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replyforge.sources.storage import materialize

# A key is hot from this many rows on. At most MAX_HOT keys are treated as hot, the hottest first, so a key
# outside the list owns less than 1/MAX_HOT of the rows.
HOT_ROWS = 2_000_000
MAX_HOT = 4096
# Largest limit Spark applies before the shuffle (default of spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
# Upper limit for the ranges a table is cut into.
MAX_RANGES = 20_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The hottest keys with their ``_rows`` as a small local table (at most ``MAX_HOT`` rows), or None.

    Counting is pre-aggregated before its shuffle and reads the key columns only.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") >= hot_rows)
    top = counts.orderBy(F.desc("_rows")).limit(MAX_HOT).collect()
    return df.sparkSession.createDataFrame(top, counts.schema) if top else None


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group with their rank as ``rank``.

    Spark cuts each group to ``limit`` rows inside every map task before the shuffle, so a hot group
    sends ``limit`` rows per task and no more. It does so up to ``GROUP_LIMIT`` rows; beyond that, rows are
    ranked in full.
    """
    if limit > GROUP_LIMIT:
        return with_running(df, keys, order, row_number="rank").where(F.col("rank") <= limit)
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= limit)


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column | str] | None = None,
    row_number: str | None = None,
    max_group: int = HOT_ROWS,
) -> DataFrame:
    """Exact running sums (current row included) and row numbers per group, in the order of ``order``.

    Groups up to ``max_group`` rows use a plain window, as one task holds many of them. The rows of larger groups, and
    those of a table without ``keys`` at any size, are cut into ranges of the whole order; each range is numbered on its
    own, and the totals of the ranges before it are added, so that no task holds a whole large group. Rows that are equal
    in the order stand as they come; they are cut into ranges like any others.
    """
    keys, order = list(keys), list(order)
    columns = {name: F.col(c) if isinstance(c, str) else c for name, c in (sums or {}).items()}
    if row_number:
        columns[row_number] = F.lit(1)
    # A struct compares its nulls as equal, so a group with a null key is a group like any other.
    grouped = df.withColumn("_group", F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")))
    if not keys:
        return _running_in_ranges(grouped, order, columns).drop("_group")
    hot = hot_keys(grouped, ["_group"], max_group + 1)
    if hot is None:
        return _running(df, [F.col(k) for k in keys], order, columns)
    total = hot.agg(F.sum("_rows")).first()[0]
    hot = F.broadcast(hot.select("_group"))
    parts = min(math.ceil(total / max_group) + 1, MAX_RANGES)
    large = _running_in_ranges(grouped.join(hot, ["_group"], "left_semi"), order, columns, parts)
    others = _running(grouped.join(hot, ["_group"], "left_anti"), [F.col("_group")], order, columns)
    return large.unionByName(others).drop("_group")


def cut_ranges(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows of every ``_group`` in ranges of their order, numbered ``_part``; ``_tie`` tells rows of equal order apart.

    Without a number of ``parts`` the session says how many, and small ones are merged. The table is written, as the
    numbers are part of the data from here on and must not change when a task is run again.
    """
    told_apart = df.withColumn("_tie", F.monotonically_increasing_id())
    places = [F.col(c) for c in ("_group", *order, "_tie")]
    ranges = told_apart.repartitionByRange(*([parts] if parts else []), *places)
    return materialize(ranges.withColumn("_part", F.spark_partition_id()), "ranges")


def _running_in_ranges(df: DataFrame, order: list[str], columns: dict[str, Column], parts: int | None = None) -> DataFrame:
    cut = cut_ranges(df, order, parts)
    totals = cut.groupBy("_group", "_part").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in columns.items()])
    # One row per range and group: at most the number of ranges, however many rows there are.
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_group", "_part", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in columns]
    )
    local = _running(cut, [F.col("_group"), F.col("_part")], [*order, "_tie"], columns)
    return local.join(offsets, ["_group", "_part"]).select(
        *df.columns, *[(F.col(n) + F.col(f"_b_{n}")).alias(n) for n in columns]
    )


def _running(df: DataFrame, groups: list[Column], order: list[str], columns: dict[str, Column]) -> DataFrame:
    upto = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: F.sum(c).over(upto) for name, c in columns.items()})
