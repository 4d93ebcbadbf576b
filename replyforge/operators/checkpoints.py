"""Checkpoint algebra: which saved record of an id counts and what is left to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replyforge.config import StatusSets
from replyforge.functions.flags import STATUSES, checkpoint_bucket, has_status, is_answered
from replyforge.operators.skew import with_running


def last_wins(df: DataFrame, ids: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Of the rows with one id keep the one with the greatest ``seq``.

    ``max_by`` combines map-side: a hot id sends one row per task. Rows with a null id are one group.
    """
    others = [c for c in df.columns if c not in ids]
    # The id columns stay the grouping columns, so that a later join on them needs no second shuffle.
    picked = df.groupBy(*ids).agg(F.max_by(F.struct(*others), F.struct(*seq)).alias("_row"))
    return picked.select(*[F.col(c) if c in ids else F.col("_row")[c].alias(c) for c in df.columns])


def classify_checkpoint(df: DataFrame, has_processor: bool, sets: StatusSets = STATUSES) -> DataFrame:
    """Add ``bucket``: completed, processing, ignored or no_response."""
    return df.withColumn("bucket", checkpoint_bucket(has_processor, sets=sets))


def merge_checkpoints(
    sources: Sequence[DataFrame], id_col: str = "id", seq: str = "seq", has_processor: bool = True
) -> DataFrame:
    """Union of checkpoint tables given from lowest to highest precedence, one row per id.

    A completed record beats one in progress wherever it comes from; otherwise the later source wins and,
    inside a source, the later row. ``bucket`` tells which kind the kept record is.
    """
    tagged = [
        classify_checkpoint(s, has_processor).withColumn("_rank", F.lit(rank)) for rank, s in enumerate(sources)
    ]
    union = tagged[0]
    for other in tagged[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    usable = union.where(F.col("bucket").isin("completed", "processing"))
    usable = usable.withColumn("_done", F.col("bucket") == "completed")
    return last_wins(usable, [id_col], ["_done", "_rank", seq]).drop("_done", "_rank")


def skip_done(df: DataFrame, done: DataFrame, id_col: str = "uuid", success: str = "success") -> DataFrame:
    """Rows whose id has no success in earlier output. Place it before any model call."""
    finished = done.where(F.coalesce(F.col(success), F.lit(False)) & F.col(id_col).isNotNull())
    return df.join(finished.select(id_col).distinct(), [id_col], "left_anti")


def resume_inputs(df: DataFrame, checkpoint: DataFrame, id_col: str = "id", prompt: str = "prompt") -> DataFrame:
    """Every input row with the saved record in its place where there is one, and the ``action`` to take.

    ``checkpoint`` is the result of :func:`merge_checkpoints`. ``reuse``: the id is completed. ``resume``: it is
    unfinished, its record goes on with status ``resume``. ``fresh``: nothing is saved, or the input's prompt is empty
    and needs no model. A saved record replaces the columns it has; the others keep the input's values. One join
    serves all three.
    """
    columns = [c for c in checkpoint.columns if c not in (id_col, "bucket", "seq")]
    packed = checkpoint.select(id_col, F.struct("bucket", *columns).alias("_saved"))
    joined = df.join(packed, [id_col], "left")
    done = F.coalesce(F.col("_saved.bucket") == "completed", F.lit(False))
    empty = F.coalesce(F.col(prompt) == "", F.lit(False)) if prompt in df.columns else F.lit(False)
    found = F.col("_saved").isNotNull() & (done | ~empty)
    out = {c: F.col(c) for c in df.columns if c != id_col and c not in columns}
    for c in columns:
        own = F.col(c) if c in df.columns else F.lit(None)
        out[c] = F.when(found, F.col("_saved")[c]).otherwise(own)
    status = out.get("status", F.lit(None).cast("string"))
    out["status"] = F.when(found & ~done, F.lit("resume")).otherwise(status)
    action = F.when(~found, F.lit("fresh")).when(done, F.lit("reuse")).otherwise(F.lit("resume"))
    return joined.select(id_col, *[c.alias(n) for n, c in out.items()], action.alias("action"))


def reuse_completed(df: DataFrame, checkpoint: DataFrame, id_col: str = "id") -> DataFrame:
    """The saved record stands in for every input row whose id is completed; other rows are unchanged.

    ``reused`` marks the replaced rows.
    """
    rows = resume_inputs(df, checkpoint.where(F.col("bucket") == "completed"), id_col)
    return rows.withColumn("reused", F.col("action") == "reuse").drop("action")


def requeue_processing(df: DataFrame, checkpoint: DataFrame, id_col: str = "id") -> DataFrame:
    """Saved records of the input's unfinished ids, with status ``resume``: to be sent again."""
    saved = checkpoint.where(F.col("bucket") == "processing").drop("bucket")
    return df.select(id_col).join(saved, [id_col]).withColumn("status", F.lit("resume"))


def fresh_rows(df: DataFrame, checkpoint: DataFrame, id_col: str = "id") -> DataFrame:
    """Input rows no usable checkpoint record exists for."""
    return df.join(checkpoint.select(id_col), [id_col], "left_anti")


def finalize_output(df: DataFrame, has_processor: bool, sets: StatusSets = STATUSES) -> DataFrame:
    """Rows that may be written; with a processor a missing status becomes ``completed``."""
    if has_processor:
        df = df.withColumn("status", F.coalesce(F.col("status"), F.lit("completed")))
    return df.where(has_status("status", sets.write))


def missing_responses(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids without a usable response."""
    return df.where(~is_answered()).select(id_col)


def split_empty_prompts(df: DataFrame, prompt: str = "prompt") -> tuple[DataFrame, DataFrame]:
    """Rows that need the model, and rows whose empty prompt is answered with an empty response."""
    empty = F.coalesce(F.col(prompt) == "", F.lit(False))
    return df.where(~empty), df.where(empty).withColumn("response", F.lit(""))


def limit_inputs(
    df: DataFrame, n: int | None, order: Sequence[str], zero_means_all: bool = False
) -> DataFrame:
    """First ``n`` rows in a stated order, taken after finished rows were skipped.

    The order columns alone are counted, summed up in order and compared, so whole rows never come together: each
    order value lets all, some or none of its rows through.
    """
    if n is None or (zero_means_all and n == 0):
        return df
    order = list(order)
    counts = df.groupBy(*order).agg(F.count("*").alias("_rows"))
    upto = with_running(counts, [], order, {"_upto": "_rows"})
    let = upto.where(F.col("_upto") - F.col("_rows") < n).select(
        F.struct(*order).alias("_key"), F.least(F.col("_rows"), n - (F.col("_upto") - F.col("_rows"))).alias("_let"), "_rows"
    )
    chosen = df.withColumn("_key", F.struct(*order)).join(let, "_key")
    whole = chosen.where(F.col("_let") == F.col("_rows")).select(*df.columns)
    # At most one order value is cut; of its rows any may go, as they are equal in the order.
    part = Window.partitionBy("_key").orderBy("_key")
    cut = chosen.where(F.col("_let") < F.col("_rows")).withColumn("_n", F.row_number().over(part))
    return whole.union(cut.where(F.col("_n") <= F.col("_let")).select(*df.columns))


def shard(
    df: DataFrame, index: int, world_size: int, id_col: str | None = None, position: str = "_position"
) -> DataFrame:
    """A reproducible subset: by a row position (``sources.tables.with_position``), or by the hash of an id.

    Not needed for parallel work, which comes from partitions.
    """
    if not 0 <= index < world_size:
        raise ValueError(f"shard {index} of {world_size}")
    place = F.col(position) if id_col is None else F.xxhash64(id_col)
    return df.where(F.pmod(place, F.lit(world_size)) == index)
