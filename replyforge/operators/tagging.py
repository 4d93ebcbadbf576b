"""Difficulty tagging: output rows, merging predictions, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyforge.functions.flags import is_complete
from replyforge.functions.jsontext import is_json_object, strict_json
from replyforge.functions.text import is_blank, strip
from replyforge.operators.checkpoints import last_wins

EMPTY_STATEMENT = "Empty formal statement"
FAILED = "Prediction failed"


def prepare_statements(df: DataFrame, statement: str = "formal_statement") -> DataFrame:
    """Stripped statement (null counts as empty) and ``uuid`` with ``id`` as its fallback."""
    ids = [c for c in ("uuid", "id") if c in df.columns]
    if not ids:
        raise ValueError("no uuid or id column")
    picked = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ids[:-1]] + [F.col(ids[-1]).cast("string")]
    return df.withColumns(
        {"uuid": F.coalesce(*picked), statement: strip(F.coalesce(F.col(statement), F.lit("")))}
    )


def _data_field(data: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(strict_json(data), f"$.{name}", kind)


def has_data(status: Column | str = "status", data: Column | str = "data") -> Column:
    """Success with a non-empty JSON object."""
    data = F.col(data) if isinstance(data, str) else data
    status = F.col(status) if isinstance(status, str) else status
    empty = F.regexp_like(data, F.lit(r"^[ \t\r\n]*\{[ \t\r\n]*\}[ \t\r\n]*$"))
    return F.coalesce((status == "success") & is_json_object(data) & ~empty, F.lit(False))


def tag_rows(df: DataFrame, statement: str = "formal_statement") -> DataFrame:
    """Final shape of a tagged row, from the columns ``status, data, response, error`` of the model call."""
    blank = is_blank(statement)
    ok = ~blank & has_data()
    return df.select(
        "uuid",
        F.col(statement).alias("formal_statement"),
        F.when(~blank, F.col("response")).alias("model_output"),
        F.when(ok, _data_field(F.col("data"), "Difficulty", "double")).alias("difficulty_score"),
        ok.alias("success"),
        F.when(blank, F.lit(EMPTY_STATEMENT)).when(~ok, F.coalesce("error", F.lit(FAILED))).alias("error"),
    )


def best_tag_per_uuid(df: DataFrame, seq: str = "seq", id_col: str = "uuid") -> DataFrame:
    """Reader view of an appended output: a success first, else the latest row."""
    return last_wins(df.withColumn("_ok", F.coalesce("success", F.lit(False))), [id_col], ["_ok", seq]).drop("_ok")


def apply_predictions(items: DataFrame, preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fill the three difficulty fields of the items whose prediction succeeded; leave the others alone.

    ``preds`` has ``status``, ``data`` and ``response``; of several successes of a key the greatest counts.
    """
    good = preds.where(has_data()).select(
        *keys,
        F.struct(
            _data_field(F.col("data"), "Difficulty", "double").alias("difficulty"),
            _data_field(F.col("data"), "Rationale", "string").alias("difficulty_rationale"),
            F.col("response").alias("difficulty_response"),
        ).alias("_new"),
    ).groupBy(*keys).agg(F.max("_new").alias("_new"))
    joined = items.join(good, list(keys), "left")
    found = F.col("_new").isNotNull()
    fields = ["difficulty", "difficulty_rationale", "difficulty_response"]
    kinds = {"difficulty": "double"}
    filled = {
        f: F.when(found, F.col("_new")[f]).otherwise(
            F.col(f) if f in items.columns else F.lit(None).cast(kinds.get(f, "string"))
        )
        for f in fields
    }
    return joined.withColumns(filled).drop("_new")


def merge_results(
    original: DataFrame,
    processed: DataFrame,
    overlay: Sequence[str],
    statement: str = "natural_language_statement",
    seq: str = "seq",
) -> DataFrame:
    """One row per statement: the last original, with ``overlay`` columns of the last processed row.

    Statements are compared after stripping; empty ones are dropped, processed rows without an original
    are ignored. Overlay columns are taken with their nulls, because a typed column cannot tell an
    absent field from a null one. Both sides shrink to one row per statement, map-side first, before
    they meet; a hash is compared before the text itself.
    """
    def keyed(df: DataFrame) -> DataFrame:
        rows = df.withColumn("_key", strip(statement)).where(F.coalesce("_key", F.lit("")) != "")
        return rows.withColumn("_hash", F.xxhash64("_key"))

    # Grouping and joining use the same two columns, so each side is shuffled once.
    base = last_wins(keyed(original), ["_hash", "_key"], [seq])
    news = keyed(processed).groupBy("_hash", "_key").agg(F.max_by(F.struct(*overlay), F.col(seq)).alias("_new"))
    joined = base.join(news, ["_hash", "_key"], "left")
    found = F.col("_new").isNotNull()
    out = {
        c: F.when(found, F.col("_new")[c]).otherwise(F.col(c) if c in original.columns else F.lit(None))
        for c in overlay
    }
    return joined.withColumns(out).select(*original.columns, *[c for c in overlay if c not in original.columns])


def difficulty_stats(items: DataFrame) -> DataFrame:
    """Totals, completion rate (0 when empty) and mean of the non-null difficulties (0 when none)."""
    done = is_complete()
    return items.agg(
        F.count("*").alias("total"),
        F.count_if(done).alias("complete"),
        F.count_if(~done).alias("incomplete"),
        F.coalesce(F.try_divide(F.count_if(done), F.count("*")), F.lit(0.0)).alias("completion_rate"),
        F.coalesce(F.avg("difficulty"), F.lit(0.0)).alias("avg_difficulty"),
    )


def difficulty_distribution(items: DataFrame) -> DataFrame:
    """Rows per bucket ``<n>-<n+1>``, n being the difficulty cut toward zero."""
    low = F.col("difficulty").cast("bigint")
    bucket = F.concat(low.cast("string"), F.lit("-"), (low + 1).cast("string"))
    return items.where(F.col("difficulty").isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("items"))


def tagging_stats(total: int | Column, tagged: DataFrame) -> DataFrame:
    """Rows asked for, rows processed, successes and their share (0 when nothing was processed)."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    total = F.lit(total).cast("bigint") if isinstance(total, int) else total
    return tagged.agg(F.count("*").alias("processed"), F.count_if(ok).alias("success")).select(
        total.alias("total"),
        "processed",
        "success",
        F.coalesce(F.try_divide("success", "processed"), F.lit(0.0)).alias("success_rate"),
    )
