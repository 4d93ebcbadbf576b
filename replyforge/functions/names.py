"""Between the column names a run is configured with and the ones the operators use."""

from __future__ import annotations

from pyspark.sql import DataFrame

from replyforge.config import FieldNames
from replyforge.functions.ids import composite_id

SAMPLE_ID = "sample_id"


def _pairs(config: FieldNames) -> dict[str, str]:
    """Configured name to operator name."""
    return {
        config.response_key: "response",
        config.meta_response_key: "meta_response",
        config.error_key: "error",
        config.prompt_key: "prompt",
        config.history_key: "history",
        config.status_key: "status",
    }


def use_operator_names(df: DataFrame, config: FieldNames) -> DataFrame:
    """Rename the configured columns and add the identifier as ``sample_id``; other columns pass through."""
    renamed = df.withColumnsRenamed({a: b for a, b in _pairs(config).items() if a != b and a in df.columns})
    parts = [c for c in config.id_columns if c in df.columns]
    return renamed.withColumn(SAMPLE_ID, composite_id(config.id_key if isinstance(config.id_key, str) else parts))


def use_configured_names(df: DataFrame, config: FieldNames) -> DataFrame:
    """The way back for output: prompt and meta response only when they are to be saved."""
    unwanted = [SAMPLE_ID]
    if not config.save_prompt:
        unwanted.append("prompt")
    if not config.save_meta_response:
        unwanted.append("meta_response")
    kept = df.drop(*unwanted)
    return kept.withColumnsRenamed({b: a for a, b in _pairs(config).items() if a != b and b in kept.columns})
