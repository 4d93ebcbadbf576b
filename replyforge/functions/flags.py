"""Row predicates over responses, statuses, verdicts and difficulty fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyforge.config import StatusSets
from replyforge.functions.jsontext import json_path
from replyforge.functions.text import _col, truthy_number, truthy_string

STATUSES = StatusSets()


def is_answered(response: Column | str = "response", error: Column | str = "error") -> Column:
    """A non-empty response that did not arrive as an error object."""
    return truthy_string(response) & _col(error).isNull()


def has_status(status: Column | str, allowed: Sequence[str]) -> Column:
    """True when the status is missing or one of ``allowed``."""
    status = _col(status)
    return status.isNull() | status.isin(list(allowed))


def checkpoint_bucket(
    has_processor: bool, response="response", error="error", status="status", sets: StatusSets = STATUSES
) -> Column:
    """``completed``, ``processing``, ``ignored`` or ``no_response`` for one saved record."""
    answered = is_answered(response, error)
    if not has_processor:
        return F.when(answered, F.lit("completed")).otherwise(F.lit("no_response"))
    return (
        F.when(~answered, F.lit("no_response"))
        .when(has_status(status, sets.skip), F.lit("completed"))
        .when(has_status(status, sets.resume), F.lit("processing"))
        .otherwise(F.lit("ignored"))
    )


def unsolved(df: DataFrame, success: str = "success") -> DataFrame:
    """Drop the rows whose verdict is exactly true; false and missing stay."""
    return df.where(~F.coalesce(F.col(success), F.lit(False)))


def is_complete(difficulty: Column | str = "difficulty", rationale: Column | str = "difficulty_rationale") -> Column:
    """Both difficulty fields filled; a difficulty of 0 counts as not filled."""
    return truthy_number(difficulty) & truthy_string(rationale)


def filter_complete(df: DataFrame, **names) -> DataFrame:
    return df.where(is_complete(**names))


def filter_incomplete(df: DataFrame, **names) -> DataFrame:
    return df.where(~is_complete(**names))


def variant_kind(value: Column) -> Column:
    """Type name of a VARIANT value, e.g. ``STRING`` or ``OBJECT<...>``."""
    return F.schema_of_variant(value)


def variant_field(record: Column | str, name: str) -> Column:
    return F.try_variant_get(_col(record), json_path(name), "variant")


def variant_string(record: Column | str, name: str) -> Column:
    """The field when it is a JSON string, else null; numbers are not turned into text."""
    value = variant_field(record, name)
    return F.when(variant_kind(value) == "STRING", F.try_variant_get(_col(record), json_path(name), "string"))


def variant_boolean(record: Column | str, name: str) -> Column:
    """The field when it is a JSON boolean, else null; the string "false" is not a boolean."""
    value = variant_field(record, name)
    return F.when(variant_kind(value) == "BOOLEAN", F.try_variant_get(_col(record), json_path(name), "boolean"))


def variant_has(record: Column | str, name: str) -> Column:
    """Key present, JSON null included."""
    return variant_field(record, name).isNotNull()


def split_response(df: DataFrame, record: str = "record", response: str = "response", error: str = "error") -> DataFrame:
    """Split the union field ``response`` (text or ``{"error": ...}``) into two text columns.

    An object that has the error key, even with a null in it, is an error; any other object is an answer and kept
    as JSON text (an empty one as empty text). Numbers and lists are no answer.
    """
    value = variant_field(record, response)
    is_object = variant_kind(value).startswith("OBJECT")
    failed = F.try_variant_get(value, json_path(error), "variant").isNotNull()
    as_text = F.try_variant_get(value, "$", "string")
    return df.withColumns(
        {
            error: F.when(failed, F.coalesce(F.try_variant_get(value, json_path(error), "string"), F.lit("null"))),
            response: F.when(variant_kind(value) == "STRING", as_text).when(
                is_object & ~F.coalesce(failed, F.lit(False)), F.when(F.to_json(value) == "{}", "").otherwise(F.to_json(value))
            ),
        }
    )
