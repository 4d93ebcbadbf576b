"""Digging a JSON object out of a model reply, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyforge.functions.jsontext import OBJECT_START, is_json_object, json_path, strict_json
from replyforge.functions.text import WHITESPACE, _col

_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]*"

# Where a reply may hide its JSON, in order of preference (fixed patterns).
FENCED_JSON = r"(?s)```json" + _SPACE + r"(\{.*?\})" + _SPACE + "```"
FENCED_ANY = r"(?s)```" + _SPACE + r"(\{.*?\})" + _SPACE + "```"
OUTERMOST_BRACES = r"(?s)(\{.*\})"


def has_keys(record: Column, keys: Sequence[str]) -> Column:
    """All ``keys`` are present in a VARIANT object."""
    found = F.lit(True)
    for key in keys:
        found = found & F.try_variant_get(record, json_path(key), "variant").isNotNull()
    return found


def candidate_objects(text: Column) -> Column:
    """Printable-ASCII form of every substring that could be the object, best first."""
    found = F.concat(
        *[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in (FENCED_JSON, FENCED_ANY, OUTERMOST_BRACES)]
    )
    return F.transform(found, lambda x: F.regexp_replace(x, r"[^\x20-\x7E]", ""))


def extract_json(text: Column | str, keys: Sequence[str] | None = None) -> Column:
    """JSON text found in a reply, or null.

    A reply that is JSON as a whole is returned untouched, unless it is an object that lacks one of
    ``keys``: then nothing is returned. Otherwise the first candidate that parses wins; its keys are
    not looked at here, :func:`valid_prediction` does that later.
    """
    text = _col(text)
    whole = strict_json(text)
    is_object = F.regexp_like(text, F.lit(OBJECT_START))
    embedded = F.try_element_at(F.filter(candidate_objects(text), lambda x: strict_json(x).isNotNull()), F.lit(1))
    whole_ok = ~is_object | has_keys(whole, keys) if keys else F.lit(True)
    return F.when(whole.isNotNull(), F.when(whole_ok, text)).otherwise(embedded)


def valid_prediction(status: Column | str = "status", data: Column | str = "data") -> Column:
    """Call succeeded and the JSON is an object with a ``Difficulty`` key; its range is not checked."""
    data = _col(data)
    ok = (
        (_col(status) == "success")
        & is_json_object(data)
        & F.try_variant_get(strict_json(data), "$.Difficulty", "variant").isNotNull()
    )
    return F.coalesce(ok, F.lit(False))
