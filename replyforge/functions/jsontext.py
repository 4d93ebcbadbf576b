"""Strict JSON parsing into VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyforge.functions.text import _col

# JSON allows these blanks before a value; an object starts with a brace.
OBJECT_START = r"^[ \t\r\n]*\{"


def json_path(name: str) -> str:
    """Path of a top-level field, whatever its name holds; a name with both kinds of quotes cannot be written."""
    if "'" not in name:
        return f"$['{name}']"
    if '"' not in name:
        return f'$["{name}"]'
    raise ValueError(f"field name with both kinds of quotes: {name}")


def strict_json(text: Column | str) -> Column:
    """VARIANT of a text that is one JSON value and nothing else, or null.

    ``try_parse_json`` stops after the first value and accepts ``{"a": 1} and more``. The text is therefore parsed
    as the first element of an array whose second element is its own hash: only when the parser reads
    past the end of the text does it meet that number in second place. Repeated keys and ``NaN`` are
    malformed.
    """
    text = _col(text)
    mark = F.xxhash64(text)
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]")))
    return F.when(F.try_variant_get(pair, "$[1]", "bigint") == mark, F.try_variant_get(pair, "$[0]", "variant"))


def is_json_object(text: Column | str) -> Column:
    """The text is one JSON object; false for everything else, null included."""
    return F.coalesce(F.regexp_like(_col(text), F.lit(OBJECT_START)), F.lit(False)) & strict_json(text).isNotNull()
