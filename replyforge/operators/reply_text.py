"""The reply rules of ``functions.replies`` for use inside a retrying call, where no plan is at hand."""

from __future__ import annotations

import json
import re

from replyforge.functions.replies import FENCED_ANY, FENCED_JSON, OUTERMOST_BRACES

# Java spells code points \x{..}; Python \uXXXX.
_PATTERNS = [
    re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", p))
    for p in (FENCED_JSON, FENCED_ANY, OUTERMOST_BRACES)
]


def _refuse(token: str):
    raise ValueError(f"{token} is not JSON")


def _unique(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("repeated key")
    return out


def _load(text: str):
    return json.loads(text, parse_constant=_refuse, object_pairs_hook=_unique)


def _loads_or_none(text: str):
    try:
        return _load(text), True
    except (ValueError, RecursionError):
        return None, False


def find_json(reply: str, keys: tuple[str, ...], required: str | None = None) -> str:
    """JSON text of a reply; raises when there is none or ``required`` is not in it."""
    value, whole = _loads_or_none(reply)
    if whole:
        if isinstance(value, dict) and (lacking := [k for k in keys if k not in value]):
            raise ValueError(f"Missing expected key: {lacking[0]}")
        text = reply
    else:
        found = (re.sub(r"[^\x20-\x7E]", "", m) for p in _PATTERNS for m in p.findall(reply))
        text = next((c for c in found if _loads_or_none(c)[1]), None)
        if text is None:
            raise ValueError("No valid JSON found in response")
        value = _load(text)
    if required is not None and not (isinstance(value, dict) and required in value):
        raise ValueError("Validation failed")
    return text
