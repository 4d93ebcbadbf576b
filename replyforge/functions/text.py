"""String, number and truth helpers that follow Python's rules where Spark's differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points Python's str.strip() removes (fixed values).
WHITESPACE_CODES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
WHITESPACE = "".join(chr(c) for c in WHITESPACE_CODES)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def one_line(c: Column | str) -> Column:
    """Newlines become single blanks."""
    return F.translate(_col(c), "\n", " ")


def coalesce_falsy(*cols: Column | str, default: Column | str | None = None) -> Column:
    """First value that is neither null nor the empty string, else ``default`` (a literal or Column)."""
    usable = [F.nullif(_col(c), F.lit("")) for c in cols]
    if default is not None:
        usable.append(default if isinstance(default, Column) else F.lit(default))
    return F.coalesce(*usable)


def round_even(c: Column | str, digits: int) -> Column:
    """Round a double to the nearest decimal, ties to even, judged by its exact binary value.

    ``bround`` looks at the shortest decimal form instead and moves 2.675, which is a little less than it
    prints, up to 2.68. Here ``x * 2 * 10**digits`` is taken as a product plus its exact error (the first
    half of ``x`` has 26 bits, so both partial products are exact), and compared with the odd number in
    the middle of the two candidates.
    """
    x = _col(c).cast("double")
    scale = float(10**digits)
    low = F.floor(x * scale).cast("double")
    head = x * 134217729.0 - (x * 134217729.0 - x)
    product = x * (2 * scale)
    error = (head * (2 * scale) - product) + (x - head) * (2 * scale)
    side = (product - (low * 2 + 1)) + error
    up = (side > 0) | ((side == 0) & (F.pmod(low, F.lit(2.0)) == 1.0))
    exact = F.when(up, low + 1).otherwise(low) / scale
    # Beyond this size the scaled number is no longer a whole number of its own.
    return F.when(F.abs(x) < 2.0**52 / scale / 2, exact).otherwise(F.bround(x, digits))


def percent(part: Column, whole: Column) -> Column:
    """``part/whole*100``; 0 when ``whole`` is 0."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def basename(c: Column | str) -> Column:
    return F.substring_index(_col(c), "/", -1)


def dirname(c: Column | str) -> Column:
    """Everything before the last slash; empty when there is none, the slashes of a root path kept."""
    head = F.regexp_extract(_col(c), "^((?s).*/)[^/]*$", 1)
    cut = F.rtrim(head, F.lit("/"))
    return F.when(cut == "", head).otherwise(cut)


def stem(c: Column | str) -> Column:
    """Base name without its last extension; leading dots do not start an extension."""
    return F.regexp_replace(basename(c), r"(?s)(?<=[^.])\.[^.]*$", "")


def zero_padded(c: Column | str, width: int = 2) -> Column:
    """Whole number with leading zeros; longer numbers are kept whole."""
    text = _col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def truthy_string(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")) != ""


def truthy_number(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("double"), F.lit(0.0)) != 0.0
