"""Line-first quality rules, as column expressions only.

A text is cut at ``\\n``. Each line that holds a word is judged on its own by three kinds of rules:

* punctuation: too large a share of the line's characters are punctuation marks or symbols, or a short line does not
  end like a sentence;
* navigation: the line is a menu (several separators between few words);
* boilerplate: a short line with one of the stock phrases of web pages.

Failing lines are removed. A document is kept when the base rules pass and the words of its remaining lines hold
enough of its characters.

Null and empty texts have no words: all counts are 0, the base rules fail, the document is not kept. Nothing is
shuffled; each row is judged alone, so ties, repeated rows and hot sources do not matter. Input columns other than the
text are left out of the expressions and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words: space and U+0009 to U+000D.
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKS = r"[\p{Punct}]"
MENU_MARKS = "[|›»•·>]"
BOILERPLATE = (
    "cookie policy|cookie settings|privacy policy|terms of (use|service)|enable javascript|click here|read more|"
    "sign in|log in|sign up|subscribe to|share this|skip to content|back to top|powered by"
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds; shares are between 0 and 1."""

    max_mark_share: float = 0.2
    judged_chars: int = 20  # shorter lines are not judged by their share of marks
    short_line_words: int = 4  # lines of fewer words have to end like a sentence
    short_line_chars: int = 80  # and of fewer characters
    sentence_end: str = r"[.!?:;…\"'”’»)\]][\x20\x09-\x0D]*+$"
    menu_separators: int = 2
    menu_words_per_separator: int = 4
    boilerplate_chars: int = 100  # longer lines are not judged by stock phrases
    max_lost_share: float = 0.5
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def word_chars_of(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE_RUN, "")).cast("long")


def marks_in(text: Column, marks: str) -> Column:
    """How many characters of the regular-expression class ``marks`` the text has."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"{marks}+", ""))).cast("long")


def repeated_words(words: Column, window: int) -> Column:
    """Number of words inside windows of ``window`` words that the text has at least twice, first ones included."""

    def covered(starts: Column) -> Column:
        step = F.transform(
            starts,
            lambda p, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1), p + window) - p),
        )
        return F.aggregate(step, F.lit(0), lambda total, n: total + n)

    def repeated_starts(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            ordered,
            lambda pairs: F.sort_array(
                F.transform(
                    F.filter(
                        pairs,
                        lambda s, i: s["h"].eqNullSafe(F.get(pairs, i + 1)["h"])
                        | s["h"].eqNullSafe(F.get(pairs, i - 1)["h"]),
                    ),
                    lambda s: s["i"],
                )
            ),
        )

    def runs(hashes: Column, n: int) -> Column:
        return F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - (n - 1), F.lit(0))),
            lambda _, i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)]),
        )

    def all_differ(values: Column) -> Column:
        return F.size(F.array_distinct(values)) == F.size(values)

    # A repeated window repeats its first half, too. Few texts repeat that, fewer a window; only those are sorted.
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.when(let(runs(h, max(1, window // 2)), all_differ), F.lit(0)).otherwise(
            let(runs(h, window), lambda r: F.when(all_differ(r), F.lit(0)).otherwise(let(repeated_starts(r), covered)))
        ),
    ).cast("long")


def line_fails(line: Column, rules: LineRules) -> Column:
    """Whether a line that holds a word is removed. Cheap conditions stand first; the others see few lines."""
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    few_words = rf"^{space}*+(?:{word}++{space}++){{0,{rules.short_line_words - 2}}}{word}*+{space}*+$"
    size = F.length(line)
    separators = marks_in(line, MENU_MARKS)
    too_many_marks = (size >= rules.judged_chars) & (marks_in(line, MARKS) > size * rules.max_mark_share)
    no_sentence = (size < rules.short_line_chars) & line.rlike(few_words) & ~line.rlike(rules.sentence_end)
    menu = (
        line.rlike(f"{MENU_MARKS}[^|›»•·>]*{MENU_MARKS}")
        & (separators >= rules.menu_separators)
        & (F.size(words_of(line)) <= (separators + 1) * rules.menu_words_per_separator)
    )
    stock = (size <= rules.boilerplate_chars) & F.lower(line).rlike(BOILERPLATE)
    return too_many_marks | no_sentence | menu | stock


def judge(docs, rules: LineRules = LineRules(), text: str = "text", prefix: str = ""):
    """Add the counts, the cleaned text and the verdict to every row.

    Columns added, each with ``prefix`` in front: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` (long), ``clean_text`` (failing lines removed), ``base_failed``, ``kept`` (boolean). An input
    column of the same name is replaced; use ``prefix`` to keep it.
    """
    # The raw column comes first; the rest is built on columns computed once per row.
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    lines = F.filter(F.split(raw, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    kept_lines = F.filter(lines, lambda x: ~line_fails(x, rules))
    t = "__rules_"
    while any(c.lower().startswith(t) for c in docs.columns):
        t = "_" + t
    first = docs.withColumns(
        {
            t + "words": words_of(raw),
            t + "lines": lines,
            t + "kept": kept_lines,
            t + "symbols": (len(SYMBOLS) * F.length(raw) - sum((F.length(F.replace(raw, F.lit(s), F.lit(""))) for s in SYMBOLS), F.lit(0))).cast("long"),
        }
    )
    second = first.withColumns(
        {
            t + "n": F.size(t + "words").cast("long"),
            t + "chars": F.length(F.array_join(t + "words", "")).cast("long"),
            t + "dup": (F.size(t + "lines") - F.size(F.array_distinct(t + "lines"))).cast("long"),
            t + "clean": F.array_join(t + "kept", "\n"),
            t + "repeat": repeated_words(F.col(t + "words"), rules.window),
        }
    )
    failed = (F.col(t + "n") < rules.min_words) | (
        100 * F.col(t + "repeat") > rules.max_repeat_percent * F.col(t + "n")
    )
    enough = word_chars_of(F.col(t + "clean")) >= F.col(t + "chars") * (1 - rules.max_lost_share)
    named = {
        "n_words": F.col(t + "n"),
        "word_chars": F.col(t + "chars"),
        "n_symbols": F.col(t + "symbols"),
        "n_dup_lines": F.col(t + "dup"),
        "n_repeat_words": F.col(t + "repeat"),
        "clean_text": F.col(t + "clean"),
        "base_failed": failed,
        "kept": ~failed & enough,
    }
    left = [F.col(f"`{c}`") for c in docs.columns if c not in {prefix + n for n in named}]
    return second.select(*left, *[c.alias(prefix + n) for n, c in named.items()])
