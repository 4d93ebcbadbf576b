"""Prompt text and chat messages as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from string import Formatter

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyforge.functions.flags import unsolved
from replyforge.functions.ids import base_id
from replyforge.functions.text import _col, coalesce_falsy, strip

# Stand-ins for empty feedback fields (fixed values).
NO_ATTEMPT = "No previous attempt"
NO_ERRORS = "No error messages"
NO_CODE = "No lean code provided"

MESSAGE = "struct<role:string,content:string>"
PROOF_MODES = ("proof", "proof_cot")
CHOICE_MODES = ("zero-shot", "five-shot")


def load_template(path: str) -> dict:
    """Read a YAML template file on the driver."""
    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)


def template_text(value: str | Sequence[str]) -> str:
    """Templates are stored as text or as a one-item list; take the whole text either way."""
    return value if isinstance(value, str) else value[0]


def render(template: str, *values: Column | str, null_text: str = "None", **named: Column | str) -> Column:
    """Fill the slots: ``{}`` left to right, ``{0}`` by number, ``{name}`` by name.

    ``{{`` and ``}}`` are literal braces, values are never expanded. A slot with a format or a conversion
    (``{:.2f}``, ``{!r}``), or one that nothing is given for, is refused.
    """
    pieces: list[Column] = []
    used = 0
    for literal, name, spec, conversion in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is None:
            continue
        if spec or conversion:
            raise ValueError(f"slots with a format are not supported: {name}{conversion or ''}{spec or ''}")
        if name and not name.isdigit():
            if name not in named:
                raise ValueError(f"template needs a value for {name}")
            value = named[name]
        else:
            slot = int(name) if name else used
            used += 1
            if slot >= len(values):
                raise ValueError(f"template needs more than {len(values)} values")
            value = values[slot]
        pieces.append(F.coalesce(_col(value).cast("string"), F.lit(null_text)))
    return F.concat(*pieces) if pieces else F.lit("")


def lettered_options(options: Column | str, shape: str = "{}) {}", joiner: str = "\n") -> Column:
    """``A) first`` / ``B) second`` ...; ``shape`` holds the letter slot and the option slot."""
    return F.array_join(
        F.transform(_col(options), lambda o, i: render(shape, F.char(i.cast("bigint") + 65), o)), joiner
    )


# Question layouts, by format index: text around the question, option shape, option joiner, tail (fixed formats).
QUESTION_LAYOUTS = (
    ("{}\n", "{}) {}", "\n", ""),
    ("{}\n", "{}. {}", "\n", "\nYour response: "),
    ("Question: {}\nOptions:\n", "{}: {}", "\n", ""),
    ("Question:\n{}\nOptions:\n", "{}) {}", "\n", "\nPlease begin answering."),
    ("Q: {}\n", "({}) {}", " ", ""),
    ("**Question**:\n{}\n**Options**:\n", "({}) {}", "\n", ""),
)


def question_block(question: Column | str, options: Column | str, layout: int = 0) -> Column:
    head, shape, joiner, tail = QUESTION_LAYOUTS[layout]
    return F.concat(render(head, question), lettered_options(options, shape, joiner), F.lit(tail))


def _generated(df: DataFrame, name: str) -> Column:
    """The field itself, else the one nested under ``generated``; columns that do not exist are skipped."""
    found = [F.col(name)] if name in df.columns else []
    if "generated" in df.columns and name in df.schema["generated"].dataType.names:
        found.append(F.col(f"generated.{name}"))
    if not found:
        raise ValueError(f"no column {name} to render")
    # The last operand of `a or b` is taken as it is, so an empty nested value stays empty.
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in found[:-1]], found[-1])


def render_proof(df: DataFrame, template: str) -> DataFrame:
    """Modes ``proof`` and ``proof_cot``: one slot, the code to complete."""
    return df.withColumn("prompt", render(template, _generated(df, "lean_code")))


def render_statement_and_code(df: DataFrame, template: str) -> DataFrame:
    """Mode ``proof_kimina``: problem text and code, each with its nested fallback."""
    return df.withColumn("prompt", render(template, _generated(df, "statement"), _generated(df, "lean_code")))


def render_feedback(df: DataFrame, template: str, per_query: bool = False, solved: DataFrame | None = None) -> DataFrame:
    """Mode ``proof_cot_feedback``: only failed rows, base ids, last proof + errors + code.

    ``per_query=True`` also drops the failed rows of a query that ``solved`` (column ``id``: base ids
    with a success) contains.
    """
    out = unsolved(df).withColumn("id", base_id("id"))
    if per_query:
        if solved is None:
            raise ValueError("per_query needs the solved base ids")
        out = out.join(solved.select("id").distinct(), ["id"], "left_anti")
    return out.withColumn(
        "prompt",
        render(
            template,
            coalesce_falsy("proof_of_last_round", default=NO_ATTEMPT),
            coalesce_falsy("error_messages", default=NO_ERRORS),
            coalesce_falsy("lean_code", default=NO_CODE),
        ),
    )


def render_correct(df: DataFrame, template: str) -> DataFrame:
    """Mode ``correct``: both columns must exist."""
    return df.withColumn("prompt", render(template, F.col("statement"), F.col("lean_code")))


def render_choice(df: DataFrame, template: str) -> DataFrame:
    """Multiple-choice modes with one slot: the question block."""
    return df.withColumn("prompt", render(template, question_block("question", "options")))


def render_choice_with_subfield(df: DataFrame, template: str) -> DataFrame:
    return df.withColumn("prompt", render(template, F.col("subfield"), question_block("question", "options")))


def render_robustness(df: DataFrame, templates: dict[str, str], mode: str) -> DataFrame:
    """Mode ``robustness-exp-<prompt>-<format>``."""
    prompt_index, layout = mode.split("-")[-2:]
    key = f"initial_prompt_{prompt_index}"
    if key not in templates or not layout.isdigit() or int(layout) >= len(QUESTION_LAYOUTS):
        raise ValueError(f"unknown robustness variant {mode}")
    return df.withColumn(
        "prompt", render(template_text(templates[key]), question_block("question", "options", int(layout)))
    )


def render_difficulty(df: DataFrame, template: str, statement: str = "formal_statement") -> DataFrame:
    """One slot, or one called ``statement``: the stripped statement."""
    stripped = strip(F.coalesce(F.col(statement), F.lit("")))
    return df.withColumn("prompt", render(template, stripped, statement=stripped))


def render_mode(df: DataFrame, mode: str, templates: dict) -> DataFrame:
    """Pick the renderer of a mode; a ``-bon`` suffix selects the same prompt."""
    name = mode.removesuffix("-bon")
    if "robustness-exp" in name:
        return render_robustness(df, templates, name)
    key = "user_prompt_format" if name == "proof_kimina" else "prompt_format"
    prompt = template_text(templates.get(key) or "")
    plain = {
        "proof_kimina": render_statement_and_code,
        "proof_cot_feedback": render_feedback,
        "correct": render_correct,
        "zero-shot-with-subfield": render_choice_with_subfield,
        **{m: render_proof for m in PROOF_MODES},
        **{m: render_choice for m in CHOICE_MODES},
    }
    if name not in plain or not prompt:
        raise ValueError(f"no renderer or template for mode {mode}")
    return plain[name](df, prompt)


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_conversation(
    prompt: Column | str, history: Column | str | None = None, system: Column | str | None = None
) -> Column:
    """System message if any, the past user/assistant turns in order, then the prompt."""
    parts: list[Column] = []
    if system is not None:
        text = _col(system)
        empty = F.array().cast(f"array<{MESSAGE}>")
        parts.append(F.when(F.coalesce(text, F.lit("")) != "", F.array(_message("system", text))).otherwise(empty))
    if history is not None:
        past = F.coalesce(_col(history), F.array().cast("array<struct<prompt:string,response:string>>"))
        turns = F.transform(past, lambda h: F.array(_message("user", h["prompt"]), _message("assistant", h["response"])))
        parts.append(F.flatten(turns))
    parts.append(F.array(_message("user", _col(prompt))))
    return F.concat(*parts)
