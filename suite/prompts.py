"""Prompt rendering and conversations."""

from pyspark.sql import functions as F

from replyforge.functions import render as R
from suite.base import query

CODE = "Finish the code {{x}}:\n{}\nend"
TWO = "Problem: {}\nCode: {}"
FEEDBACK = "Last: {}\nErrors: {}\nCode: {}"
_NL = "chr(10)"


@query(f"SELECT doc_id, 'lang {{{{}}}} ' || lang || {_NL} || 'n=' || cast(n_chars AS string) || ' src=' || source AS prompt FROM {{documents}}")
def render(t):
    return t["documents"].select("doc_id", R.render("lang {{}} {}\nn={} src={}", "lang", "n_chars", "source").alias("prompt"))


@query(
    f"""SELECT id, 'Finish the code {{{{x}}}}:' || {_NL} || coalesce(nullif(lean_code, ''), g_code, 'None') || {_NL} || 'end' AS prompt FROM {{statements}}"""
)
def render_proof(t):
    return R.render_mode(t["nested_statements"], "proof_cot-bon", {"prompt_format": [CODE]}).select("id", "prompt")


@query(
    f"""SELECT id, 'Problem: ' || coalesce(nullif(statement, ''), g_statement) || {_NL} || 'Code: ' || coalesce(nullif(lean_code, ''), g_code, 'None') AS prompt FROM {{statements}}"""
)
def render_proof_kimina(t):
    return R.render_mode(t["nested_statements"], "proof_kimina-bon", {"user_prompt_format": TWO}).select("id", "prompt")


@query(
    f"""SELECT id, 'You are careful.' AS system, 'Problem: ' || coalesce(nullif(statement, ''), g_statement) || {_NL} || 'Code: ' || coalesce(nullif(lean_code, ''), g_code, 'None') AS user FROM {{statements}}"""
)
def proof_kimina_conversation(t):
    asked = R.render_statement_and_code(t["nested_statements"], TWO)
    chat = R.build_conversation("prompt", system=F.lit("You are careful."))
    return asked.select("id", chat[0]["content"].alias("system"), chat[1]["content"].alias("user"))


_FEEDBACK_SQL = f"""
    SELECT split_part(id, '_', 1) AS id, 'Last: ' || coalesce(nullif(proof_of_last_round, ''), 'No previous attempt') || {_NL} ||
           'Errors: ' || coalesce(nullif(error_messages, ''), 'No error messages') || {_NL} ||
           'Code: ' || coalesce(nullif(lean_code, ''), 'No lean code provided') AS prompt
    FROM {{feedback_rows}} WHERE success IS NOT TRUE"""


@query(_FEEDBACK_SQL)
def render_feedback(t):
    return R.render_feedback(t["feedback_rows"], FEEDBACK).select("id", "prompt")


@query(f"SELECT id, prompt FROM ({_FEEDBACK_SQL}) WHERE cast(id AS bigint) % 2 = 1")
def render_feedback_per_query(t):
    solved = t["documents"].where("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("id"))
    return R.render_feedback(t["feedback_rows"], FEEDBACK, per_query=True, solved=solved).select("id", "prompt")


@query(f"SELECT id, 'Problem: ' || coalesce(statement, 'None') || {_NL} || 'Code: ' || coalesce(lean_code, 'None') AS prompt FROM {{statements}}")
def render_correct(t):
    return R.render_mode(t["statements"], "correct", {"prompt_format": [TWO]}).select("id", "prompt")


def _options(shape: str, joiner: str) -> str:
    """Lettered options in DuckDB; ``shape`` has the letter at ``L`` and the option at ``O``."""
    before, rest = shape.split("L")
    middle, after = rest.split("O")
    item = f"'{before}' || chr(cast(64 + i AS integer)) || '{middle}' || o || '{after}'"
    return f"list_aggregate(list_transform(options, lambda o, i: {item}), 'string_agg', {joiner})"


_BLOCK = f"question || {_NL} || {_options('L) O', _NL)}"


@query(f"SELECT doc_id, 'Q> ' || {_BLOCK} AS prompt FROM {{choices}}")
def render_choice(t):
    return R.render_mode(t["choices"], "zero-shot-bon", {"prompt_format": ["Q> {}"]}).select("doc_id", "prompt")


@query(f"SELECT doc_id, subfield || ': ' || {_BLOCK} AS prompt FROM {{choices}}")
def render_choice_with_subfield(t):
    return R.render_mode(t["choices"], "zero-shot-with-subfield", {"prompt_format": ["{}: {}"]}).select("doc_id", "prompt")


_LAYOUTS = [
    _BLOCK,
    f"question || {_NL} || {_options('L. O', _NL)} || {_NL} || 'Your response: '",
    f"'Question: ' || question || {_NL} || 'Options:' || {_NL} || {_options('L: O', _NL)}",
    f"'Question:' || {_NL} || question || {_NL} || 'Options:' || {_NL} || {_options('L) O', _NL)} || {_NL} || 'Please begin answering.'",
    f"'Q: ' || question || {_NL} || {_options('(L) O', chr(39) + ' ' + chr(39))}",
    f"'**Question**:' || {_NL} || question || {_NL} || '**Options**:' || {_NL} || {_options('(L) O', _NL)}",
]


@query(
    " UNION ALL ".join(
        f"SELECT doc_id, {i} AS layout, md5('try {i % 2}: ' || {block}) AS prompt_md5 FROM {{choices}}" for i, block in enumerate(_LAYOUTS)
    )
)
def render_robustness(t):
    """All six layouts in one scan of the questions."""
    templates = {f"initial_prompt_{p}": [f"try {p}: {{}}"] for p in (0, 1)}
    wide = t["choices"]
    for i in range(6):
        wide = R.render_mode(wide, f"robustness-exp-{i % 2}-{i}", templates).withColumnRenamed("prompt", f"p{i}")
    rows = F.array(*[F.struct(F.lit(i).alias("layout"), F.md5(f"p{i}").alias("prompt_md5")) for i in range(6)])
    return wide.select("doc_id", F.inline(rows))


@query("SELECT doc_id, trim(natural_language_statement, ' ' || chr(10)) || ' {{x}} ' || trim(natural_language_statement, ' ' || chr(10)) AS prompt FROM {tag_items}")
def render_difficulty_named(t):
    """A template with a named slot."""
    return R.render_difficulty(t["tag_items"], "{statement} {{x}} {statement}", "natural_language_statement").select("doc_id", "prompt")


@query("SELECT doc_id, 'Rate <' || trim(natural_language_statement, ' ' || chr(10)) || '> now' AS prompt FROM {tag_items}")
def render_difficulty(t):
    return R.render_difficulty(t["tag_items"], "Rate <{}> now", "natural_language_statement").select("doc_id", "prompt")


@query(
    """SELECT doc_id, pos, role, content FROM (
         SELECT doc_id, 0 AS pos, 'system' AS role, source AS content FROM {documents} WHERE doc_id % 3 <> 0
         UNION ALL SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 0 END, 'user', 'hi ' || lang FROM {documents} WHERE doc_id % 2 = 0
         UNION ALL SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 2 ELSE 1 END, 'assistant', 'yes ' || lang FROM {documents} WHERE doc_id % 2 = 0
         UNION ALL SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 0 END, 'user', text FROM {documents})"""
)
def build_conversation(t):
    past = F.when(
        F.col("doc_id") % 2 == 0,
        F.array(F.struct(F.concat(F.lit("hi "), "lang").alias("prompt"), F.concat(F.lit("yes "), "lang").alias("response"))),
    )
    system = F.when(F.col("doc_id") % 3 == 1, F.col("source")).when(F.col("doc_id") % 3 == 2, F.col("source")).otherwise("")
    chat = R.build_conversation("text", past, system)
    return t["documents"].select("doc_id", F.posexplode(chat).alias("pos", "m")).select("doc_id", "pos", "m.role", "m.content")


@query(
    """SELECT c.conv_id, c.turn, p.turn AS asked, c.text AS answer, p.text AS question FROM {turns} c JOIN {turns} p
       ON c.conv_id = p.conv_id AND p.turn = c.turn - 1 WHERE c.role = 'assistant' AND p.role = 'user'"""
)
def chat_history(t):
    """User/assistant pairs of the recorded conversations as history messages."""
    turns = t["turns"]
    asked = turns.where("role = 'user'").select("conv_id", F.col("turn").alias("asked"), F.col("text").alias("question"))
    replies = turns.where("role = 'assistant'").select("conv_id", "turn", (F.col("turn") - 1).alias("asked"), F.col("text").alias("answer"))
    pairs = replies.join(asked, ["conv_id", "asked"])
    chat = R.build_conversation(F.lit("next"), F.array(F.struct(F.col("question").alias("prompt"), F.col("answer").alias("response"))))
    return pairs.select("conv_id", "turn", "asked", chat[1]["content"].alias("answer"), chat[0]["content"].alias("question"))
