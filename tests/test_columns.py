"""Rules of the column helpers on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from replyforge.config import FieldNames, load_config
from replyforge.functions import flags, ids, names, text
from replyforge.functions import render as R
from replyforge.functions.replies import extract_json, valid_prediction
from replyforge.operators.classify import label_number
from replyforge.operators.reply_text import find_json
from replyforge.sources.jsonl import parse_lines, typed_rows, verdict_rows


def column(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_strip_removes_what_python_removes(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    values = [s + "a b" + s for s in spaces] + ["".join(spaces), "\x00a\x00", "​a"]
    assert column(spark, values, text.strip("v")) == [v.strip() for v in values]


def test_round_even_equals_python(spark):
    random.seed(3)
    values = [2.675, 0.125, 1.005, -2.675, -0.125, 3.125, 0.0, 4102.855, 1e300, 123456789012.345]
    values += [random.randint(-(10**7), 10**7) / 1000 for _ in range(3000)]
    values += [random.random() * 100 for _ in range(3000)]
    assert column(spark, values, text.round_even("v", 2), "double") == [round(v, 2) for v in values]
    assert column(spark, values[:8] + values[10:], text.round_even("v", 4), "double") == [round(v, 4) for v in values[:8] + values[10:]]
    assert column(spark, [None], text.round_even("v", 2), "double") == [None]


def test_paths(spark):
    import os

    values = ["a/b/c.tar.gz", "c", "/c", "/a/c.x", "a//c", ".hidden", "a/.hidden", "..x", "a.b/c", "//c", "a/b/"]
    assert column(spark, values, text.basename("v")) == [os.path.basename(v) for v in values]
    assert column(spark, values, text.dirname("v")) == [os.path.dirname(v) for v in values]
    assert column(spark, values, text.stem("v")) == [os.path.splitext(os.path.basename(v))[0] for v in values]


def test_zero_padded(spark):
    assert column(spark, [3, 12, 123], text.zero_padded("v"), "int") == ["03", "12", "123"]


def test_attempt_ids(spark):
    values = ["a", "a_b_c", "a_x", "a_ 3", "7_+4", "7_-1", "7_3.0", "_5", "7_", None, "7_　9\n", "7__1", "7_1e3"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, id string")
    got = {r["i"]: (r["query_id"], r["response_idx"]) for r in ids.attempt_rows(frame).collect()}
    assert got == {3: ("a", 3), 4: ("7", 4), 5: ("7", -1), 7: ("", 5), 10: ("7", 9)}
    assert ids.rejected_attempt_ids(frame).count() == len(values) - len(got)


def test_base_and_composite_ids(spark):
    assert column(spark, ["63_0", "63", "a_b_c", None, "_x"], ids.base_id("v")) == ["63", "63", "a", None, ""]
    frame = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert frame.select(ids.composite_id(["x", "y", "z"])).first()[0] == "a_3"
    assert frame.select(ids.composite_id(["x", "y", "z"], nulls="None")).first()[0] == "a_None_3"
    assert frame.select(ids.composite_id("y")).first()[0] is None


def test_label_number(spark):
    values = ["__label__1", "__label__0", "7", "x", "__label__", None]
    assert column(spark, values, label_number("v")) == [1, 0, 7, None, None, None]


def test_response_union_and_truth(spark):
    lines = [
        '{"id": "1", "response": "text", "success": true}',
        '{"id": "2", "response": {"error": "boom"}, "success": "false"}',
        '{"id": "3", "response": "", "success": false}',
        '{"id": "4", "response": null}',
        '{"id": 5, "success": 1}',
        '{"id": "6", "response": "{\\"error\\": 1}"}',
        '{"id": "7", "response": {"error": null}}',
        '{"id": "8", "response": {"text": "t"}}',
        '{"id": "9", "response": {}}',
        '{"id": "10", "response": ["x"]}',
        '{"id": "11", "response": 5}',
    ]
    frame = parse_lines(spark.createDataFrame([(v,) for v in lines], "value string"))
    rows = flags.split_response(frame).withColumn("answered", flags.is_answered()).collect()
    assert [r["answered"] for r in rows] == [True, False, False, False, False, True, False, True, False, False, False]
    assert rows[1]["error"] == "boom"
    assert rows[6]["error"] == "null" and rows[7]["response"] == '{"text":"t"}'
    good = verdict_rows(frame.withColumn("record", F.parse_json(F.lit('{"id": "3_4", "success": true}'))))
    assert good.rows.count() == 11 and good.rejects.count() == 0
    assert verdict_rows(frame).rejects.count() == 11
    typed = typed_rows(frame, "id string, success boolean").collect()[:6]
    assert [(r["id"], r["success"]) for r in typed] == [
        ("1", True), ("2", None), ("3", False), ("4", None), (None, None), ("6", None),
    ]


def test_missing_key_and_json_null(spark):
    frame = parse_lines(spark.createDataFrame([('{"a": null}',), ("{}",)], "value string"))
    assert [r[0] for r in frame.select(flags.variant_has("record", "a")).collect()] == [True, False]


REPLIES = [
    '{"Difficulty": 1, "Rationale": "r"}',
    '  {"Difficulty": 1, "Rationale": "r"}\n',
    '{"Rationale": "only"}',
    "[1, 2]",
    "3",
    'x ```json\n{"Difficulty": 2,\n "Rationale": "é\tz"}\n``` y',
    'x ```json {"a": } ``` then ``` {"Difficulty": 3} ``` z',
    'text {"Difficulty": 4, "in": {"x": "}"}} tail',
    'text {"Rationale": "no key check here"} tail',
    "nothing",
    "",
    "```json\n{}\n```",
    'two {"a": 1} and {"b": 2}',
    '{"a": 1, "a": 2}',
    '{"a": NaN}',
    "```json\xa0{\"Difficulty\": 5}　```",
    "{broken ```json\n{\"Difficulty\": 6}\n```",
]
KEYS = ("Difficulty", "Rationale")


@pytest.mark.parametrize("keys", [KEYS, ()])
def test_both_forms_of_reply_parsing_agree(spark, keys):
    def plain(reply):
        try:
            return find_json(reply, keys)
        except ValueError:
            return None

    assert column(spark, REPLIES, extract_json("v", list(keys))) == [plain(r) for r in REPLIES]


def test_reply_rules():
    assert find_json(REPLIES[5], KEYS) == '{"Difficulty": 2, "Rationale": "z"}'
    assert find_json(REPLIES[8], KEYS) == '{"Rationale": "no key check here"}'
    assert find_json(REPLIES[3], KEYS) == "[1, 2]"
    with pytest.raises(ValueError, match="Missing expected key: Difficulty"):
        find_json(REPLIES[2], KEYS)
    with pytest.raises(ValueError, match="Validation failed"):
        find_json(REPLIES[8], KEYS, "Difficulty")
    with pytest.raises(ValueError, match="No valid JSON"):
        find_json(REPLIES[12], KEYS)


def test_valid_prediction(spark):
    rows = [
        ("success", '{"Difficulty": null}'),
        ("success", '{"Rationale": "x"}'),
        ("success", "[1]"),
        ("success", None),
        ("failed", '{"Difficulty": 1}'),
        (None, '{"Difficulty": 1}'),
        ("success", '{"Difficulty": 99}'),
    ]
    frame = spark.createDataFrame(rows, "status string, data string")
    assert [r[0] for r in frame.select(valid_prediction()).collect()] == [True, False, False, False, False, False, True]


def test_render_slots(spark):
    frame = spark.createDataFrame([("{x} {}", None, 3)], "a string, b string, c int")
    template = "{{literal}} {} / {} / {}"
    assert frame.select(R.render(template, "a", "b", "c")).first()[0] == template.format("{x} {}", None, 3)
    assert frame.select(R.render("{1}-{0}", "a", "c")).first()[0] == "3-{x} {}"
    with pytest.raises(ValueError):
        R.render("{} {}", "a")


def test_question_layouts(spark):
    frame = spark.createDataFrame([("Why?", ["a", "b"])], "question string, options array<string>")
    got = [frame.select(R.question_block("question", "options", i)).first()[0] for i in range(6)]
    assert got == [
        "Why?\nA) a\nB) b",
        "Why?\nA. a\nB. b\nYour response: ",
        "Question: Why?\nOptions:\nA: a\nB: b",
        "Question:\nWhy?\nOptions:\nA) a\nB) b\nPlease begin answering.",
        "Q: Why?\n(A) a (B) b",
        "**Question**:\nWhy?\n**Options**:\n(A) a\n(B) b",
    ]


def test_unknown_modes_are_refused(spark):
    frame = spark.createDataFrame([("q", ["a"])], "question string, options array<string>")
    with pytest.raises(ValueError):
        R.render_mode(frame, "no-such-mode", {"prompt_format": ["{}"]})
    with pytest.raises(ValueError):
        R.render_mode(frame, "robustness-exp-0-9", {"initial_prompt_0": ["{}"]})
    with pytest.raises(ValueError):
        R.render_mode(frame, "zero-shot", {})


def test_kimina_template_is_rendered_whole(spark):
    frame = spark.createDataFrame([("p", "c")], "statement string, lean_code string")
    out = R.render_mode(frame, "proof_kimina-bon", {"user_prompt_format": "Think: {} | {}"})
    assert out.first()["prompt"] == "Think: p | c"


def test_feedback_rows(spark):
    rows = [("63_0", True, "c", "p", "e"), ("63_1", None, None, "", None), ("64", False, "c", "p", "e")]
    frame = spark.createDataFrame(rows, "id string, success boolean, lean_code string, proof_of_last_round string, error_messages string")
    out = {r["id"]: r["prompt"] for r in R.render_feedback(frame, "{}|{}|{}").collect()}
    assert out == {"63": "No previous attempt|No error messages|No lean code provided", "64": "p|e|c"}


def test_conversation_order(spark):
    frame = spark.createDataFrame(
        [("now", [("q1", "a1"), ("q2", "a2")], "sys"), ("now", None, "")],
        "p string, h array<struct<prompt:string,response:string>>, s string",
    )
    chats = [[tuple(m) for m in r[0]] for r in frame.select(R.build_conversation("p", "h", "s")).collect()]
    assert chats[0] == [
        ("system", "sys"), ("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "now"),
    ]
    assert chats[1] == [("user", "now")]


def test_config(tmp_path):
    path = tmp_path / "run.yaml"
    path.write_text("response_key: answer\nid_key:\n  - a\n  - b\nBoN: 32\nmax_rounds: 3\nunknown: 1\n")
    config = load_config(str(path))
    assert config.response_key == "answer" and config.id_columns == ["a", "b"]
    assert (config.bon, config.max_rounds) == (32, 3)
    assert FieldNames().id_columns == ["id"]


def test_completeness(spark):
    rows = [(0.0, "r"), (1.0, ""), (None, "r"), (0.5, "r"), (2.0, None)]
    frame = spark.createDataFrame(rows, "difficulty double, difficulty_rationale string")
    assert flags.filter_complete(frame).count() == 1
    assert flags.filter_incomplete(frame).count() == 4


def test_names_there_and_back(spark):
    config = FieldNames(response_key="answer", prompt_key="ask", id_key=("a", "b", "gone"), save_prompt=False)
    frame = spark.createDataFrame([("x", 1, "r", "p", "keep")], "a string, b int, answer string, ask string, other string")
    inside = names.use_operator_names(frame, config)
    assert inside.columns == ["a", "b", "response", "prompt", "other", "sample_id"]
    assert inside.first()["sample_id"] == "x_1"
    assert names.use_configured_names(inside, config).columns == ["a", "b", "answer", "other"]


def test_both_forms_agree_on_random_replies(spark):
    rng = random.Random(11)
    pieces = ["{", "}", "[", "]", '"Difficulty"', '"Rationale"', ":", ",", " 1", " 2.5", '"x"', "```json", "```", "\n", " ", "é", "null", '{"Difficulty": 3, "Rationale": "r"}', "text", "\\", "\x0b", "{}"]
    replies = list(dict.fromkeys("".join(rng.choices(pieces, k=rng.randrange(1, 12))) for _ in range(4000)))

    def plain(reply, keys):
        try:
            return find_json(reply, keys)
        except ValueError:
            return None

    for keys in (KEYS, ()):
        assert column(spark, replies, extract_json("v", list(keys))) == [plain(r, keys) for r in replies]


def test_templates_from_yaml(spark, tmp_path):
    """A template stored as text and one stored as a list both give the whole text."""
    path = tmp_path / "own.yaml"
    path.write_text("prompt_format:\n  - |\n    Finish:\n    {}\nsystem_prompt_format: |\n  Be careful.\nuser_prompt_format: |\n  Solve {} with {}\n")
    templates = R.load_template(str(path))
    assert R.template_text(templates["prompt_format"]) == "Finish:\n{}\n"
    frame = spark.createDataFrame([("p", "c")], "statement string, lean_code string")
    assert R.render_mode(frame, "proof_kimina", templates).first()["prompt"] == "Solve p with c\n"
    assert R.render_mode(frame, "proof", templates).first()["prompt"] == "Finish:\nc\n"


def test_named_slots_and_formats(spark):
    import pytest

    from replyforge.functions.render import render

    row = spark.range(1).select(render("{{a}} {b} {} {b}", F.lit("x"), b=F.lit("y")).alias("p")).first()
    assert row["p"] == "{a} y x y"
    for template in ("{:.2f}", "{!r}", "{c}"):
        with pytest.raises(ValueError):
            render(template, F.lit(1.0))
