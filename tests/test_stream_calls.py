"""Model calls on a stream: stopped midway and started again, none is made twice."""

import json
import os
from collections import Counter
from functools import partial

import pytest

from replyforge.operators.calls import ask_for_json, infer_batch
from replyforge.plans.once import call_once
from replyforge.streaming.calls import TAGGED, answered, call_stream
from replyforge.streaming.ingest import jsonl_stream

ROW = "id string, prompt string"


def logged(folder):
    return Counter(name.split("-")[0] for name in os.listdir(folder))


def model(folder, switch, dies_at):
    def factory():
        import os
        import uuid

        def call(texts, _):
            if dies_at in texts and os.path.exists(switch):
                os._exit(1)
            for t in texts:
                open(f"{folder}/{t}-{uuid.uuid4().hex}", "w").close()
            return [{"error": "no"} if t.endswith("3") else t.upper() for t in texts], [None] * len(texts)

        return call

    return factory


def tagger(folder, switch, dies_at):
    def factory():
        import os
        import uuid

        def call(text):
            if text == dies_at and os.path.exists(switch):
                os._exit(1)
            open(f"{folder}/{text}-{uuid.uuid4().hex}", "w").close()
            return json.dumps({"Difficulty": int(text[1:]), "Rationale": "r"})

        return call

    return factory


@pytest.fixture
def place(tmp_path):
    for name in ("calls", "src"):
        (tmp_path / name).mkdir()
    (tmp_path / "switch").write_text("")
    for file in range(3):
        # Ten new ids a file, two of the file before, and one twice.
        ids = [*range(max(0, 10 * file - 2), 10 * file + 10), 10 * file + 5]
        lines = [json.dumps({"id": str(i), "prompt": f"p{i}"}) for i in ids]
        (tmp_path / "src" / f"{file}.jsonl").write_text("\n".join([*lines, "torn {"]) + "\n")
        os.utime(tmp_path / "src" / f"{file}.jsonl", (1000 + file, 1000 + file))
    return tmp_path


@pytest.mark.parametrize("kind", ["infer", "tag"])
def test_stream_stopped_midway(spark, place, kind):
    folder, switch, sink = str(place / "calls"), str(place / "switch"), str(place / "sink")
    if kind == "infer":
        call, added = partial(infer_batch, predictor=model(folder, switch, "p17"), batch_size=1), None
    else:
        call, added = partial(ask_for_json, predictor=tagger(folder, switch, "p17"), threads=1, tries=1), TAGGED
    options = {"added": added} if added else {}

    def run():
        rows = jsonl_stream(spark, str(place / "src"), ROW, files_per_trigger=1)
        call_stream(rows, call, sink, ["id"], **options).awaitTermination()

    with pytest.raises(Exception):  # noqa: B017
        run()
    first = logged(folder)
    # The first batch is done; of the second some calls were made.
    assert {f"p{i}" for i in range(10)} <= set(first) and "p17" not in first and not any(f"p{i}" in first for i in range(20, 30))
    os.remove(switch)
    run()
    run()
    assert logged(folder) == {f"p{i}": 1 for i in range(30)}
    got = answered(spark, sink, ROW, **options)
    if kind == "infer":
        assert got.columns == ["id", "prompt", "response", "error", "meta_response"]
        want = {(str(i), None if i % 10 == 3 else f"P{i}", "no" if i % 10 == 3 else None) for i in range(30)}
        assert {(r["id"], r["response"], r["error"]) for r in got.collect()} == want
    else:
        assert {(r["id"], r["status"], json.loads(r["data"])["Difficulty"]) for r in got.collect()} == {(str(i), "success", i) for i in range(30)}
    assert got.count() == 30


def test_stream_equals_batch_with_null_ids(spark, tmp_path):
    (tmp_path / "src").mkdir()
    lines = [{"id": "a", "prompt": "p"}, {"prompt": "q"}, {"prompt": "q"}, {"id": "a", "prompt": "p"}, {"id": "b"}]
    (tmp_path / "src" / "x.jsonl").write_text("\n".join(map(json.dumps, lines)))
    echo = lambda: lambda texts, _: ([f"{t}!" for t in texts], [None] * len(texts))
    call = partial(infer_batch, predictor=echo)
    sink = str(tmp_path / "sink")
    assert answered(spark, sink, ROW).collect() == []
    call_stream(jsonl_stream(spark, str(tmp_path / "src"), ROW), call, sink, ["id"]).awaitTermination()
    got = sorted(((r["id"], r["response"]) for r in answered(spark, sink, ROW).collect()), key=str)
    assert got == [("a", "p!"), ("b", "None!"), (None, "q!"), (None, "q!")]


def test_rows_without_any_call(spark, tmp_path):
    none = spark.createDataFrame([], ROW)
    out = call_once(none, partial(infer_batch, predictor=lambda: None), str(tmp_path / "run"), "response string, error string, meta_response string")
    assert out.collect() == [] and out.columns == ["id", "prompt", "response", "error", "meta_response"]
