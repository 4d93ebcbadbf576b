"""Operators that call user code, live loops and resumable runs."""

import os
import time

import pytest

from replyforge.operators.bestofn import best_of_n
from replyforge.operators.calls import ask_for_json, fetch, infer_batch, verify
from replyforge.operators.multimodal import build_multimodal, image_prompt, read_images
from replyforge.plans.acquire import acquire_group
from replyforge.plans.collect import best_of_n_loop, collect_responses
from replyforge.plans.feedback import feedback_rounds
from replyforge.plans.inference import run_inference
from replyforge.plans.tagging import tag_statements


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def prompts(spark, n=20, parts=2):
    frame = spark.createDataFrame([(i, f"p{i}") for i in range(n)], "id int, prompt string")
    return frame.repartitionByRange(parts, "id")


def test_failed_batch_marks_its_rows_only(spark):
    def factory():
        def call(texts, histories):
            if "p3" in texts:
                raise RuntimeError("out of memory")
            return [t.upper() for t in texts], [None] * len(texts)

        return call

    out = infer_batch(prompts(spark, parts=1), factory, batch_size=5).collect()
    assert [r["id"] for r in out if r["error"]] == [0, 1, 2, 3, 4]
    assert all(r["error"] == "out of memory" and r["response"] is None for r in out[:5])
    assert out[7]["response"] == "P7" and out[7]["error"] is None


def test_wrong_number_of_responses_is_an_error(spark):
    out = infer_batch(prompts(spark), lambda: lambda texts, _: (texts[:1], [None]), batch_size=4).collect()
    assert all(r["response"] is None and "1 responses for" in r["error"] for r in out)


def test_history_and_other_columns_pass_through(spark):
    frame = spark.createDataFrame(
        [(2**60 + 1, "p", [("q", "a")], None), (None, "r", None, 1.5)],
        "big bigint, prompt string, history array<struct<prompt:string,response:string>>, x double",
    )
    def factory():
        return lambda texts, past: ([f"{t}{len(h)}" for t, h in zip(texts, past)], ["m", ""])

    out = rows(infer_batch(frame.coalesce(1), factory), "big", "response", "meta_response", "x")
    assert out == [(2**60 + 1, "p1", "m", None), (None, "r0", None, 1.5)]


def test_factory_runs_once_per_worker(spark, tmp_path):
    mark = str(tmp_path / "built")

    def factory():
        with open(mark, "a") as handle:
            handle.write(f"{os.getpid()}\n")
        return lambda texts, _: (texts, [None] * len(texts))

    infer_batch(prompts(spark, 40, 1), factory, batch_size=1).collect()
    assert len(open(mark).read().split()) == 1
    # More tasks and a second job over the same factory reuse what their workers built. Spark may replace workers.
    for _ in range(2):
        infer_batch(prompts(spark, 200, 50), factory, batch_size=1).collect()
    built = open(mark).read().split()
    assert len(built) == len(set(built))


def test_reply_is_asked_again(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        def call(prompt):
            path = os.path.join(folder, prompt)
            with open(path, "a") as handle:
                handle.write("x")
            tries = os.path.getsize(path)
            if prompt == "never":
                raise OSError("down")
            return '{"Difficulty": 1, "Rationale": ""}' if tries >= 3 else "hm"

        return call

    frame = spark.createDataFrame([("later",), ("never",), (None,)], "prompt string").coalesce(1)
    out = {r["prompt"]: r for r in ask_for_json(frame, factory, delay=0.0).collect()}
    assert out["later"]["status"] == "success" and out["later"]["response"].startswith("{")
    assert out["never"]["status"] == "failed" and out["never"]["error"] == "down" and out["never"]["response"] is None
    assert out[None]["status"] is None
    assert os.path.getsize(os.path.join(folder, "never")) == 3


def test_tagging_skips_finished_rows_before_the_call(spark, tmp_path):
    mark = str(tmp_path / "calls")

    def factory():
        def call(prompt):
            with open(mark, "a") as handle:
                handle.write("x")
            return '{"Difficulty": 2.5, "Rationale": "r"}'

        return call

    statements = spark.createDataFrame([(f"u{i}", " s " if i else " ") for i in range(6)], "uuid string, formal_statement string")
    earlier = spark.createDataFrame([("u1", True), ("u2", False), ("u3", None), (None, True)], "uuid string, success boolean")
    out = tag_statements(statements, factory, "rate {}", earlier, max_items=4)
    assert rows(out, "uuid", "success") == [("u0", False), ("u2", True), ("u3", True), ("u4", True)]
    # One action above, three statements that are not empty.
    assert os.path.getsize(mark) == 3


def test_verifier_must_answer_every_row(spark):
    frame = spark.createDataFrame([("c", "p")], "lean_code string, response string")
    assert rows(verify(frame, lambda: lambda c, p: [(True, None)]), "success", "error_messages") == [(True, None)]
    with pytest.raises(Exception, match="0 verdicts for 1 rows"):
        verify(frame, lambda: lambda c, p: []).collect()


def test_fetch_never_raises_and_keeps_its_time_limit(spark):
    def factory():
        def call(url, target):
            if url == "slow":
                time.sleep(3)
            if url == "bad":
                raise OSError("404")
            return 7

        return call

    plan = spark.createDataFrame([("ok", "a"), ("slow", "b"), ("bad", "c")], "url string, target string")
    out = {r["url"]: r for r in fetch(plan, factory, partitions=1, timeout=0.3).collect()}
    assert (out["ok"]["success"], out["ok"]["size"]) == (True, 7)
    assert (out["bad"]["success"], out["bad"]["error"]) == (False, "404")
    assert not out["slow"]["success"] and "0.3" in out["slow"]["error"]


def test_acquire_group_reads_only_open_manifests(spark, tmp_path):
    import pandas as pd

    folder = tmp_path / "manifests"
    folder.mkdir()
    for name in ("a", "b", "c"):
        pd.DataFrame({"repo": ["o/r", "o/s"], "commit_id": [name, name], "rel_path": ["x/y.lean", "x/y.lean"]}).to_parquet(folder / f"{name}.parquet")
    pd.DataFrame({"repo": pd.Series([], dtype=str), "commit_id": pd.Series([], dtype=str), "rel_path": pd.Series([], dtype=str)}).to_parquet(folder / "empty.parquet")
    ledger = spark.createDataFrame([("b.parquet",)], "parquet_filename string")

    def factory():
        def call(url, target):
            if "/c/" in url:
                raise OSError("gone")
            return 1

        return call

    outcomes, stats, done = acquire_group(spark, str(folder), 0, "/out", factory, ledger)
    assert rows(stats, "manifest", "total_files", "failed") == [("a.parquet", 2, 0), ("c.parquet", 2, 2), ("empty.parquet", 0, 0)]
    assert rows(done, "parquet_filename") == [("a.parquet",), ("empty.parquet",)]
    # Equal paths of two repositories have targets of their own.
    assert outcomes.select("target").distinct().count() == 4


def scripted_model(folder, script):
    """The i-th call for a prompt gives the i-th entry of its script; True means an error."""

    def factory():
        def call(texts, _):
            answers = []
            for text in texts:
                path = os.path.join(folder, text)
                with open(path, "a") as handle:
                    handle.write("x")
                turn = os.path.getsize(path) - 1
                answers.append({"error": "e"} if script[text][turn] else f"{text}#{turn}")
            return answers, [None] * len(texts)

        return call

    return factory


@pytest.mark.parametrize("n,max_rounds", [(2, 2), (3, -1)])
def test_live_loop_equals_recorded_attempts(spark, tmp_path, n, max_rounds):
    import random

    rng = random.Random(n)
    script = {f"s{i}": [rng.random() < 0.5 for _ in range(15)] + [False] * 10 for i in range(12)}
    frame = spark.createDataFrame([(s, s) for s in script], "id string, prompt string")
    run = str(tmp_path / "run")
    calls = tmp_path / "calls"
    calls.mkdir()
    live = best_of_n_loop(frame, scripted_model(str(calls), script), n, max_rounds, run_path=run)
    got = rows(live, "id", "status", "round", "response_n")
    attempts = spark.createDataFrame(
        [(s, i, err, f"{s}#{i}") for s, errs in script.items() for i, err in enumerate(errs)],
        "id string, attempt int, err boolean, response string",
    )
    assert got == rows(best_of_n(attempts, n, max_rounds, response="response"), "id", "status", "round", "response_n")
    made = {p.name: p.stat().st_size for p in calls.iterdir()}
    # A second run over the same folder finds all its rounds and calls nothing.
    again = best_of_n_loop(frame, scripted_model(str(calls), script), n, max_rounds, run_path=run)
    assert rows(again, "id", "status", "round", "response_n") == got
    assert {p.name: p.stat().st_size for p in calls.iterdir()} == made


def test_loop_keeps_responses_of_a_resumed_sample(spark):
    frame = spark.createDataFrame(
        [("a", "p", ["old"], "resume", 9), ("b", "q", ["x", "y"], "processing", 1), ("c", "r", None, None, None), ("d", "s", ["z"], "processing", 2)],
        "id string, prompt string, response_n array<string>, status string, round int",
    )
    echo = lambda: lambda texts, _: ([t + "!" for t in texts], [None] * len(texts))
    out = best_of_n_loop(frame, echo, 2, 2)
    assert rows(out, "id", "response_n", "status", "round") == [
        ("a", ["old", "p!"], "completed", 0),
        ("b", ["x", "y"], "completed", 1),
        ("c", ["r!", "r!"], "completed", 0),
        ("d", ["z"], "max_rounds", 2),
    ]


def test_loop_keeps_rows_with_equal_or_missing_ids_apart(spark):
    frame = spark.createDataFrame([("a", "p"), ("a", "q"), (None, "r"), (None, "r")], "id string, prompt string")
    echo = lambda: lambda texts, _: ([t + "!" for t in texts], [None] * len(texts))
    out = best_of_n_loop(frame, echo, 2, 2)
    assert rows(out, "id", "response_n") == [("a", ["p!", "p!"]), ("a", ["q!", "q!"]), (None, ["r!", "r!"]), (None, ["r!", "r!"])]


def test_modes_without_state_call_once(spark):
    echo = lambda: lambda texts, _: (texts, [None] * len(texts))
    assert "response_n" not in collect_responses(prompts(spark), echo, "proof").columns
    assert "response_n" in collect_responses(prompts(spark), echo, "proof-bon").columns


def test_run_inference_without_state(spark):
    echo = lambda: lambda texts, _: ([t + "!" for t in texts], [None] * len(texts))
    saved = spark.createDataFrame([("1", 0, "had", None, None, "p"), ("2", 0, "", None, None, "p")], "id string, seq int, response string, error string, status string, prompt string")
    inputs = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", ""), ("4", "d")], "id string, prompt string")
    out = run_inference(inputs, echo, "proof", [saved], infer_limit=1)
    assert rows(out, "id", "response") == [("1", "had"), ("2", "b!"), ("3", "")]


def test_feedback_rounds(spark):
    """A prompt that shows the first proof gets a better one."""

    def model():
        return lambda texts, _: (["good" if "|weak|" in t else {"error": "x"} if "mute" in t else "weak" for t in texts], [None] * len(texts))

    def verifier():
        return lambda codes, proofs: [(c == "easy" or p == "good", None if p == "good" else "why") for c, p in zip(codes, proofs)]

    statements = spark.createDataFrame([("1", "easy"), ("2", "hard"), ("3", "mute")], "id string, lean_code string")
    verdicts, summary = feedback_rounds(statements, model, verifier, "|{}|{}|{}", max_rounds=3, max_errors=1)
    assert rows(verdicts, "round", "id", "success") == [
        (1, "1_0", True), (1, "2_0", False), (1, "3_0", False), (2, "2_0", True), (2, "3_0", False), (3, "3_0", False),
    ]
    assert rows(summary, "round", "success", "total") == [(1, 1, 3), (2, 1, 2), (3, 0, 1)]


def test_feedback_with_several_attempts_keeps_every_failure(spark):
    model = lambda: lambda texts, _: (["p"] * len(texts), [None] * len(texts))
    verifier = lambda: lambda codes, proofs: [(False, "no")] * len(codes)
    statements = spark.createDataFrame([("1", "c")], "id string, lean_code string")
    verdicts, _ = feedback_rounds(statements, model, verifier, "{}{}{}", max_rounds=2, n=2)
    assert rows(verdicts, "round", "id") == [(1, "1_0"), (1, "1_1"), (2, "1_0"), (2, "1_0"), (2, "1_1"), (2, "1_1")]
    assert verdicts.where("round = 2").select("sample").distinct().count() == 4


def test_feedback_stops_when_all_is_solved(spark):
    model = lambda: lambda texts, _: (["p"] * len(texts), [None] * len(texts))
    verifier = lambda: lambda codes, proofs: [(True, None)] * len(codes)
    statements = spark.createDataFrame([("1", "c")], "id string, lean_code string")
    _, summary = feedback_rounds(statements, model, verifier, "{}{}{}", max_rounds=5)
    assert rows(summary, "round", "accuracy") == [(1, 100.0)]


def test_feedback_goes_on_where_it_stopped(spark, tmp_path):
    mark = str(tmp_path / "verified")

    def verifier():
        def call(codes, proofs):
            with open(mark, "a") as handle:
                handle.write("x" * len(codes))
            return [(False, "no")] * len(codes)

        return call

    model = lambda: lambda texts, _: (["p"] * len(texts), [None] * len(texts))
    statements = spark.createDataFrame([("1", "c"), ("2", "d")], "id string, lean_code string")
    run = str(tmp_path / "run")
    feedback_rounds(statements, model, verifier, "{}{}{}", max_rounds=1, run_path=run)
    assert os.path.getsize(mark) == 2
    _, summary = feedback_rounds(statements, model, verifier, "{}{}{}", max_rounds=2, run_path=run)
    assert os.path.getsize(mark) == 4
    assert rows(summary, "round", "failed") == [(1, 2), (2, 2)]


def test_images_from_files(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"\xff\xd8" + bytes(range(256)) * 2)
    parts = ["look", f"<|image|>{tmp_path}/a.jpg", "<image> " + f"{tmp_path}/a.jpg", "<image>no blank"]
    frame = spark.createDataFrame([(1, parts), (2, []), (1, ["again"])], "id int, parts array<string>")
    import base64

    url = "data:image/jpeg;base64," + base64.b64encode((tmp_path / "a.jpg").read_bytes()).decode()
    out = {(r["id"], len(r["parts"])): r["items"] for r in build_multimodal(frame, read_images(spark, str(tmp_path))).collect()}
    assert [(i["type"], i["text"], i["image"], i["detail"]) for i in out[1, 4]] == [
        ("text", "look", None, None), ("image_url", None, url, "low"), ("image_url", None, url, "low"), ("text", "<image>no blank", None, None),
    ]
    assert out[2, 0] == [] and out[1, 1][0]["text"] == "again"
    missing = spark.createDataFrame([(1, ["<|image|>/nowhere.jpg"])], "id int, parts array<string>")
    with pytest.raises(Exception, match="no image /nowhere.jpg"):
        build_multimodal(missing, read_images(spark, str(tmp_path))).collect()


def test_no_exchange_holds_an_image(spark, tmp_path):
    """Equal images are kept once; what goes through exchanges are texts and addresses; small batches of shown rows."""
    from pyspark.sql import functions as F

    from replyforge.operators import multimodal as M

    for name in "abc":
        (tmp_path / f"{name}.jpg").write_bytes((b"same" if name < "c" else b"other") * 1000)
    frame = spark.range(30).select("id", F.array(F.lit("see"), F.concat(F.lit(f"<|image|>{tmp_path}/"), F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")), F.lit(".jpg"))).alias("parts"))
    store = str(tmp_path / "store")
    built = M.build_multimodal(frame, M.read_images(spark, str(tmp_path / "*.jpg")), store=store)
    assert len([f for _, _, files in os.walk(store) for f in files if not f.startswith(".")]) == 2
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    # The step that makes data URLs stands above everything, and the image contents are nowhere below it.
    assert plan.lstrip().startswith("MapInArrow") and plan.count("MapInArrow") == 1
    assert "content" not in plan and "base64" not in plan
    rows_ = built.collect()
    assert len(rows_) == 30 and {len(r["items"][1]["image"]) for r in rows_} == {len("data:image/jpeg;base64,") + 4 * -(-n // 3) for n in (4000, 5000)}


def test_image_positions(spark):
    frame = spark.createDataFrame([("see <image> it", ["a", "b"])], "p string, i array<string>")
    def kinds(position):
        return [(x["type"], x["text"] or x["image"]) for x in frame.select(image_prompt("p", "i", position)).first()[0]]

    shown = [("image", "file://a"), ("image", "file://b")]
    assert kinds("before") == [*shown, ("text", "see it")]
    assert kinds("after") == [("text", "see it"), *shown]
    assert kinds("none") == [("text", "see it")]
    assert frame.select(image_prompt("p")).first()[0][0]["text"] == "see <image> it"


def test_batches_are_filled_however_wide_the_rows(spark):
    """Long prompts arrive in small Arrow batches; the model still gets full calls, and a failed one marks just those."""

    def model():
        def call(prompts, histories):
            if len(prompts) != 40:
                raise ValueError(f"odd call of {len(prompts)}")
            return [str(len(prompts))] * len(prompts), [None] * len(prompts)

        return call

    frame = spark.range(0, 130, 1, 1).selectExpr("id", "repeat('x', 300000) as prompt")
    got = infer_batch(frame, model, batch_size=40).select("response", "error").groupBy("response", "error").count().collect()
    assert sorted((r["response"], r["error"], r["count"]) for r in got if r["response"]) == [("40", None, 120)]
    assert [(r["error"], r["count"]) for r in got if not r["response"]] == [("odd call of 10", 10)]


def test_each_fetch_has_its_own_deadline(spark):
    def fetcher():
        import time

        def call(url, target):
            time.sleep(float(url))
            return 1

        return call

    frame = spark.createDataFrame([(str(s), f"t{s}") for s in (0.1, 1.9, 2.8, 3.7)], "url string, target string").coalesce(1)
    got = fetch(frame, fetcher, partitions=1, timeout=1.2, threads=4).collect()
    assert sorted((r["url"], r["success"]) for r in got) == [("0.1", True), ("1.9", False), ("2.8", False), ("3.7", False)]


def test_tagging_goes_on_after_a_broken_run(spark, tmp_path):
    """A model that dies midway; over both runs each statement is asked for once, but for the piece that broke."""
    log, broken = tmp_path / "calls", tmp_path / "broken"
    log.mkdir()
    broken.write_text("")

    def model(calls=str(log), switch=str(broken)):
        import os
        import uuid

        def call(prompt):
            number = int(prompt.split()[-1])
            if number == 17 and os.path.exists(switch):
                os._exit(1)  # the worker is lost, not the call
            open(f"{calls}/{number}-{uuid.uuid4().hex}", "w").close()
            return '{"Difficulty": 3, "Rationale": "r"}'

        return call

    statements = spark.range(40).selectExpr("cast(id as string) as uuid", "concat('number ', id) as formal_statement")
    run = lambda: tag_statements(statements, model, "rate {}", run_path=str(tmp_path / "run"), chunks=5).collect()
    with pytest.raises(Exception):  # noqa: B017
        run()
    done = len(list((tmp_path / "run").glob("commits/chunk=*/_SUCCESS")))
    broken.unlink()
    assert len(run()) == 40
    calls = [int(p.name.split("-")[0]) for p in log.iterdir()]
    assert set(calls) == set(range(40)) and done < 5
    before = len(calls)
    run()
    assert len(list(log.iterdir())) == before
