"""Time limits and processes of their own for user code."""

import os
import time

import pytest

from replyforge.operators.calls import _build_once, fetch, infer_batch, verify
from replyforge.operators.isolation import CallLost, CallTimeout, Isolated
from replyforge.plans.collect import best_of_n_loop


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def moody():
    """Sleeps, dies or raises by what it is asked."""
    import os
    import time

    def call(texts, _=None):
        if any("sleep" in t for t in texts):
            time.sleep(60)
        if any("die" in t for t in texts):
            os._exit(3)
        if any("raise" in t for t in texts):
            raise ValueError("no " + texts[0])
        return [f"{t} by {os.getpid()}" for t in texts], [None] * len(texts)

    return call


def test_calls_behind_a_pipe():
    call = Isolated(moody, 1.0)
    first = call(["a"])[0][0]
    assert call(["a"])[0][0] == first and str(os.getpid()) not in first
    with pytest.raises(RuntimeError, match="no raise"):
        call(["raise"])
    assert call(["a"])[0][0] == first  # an exception is an answer
    start = time.monotonic()
    with pytest.raises(CallTimeout, match="within 1 s"):
        call(["sleep"])
    assert time.monotonic() - start < 5
    second = call(["a"])[0][0]
    assert second != first
    with pytest.raises(CallLost, match="code 3"):
        call(["die"])
    third = call(["a"])[0][0]
    assert third not in (first, second)
    process = call.process
    call.close()
    assert not process.is_alive()
    unsendable = Isolated(lambda: lambda: (lambda: None), 5.0)
    with pytest.raises(RuntimeError, match="not sent"):
        unsendable()
    unsendable.close()


def test_batches_that_hang_or_die_mark_their_rows(spark):
    texts = ["a", "b", "sleep", "c", "d", "die", "e", "raise", "f", "g"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, prompt string").coalesce(1)
    out = infer_batch(frame, moody, batch_size=2, timeout=2.0).collect()
    assert [r["id"] for r in out if r["error"]] == [2, 3, 4, 5, 6, 7]
    assert all("within 2 s" in r["error"] for r in out[2:4]) and all("code 3" in r["error"] for r in out[4:6])
    assert [r["error"] for r in out[6:8]] == ["no e", "no e"]
    assert [r["response"].split()[0] for r in out if r["response"]] == ["a", "b", "f", "g"]


def test_loop_over_a_model_that_hangs(spark):
    frame = spark.createDataFrame([("a",), ("sleep",), ("b",)], "prompt string").coalesce(1)
    out = best_of_n_loop(frame, moody, 2, 1, batch_size=1, tasks=1, timeout=1.5)
    assert rows(out, "prompt", "status", "round") == [("a", "completed", 0), ("b", "completed", 0), ("sleep", "max_rounds", 1)]


def test_verifier_that_hangs_or_dies(spark):
    """Only the proofs it does not survive have failed for that; the others keep their verdicts."""

    def checker():
        inner = moody()
        return lambda codes, proofs: [(p == "good", None if p == "good" else "bad") for p in proofs if inner([p])]

    proofs = ["good", "bad", "sleep", "good", "die", "good", "bad"]
    frame = spark.createDataFrame([(i, "c", p) for i, p in enumerate(proofs)], "id int, lean_code string, response string").coalesce(1)
    out = rows(verify(frame, checker, timeout=1.5), "id", "success", "error_messages")
    assert [(i, s) for i, s, _ in out] == [(i, p == "good") for i, p in enumerate(proofs)]
    assert "within 1.5 s" in out[2][2] and "code 3" in out[4][2] and out[1][2] == "bad"
    with pytest.raises(Exception, match="0 verdicts for 1 rows"):
        verify(frame.limit(1), lambda: lambda c, p: [], timeout=5.0).collect()


def test_as_many_models_are_kept_as_asked_for(spark, tmp_path):
    """Six models in turn: each is built once per process when six are kept."""
    frame = spark.createDataFrame([("p",)], "prompt string").coalesce(1)
    factories = []
    for number in range(6):

        def factory(mark=str(tmp_path / str(number))):
            with open(mark, "a") as handle:
                handle.write(f"{os.getpid()}\n")
            return lambda texts, _: (texts, [None] * len(texts))

        factories.append(factory)
    for _ in range(2):
        for factory in factories:
            infer_batch(frame, factory, kept=6).collect()
    built = [open(tmp_path / str(n)).read().split() for n in range(6)]
    assert all(len(pids) == len(set(pids)) for pids in built)


def test_the_last_models_used_are_kept():
    made = []
    use = lambda name, kept: _build_once(name, lambda: made.append(name) or name, kept)
    for name in "abcabc":
        assert use(f"kept-{name}", 3) == f"kept-{name}"
    assert made == ["kept-a", "kept-b", "kept-c"]
    use("kept-a", 3), use("kept-d", 3), use("kept-a", 3), use("kept-b", 3)
    assert made[3:] == ["kept-d", "kept-b"]


def test_tasks_follow_the_plan(spark):
    plan = spark.range(1000).selectExpr("concat('u', id) as url", "concat('t', id) as target")
    fetched = fetch(plan, lambda: lambda url, target: 1, rows_per_task=50)
    assert fetched.selectExpr("spark_partition_id() as p").distinct().count() == 20
    assert fetched.where("success").count() == 1000
