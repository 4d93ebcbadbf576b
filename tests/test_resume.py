"""Runs that are cut off and go on: the work ledger and the log of best-of-N."""

import os
from collections import Counter
from functools import partial
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from replyforge.operators.calls import infer_batch
from replyforge.operators.fetching import fetch_plan
from replyforge.plans.acquire import acquire
from replyforge.plans.collect import best_of_n_loop
from replyforge.plans.feedback import feedback_rounds
from replyforge.plans.inference import run_inference
from replyforge.plans.ledger import Ledger


def logged(folder):
    """How often each prompt was asked."""
    return Counter(name.split("-")[0] for name in os.listdir(folder))


def model_that_dies(folder, dies_at, switch, accept=lambda turn: True):
    """Notes each prompt of a call in a file; while ``switch`` is there, the call with ``dies_at`` takes the worker along."""

    def factory():
        import os
        import uuid

        def call(texts, _):
            if dies_at in texts and os.path.exists(switch) and len([f for f in os.listdir(folder) if f.split("-")[0] == dies_at]) >= 2:
                os._exit(1)
            turns = []
            for t in texts:
                turns.append(len([f for f in os.listdir(folder) if f.split("-")[0] == t]))
                open(f"{folder}/{t}-{uuid.uuid4().hex}", "w").close()
            return [f"{t}#{n}" if accept(n) else {"error": "e"} for t, n in zip(texts, turns)], [None] * len(texts)

        return call

    return factory


@pytest.fixture
def calls(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    (tmp_path / "switch").write_text("")
    return folder


def samples(spark, n=24):
    return spark.range(n).selectExpr("cast(id as string) as id", "concat('p', id) as prompt", "repeat('x', 100) as kept")


def test_prompts_are_written_once_whatever_n_is(spark, tmp_path):
    echo = lambda: lambda texts, _: ([t + "!" for t in texts], [None] * len(texts))
    sizes = {}
    for n in (1, 8):
        run = tmp_path / f"run{n}"
        out = best_of_n_loop(samples(spark), echo, n, 3, batch_size=5, run_path=str(run))
        assert {(r["id"], len(r["response_n"])) for r in out.collect()} == {(str(i), n) for i in range(24)}
        holding = [f for f in glob(f"{run}/**/*.parquet", recursive=True) if "prompt" in pq.read_schema(f).names]
        assert all("/texts/" in f for f in holding)
        assert sum(pq.read_metadata(f).num_rows for f in holding) == 24
        sizes[n] = sum(os.path.getsize(f) for f in holding)
        answers = [pq.read_table(f, partitioning=None) for f in glob(f"{run}/log/**/*.parquet", recursive=True)]
        assert sum(a.num_rows for a in answers) == 24 * n
        assert all(a.column_names == ["_sample", "turn", "response", "error"] for a in answers)
    assert sizes[1] == sizes[8]


@pytest.mark.parametrize("every", [1, 3])
def test_loop_cut_off_inside_a_turn_repeats_no_call(spark, tmp_path, calls, every):
    """The worker dies in a later call of its task; the next run goes on behind the last answer of every sample."""
    switch = tmp_path / "switch"
    model = model_that_dies(str(calls), "p7", str(switch), accept=partial(lambda every, turn: turn % every == every - 1, every))
    run = lambda: best_of_n_loop(samples(spark), model, 4, -1, batch_size=3, run_path=str(tmp_path / "run"))
    with pytest.raises(Exception):  # noqa: B017
        run().collect()
    assert 0 < sum(logged(calls).values()) < 24 * 4 * every
    switch.unlink()
    got = {r["id"]: (r["response_n"], r["round"], r["status"]) for r in run().collect()}
    want = [t for t in range(4 * every) if t % every == every - 1]
    assert got == {str(i): ([f"p{i}#{t}" for t in want], 4 * (every - 1), "completed") for i in range(24)}
    assert logged(calls) == {f"p{i}": 4 * every for i in range(24)}
    run().collect()
    assert sum(logged(calls).values()) == 24 * 4 * every


def test_feedback_cut_off_inside_a_round_repeats_no_call(spark, tmp_path, calls):
    switch = tmp_path / "switch"
    model = model_that_dies(str(calls), "p1", str(switch))
    verifier = lambda: lambda codes, proofs: [(p.endswith("#2"), "no") for p in proofs]
    statements = samples(spark, 6).select("id", F.col("prompt").alias("lean_code"))
    run = lambda: feedback_rounds(statements, model, verifier, "{2}", max_rounds=2, n=3, run_path=str(tmp_path / "run"))
    with pytest.raises(Exception):  # noqa: B017
        run()
    switch.unlink()
    verdicts, summary = run()
    assert [(r["round"], r["success"], r["failed"]) for r in summary.orderBy("round").collect()] == [(1, 6, 12), (2, 0, 36)]
    # Three calls in the first round, three for each of the two failed attempts in the second.
    assert logged(calls) == {f"p{i}": 9 for i in range(6)}


def test_chunk_reads_the_files_of_its_partition(spark, tmp_path):
    ledger = Ledger(samples(spark, 200), str(tmp_path / "run"), chunks=5)
    own = {n: set(glob(f"{tmp_path}/run/work/_chunk={n}/*.parquet")) for n in ledger.chunks()}
    seen = []
    for number, files in own.items():
        read = ledger.chunk(number).select("id", F.col("_metadata.file_path").alias("file")).collect()
        assert {"/" + r["file"].removeprefix("file:").lstrip("/") for r in read} == files
        seen += [r["id"] for r in read]
    assert sorted(seen, key=int) == [str(i) for i in range(200)]
    # No other file is even opened: they may be unreadable.
    for file in set().union(*own.values()) - own[2]:
        with open(file, "w") as handle:
            handle.write("not a table")
    assert len(ledger.chunk(2).collect()) == len([1 for f in own[2] for _ in range(pq.read_metadata(f).num_rows)])


def test_rows_of_one_key_are_dealt_over_all_chunks(spark, tmp_path):
    rows = spark.range(1000).selectExpr("'same' as id", "'p' as prompt")
    ledger = Ledger(rows, str(tmp_path / "run"), chunks=4)
    assert all(200 <= ledger.chunk(c).count() <= 300 for c in ledger.chunks())


def test_chunks_run_side_by_side(spark, tmp_path):
    """Each waits for another one to be under way, too."""
    here = str(tmp_path / "here")
    os.mkdir(here)

    def meet():
        import os
        import time

        def call(texts, _):
            open(f"{here}/{os.getpid()}", "w").close()
            until = time.time() + 60
            while len(os.listdir(here)) < 2 and time.time() < until:
                time.sleep(0.05)
            return [str(len(os.listdir(here)) >= 2)] * len(texts), [None] * len(texts)

        return call

    ledger = Ledger(samples(spark, 2), str(tmp_path / "run"), chunks=2, parallel=2)
    out = ledger.run(partial(infer_batch, predictor=meet)).collect()
    assert [r["response"] for r in out] == ["True", "True"]


def test_attempt_without_a_commit_does_not_count(spark, tmp_path):
    ledger = Ledger(samples(spark, 8), str(tmp_path / "run"), chunks=2)
    samples(spark, 50).write.parquet(str(tmp_path / "run/results/000000-cut-off"))
    assert ledger.run(lambda rows: rows).count() == 8
    assert sorted(ledger.finished()) == ledger.chunks()


def test_inference_goes_on_after_a_broken_run(spark, tmp_path, calls):
    """Finished chunks are not called again: each prompt once, but for those of the chunks that were under way."""
    switch = tmp_path / "switch"
    (calls / "p7-a").write_text(""), (calls / "p7-b").write_text("")
    run = lambda: run_inference(samples(spark), model_that_dies(str(calls), "p7", str(switch)), "proof", run_path=str(tmp_path / "run"), chunks=6, parallel=2, batch_size=2)
    with pytest.raises(Exception):  # noqa: B017
        run()
    done = len(glob(f"{tmp_path}/run/commits/chunk=*/_SUCCESS"))
    switch.unlink()
    assert run().count() == 24
    assert done < 6
    made = logged(calls)
    made["p7"] -= 2
    assert set(made) == {f"p{i}" for i in range(24)}
    again = sum(made.values())
    assert run().count() == 24 and sum(logged(calls).values()) - 2 == again


def test_fetching_goes_on_after_a_broken_run(spark, tmp_path, calls):
    switch = tmp_path / "switch"

    def fetcher(folder=str(calls), switch=str(switch)):
        import os
        import uuid

        def call(url, target):
            number = url.rsplit("/", 1)[-1]
            if number == "11" and os.path.exists(switch):
                os._exit(1)
            open(f"{folder}/{number}-{uuid.uuid4().hex}", "w").close()
            return int(number)

        return call

    manifest = spark.range(30).selectExpr("'m' as manifest", "'o/r' as repo", "'c' as commit_id", "cast(id as string) as rel_path")
    assert fetch_plan(manifest, "/out").count() == 30
    run = lambda: acquire(manifest, "/out", fetcher, run_path=str(tmp_path / "run"), chunks=5, parallel=2, threads=2)
    with pytest.raises(Exception):  # noqa: B017
        run()
    done = len(glob(f"{tmp_path}/run/commits/chunk=*/_SUCCESS"))
    committed = [pq.read_table(f)["url"].to_pylist() for c in glob(f"{tmp_path}/run/commits/chunk=*/*.parquet") for f in glob(pq.read_table(c, partitioning=None)["folder"][0].as_py().removeprefix("file:") + "/*.parquet")]
    finished = {u.rsplit("/", 1)[-1] for part in committed for u in part}
    switch.unlink()
    outcomes, stats, _ = run()
    assert [(r["total_files"], r["failed"], r["total_size"]) for r in stats.collect()] == [(30, 0, sum(range(30)))]
    assert done < 5 and set(logged(calls)) == {str(i) for i in range(30)}
    assert all(logged(calls)[u] == 1 for u in finished)
