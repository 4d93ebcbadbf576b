"""Operators against brute force on small frames, with the paths large groups take forced by low limits."""

import random

import pytest
from pyspark.sql import functions as F

from replyforge.functions.flags import unsolved
from replyforge.operators import attempts as A
from replyforge.operators import checkpoints as C
from replyforge.operators import classify as K
from replyforge.operators import fetching as X
from replyforge.operators import profile, tagging
from replyforge.operators.bestofn import accepted_attempts, best_of_n
from replyforge.operators.skew import cut_ranges, first_rows, hot_keys, with_running


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def skewed(spark, n=3000, seed=5):
    """One key owns a third of the rows, one null group another sixth."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 6 == 1 else f"k{rng.randrange(300)}"
        data.append((key, rng.randrange(50), i, rng.random() < 0.02))
    return data, spark.createDataFrame(data, "query_id string, response_idx bigint, seq bigint, success boolean")


@pytest.mark.parametrize("max_group", [100, 10**6])
def test_with_running_is_exact_on_hot_groups(spark, max_group):
    data, frame = skewed(spark)
    out = with_running(frame, ["query_id"], ["response_idx", "seq"], {"total": "seq"}, "rank", max_group=max_group)
    expected, seen = [], {}
    for key, idx, seq, _ in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        count, total = seen.get(key, (0, 0))
        seen[key] = (count + 1, total + seq)
        expected.append((key, seq, *seen[key]))
    assert rows(out, "query_id", "seq", "rank", "total") == sorted(expected, key=str)


def test_with_running_over_the_whole_table(spark):
    _, frame = skewed(spark)
    out = with_running(frame, [], ["seq"], {"total": "seq"}, "n")
    assert rows(out, "seq", "n", "total") == sorted([(i, i + 1, i * (i + 1) // 2) for i in range(3000)], key=str)
    assert with_running(frame.limit(0), [], ["seq"], {"total": "seq"}, "n").collect() == []


def test_rows_of_equal_order_are_dealt_over_ranges(spark):
    """One group whose rows are all alike in the order: numbered by several tasks, each number once."""
    frame = spark.range(20_000).selectExpr("'hot' as k", "7 as at", "id as v").repartition(4)
    cut = cut_ranges(frame.withColumn("_group", F.struct("k")), ["at"], 10)
    sizes = [r["count"] for r in cut.groupBy("_part").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 4 * 20_000 / 10
    out = with_running(frame, ["k"], ["at"], {"total": F.lit(2)}, "n", max_group=1000)
    numbers = out.agg(F.count_distinct("n"), F.min("n"), F.max("n"), F.count_if(F.col("total") != 2 * F.col("n"))).first()
    assert tuple(numbers) == (20_000, 1, 20_000, 0)
    whole = with_running(frame, [], ["at"], row_number="n").agg(F.count_distinct("n"), F.max("n")).first()
    assert tuple(whole) == (20_000, 20_000)


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_pass_at_k_equals_brute_force(spark, parts):
    data, frame = skewed(spark)
    groups = {}
    for key, idx, seq, ok in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(key, []).append(ok)
    expected = [(k, len(groups), sum(any(g[:k]) for g in groups.values())) for k in A.K_VALUES]
    rates = A.pass_at_k(frame.repartition(parts))
    assert rows(rates, "k", "total", "successful") == sorted(expected, key=str)
    found = {r["k"]: r["pass_rate"] for r in rates.collect()}
    assert [found[k] for k in A.K_VALUES] == sorted(found.values())
    many = A.pass_at_k(frame, ks=(1500,)).first()
    assert many["successful"] == A.overall_success(frame).first()["solved"]


def test_pass_at_k_of_nothing(spark):
    empty = spark.createDataFrame([], "query_id string, response_idx bigint, seq bigint, success boolean")
    assert {r["pass_rate"] for r in A.pass_at_k(empty).collect()} == {0.0}
    assert A.overall_success(empty).first()["success_rate"] is None
    report = A.pass_at_k_report(empty).first()
    assert report["summary"]["average_improvement"] == 0.0


def test_pass_at_k_cuts_groups_before_the_shuffle(spark, capsys):
    _, frame = skewed(spark)
    A.pass_at_k(frame).explain()
    plan = capsys.readouterr().out
    partial = [i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    shuffle = [i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line]
    assert partial and partial[0] > shuffle[-1]


def test_gain_needs_both_ends(spark):
    _, frame = skewed(spark)
    assert rows(A.pass_at_k_gain(A.pass_at_k(frame, ks=(1, 2, 8))), "transition") == [("1→2",)]
    assert A.average_gain(A.pass_at_k_gain(A.pass_at_k(frame, ks=(1,)))).first()[0] == 0.0


def test_hot_keys_are_found(spark):
    _, frame = skewed(spark)
    assert rows(hot_keys(frame, ["query_id"], 400), "query_id") == [("hot",), (None,)]
    assert hot_keys(frame, ["query_id"], 5000) is None


def test_first_rows(spark):
    data, frame = skewed(spark)
    out = first_rows(frame, ["query_id"], ["response_idx", "seq"], 3)
    assert out.groupBy("query_id").count().agg(F.max("count")).first()[0] == 3


def simulate(attempts, n, max_rounds, kept=0):
    """The sample's life, one attempt after the other."""
    ok, err, taken = kept, 0, []
    status = "processing"
    for number, failed in attempts:
        if ok >= n:
            status = "completed"
            break
        if max_rounds != -1 and err >= max_rounds:
            status = "max_rounds"
            break
        if failed:
            err += 1
            continue
        ok += 1
        taken.append(number)
        if ok >= n:
            status = "completed"
            break
    return taken, err, status


@pytest.mark.parametrize("n,max_rounds", [(1, 30), (4, 2), (8, 3), (3, 0), (5, -1), (1, 1)])
def test_best_of_n_equals_simulation(spark, n, max_rounds):
    rng = random.Random(n * 100 + max_rounds)
    data = [(f"s{s}", a, rng.random() < rng.choice([0.1, 0.9]), f"r{a}") for s in range(120) for a in range(rng.randrange(1, 40))]
    frame = spark.createDataFrame(data, "id string, attempt int, err boolean, response string").repartition(6)
    by_id = {}
    for sample, number, failed, _ in data:
        by_id.setdefault(sample, []).append((number, failed))
    expected = []
    for sample, attempts in by_id.items():
        taken, err, status = simulate(attempts, n, max_rounds)
        expected.append((sample, len(taken), err, status, [f"r{t}" for t in taken]))
    got = best_of_n(frame, n, max_rounds, response="response")
    assert rows(got, "id", "accepted", "round", "status", "response_n") == sorted(expected, key=str)
    taken = accepted_attempts(frame, n, max_rounds)
    assert taken.count() == sum(e[1] for e in expected)


def test_best_of_n_goes_on_from_kept_responses(spark):
    data = [("a", 1, False, 2), ("a", 2, False, 2), ("b", 1, True, 3), ("b", 2, False, 3), ("c", 1, False, 0)]
    frame = spark.createDataFrame(data, "id string, attempt int, err boolean, have int")
    got = best_of_n(frame, 3, 5, start_ok="have")
    assert rows(got, "id", "accepted", "status") == [("a", 3, "completed"), ("b", 3, "completed"), ("c", 1, "processing")]
    endless = best_of_n(frame.unionByName(spark.createDataFrame([("d", 1, True, 1)], frame.schema)), 3, -1, start_ok="have")
    assert rows(endless, "id", "accepted", "round", "status") == [
        ("a", 3, 0, "completed"), ("b", 3, 0, "completed"), ("c", 1, 0, "processing"), ("d", 1, 1, "processing"),
    ]


def test_still_open_and_rounds(spark):
    data = [("a", 1, False), ("a", 2, True), ("a", 3, True), ("b", 1, None), ("b", 2, False), ("c", 1, True)]
    frame = spark.createDataFrame(data, "id string, round int, success boolean")
    open_rows = A.still_open(frame)
    assert rows(open_rows, "id", "round") == [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("c", 1)]
    summary = rows(A.round_summary(open_rows), "round", "success", "failed", "total", "accuracy")
    assert summary == [(1, 1, 2, 3, 1 / 3 * 100), (2, 1, 1, 2, 50.0)]
    assert unsolved(frame).count() == 3


def test_avg_responses(spark):
    frame = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "response_n array<string>")
    assert tuple(A.avg_responses(frame).first()) == (2, 2, 1.0)
    assert A.avg_responses(frame.where("response_n is null")).first()["average"] is None


def test_explode_attempts_keeps_order(spark):
    frame = spark.createDataFrame([("7", ["x", "y"]), ("8", [])], "id string, response_n array<string>")
    assert rows(A.explode_attempts(frame), "id", "response") == [("7_0", "x"), ("7_1", "y")]


RECORD = "id string, seq int, response string, error string, status string"


def test_merge_checkpoints_precedence(spark):
    low = [("a", 1, "r1", None, "completed"), ("a", 2, "r2", None, "completed"), ("b", 1, "r3", None, "completed"), ("c", 9, "r4", None, "processing")]
    high = [("a", 0, "r5", None, "processing"), ("b", 0, "r6", None, None), ("c", 0, "r7", None, "resume"), ("d", 0, "", None, "completed"), ("e", 0, "r8", "boom", None), ("f", 0, "r", None, "odd")]
    merged = C.merge_checkpoints([spark.createDataFrame(low, RECORD), spark.createDataFrame(high, RECORD)])
    assert rows(merged, "id", "response", "bucket") == [("a", "r2", "completed"), ("b", "r6", "completed"), ("c", "r7", "processing")]


def test_reused_rows_are_the_saved_record(spark):
    inputs = spark.createDataFrame([("a", "p", "x"), ("b", "q", "y")], "id string, prompt string, extra string")
    saved = C.merge_checkpoints([spark.createDataFrame([("a", 1, "r", None, "completed")], RECORD)])
    out = {r["id"]: r for r in C.reuse_completed(inputs, saved).collect()}
    assert out["a"]["response"] == "r" and out["a"]["extra"] == "x" and out["a"]["reused"]
    assert out["b"]["response"] is None and out["b"]["extra"] == "y" and not out["b"]["reused"]


def test_limits(spark):
    frame = spark.range(10)
    assert C.limit_inputs(frame, None, ["id"]).count() == 10
    assert C.limit_inputs(frame, 0, ["id"]).count() == 0
    assert C.limit_inputs(frame, 0, ["id"], zero_means_all=True).count() == 10
    assert rows(C.limit_inputs(frame, 2, ["id"]), "id") == [(0,), (1,)]
    assert rows(C.limit_inputs(frame, 3, ["id"]), "id") == [(0,), (1,), (2,)]
    with pytest.raises(ValueError):
        C.shard(frame, 3, 3, "id")


def test_last_wins_on_a_hot_id(spark):
    data = [("hot", i, f"v{i}") for i in range(500)] + [("x", 1, None), (None, 3, "n"), (None, 4, "m")]
    frame = spark.createDataFrame(data, "id string, seq int, v string").repartition(9)
    assert rows(C.last_wins(frame, ["id"], ["seq"]), "id", "v") == [("hot", "v499"), ("x", None), (None, "m")]


def test_merge_results_rules(spark):
    schema = "natural_language_statement string, seq int, difficulty double, note string"
    original = spark.createDataFrame([(" s ", 1, 1.0, "old"), ("s", 2, 2.0, "new"), ("t", 1, None, "t"), ("  ", 1, 9.0, "gone"), (None, 1, 9.0, "gone")], schema)
    processed = spark.createDataFrame([("s\n", 1, 5.0, "x"), ("s", 2, None, "y"), ("u", 1, 7.0, "z")], schema)
    merged = tagging.merge_results(original, processed, ["difficulty"])
    assert rows(merged, "natural_language_statement", "difficulty", "note") == [("s", None, "new"), ("t", None, "t")]


def test_difficulty_buckets_cut_toward_zero(spark):
    frame = spark.createDataFrame([(-0.5,), (0.0,), (9.9,), (10.0,), (None,)], "difficulty double")
    assert rows(tagging.difficulty_distribution(frame), "bucket", "items") == [("0-1", 2), ("10-11", 1), ("9-10", 1)]
    stats = tagging.difficulty_stats(frame.withColumn("difficulty_rationale", F.lit("r"))).first()
    assert (stats["complete"], stats["incomplete"], stats["completion_rate"]) == (3, 2, 0.6)
    nothing = tagging.difficulty_stats(frame.where("false").withColumn("difficulty_rationale", F.lit("r"))).first()
    assert (nothing["total"], nothing["completion_rate"], nothing["avg_difficulty"]) == (0, 0.0, 0.0)


def test_tag_rows_shape(spark):
    data = [
        ("1", " ", "success", '{"Difficulty": 3}', "r", None),
        ("2", "s", "success", '{"Difficulty": 3}', "r", None),
        ("3", "s", "failed", None, None, "boom"),
        ("4", None, None, None, None, None),
        ("5", "s", "success", "{}", "r", None),
    ]
    frame = spark.createDataFrame(data, "uuid string, formal_statement string, status string, data string, response string, error string")
    out = rows(tagging.tag_rows(tagging.prepare_statements(frame)), "uuid", "difficulty_score", "success", "error", "model_output")
    assert out == [
        ("1", None, False, "Empty formal statement", None),
        ("2", 3.0, True, None, "r"),
        ("3", None, False, "boom", None),
        ("4", None, False, "Empty formal statement", None),
        ("5", None, False, "Prediction failed", "r"),
    ]


def test_classifier_against_plain_python(spark):
    import math

    model = {("__label__0", "a"): 0.2, ("__label__1", "a"): 1.0, ("__label__0", "b"): 2.0, ("__label__1", "b"): -1.0}
    texts = {1: "a a\nb", 2: "b x", 3: "x y", 4: "", 5: "a\ta"}
    docs = spark.createDataFrame(list(texts.items()) + [(6, None)], "doc_id int, text string")
    table = spark.createDataFrame([(*k, v) for k, v in model.items()], "label string, token string, weight double")
    got = {r["doc_id"]: (r["label"], r["confidence"]) for r in K.classify_text(docs, table, ["doc_id"]).collect()}
    assert set(got) == {1, 2, 5}
    for doc, text in texts.items():
        known = [w for w in text.split() if w in "ab"]
        if known:
            z = [sum(model[lab, w] for w in known) / len(known) for lab in ("__label__0", "__label__1")]
            p = [math.exp(v) / sum(map(math.exp, z)) for v in z]
            assert got[doc][0] == p.index(max(p)) and abs(got[doc][1] - max(p)) < 1e-12


def test_classifier_with_many_labels_and_absent_pairs(spark):
    table = spark.createDataFrame([("1", "a", 2.0), ("2", "b", 3.0), ("x", "a", 5.0)], "label string, token string, weight double")
    docs = spark.createDataFrame([(1, "b b a"), (2, "a")], "doc_id int, text string")
    # Document 2 has its best label in text that is no number and is left out.
    assert rows(K.classify_text(docs, table, ["doc_id"]), "doc_id", "label") == [(1, 2)]


def test_retention_of_nothing(spark):
    lines = spark.createDataFrame([], "source_file string, retained boolean")
    summary = K.retention_summary(K.retention_by_file(lines)).first()
    assert (summary["total_files"], summary["overall_retention_rate"]) == (0, 0.0)


def test_cumulative_retention_in_ranges(spark):
    files = spark.createDataFrame([(f"f{i:03d}", 10, i % 4) for i in range(200)], "source_file string, total bigint, retained bigint")
    small = rows(K.cumulative_retention(files), "source_file", "processed", "kept", "cumulative_rate")
    assert small == rows(K.cumulative_retention(files.repartition(7)), "source_file", "processed", "kept", "cumulative_rate")
    assert small[-1][1] == 2000


def test_file_groups_and_ledger(spark):
    files = spark.createDataFrame([(f"in/m{i:03d}.parquet",) for i in range(120)], "file string")
    groups = X.file_groups(files)
    assert rows(groups.groupBy("group_id").count(), "group_id", "count") == [(0, 50), (1, 50), (2, 20)]
    with pytest.raises(ValueError):
        X.group_of(groups, 3)
    ledger = spark.createDataFrame([("m000.parquet",)], "parquet_filename string")
    assert X.remaining_files(files, ledger).count() == 119


def test_profile_is_one_pass(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, "y", None)], "a int, `b c` string, d string")
    assert rows(profile.column_profile(frame), "column_name", "non_null", "total") == [("a", 2, 2), ("b c", 1, 2), ("d", 1, 2)]
    assert profile.column_profile(frame, 2).count() == 2
    assert profile.sample_rows(frame, rows=1).count() == 1


def test_saved_sample(spark, tmp_path):
    profile.save_sample(spark.range(20), str(tmp_path / "sample"))
    assert spark.read.json(str(tmp_path / "sample")).count() == 5


def test_building_joins_starts_no_job(spark):
    """Plans are only described; counting or collecting is for the action that runs them."""
    from replyforge.operators import checkpoints, fetching

    tracker = spark.sparkContext.statusTracker()
    frame = spark.range(10).selectExpr("cast(id as string) as id", "cast(id as string) as uuid", "'p' as prompt", "true as success")
    saved = frame.selectExpr("id", "'completed' as bucket", "1 as seq", "prompt")
    plan = spark.createDataFrame([("r", "c", "p", "t")], "repo string, commit_id string, rel_path string, target string")
    spark.sparkContext.setJobGroup("building", "")
    checkpoints.skip_done(frame, frame)
    checkpoints.resume_inputs(frame, saved)
    checkpoints.fresh_rows(frame, saved)
    fetching.skip_fetched(plan, plan.withColumn("size", F.lit(1)))
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_scoring_shuffles_no_text(spark):
    docs = spark.range(50).selectExpr("id as doc_id", "'good bad' as text")
    model = spark.createDataFrame([("1", "good", 1.0), ("0", "good", -1.0)], "label string, token string, weight double")
    plan = K.filter_documents(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_end_token_and_word_runs(spark):
    model = spark.createDataFrame(
        [("1", "a b", 4.0), ("0", "a b", 0.0), ("1", "</s>", 0.0), ("0", "</s>", 1.0)], "label string, token string, weight double"
    )
    docs = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "doc_id int, text string")
    got = rows(K.classify_text(docs, model, ["doc_id"], end="</s>", ngrams=2), "doc_id", "label")
    assert got == [(1, 1), (2, 0), (3, 0)]


def test_limit_cuts_equal_order_values(spark):
    from replyforge.operators.checkpoints import limit_inputs

    frame = spark.createDataFrame([(i, i // 4) for i in range(20)] + [(20, None)], "id int, place int")
    for n in (0, 1, 5, 6, 20, 30):
        got = limit_inputs(frame, n, ["place"]).collect()
        want = sorted([-1] + [i // 4 for i in range(20)])[:n]
        assert sorted(-1 if r["place"] is None else r["place"] for r in got) == want
