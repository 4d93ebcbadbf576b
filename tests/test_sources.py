"""Readers, writers, snapshots and streaming on files."""

import os
import time

import pytest
from pyspark.sql import functions as F

from replyforge.plans.filtering import filter_folder, with_score
from replyforge.sources import jsonl, sinks, snapshots, storage, tables
from replyforge.streaming.ingest import ingest_stream, jsonl_stream


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_read_jsonl_sets_bad_lines_apart(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": "1"}\n\n  \t\n{"id": \n[1]\n{"id": "2"} tail\n{"id": 3}\n"text"\n{"id": "é"}\n', encoding="utf-8")
    lines = jsonl.read_jsonl(spark, str(path), "id string")
    assert rows(lines.rows, "id") == [("1",), ("é",), (None,)]
    assert lines.rejects.count() == 4
    whole = jsonl.read_jsonl(spark, str(path)).rows
    assert whole.columns == ["record"] and whole.count() == 3


def test_strict_reader(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"k": "a", "v": 1}\n{"k": "b", "v": 2}\n{"k": "a", "v": 3}\n{"v": 4}\n')
    got = jsonl.read_json_table(spark, str(tmp_path / "t"), "k", "k string, v int")
    assert rows(got, "k", "v") == [("a", 3), ("b", 2)]
    assert jsonl.read_json_table(spark, str(tmp_path / "t")).count() == 4
    (tmp_path / "d.json").write_text('[{"k": "x"},\n {"k": "y"}]')
    assert jsonl.read_json_table(spark, str(tmp_path / "d"), schema="k string").count() == 2
    assert jsonl.read_json_table(spark, str(tmp_path / "d.json"), schema="k string").count() == 2
    (tmp_path / "bad.jsonl").write_text('{"k": "a"}\n{"k"\n')
    with pytest.raises(Exception):
        jsonl.read_json_table(spark, str(tmp_path / "bad"), schema="k string").collect()
    for name, text in (("tail", '{"k": "a"}\n{"k": "b"} more\n'), ("blank", '{"k": "a"}\n\n{"k": "b"}\n')):
        (tmp_path / f"{name}.jsonl").write_text(text)
        with pytest.raises(Exception, match="not one JSON value"):
            jsonl.read_json_table(spark, str(tmp_path / name)).collect()
    with pytest.raises(FileNotFoundError):
        jsonl.read_json_table(spark, str(tmp_path / "none"))


def test_json_ending_is_tried_first(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"k": "doc"}]')
    (tmp_path / "t.jsonl").write_text('{"k": "line"}\n')
    assert jsonl.resolve_json_path(spark, str(tmp_path / "t")).endswith("t.json")


def test_lookup(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "idx int, v string")
    assert jsonl.lookup_idx(frame, 2).first()["v"] == "b"
    assert jsonl.lookup_idx(frame).count() == 2
    with pytest.raises(ValueError):
        jsonl.lookup_idx(frame, 5)
    assert jsonl.join_base_dir("data", "x") == "data/x" and jsonl.join_base_dir("data", "a/x") == "a/x"


def test_statement_columns(spark, tmp_path):
    spark.createDataFrame([("1", "s")], "id string, formal_statement string").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([("1", "2", "s")], "id string, uuid string, formal_statement string").write.parquet(str(tmp_path / "b"))
    spark.createDataFrame([("1",)], "id string").write.parquet(str(tmp_path / "c"))
    assert rows(tables.read_statements(spark, str(tmp_path / "a")), "uuid") == [("1",)]
    assert rows(tables.read_statements(spark, str(tmp_path / "b")), "uuid") == [("2",)]
    with pytest.raises(ValueError):
        tables.read_statements(spark, str(tmp_path / "c"))


def test_dataset_names_and_row_ids(spark, tmp_path):
    path = str(tmp_path / "set.lance")
    spark.range(100).repartition(4).write.parquet(path)
    table = tables.read_dataset(spark, path + "/")
    assert table.select("lance_dataset").distinct().first()[0] == "set.lance"
    assert table.select("_rowid").distinct().count() == 100
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
    placed = tables.with_position(spark.read.parquet(path))
    assert sorted(r["_position"] for r in placed.collect()) == list(range(100))
    one = spark.read.parquet(path).coalesce(1)
    one.write.parquet(str(tmp_path / "one"))
    assert sorted(r["_position"] for r in tables.with_position(spark.read.parquet(str(tmp_path / "one"))).collect()) == list(range(100))


def test_scan_dir_takes_jsonl_files_only(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("1\n2\n")
    (tmp_path / "b.txt").write_text("3\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.jsonl").write_text("4\n")
    assert rows(jsonl.scan_dir(spark, str(tmp_path)), "source_file", "value") == [("a.jsonl", "1"), ("a.jsonl", "2")]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert jsonl.scan_dir(spark, str(empty)).count() == 0


def test_written_lines(spark, tmp_path):
    frame = spark.createDataFrame([(1, "é→", None, "p")], "id int, t string, gap string, prompt string")
    path = str(tmp_path / "out")
    sinks.write_jsonl(frame, path, save_prompt=False)
    assert spark.read.text(path).first()[0] == '{"id":1,"t":"é→","gap":null}'
    sinks.write_jsonl(frame.drop("prompt"), path, "append", save_prompt=False)
    assert spark.read.text(path).count() == 2


def test_output_per_source(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_by_source(spark.createDataFrame([("a.jsonl", 1), ("b.jsonl", 2)], "source_file string, v int"), path)
    assert {d for d in os.listdir(path) if "=" in d} == {"source_file=a.jsonl", "source_file=b.jsonl"}


def test_newest_snapshot_is_restored(spark, tmp_path):
    for i, name in enumerate(("snapshot_2.jsonl", "snapshot_1.jsonl", "other.jsonl")):
        (tmp_path / name).write_text(f'{{"id": "{name}"}}\n')
        stamp = time.time() - 100 + i
        os.utime(tmp_path / name, (stamp, stamp))
    restored = snapshots.restore_latest(spark, str(tmp_path), "id string")
    assert rows(restored.rows, "id") == [("snapshot_1.jsonl",)]
    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        snapshots.restore_latest(spark, str(empty))


def test_stream_takes_each_line_once(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")

    def run():
        ingest_stream(jsonl_stream(spark, str(src), "id string"), sink, checkpoint).awaitTermination()
        return rows(spark.read.parquet(sink), "id")

    (src / "a.jsonl").write_text('{"id": "1"}\nbroken\n')
    assert run() == [("1",)]
    (src / "b.jsonl").write_text('{"id": "2"}\n')
    (src / "c.tmp").write_text('{"id": "3"}\n')
    assert run() == [("1",), ("2",)]
    assert run() == [("1",), ("2",)]


def test_score_replaces_an_old_one(spark):
    frame = spark.sql("""select parse_json('{"text": "a", "score": "old", "n": null}') as record, 0.25d as score""")
    text = frame.select(with_score(F.col("record"), F.col("score"))).first()[0]
    import json

    assert json.loads(text) == {"text": "a", "n": None, "score": 0.25}


def test_folder_filter(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    (src / "a.jsonl").write_text('{"text": "good good", "score": 7}\n{"text": "bad"}\nbroken\n\n{"x": 1}\n{"text": 5}\n')
    (src / "b.jsonl").write_text('{"text": "good good", "score": 7}\n' * 3)
    (src / "c.jsonl").write_text("\n \n")
    (src / "d é.jsonl").write_text("")
    model = spark.createDataFrame([("__label__1", "good", 1.0), ("__label__0", "good", -1.0), ("__label__1", "bad", -1.0), ("__label__0", "bad", 1.0)], "label string, token string, weight double")
    figures = filter_folder(spark, str(src), out, model)
    assert rows(figures, "source_file", "total", "retained", "retention_rate") == [("a.jsonl", 5, 1, 20.0), ("b.jsonl", 3, 3, 100.0), ("c.jsonl", 0, 0, 0.0), ("d é.jsonl", 0, 0, 0.0)]
    kept = spark.read.schema("text string, score double, source_file string").json(out + "/records")
    assert rows(kept, "source_file", "text", "score") == [("a.jsonl", "good good", 0.8808)] + [("b.jsonl", "good good", 0.8808)] * 3
    assert spark.read.json(out + "/report/summary").first()["overall_retention_rate"] == 50.0


def test_work_dir_is_the_named_one(spark):
    assert storage.work_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert storage.new_path(spark, "x") != storage.new_path(spark, "x")


def test_stateless_operators_run_on_a_stream(spark, tmp_path):
    """Parsing, rendering, reply extraction and the model call, all in one streaming query."""
    from replyforge.functions.render import render
    from replyforge.functions.replies import extract_json
    from replyforge.operators.calls import infer_batch

    src = tmp_path / "src"
    src.mkdir()
    (src / "a.jsonl").write_text('{"id": "1", "lean_code": "c"}\nbroken\n{"id": "2", "lean_code": null}\n')
    model = lambda: lambda texts, _: ([f'so {{"n": {len(t)}}} it is' for t in texts], [None] * len(texts))
    rows_in = jsonl_stream(spark, str(src), "id string, lean_code string")
    asked = rows_in.withColumn("prompt", render("do {}", "lean_code"))
    answered = infer_batch(asked, model).withColumn("json", extract_json("response"))
    sink = str(tmp_path / "sink")
    ingest_stream(answered, sink, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(spark.read.parquet(sink), "id", "prompt", "json") == [("1", "do c", '{"n": 4}'), ("2", "do None", '{"n": 7}')]


def test_last_row_over_several_files(spark, tmp_path):
    """Larger files are read first, but the name says which is last."""
    folder = tmp_path / "t.jsonl"
    folder.mkdir()
    (folder / "part-0.json").write_text('{"k": "a", "v": "old"}\n')
    (folder / "part-1.json").write_text('{"k": "b", "v": "x"}\n' * 50 + '{"k": "a", "v": "new"}\n')
    assert rows(jsonl.read_json_table(spark, str(tmp_path / "t"), "k"), "k", "v") == [("a", "new"), ("b", "x")]


def test_intermediate_tables_go_with_their_run(spark, tmp_path):
    from replyforge.sources.storage import materialize, new_path, scratch

    with scratch(spark) as folder:
        table = materialize(spark.range(5), "numbers")
        assert table.count() == 5
        place = folder.removeprefix("file://")
        assert len(os.listdir(place)) == 1 and new_path(spark, "x").startswith(folder + "/")
        with scratch(spark) as inner:
            assert inner.startswith(folder)
            materialize(spark.range(2), "more")
            assert os.path.isdir(inner.removeprefix("file://"))
        assert not os.path.exists(inner.removeprefix("file://")) and table.count() == 5
    assert not os.path.exists(place) and not new_path(spark, "x").startswith(folder)
    with pytest.raises(ValueError), scratch(spark) as folder:
        materialize(spark.range(1), "numbers")
        raise ValueError
    assert not os.path.exists(folder.removeprefix("file://"))
    with scratch(spark):
        pass
