"""Listings in tasks, and files of which a part cannot be read."""

import gzip
import json
import os

import pytest

from replyforge.operators.fetching import fetch_plan, skip_fetched
from replyforge.plans.acquire import acquire
from replyforge.plans.filtering import filter_folder
from replyforge.sources.files import list_folder
from replyforge.sources.jsonl import list_files, part_failed, scan_files
from replyforge.sources.storage import materialize


def torn_gzip(path, lines):
    """A packed file whose end is missing: its first lines can be read, then it fails."""
    whole = gzip.compress("".join(f"{line}\n" for line in lines).encode(), compresslevel=0)
    path.write_bytes(whole[: len(whole) * 2 // 3])


def test_listing_in_tasks(spark, tmp_path):
    for name in ("a.jsonl", "b.txt", "sub/c.jsonl", "sub/deep/d é.jsonl", "_hidden/e.jsonl", ".f.jsonl"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x" * len(name))
    flat = {(r["name"], r["size"]) for r in list_folder(spark, str(tmp_path), "*.jsonl").collect()}
    assert flat == {("a.jsonl", 7)}
    deep = {(r["path"].removeprefix(f"{tmp_path}/"), r["size"]) for r in list_folder(spark, str(tmp_path), "*.jsonl", recursive=True).collect()}
    assert deep == {(n, len(n)) for n in ("a.jsonl", "sub/c.jsonl", "sub/deep/d é.jsonl")}
    os.utime(tmp_path / "a.jsonl", (1000, 1000))
    assert list_folder(spark, f"file://{tmp_path}", "a.*").first()["modified"].timestamp() == 1000
    with pytest.raises(Exception, match="nowhere"):
        list_folder(spark, str(tmp_path / "nowhere")).collect()


def test_lines_and_failures(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(f"{i}\n" for i in range(1000)) + "last")
    (tmp_path / "empty.jsonl").write_text("")
    (tmp_path / "e.jsonl.gz").write_bytes(gzip.compress(b"x\ny\n"))
    torn_gzip(tmp_path / "torn.jsonl.gz", range(1_200_000))
    rows = materialize(scan_files(spark, str(tmp_path), "*.jsonl*", part_bytes=500), "rows")
    assert rows.where("source_file = 'torn.jsonl.gz' AND error IS NULL").count() > 0
    good, failed = part_failed(rows)
    assert sorted(r["value"] for r in good.where("source_file = 'a.jsonl'").collect()) == sorted([*map(str, range(1000)), "last"])
    assert {r["source_file"] for r in good.collect()} == {"a.jsonl", "e.jsonl.gz"}
    assert [r["source_file"] for r in failed.collect()] == ["torn.jsonl.gz"]
    assert failed.first()["error"]


def test_half_read_file_gives_no_line_and_no_figure(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    line = lambda i: json.dumps({"id": i, "text": "good" if i % 2 else "bad"})
    (src / "a.jsonl").write_text("".join(line(i) + "\n" for i in range(10)) + "\n{torn\n")
    (src / "none.jsonl").write_text("")
    torn_gzip(src / "torn.jsonl.gz", [line(i) for i in range(20_000)])
    model = spark.createDataFrame([("__label__1", "good", 2.0), ("__label__0", "good", 0.0), ("__label__1", "bad", 0.0), ("__label__0", "bad", 2.0)], "label string, token string, weight double")
    figures = {r["source_file"]: (r["total"], r["retained"]) for r in filter_folder(spark, str(src), out, model, pattern="*.jsonl*").collect()}
    assert figures == {"a.jsonl": (11, 5), "none.jsonl": (0, 0)}
    assert {d for d in os.listdir(f"{out}/records") if "=" in d} == {"source_file=a.jsonl"}
    summary = spark.read.json(f"{out}/report/summary").first()
    assert (summary["total_files"], summary["failed_files"], summary["total_lines"]) == (3, 1, 11)
    failures = spark.read.json(f"{out}/report/failed_files").collect()
    assert [r["source_file"] for r in failures] == ["torn.jsonl.gz"] and failures[0]["error"]
    assert {r["source_file"] for r in list_files(spark, str(src)).collect()} == {"a.jsonl", "none.jsonl"}


def test_fetched_files_are_found_in_their_folder(spark, tmp_path):
    manifest = spark.createDataFrame([("m.parquet", "o/r", "c", f"d/{i}.lean") for i in range(6)], "manifest string, repo string, commit_id string, rel_path string")
    plan = fetch_plan(manifest, str(tmp_path))
    for r in plan.collect()[:2]:
        os.makedirs(os.path.dirname(r["target"]), exist_ok=True)
        with open(r["target"], "w") as file:
            file.write("x" * 5)
    left, there = skip_fetched(plan, str(tmp_path))
    assert left.count() == 4 and [(r["success"], r["skipped"], r["size"]) for r in there.collect()] == [(True, True, 5)] * 2
    outcomes, stats, _ = acquire(manifest, str(tmp_path), lambda: lambda url, target: 1, existing=str(tmp_path))
    assert tuple(stats.select("total_files", "new_files", "skipped_files", "total_size").first()) == (6, 4, 2, 14)
