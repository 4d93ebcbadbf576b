"""Files that grow: ranges of lines, the byte-offset source, and looks that take what was appended."""

import json
import os
import random
import shutil

import pytest

from replyforge.sources import growing
from replyforge.sources.files import count_lines, last_line_end, lines_of, open_folder, ranges
from replyforge.streaming.ingest import appended_lines, growing_stream, ingest_appended, ingest_stream


def taken(spark, sink):
    return sorted((r["source_file"], r["start"], r["value"]) for r in appended_lines(spark, sink).collect())


def batches(sink):
    return sorted(int(f) for f in os.listdir(f"{sink}/checkpoint/commits") if f.isdigit())


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_parts_of_a_file_hold_each_line_once(tmp_path, monkeypatch, block):
    monkeypatch.setattr("replyforge.sources.files.READ_BYTES", block)
    numbers = random.Random(block)
    for case in range(30):
        content = "".join(numbers.choice(["a", "é", "\n", "\r\n", "xyz", "\n\n"]) for _ in range(numbers.randint(0, 60)))
        path = tmp_path / f"{case}.txt"
        path.write_bytes(content.encode())
        want, at = [], 0
        raw = content.encode().split(b"\n")
        for line in raw if raw[-1] else raw[:-1]:
            want.append((at, line.removesuffix(b"\r").decode()))
            at += len(line) + 1
        files, place = open_folder(str(path))
        size = path.stat().st_size
        for step in (1, 3, 10, 1000):
            got = [x for a, b in ranges(size, 0, step) for s, t in lines_of(files, place, a, b, a == 0) for x in zip(s, t, strict=True)]
            assert got == want
        assert [x for s, t in lines_of(files, place) for x in zip(s, t, strict=True)] == want
        assert last_line_end(files, place, 0, size) == content.encode().rfind(b"\n") + 1
        assert count_lines(files, place, 0, size, 10**9) == content.count("\n")


def test_appended_lines_are_taken_once(spark, tmp_path):
    """A growing file, a line cut in the middle, a new file, and a batch that was cut off before its commit."""
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    src.mkdir()
    (src / "other.txt").write_text("no\n")
    look = lambda: ingest_appended(spark, str(src), sink)
    (src / "a.jsonl").write_text('{"x": 1}\n{"x": 2}\n{"x"')
    assert look() == 2 and taken(spark, sink) == [("a.jsonl", 0, '{"x": 1}'), ("a.jsonl", 9, '{"x": 2}')]
    assert look() == 0
    with (src / "a.jsonl").open("a") as file:
        file.write(': 3}\n{"x": 4}\n')
    (src / "b.jsonl").write_text('{"y": 1}\n')
    assert look() == 3
    want = [*[("a.jsonl", 9 * i, f'{{"x": {i + 1}}}') for i in range(4)], ("b.jsonl", 0, '{"y": 1}')]
    assert taken(spark, sink) == want
    # The last batch was written, but the run died before its commit: it is repeated, and counts once.
    last = batches(sink)[-1]
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{sink}/checkpoint/commits/{name}")
    (src / "c.jsonl").write_text("7\n")
    look()  # repeats that batch alone
    assert look() == 1 and look() == 0
    assert taken(spark, sink) == [*want, ("c.jsonl", 0, "7")]


def test_a_look_reads_only_what_was_appended(spark, tmp_path):
    """What was taken before may even be unreadable: its bytes are gone from the file."""
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    src.mkdir()
    path = src / "a.jsonl"
    path.write_text("".join(f"{i:07d}\n" for i in range(20_000)))
    assert ingest_appended(spark, str(src), sink) == 20_000
    with path.open("r+b") as file:
        file.write(b"\xff" * 160_000)
        file.seek(160_000)
        file.write(b"new 1\nnew 2\n")
    assert ingest_appended(spark, str(src), sink) == 2
    assert taken(spark, sink)[-2:] == [("a.jsonl", 160_000, "new 1"), ("a.jsonl", 160_006, "new 2")]
    reader = growing.GrowingReader({"path": str(src), "checkpoint": f"{sink}/checkpoint", "part_bytes": "5"})
    assert reader.taken == {"a.jsonl": 160_012}
    path.open("ab").write(b"12345678\n9\n")
    parts = reader.partitions(reader.taken, reader.latestOffset())
    assert [(p.begin, p.end) for p in parts] == [(160_012, 160_017), (160_017, 160_022), (160_022, 160_023)]
    assert [v for p in parts for b in reader.read(p) for v in b.column(2).to_pylist()] == ["12345678", "9"]


def test_lines_below_the_threshold_wait(spark, tmp_path):
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    src.mkdir()
    look = lambda: ingest_appended(spark, str(src), sink, min_lines=10)

    def grow(name, n):
        with (src / name).open("a") as file:
            file.write("".join(f"{json.dumps({'n': i})}\n" for i in range(n)))

    grow("a.jsonl", 9)
    assert look() == 0
    grow("b.jsonl", 1)
    assert look() == 10
    grow("a.jsonl", 5)
    assert look() == 0
    grow("a.jsonl", 4)
    assert look() == 0
    grow("b.jsonl", 1)
    assert look() == 10 and len(taken(spark, sink)) == 20


def test_no_files_and_no_lines(spark, tmp_path):
    src, sink = tmp_path / "src", str(tmp_path / "sink")
    src.mkdir()
    assert ingest_appended(spark, str(src), sink) == 0
    (src / "a.jsonl").write_text("")
    (src / "b.jsonl").write_text("no end of line")
    assert ingest_appended(spark, str(src), sink) == 0
    with (src / "b.jsonl").open("a") as file:
        file.write("\n\n")
    assert ingest_appended(spark, str(src), sink) == 2
    assert [v for _, _, v in taken(spark, sink)] == ["no end of line", ""]


def test_large_file_is_read_by_several_tasks(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.jsonl").write_text("".join(f"{i}\n" for i in range(30_000)))
    rows = growing_stream(spark, str(src), part_bytes=10_000)
    ingest_stream(rows, str(tmp_path / "sink"), str(tmp_path / "checkpoint")).awaitTermination()
    read = spark.read.parquet(str(tmp_path / "sink"))
    assert sorted(int(r["value"]) for r in read.collect()) == list(range(30_000))
    assert len(os.listdir(tmp_path / "sink")) > 5
    shutil.rmtree(tmp_path / "sink")
