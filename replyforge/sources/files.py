"""Files that tasks list, read and write themselves: of any scheme pyarrow knows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyforge.sources.storage import materialize


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, named by a path or by an URI of a scheme pyarrow knows, and the path in it."""
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", folder))
    return fs.LocalFileSystem(), folder


def listing(files: fs.FileSystem, folder: str, suffix: str = "") -> list[fs.FileInfo]:
    """Files directly in a folder by name, hidden ones left out; none when there is no such folder."""
    found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    shown = [f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._" and f.base_name.endswith(suffix)]
    return sorted(shown, key=lambda f: f.base_name)


LISTED = "path string, name string, size long, modified timestamp, folder boolean"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies directly in each folder."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            files, place = open_folder(folder)
            found = files.get_file_info(fs.FileSelector(place))
            shown = [f for f in found if f.base_name[0] not in "._" and f.type in (fs.FileType.File, fs.FileType.Directory)]
            base = folder.rstrip("/")
            columns = [
                pa.array([f"{base}/{f.base_name}" for f in shown], pa.string()),
                pa.array([f.base_name for f in shown], pa.string()),
                pa.array([f.size or 0 for f in shown], pa.int64()),
                pa.array([f.mtime for f in shown], pa.timestamp("us", "UTC")),
                pa.array([f.type == fs.FileType.Directory for f in shown], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["path", "name", "size", "modified", "folder"])


def list_folder(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """``path, name, size, modified`` of the files of a folder whose names match, hidden ones left out.

    Folders are listed in tasks, each level of folders by as many as there are cores; no path passes the driver. A
    folder that is not there fails the job. The listing is made anew whenever the table is read.
    """
    glob = "^" + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in pattern) + "$"
    level = spark.createDataFrame([(folder,)], "path string")
    found = None
    while True:
        entries = level.mapInArrow(_entries, LISTED)
        if recursive:
            entries = materialize(entries, "listing")  # read for its files and for its folders
        files = entries.where(~F.col("folder") & F.regexp_like("name", F.lit(glob))).drop("folder")
        found = files if found is None else found.unionAll(files)
        if not recursive:
            return found
        level = entries.where("folder").select("path")
        if level.isEmpty():
            return found
        level = level.repartition(spark.sparkContext.defaultParallelism)


def write_table(files: fs.FileSystem, folder: str, name: str, table: pa.Table) -> None:
    """A Parquet file that appears whole or not at all."""
    files.create_dir(folder, recursive=True)
    draft = f"{folder}/_{name}"
    pq.write_table(table, draft, filesystem=files)
    files.move(draft, f"{folder}/{name}")


#: Bytes of a file that are read by one task, and at a time.
PART_BYTES = 64 << 20
READ_BYTES = 4 << 20
#: Endings of files that can only be read from their start.
PACKED = (".gz", ".bz2", ".zst", ".lz4")


def ranges(size: int, begin: int = 0, part_bytes: int = PART_BYTES) -> list[tuple[int, int]]:
    """A file from ``begin`` to its end in parts of bounded size."""
    return [(at, min(at + part_bytes, size)) for at in range(begin, size, part_bytes)]


def lines_of(files: fs.FileSystem, path: str, begin: int = 0, end: int | None = None, whole_line: bool = True) -> Iterator[tuple[list[int], list[str]]]:
    """Starts and texts of the lines whose first byte lies from ``begin`` to before ``end``, some at a time.

    A line that begins in front of ``begin`` belongs to the part before, unless ``whole_line`` says that one begins there.
    Without ``end`` the file is read from its start to its end, unpacked if its name says so. What is no UTF-8 is replaced.
    """
    # The byte in front of a part tells whether a line begins with it; what is read up to the first end is not its own.
    skip = end is not None and not whole_line and begin > 0
    at, rest = (begin - skip if end is not None else 0), b""
    handle = files.open_input_stream(path, compression="detect") if end is None else files.open_input_file(path)
    with handle:
        if end is not None:
            handle.seek(at)
        while True:
            block = handle.read(READ_BYTES)
            held = rest + block
            if skip:
                first = held.find(b"\n")
                if first < 0:
                    at, rest = at + len(held), b""
                    if not block or at >= end:
                        return
                    continue
                held, at, skip = held[first + 1 :], at + first + 1, False
            texts = held.split(b"\n")
            rest = texts.pop() if block else b""
            if not block and texts and not texts[-1]:
                texts.pop()
            starts, own = [], []
            for text in texts:
                if end is not None and at >= end:
                    break
                starts.append(at)
                own.append(text.removesuffix(b"\r").decode("utf-8", "replace"))
                at += len(text) + 1
            if own:
                yield starts, own
            if not block or end is not None and at >= end:
                return


def last_line_end(files: fs.FileSystem, path: str, begin: int, size: int) -> int:
    """The place behind the last newline between ``begin`` and ``size``; ``begin`` if there is none."""
    with files.open_input_file(path) as handle:
        while size > begin:
            low = max(begin, size - (64 << 10))
            handle.seek(low)
            found = handle.read(size - low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            size = low
    return begin


def count_lines(files: fs.FileSystem, path: str, begin: int, end: int, enough: int) -> int:
    """Newlines of a range; counting stops at ``enough``."""
    found = 0
    with files.open_input_file(path) as handle:
        handle.seek(begin)
        while begin < end and found < enough:
            block = handle.read(min(READ_BYTES, end - begin))
            if not block:
                break
            found += block.count(b"\n")
            begin += len(block)
    return found
