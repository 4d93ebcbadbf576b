"""A streaming source over files that grow: its offset is how many bytes of each file were taken."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from replyforge.sources.files import PART_BYTES, count_lines, last_line_end, lines_of, listing, open_folder, ranges

SCHEMA = "source_file string, start long, value string"


@dataclass
class FileRange(InputPartition):
    name: str
    begin: int
    end: int
    whole_line: bool


class GrowingFiles(DataSource):
    """``spark.readStream.format("growing_files")`` over the files directly in a folder.

    Rows are ``source_file``, ``start`` (the byte a line begins at, which names the line) and ``value``. A batch reads the
    bytes that were appended since the one before, up to the last newline; what follows it may still be being
    written and waits. Files must only grow; their names tell them apart.

    Options: ``path``; ``pattern`` of the file names; ``min_lines``, the new lines all files together have to have before a
    batch is made; ``checkpoint``, the stream's own checkpoint folder, from which a stream that goes on knows at its
    first look what was taken (needed for ``min_lines`` only); ``part_bytes``, what a task reads at most.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_files"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(dict(self.options))


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.files, self.place = open_folder(options["path"].rstrip("/"))
        self.pattern = options.get("pattern", "*.jsonl")
        self.min_lines = int(options.get("min_lines", 1))
        self.part_bytes = int(options.get("part_bytes", PART_BYTES))
        self.taken = self._from_checkpoint(options.get("checkpoint"))

    @staticmethod
    def _from_checkpoint(folder: str | None) -> dict:
        """The end of the last batch that Spark has planned: the last line of its newest offset file."""
        if not folder:
            return {}
        files, place = open_folder(folder.rstrip("/"))
        batches = [f for f in listing(files, f"{place}/offsets") if f.base_name.isdigit()]
        if not batches:
            return {}
        with files.open_input_stream(max(batches, key=lambda f: int(f.base_name)).path) as handle:
            return json.loads(handle.read().decode().strip().splitlines()[-1])

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        found = dict(self.taken)
        for file in listing(self.files, self.place):
            begin = found.get(file.base_name, 0)
            if fnmatchcase(file.base_name, self.pattern) and file.size > begin:
                end = last_line_end(self.files, file.path, begin, file.size)
                if end > begin:
                    found[file.base_name] = end
        return found if self._enough(found) else dict(self.taken)

    def _enough(self, found: dict) -> bool:
        """Whether there are ``min_lines`` new ones; no more than these are counted."""
        missing = self.min_lines
        for name, end in found.items():
            begin = self.taken.get(name, 0)
            if missing > 0 and end > begin:
                missing -= count_lines(self.files, f"{self.place}/{name}", begin, end, missing)
        return missing <= 0

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        self.taken = dict(end)
        found = []
        for name, last in end.items():
            first = start.get(name, 0)
            found += [FileRange(name, a, b, a == first) for a, b in ranges(last, first, self.part_bytes)]
        return found

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        path = f"{self.place}/{partition.name}"
        for starts, texts in lines_of(self.files, path, partition.begin, partition.end, partition.whole_line):
            names = pa.array([partition.name] * len(texts), pa.string())
            columns = [names, pa.array(starts, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["source_file", "start", "value"])
