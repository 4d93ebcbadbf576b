"""The append-only log of model calls for samples that are asked until they are decided.

A task writes each call's answers to a file of its own before it uses them. Whatever happens to the task or the
run, the next one reads what is there and goes on behind it; only the call under way is lost. Rows are (sample, turn,
response, error); a prompt is in none of them.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq

from replyforge.sources.files import listing, open_folder, write_table

LOG = pa.schema([("_sample", pa.int64()), ("turn", pa.int32()), ("response", pa.string()), ("error", pa.string())])
#: Samples are numbered within the part of the texts they were written to.
PART_BITS = 33


def split_parts(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    """Rows by the part of the texts they belong to."""
    parts = [n >> PART_BITS for n in table["_sample"].to_pylist()]
    for part in sorted(set(parts)):
        yield part, table.filter(pa.array([p == part for p in parts]))


class RowLog:
    """The results of a step that is made once per row, below ``folder``, one sub-folder per part of the texts."""

    def __init__(self, folder: str):
        self.files, self.place = open_folder(folder)
        self.parts: dict[int, set[int]] = {}

    def _known(self, part: int) -> set[int]:
        if part not in self.parts:
            found = listing(self.files, f"{self.place}/part={part}", ".parquet")
            tables = [pq.read_table(f.path, filesystem=self.files, columns=["_sample"], partitioning=None) for f in found]
            self.parts[part] = {n for t in tables for n in t["_sample"].to_pylist()}
        return self.parts[part]

    def missing(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The rows of a batch that no task has logged."""
        numbers = batch.column("_sample").to_pylist()
        return batch.filter(pa.array([n not in self._known(n >> PART_BITS) for n in numbers], pa.bool_()))

    def append(self, table: pa.Table) -> None:
        for part, own in split_parts(table):
            write_table(self.files, f"{self.place}/part={part}", f"{uuid.uuid4().hex}.parquet", own)


@dataclass
class Sample:
    number: int
    prompt: str | None
    history: list
    accepted: int
    failed: int
    turn: int = 0


@dataclass
class CallLog:
    """The log below ``folder``, one sub-folder per part of the texts."""

    folder: str
    parts: dict[int, dict[int, list[int]]] = field(default_factory=dict)

    def __post_init__(self):
        self.files, self.place = open_folder(self.folder)

    def _part(self, part: int) -> dict[int, list[int]]:
        """Per sample of a part its turns, accepted answers and errors so far."""
        if part not in self.parts:
            known: dict[int, list[int]] = {}
            seen = set()
            for file in listing(self.files, f"{self.place}/part={part}", ".parquet"):
                table = pq.read_table(file.path, filesystem=self.files, columns=["_sample", "turn", "error"], partitioning=None)
                failed = table["error"].is_valid().to_pylist()
                for sample, turn, bad in zip(table["_sample"].to_pylist(), table["turn"].to_pylist(), failed, strict=True):
                    if (sample, turn) not in seen:
                        seen.add((sample, turn))
                        counts = known.setdefault(sample, [0, 0, 0])
                        counts[0] = max(counts[0], turn)
                        counts[1 + bad] += 1
            self.parts[part] = known
        return self.parts[part]

    def recall(self, sample: Sample) -> Sample:
        """A sample with what earlier tasks have logged for it."""
        turn, accepted, failed = self._part(sample.number >> PART_BITS).get(sample.number, (0, 0, 0))
        sample.turn, sample.accepted, sample.failed = turn, sample.accepted + accepted, sample.failed + failed
        return sample

    def append(self, samples: list[Sample], responses: list[str | None], errors: list[str | None]) -> None:
        """The answers of one call, a file for each part that has samples in it."""
        columns = [[s.number for s in samples], [s.turn for s in samples], responses, errors]
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, LOG, strict=True)], schema=LOG)
        for part, own in split_parts(table):
            write_table(self.files, f"{self.place}/part={part}", f"{uuid.uuid4().hex}.parquet", own)


def ask_until_decided(
    samples: Iterable[Sample],
    ask: Callable[[list[str | None], list[list]], tuple[list, list]],
    log: CallLog,
    n: int,
    max_rounds: int,
    batch_size: int,
) -> Iterator[tuple[int, int]]:
    """Call for the samples, ``batch_size`` at a time, until each has ``n`` answers or ``max_rounds`` errors.

    ``ask`` answers (responses, errors). Samples that stay open are asked again before new ones are taken, so calls are
    full until the rows run out and no more than a batch is held. Yields per call its rows and how many were decided.
    """

    def is_open(s: Sample) -> bool:
        return s.accepted < n and (max_rounds == -1 or s.failed < max_rounds)

    waiting: deque[Sample] = deque()
    left = iter(samples)
    while True:
        while len(waiting) < batch_size and (new := next(left, None)) is not None:
            if is_open(log.recall(new)):
                waiting.append(new)
        if not waiting:
            return
        batch = [waiting.popleft() for _ in range(min(batch_size, len(waiting)))]
        for s in batch:
            s.turn += 1
        responses, errors = ask([s.prompt for s in batch], [s.history for s in batch])
        log.append(batch, responses, errors)
        for s, error in zip(batch, errors, strict=True):
            s.accepted, s.failed = s.accepted + (error is None), s.failed + (error is not None)
        still = [s for s in batch if is_open(s)]
        waiting.extend(still)
        yield len(batch), len(batch) - len(still)
