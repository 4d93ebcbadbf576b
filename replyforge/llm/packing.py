"""Packing documents into training sequences of a fixed number of tokens, balanced by cost.

A piece of ``n`` tokens costs ``n + quadratic * n * n``: linear layers see every token once, attention every pair of a
piece. Each task gathers documents until it has a group of them and packs that group. A document's whole sequences are
cut off first and stand alone; what remains is shorter than a sequence. The group's remainders get as many sequences
as their tokens fill. The longest document comes first and goes whole into the cheapest sequence that has room for it.
When none has, the cheapest one with any room is filled up with its head and the rest waits for its turn by length,
so every sequence loses at most one document's end.

No padding is left in a group: full sequences take all but the last tokens, and the rest is dealt over sequences whose
lengths are the powers of two that add up to it; those need none.

``pack`` is narrow. No row is shuffled, a task holds the ids of one group (``group_tokens``, and one document), and
groups are the same whenever a task reads the same rows. Its output has one row per piece; write it once before
reading it twice, when the rows in front of it may come in another order.

Null and empty texts are documents of the end id alone. Keys may be null or repeat; every row is a document of its
own. Texts of any length are encoded in parts at spaces. Other columns are not read, whatever their names. An empty
table gives no pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.llm.batches import per_process
from replyforge.llm.token_files import Encoder

LENGTH = 2048
#: Attention against the linear part of a model 1024 wide: 4 * width * n * n against 24 * width * width * n.
QUADRATIC = 1 / 6144
#: Tokens and documents packed together.
GROUP_TOKENS = 1 << 21
GROUP_DOCS = 1 << 16
#: Sequence numbers a task may use.
SEQUENCE_BITS = 33

PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, cost double"


def capacities(total: int, length: int) -> np.ndarray:
    """Full sequences, then the powers of two that add up to what is left."""
    rest = total % length
    tails = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([*[length] * (total // length), *tails], np.int64)


def cost(tokens, quadratic: float = QUADRATIC):
    return tokens + quadratic * tokens * tokens


def assign(sizes: list[int], length: int = LENGTH, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents of at most ``length`` tokens."""
    room = capacities(sum(sizes), length)
    spent = np.zeros(len(room))
    filled = np.zeros(len(room), np.int64)
    # Longest first; of equal lengths the earlier document.
    waiting = [(-n, i, 0) for i, n in enumerate(sizes) if n]
    heapq.heapify(waiting)
    pieces = []
    while waiting:
        n, document, start = heapq.heappop(waiting)
        n = -n
        fits = room >= n
        if not fits.any():
            fits = room > 0
        place = int(np.where(fits, spent, np.inf).argmin())
        taken = min(n, int(room[place]))
        pieces.append((document, start, taken, place, int(filled[place])))
        room[place] -= taken
        filled[place] += taken
        spent[place] += cost(taken, quadratic)
        if taken < n:
            heapq.heappush(waiting, (taken - n, document, start + taken))
    return pieces


class Group:
    """Documents of a task that are packed together."""

    def __init__(self, width: int, length: int, quadratic: float):
        self.kind, self.length, self.quadratic = f"<u{width}", length, quadratic
        self.next_sequence = TaskContext.get().partitionId() << SEQUENCE_BITS
        self.clear()

    def clear(self) -> None:
        self.ids: list[np.ndarray] = []
        self.cut: list[int] = []
        self.keys: list = []
        self.tokens = 0

    def add(self, key, ids: bytes) -> None:
        content = np.frombuffer(ids, self.kind)
        self.ids.append(content)
        self.cut.append(len(content) // self.length * self.length)
        self.keys.append(key)
        self.tokens += len(content)

    def rows(self) -> Iterator[tuple]:
        """Every piece with its key, ids and numbers."""
        whole = 0
        for key, ids, cut in zip(self.keys, self.ids, self.cut, strict=True):
            for start in range(0, cut, self.length):
                yield self._row(key, ids, start, self.length, self.next_sequence + whole, 0)
                whole += 1
        self.next_sequence += whole
        used = 0
        rests = [len(ids) - cut for ids, cut in zip(self.ids, self.cut, strict=True)]
        for document, start, n, sequence, offset in assign(rests, self.length, self.quadratic):
            ids, cut = self.ids[document], self.cut[document]
            yield self._row(self.keys[document], ids, cut + start, n, self.next_sequence + sequence, offset)
            used = max(used, sequence + 1)
        self.next_sequence += used

    def _row(self, key, ids, start, n, sequence, offset) -> tuple:
        content = ids[start : start + n].astype("<u4").tobytes()
        return key, start, n, content, len(ids), sequence, offset, cost(n, self.quadratic)


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    length: int = LENGTH,
    quadratic: float = QUADRATIC,
    group_tokens: int = GROUP_TOKENS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: the key, ``start`` in its document, ``length``, ``ids`` (unsigned 32-bit, little-endian), ``doc_tokens``, ``sequence_id``, ``offset`` there and ``cost``."""
    narrow = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("encoder", path), lambda: Encoder(path))
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        group = Group(encoder.width, length, quadratic)

        def packed() -> Iterator[pa.RecordBatch]:
            rows = list(group.rows())
            group.clear()
            for low in range(0, len(rows), 4096):
                columns = [pa.array(v, f.type) for v, f in zip(zip(*rows[low : low + 4096], strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

        fields = None
        for batch in batches:
            if fields is None:
                fields = [
                    pa.field("key", batch.schema.field("key").type),
                    *[pa.field(n, pa.int64()) for n in ("start", "length")],
                    pa.field("ids", pa.binary()),
                    *[pa.field(n, pa.int64()) for n in ("doc_tokens", "sequence_id", "offset")],
                    pa.field("cost", pa.float64()),
                ]
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                encoded = encoder.encode(part.column("text").to_pylist())
                for k, ids in zip(part.column("key").to_pylist(), encoded, strict=True):
                    group.add(k, ids + end)
                    if group.tokens >= group_tokens or len(group.keys) >= GROUP_DOCS:
                        yield from packed()
        if group.keys:
            yield from packed()

    return narrow.mapInArrow(run, f"key {kind}, {PIECES}").withColumnRenamed("key", key)
