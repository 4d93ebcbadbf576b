"""Token counts by byte-pair merging on a heap and a linked list.

A piece starts as a list of byte symbols. The lowest-rank adjacent pair, leftmost first, is popped and merged until no
mergeable pair is left; the count is the number of initial symbols minus the number of merges. No ids are emitted.

Null and empty texts have no tokens. Texts of any length are cut at spaces, where no merge can cross. Rows are counted
one by one without a shuffle; equal pieces are merged once per worker. Only key and text are read, so other columns may
have any name. An empty table gives an empty table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.llm.batches import per_process
from replyforge.llm.presplit import PieceTable, cut
from replyforge.llm.vocabulary import Vocabulary, read_vocabulary


def count_merges(symbols: list[int], merges: dict[int, tuple[int, int]]) -> int:
    """How many merges the piece takes."""
    n = len(symbols)
    if n < 2:
        return 0
    after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
    pending = [-1] * n  # rank of the pair that starts here
    heap = []
    for i in range(n - 1):
        found = merges.get(symbols[i] << 20 | symbols[i + 1])
        if found:
            pending[i] = found[0]
            heap.append(found[0] << 32 | i)
    heapq.heapify(heap)
    done = 0
    while heap:
        entry = heapq.heappop(heap)
        i, rank = entry & 0xFFFFFFFF, entry >> 32
        if pending[i] != rank:
            continue  # one of its sides has been merged meanwhile
        j = after[i]
        symbols[i] = merges[symbols[i] << 20 | symbols[j]][1]
        done += 1
        pending[j] = -1
        after[i] = k = after[j]
        if k < n:
            ahead[k] = i
            found = merges.get(symbols[i] << 20 | symbols[k])
            pending[i] = found[0] if found else -1
            if found:
                heapq.heappush(heap, found[0] << 32 | i)
        else:
            pending[i] = -1
        h = ahead[i]
        if h >= 0:
            found = merges.get(symbols[h] << 20 | symbols[i])
            pending[h] = found[0] if found else -1
            if found:
                heapq.heappush(heap, found[0] << 32 | h)
    return done


def piece_cutter(path: str):
    """The library's own pre-tokenizer, for texts with characters of unsure class."""
    from tokenizers import Tokenizer

    cutter = Tokenizer.from_file(path).pre_tokenizer
    return lambda text: [span for _, span in cutter.pre_tokenize_str(text)]


class Counter:
    def __init__(self, path: str):
        self.vocabulary: Vocabulary = read_vocabulary(path)
        self.library = piece_cutter(path)
        self.seen = PieceTable(2_000_000)

    def values(self, pieces: list[str]) -> list[int]:
        byte_ids, merges, specials = self.vocabulary.byte_ids, self.vocabulary.merges, self.vocabulary.specials
        counts = []
        for piece in pieces:
            if piece in specials:
                counts.append(1)
                continue
            symbols = [byte_ids[b] for b in piece.encode("utf-8")]
            counts.append(len(symbols) - count_merges(symbols, merges))
        return counts

    def count(self, texts: list[str | None]) -> np.ndarray:
        totals = np.zeros(len(texts), np.int64)
        for pieces in cut(texts, True, self.library, tuple(self.vocabulary.specials)):
            slots = self.seen.slots_of(pieces, self.values)
            counts = np.array(self.seen.values, np.int64)[slots] if len(slots) else np.zeros(0, np.int64)
            totals += np.bincount(pieces.rows, counts, len(texts)).astype(np.int64)
        return totals


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``n_bytes`` and ``n_tokens`` of every row. ``path`` is the vocabulary file, there on every worker."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        counter = per_process(("counter", path), lambda: Counter(path))
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                counts = pa.array(counter.count(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), counts], ["key", "n_bytes", "n_tokens"])

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return (
        docs.select(F.col(f"`{key}`").alias("key"), body.alias("text"), F.octet_length(body).cast("long").alias("n_bytes"))
        .mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
        .withColumnRenamed("key", key)
    )
