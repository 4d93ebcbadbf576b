"""Benchmark decontamination as a prefix-filtered set join of word windows.

Words are runs of ASCII letters and digits and of all that is not ASCII, in lower case. An item's windows are all its
runs of ``WINDOW`` words; an item with fewer words is one window. A window occurs in a document when its words stand
there one after another; the words of every occurrence are hit.

A window is taken as the set of its shingles of up to ``SHINGLE`` words. Its shingles are ordered by how often they occur
in all documents, rarest first. An occurrence holds all of them, so the necessary prefix is the rarest one alone:
documents are joined on it. Its place in the window says where the occurrence has to start (the positional bound), and
the whole window has to lie inside the document (the length bound). What is left is verified word by word over the
whole window.

Items are taken in blocks of at most ``BLOCK_WORDS`` words, chosen by hash, so that what is sent to the tasks is bounded
however large the benchmark is. Each block is one narrow pass that adds its hits to those carried along; documents are
never shuffled.

Null and empty texts have no words; such documents have no hits, such items no windows. Repeated items and windows count
for each item id once; a null item id is left out. Repeated document rows each get their result. Very long texts are
one sequence of words. Other columns may have any name but those that are added, which can be chosen.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyforge.functions.spans import gathered
from replyforge.llm.batches import utf8
from replyforge.llm.words import shingles, words
from replyforge.shipping import broadcast, opened
from replyforge.sources.storage import materialize

WINDOW = 10
SHINGLE = 3
BLOCK_WORDS = 500_000
FILTER_BITS = 20
#: Blocks that go through one stage.
PASSES = 4
STATE = "words long, hits binary, items array<string>"


@dataclass
class Windows:
    """Distinct windows of a block of items. Rows of ``content`` are word hashes, filled up with zeros.

    ``text`` has the windows' words one after another; rows of ``starts`` and ``ends`` tell where.
    """

    content: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def shingle_size(self) -> np.ndarray:
        return np.minimum(self.lengths, SHINGLE)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, window and place of every shingle of the windows that are cut into shingles of ``size`` words."""
        found = []
        for w in np.flatnonzero(self.shingle_size() == size):
            n = int(self.lengths[w])
            own, places = shingles(self.content[w, :n], np.zeros(n, np.int64), size)
            found.append((own, np.full(len(own), w), places))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def item_windows(items: list[tuple[str, str | None]]) -> Windows:
    """The windows of a block of (id, text)."""
    texts = pa.array([text for _, text in items], pa.string())
    by_words: dict[tuple[bytes, ...], tuple[list[int], set[str]]] = {}
    for low, n, rows, starts, ends, hashes, text in words(*utf8(texts), solid=False):
        cuts = np.searchsorted(rows, np.arange(n + 1))
        spelt = [text[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        for i in range(n):
            own, shown = hashes[cuts[i] : cuts[i + 1]].tolist(), spelt[cuts[i] : cuts[i + 1]]
            for at in range(max(1, len(own) - WINDOW + 1) if own else 0):
                window = by_words.setdefault(tuple(shown[at : at + WINDOW]), (own[at : at + WINDOW], set()))
                window[1].add(items[low + i][0])
    shape = (len(by_words), WINDOW)
    content, sizes = np.zeros(shape, np.uint64), np.zeros(shape, np.int64)
    for i, (window, (own, _)) in enumerate(by_words.items()):
        content[i, : len(own)], sizes[i, : len(own)] = own, [len(w) for w in window]
    ends = np.cumsum(sizes).reshape(shape)
    text = np.frombuffer(b"".join([w for window in by_words for w in window]), np.uint8)
    lengths = np.array([len(w) for w in by_words], np.int64)
    return Windows(content, lengths, [sorted(ids) for _, ids in by_words.values()], text, ends - sizes, ends)


@dataclass
class Index:
    """Prefix shingles of one size, sorted: hash, window, place; and a filter over their hashes."""

    size: int
    keys: np.ndarray
    windows: np.ndarray
    places: np.ndarray
    filter: np.ndarray


def _filter(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
    return bits


def _candidates(hashes: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places in ``hashes`` of values that are in the sorted ``keys``."""
    maybe = np.flatnonzero(bits[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
    at = np.searchsorted(keys, hashes[maybe])
    at[at == len(keys)] = 0
    return maybe[keys[at] == hashes[maybe]]


def prefix_index(windows: Windows, counts: dict[int, int]) -> list[Index]:
    """The rarest shingle of every window; ties go to the smaller hash, then the earlier place."""
    found = []
    for size in range(1, SHINGLE + 1):
        own, window, place = windows.shingles(size)
        if not len(own):
            continue
        often = np.array([counts.get(h, 0) for h in own.tolist()])
        order = np.lexsort((place, own, often, window))
        first = order[np.append(True, window[order][1:] != window[order][:-1])]
        first = first[np.argsort(own[first], kind="stable")]
        found.append(Index(size, own[first], window[first], place[first], _filter(own[first])))
    return found


def _shingle_counts(docs: DataFrame, text: str, windows: Windows) -> dict[int, int]:
    """How often each shingle of the windows occurs in all documents."""
    known = {s: np.unique(windows.shingles(s)[0]) for s in range(1, SHINGLE + 1)}
    known = {s: (keys, _filter(keys)) for s, keys in known.items() if len(keys)}
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        totals = {s: np.zeros(len(keys), np.int64) for s, (keys, _) in sent.value.items()}
        for batch in batches:
            for _, _, rows, _, _, hashes, _ in words(*utf8(batch.column(0)), solid=False):
                for s, (keys, bits) in sent.value.items():
                    own, _ = shingles(hashes, rows, s)
                    hit = own[_candidates(own, keys, bits)]
                    totals[s] += np.bincount(np.searchsorted(keys, hit), minlength=len(keys))
        for s, (keys, _) in sent.value.items():
            some = totals[s] > 0
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(totals[s][some])], ["shingle", "n"])

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "shingle long, n long")
    # One row for each shingle of the block: bounded by BLOCK_WORDS windows of at most WINDOW shingles.
    found = counted.groupBy("shingle").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(found["shingle"].to_numpy().astype(np.uint64).tolist(), found["n"].to_numpy().tolist(), strict=True))


def _spelt_alike(text, starts, ends, place, windows: Windows, window, k: int) -> np.ndarray:
    """Whether words are the ``k``-th ones of windows, byte for byte."""
    ours, cuts = gathered(text, starts[place], ends[place])
    theirs, other = gathered(windows.text, windows.starts[window, k], windows.ends[window, k])
    same = np.diff(cuts) == np.diff(other)
    if not same.all():
        ours, cuts = gathered(text, starts[place[same]], ends[place[same]])
        theirs, _ = gathered(windows.text, windows.starts[window[same], k], windows.ends[window[same], k])
    wrong = np.append(0, np.cumsum(ours != theirs))
    same[same] = wrong[cuts[1:]] == wrong[cuts[:-1]]
    return same


def occurrences(group: tuple, windows: Windows, indexes: list[Index]):
    """Verified (row, first word, window) of a group of :func:`words`, word places counted over the group.

    Words are compared by hash first, and those that agree byte for byte.
    """
    _, n, rows, starts, ends, hashes, text = group
    cuts = np.searchsorted(rows, np.arange(n + 1))
    found = []
    for index in indexes:
        own, places = shingles(hashes, rows, index.size)
        hit = _candidates(own, index.keys, index.filter)
        low, high = np.searchsorted(index.keys, own[hit], "left"), np.searchsorted(index.keys, own[hit], "right")
        many = high - low
        entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        place, window = np.repeat(places[hit], many), index.windows[entry]
        start, row = place - index.places[entry], rows[place]
        length = windows.lengths[window]
        inside = (start >= cuts[row]) & (start + length <= cuts[row + 1])
        start, row, window, length = start[inside], row[inside], window[inside], length[inside]
        for k in range(WINDOW):
            if not len(start):
                break
            place = np.minimum(start + k, len(hashes) - 1)
            same = (k >= length) | (hashes[place] == windows.content[window, k])
            own = np.flatnonzero(same & (k < length))
            same[own] = _spelt_alike(text, starts, ends, place[own], windows, window[own], k)
            start, row, window, length = start[same], row[same], window[same], length[same]
        found.append((row, start, window))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else tuple(np.zeros((3, 0), np.int64))


def mark(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    names: tuple[str, str, str] = ("n_words", "hits", "items"),
) -> DataFrame:
    """Columns ``carry`` of every row (default: all) with ``n_words``, ``hits`` and ``items``, called ``names``.

    ``hits`` are the hit word ranges, as (first, end) counted from 0, in order and merged; ``items`` are the ids of the
    items with occurring windows, as sorted strings.
    """
    spark = docs.sparkSession
    named = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("id"), F.col(f"`{item_text}`").alias("text"))
    # An item's words are at most half its bytes, rounded up.
    most = named.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    n_blocks = max(1, -(-int(most) // BLOCK_WORDS))
    kept = docs.columns if carry is None else carry
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    extra = [] if text in kept else [F.col(f"`{text}`").alias("text")]
    # Inside, columns go by number, so that none can clash.
    marked = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)],
        F.lit(None).cast("long").alias("words"),
        F.lit(None).cast("binary").alias("hits"),
        F.array().cast("array<string>").alias("items"),
        *extra,
    )
    for block in range(n_blocks):
        chosen = named.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == block) if n_blocks > 1 else named
        windows = item_windows([(r["id"], r["text"]) for r in chosen.collect()])  # one block
        indexes = prefix_index(windows, _shingle_counts(docs, text, windows)) if len(windows.lengths) else []
        fields = [T.StructField(f"c{i}", kinds[c]) for i, c in enumerate(kept)] + T.StructType.fromDDL(STATE).fields
        if extra and block < n_blocks - 1:  # the text goes on to the next pass
            fields.append(T.StructField("text", T.StringType()))
        place = len(kept) + 3 if extra else kept.index(text)
        marked = _pass(spark, marked, len(kept), place, T.StructType(fields), windows, indexes)
        if (block + 1) % PASSES == 0 and block < n_blocks - 1:
            marked = materialize(marked, "decontaminate")
    hits = F.from_json(F.col("hits").cast("string"), "array<struct<first:long,end:long>>")
    return marked.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
        F.col("words").alias(names[0]),
        hits.alias(names[1]),
        F.col("items").alias(names[2]),
    )


def _pass(
    spark: SparkSession, marked: DataFrame, n_kept: int, place: int, schema: T.StructType, windows: Windows, indexes: list[Index]
) -> DataFrame:
    """Add the hits of one block of items to those carried along."""
    sent = broadcast(spark, (windows, indexes))
    names = schema.fieldNames()

    def run(batches):
        block, found = opened(sent)
        for batch in batches:
            old_hits, old_items = batch.column(n_kept + 1).to_pylist(), batch.column(n_kept + 2).to_pylist()
            n_words, all_hits, all_items = [], [], []
            for group in words(*utf8(batch.column(place)), solid=False):
                low, n, rows = group[:3]
                cuts = np.searchsorted(rows, np.arange(n + 1))
                n_words.extend(np.diff(cuts).tolist())
                row, start, window = occurrences(group, block, found)
                order = np.lexsort((start, row))
                row, start, window = row[order], start[order], window[order]
                bounds = np.searchsorted(row, np.arange(n + 1))
                for i in range(n):
                    a, b = bounds[i], bounds[i + 1]
                    hits, items = old_hits[low + i], old_items[low + i]
                    if a < b:
                        ends = start[a:b] + block.lengths[window[a:b]]
                        own = list(zip((start[a:b] - cuts[i]).tolist(), (ends - cuts[i]).tolist(), strict=True))
                        hits = _merged(hits, own)
                        items = sorted({*items, *[x for w in set(window[a:b].tolist()) for x in block.items[w]]})
                    all_hits.append(hits or b"[]")
                    all_items.append(items)
            state = [pa.array(n_words, pa.int64()), pa.array(all_hits, pa.binary()), pa.array(all_items, pa.list_(pa.string()))]
            columns = [*batch.columns[:n_kept], *state, *batch.columns[n_kept + 3 :]]
            yield pa.RecordBatch.from_arrays(columns[: len(names)], names)

    return marked.mapInArrow(run, schema)


def _merged(old: bytes | None, new: list[tuple[int, int]]) -> bytes:
    ranges = sorted([*[(r["first"], r["end"]) for r in json.loads(old or b"[]")], *new])
    out: list[list[int]] = []
    for first, end in ranges:
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return json.dumps([{"first": a, "end": b} for a, b in out]).encode()


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit word, with their columns."""
    own, taken = ("__n_words", "__hits", "__items"), {c.lower() for c in docs.columns}
    while taken & set(own):
        own = tuple(f"_{name}" for name in own)
    return mark(docs, items, text, names=own).where(F.size(own[1]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
