"""Removal of byte strings that documents with a smaller key have, too, by suffix arrays.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller key. Texts are
UTF-8 bytes; matches never cross documents, and are judged on the input, not on what is left.

Equal strings have to meet in one task. The anchor of a string is the leftmost of its substrings of ``GRAM`` bytes with
the smallest hash, so equal strings have equal anchors at equal places. Neighbouring strings mostly share one; a segment
is a run of strings with one anchor, and holds their bytes.

1. Anchors' hashes are exchanged, packed, and those that only one row has are dropped: their strings are nowhere else.
2. Documents take the shared anchors back and send the segments around them to the anchors' tasks. A task of documents
   sends equal segments once, with their smallest key. Its documents with larger keys lose the segment in any case; those
   with the same key take over what is found for the one that was sent. Around an anchor that more than ``HOT`` places
   have, each string is a segment of its own and goes to the task of its hash, so that no task gets an entry per place.
3. There equal segments become one, with the smallest key that has it. The segments of an anchor are put one behind
   the other, and the suffix array of that string is built by Lyndon grouping (``suffix_groups``). Suffixes that begin
   with the same ``LENGTH`` bytes are neighbours in it, and get the smallest key among their segments. An anchor with
   more than ``SPLIT`` segments is first split by the bytes next to it, on the side where each string has them.
4. Strings with a smaller key elsewhere go back to their document as byte ranges, which are merged and cut out.

Rows with a null text have no bytes. Rows with a null key count as larger than all keys, and not against each other;
neither do rows that repeat a key. Texts shorter than ``LENGTH`` lose nothing. Very long texts are worked on whole; a
text is the largest thing that is held at once, besides buckets of bounded size. An empty table gives an empty table.
Other columns are
read only when they are to be carried along, under any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from replyforge.llm import packed
from replyforge.llm.batches import groups, mixed, per_process, powers, span_hashes, utf8
from replyforge.llm.suffix_groups import ranges, suffix_arrays

LENGTH = 50
GRAM = 24
WIDTH = LENGTH - GRAM + 1  # places of a gram in a string
SIDE = (LENGTH - GRAM) // 2
#: Anchors of a bucket, segments of an anchor, places of an anchor, symbols sorted at a time.
BUCKET_ANCHORS = 1 << 20
SPLIT = 64
HOT = 1 << 16
SORT_SYMBOLS = 1 << 19
LAST = np.iinfo(np.int64).max
MASK48 = np.uint64((1 << 48) - 1)
PLACE = np.uint64((1 << 30) - 1)
ODD = np.uint64(1)


def bucket_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mixed(hashes ^ np.uint64(0xA5A5A5A5)) % np.uint64(n_buckets)).astype(np.int64)


def row_names(keys: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A name for each row from key and text; rows that agree in both share it, and its result."""
    out = np.zeros(len(keys), np.uint64)
    for low, high in groups(np.diff(offsets)):
        local = offsets[low : high + 1] - offsets[low]
        out[low:high] = span_hashes(data[offsets[low] : offsets[high]], local[:-1], local[1:])
    return mixed(out + mixed(keys.view(np.uint64)))


def anchors(data: np.ndarray, offsets: np.ndarray):
    """Segments of a group of texts: row, first string, number of strings, place of the anchor, its hash.

    Places count from the group's first byte.
    """
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros((4, 0), np.int64)) + (np.zeros(0, np.uint64),)
    up, down = powers(n + 1)
    values = per_process("symbols", lambda: mixed(np.arange(1, 0x110001, dtype=np.uint64)))[:256]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * up[:n], out=sums[1:])
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    # The smallest hash wins, then the leftmost place.
    best = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach < WIDTH:
        step = min(reach, WIDTH - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    size = np.diff(offsets)
    strings = np.maximum(size - LENGTH + 1, 0)
    first = ranges(offsets[:-1], strings)  # strings inside a text
    place = (best[first] & PLACE).astype(np.int64)
    row = np.repeat(np.arange(len(size)), strings)
    new = np.append(True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])) if len(first) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(first)))
    return row[heads], first[heads], count, place[heads], grams[place[heads]]


def _rows(docs: DataFrame, key: str, text: str, carry: list[str]) -> DataFrame:
    key_column = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(int(LAST)))
    more = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    return docs.select(key_column.alias("key"), F.col(f"`{text}`").alias("text"), *more)


def _texts(rows: DataFrame, n_buckets: int) -> DataFrame:
    """Packed texts by document bucket, with the columns behind the text as Arrow streams."""
    carried = rows.columns[2:]

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().astype(np.int64)
            data, offsets = utf8(batch.column(1))
            names = row_names(keys, data, offsets)
            bucket = bucket_of(names, n_buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            out = []
            for b in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[b] : cuts[b + 1]]
                body = b"".join([data[offsets[i] : offsets[i + 1]].tobytes() for i in own])
                more = _stream(batch.select(carried).take(pa.array(own))) if carried else b""
                sizes = np.diff(offsets)[own].tobytes()
                out.append((int(b), keys[own].tobytes(), names[own].tobytes(), sizes, zstandard.compress(body, 3), more))
            columns = [pa.array([r[k] for r in out], pa.int32() if not k else pa.binary()) for k in range(6)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "keys", "names", "sizes", "body", "more"])

    return rows.mapInArrow(run, packed.schema(["keys", "names", "sizes", "body", "more"]))


def _stream(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.compress(sink.getvalue().to_pybytes(), 1)


def _unpacked_texts(table: pa.Table):
    keys, names = packed.gather(table, "keys", np.int64), packed.gather(table, "names", np.uint64)
    body = b"".join([zstandard.decompress(b) for b in table.column("body").to_pylist()])
    return keys, names, np.append(0, np.cumsum(packed.gather(table, "sizes", np.int64))), np.frombuffer(body, np.uint8)


def _anchor_rows(rows: DataFrame, n_buckets: int) -> DataFrame:
    """Packed anchor hashes by anchor bucket, with the rows that have them."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().astype(np.int64)
            data, offsets = utf8(batch.column(1))
            names = row_names(keys, data, offsets)
            found = []
            for low, high in groups(np.diff(offsets)):
                row, _, _, _, grams = anchors(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                found.append((row + low, grams))
            if not found:
                continue
            row, grams = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            bucket = bucket_of(grams, n_buckets)
            order = np.lexsort((row, bucket))
            row, grams, bucket = row[order], grams[order], bucket[order]
            heads = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1]))) if len(row) else row
            counts = np.diff(np.append(heads, len(row))).astype(np.int32)
            who = packed.split(bucket[heads], {"names": names[row[heads]], "counts": counts}, n_buckets)
            what = packed.split(bucket, {"grams": (grams & MASK48).view(np.uint8).reshape(-1, 8)[:, :6]}, n_buckets)
            yield pa.RecordBatch.from_arrays([*who.columns, what.column(1)], [*who.schema.names, "grams"])

    return rows.mapInArrow(run, packed.schema(["names", "counts", "grams"]))


def _shared(anchor_rows: DataFrame, n_buckets: int) -> DataFrame:
    """For each row marks of the anchors that another row has, packed by document bucket; those of hot anchors are odd."""
    hot = HOT

    def run(table: pa.Table) -> pa.Table:
        counts, raw = packed.gather(table, "counts", np.int32), packed.gather(table, "grams", np.uint8, 6)
        grams = np.zeros((len(raw), 8), np.uint8)
        grams[:, :6] = raw
        grams = grams.view(np.uint64).ravel()
        names = np.repeat(packed.gather(table, "names", np.uint64), counts)
        order = np.argsort(grams)
        grams, names = grams[order], names[order]
        heads = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, np.int64)
        several = np.minimum.reduceat(names, heads) != np.maximum.reduceat(names, heads) if len(heads) else np.zeros(0, bool)
        places = np.diff(np.append(heads, len(grams)))
        keep = np.repeat(several, places)
        marks = mark_of(grams[keep], names[keep]) | np.repeat(places > hot, places)[keep].astype(np.uint64)
        return pa.Table.from_batches([packed.split(bucket_of(names[keep], n_buckets), {"marks": marks}, n_buckets)])

    return anchor_rows.groupBy("bucket").applyInArrow(run, packed.schema(["marks"]))


def mark_of(grams: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Even marks of anchors in rows."""
    return mixed((grams & MASK48) * np.uint64(3) + names) & ~ODD


SEGMENT = ["grams", "keys", "names", "places", "counts", "offsets", "body", "starts", "ends", "copies"]


def _segments(texts: DataFrame, shared: DataFrame, n_buckets: int) -> DataFrame:
    """Segments around shared anchors, packed by anchor bucket: of equal ones in a task one with the smallest key.

    Buckets from ``n_buckets`` on are document buckets: ranges of bytes that are known to go (``starts``, ``ends``), and
    ``copies`` of what was sent (name, place, then name, place and strings of the one sent).
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return SEGMENT_SCHEMA.empty_table()
        marks = np.sort(packed.gather(right, "marks", np.uint64))
        keys, names, offsets, data = _unpacked_texts(left)
        found = []
        for low, high in groups(np.diff(offsets)):
            start = offsets[low]
            part = data[start : offsets[high]]
            row, first, count, place, grams = anchors(part, offsets[low : high + 1] - start)
            mark = mark_of(grams, names[low + row])
            at = np.searchsorted(marks, mark)
            at[at == len(marks)] = 0
            keep = np.flatnonzero((marks[at] & ~ODD) == mark)
            if not len(keep):
                continue
            single = (marks[at[keep]] & ODD) == ODD
            row, first, count, place, grams = (x[keep] for x in (row, first, count, place, grams))
            # Strings around hot anchors one by one, under a name of their own.
            times = np.where(single, count, 1)
            first = ranges(first, times)
            single = np.repeat(single, times)
            row, place, grams, count = (np.repeat(x, times) for x in (row, place, grams, count))
            count[single] = 1
            content = span_hashes(part, first, first + count + LENGTH - 1)
            grams = np.where(single, mixed(content ^ np.uint64(0x5851F42D4C957F2D)), grams)
            found.append((low + row, first + start, count.astype(np.uint8), (place - first).astype(np.int8), grams, mixed(content ^ grams)))
        if not found:
            return SEGMENT_SCHEMA.empty_table()
        row, first, count, anchor, grams, content = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        where = first - offsets[row]
        order = np.lexsort((where, names[row], keys[row], content))
        row, first, count, anchor, grams, content, where = (x[order] for x in (row, first, count, anchor, grams, content, where))
        head = np.append(True, content[1:] != content[:-1])
        one = np.flatnonzero(head)[np.cumsum(head) - 1]
        sent = np.flatnonzero(head)
        later = keys[row] > keys[row[one]]
        again = ~later & ~head & ((names[row] != names[row[one]]) | (where != where[one]))
        batches = [_known(names[row[later]], where[later], count[later], n_buckets)]
        batches.append(_copies(names[row], where, count, one, np.flatnonzero(again), n_buckets))
        sent = sent[np.argsort(first[sent], kind="stable")]
        for low, high in groups(count[sent].astype(np.int64) + LENGTH - 1):
            i = sent[low:high]
            own = row[i]
            batches.append(_packed_segments(data, first[i], where[i], count[i], anchor[i], grams[i], names[own], keys[own], n_buckets))
        return pa.Table.from_batches(batches, SEGMENT_SCHEMA)

    return texts.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(run, packed.schema(SEGMENT))


SEGMENT_SCHEMA = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in SEGMENT]])


def _padded(rows: pa.RecordBatch, shift: int = 0) -> pa.RecordBatch:
    """Packed rows with all columns of ``SEGMENT_SCHEMA``."""
    columns = {c: rows.column(i) for i, c in enumerate(rows.schema.names)}
    columns["bucket"] = pa.array(rows.column(0).to_numpy() + np.int32(shift), pa.int32())
    empty = pa.array([b""] * rows.num_rows, pa.binary())
    return pa.RecordBatch.from_arrays([columns.get(c, empty) for c in SEGMENT_SCHEMA.names], schema=SEGMENT_SCHEMA)


def _known(names: np.ndarray, first: np.ndarray, count: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """Ranges of bytes of whole segments, by document bucket; neighbours become one."""
    order = np.lexsort((first, names))
    names, first, end = names[order], first[order], (first + count)[order]
    head = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (first[1:] > end[:-1]))) if len(names) else first
    last = np.append(head[1:], len(names)) - 1 if len(names) else head
    columns = {"names": names[head], "starts": first[head].astype(np.int64), "ends": (end[last] + LENGTH - 1).astype(np.int64)}
    return _padded(packed.split(bucket_of(columns["names"], n_buckets), columns, n_buckets), n_buckets)


def _copies(names, places, counts, one, again, n_buckets: int) -> pa.RecordBatch:
    rep = one[again]
    what = np.stack([names[again], places[again].astype(np.uint64), names[rep], places[rep].astype(np.uint64), counts[rep].astype(np.uint64)], 1)
    return _padded(packed.split(bucket_of(names[again], n_buckets), {"copies": what}, n_buckets), n_buckets)


def _packed_segments(data, first, places, counts, anchor, grams, names, keys, n_buckets: int) -> pa.RecordBatch:
    bucket = bucket_of(grams, n_buckets)
    order = np.argsort(bucket, kind="stable")
    size = counts.astype(np.int64) + LENGTH - 1
    columns = {
        "grams": grams,
        "keys": keys,
        "names": names,
        "places": places.astype(np.uint32),
        "counts": counts,
        "offsets": anchor,
    }
    rows = packed.split(bucket, columns, n_buckets)
    body = data[ranges(first[order], size[order])]
    cuts = np.searchsorted(bucket[order], np.append(rows.column(0).to_numpy(), n_buckets))
    ends = np.append(0, np.cumsum(size[order]))[cuts]
    bodies = [zstandard.compress(body[a:b].tobytes(), 1) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return _padded(pa.RecordBatch.from_arrays([*rows.columns, pa.array(bodies, pa.binary())], [*rows.schema.names, "body"]))


def _equal_starts(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the ``LENGTH`` symbols from ``a`` and from ``b`` on are the same, byte by byte."""
    same = np.zeros(len(a), bool)
    open_ = np.arange(len(a))
    for k in range(LENGTH):
        open_ = open_[text[a[open_] + k] == text[b[open_] + k]]
    same[open_] = True
    return same


def least_keys(body: np.ndarray, offsets: np.ndarray, counts: np.ndarray, grams: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For every string of every segment the smallest key of a segment of its group that has the string.

    Segments are ordered by group (``grams``); ``key`` is a segment's own. Groups are cut into lots of about
    ``SORT_SYMBOLS`` symbols, each sorted in one go.
    """
    out = np.repeat(key, counts)
    string_offsets = np.append(0, np.cumsum(counts))
    size = np.diff(offsets)
    heads = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    members = np.diff(np.append(heads, len(grams)))
    symbols = np.add.reduceat(size + 1, heads)
    # A group of one segment is in order as it is, and its strings have its key.
    several = np.flatnonzero(members > 1)
    several = several[np.argsort(symbols[several], kind="stable")]
    for low, high in groups(symbols[several], SORT_SYMBOLS):
        lot = several[low:high]
        own = ranges(heads[lot], members[lot])
        places = np.cumsum(size[own] + 1) - (size[own] + 1)
        text = np.ones(int((size[own] + 1).sum()), np.int64)  # 1 stands behind each segment
        text[ranges(places, size[own])] = body[ranges(offsets[own], size[own])].astype(np.int64) + 2
        order = suffix_arrays(text, symbols[lot])
        # Where strings start, and which.
        string = np.full(len(text), -1, np.int64)
        string[ranges(places, counts[own])] = ranges(string_offsets[own], counts[own])
        order = order[string[order] >= 0]
        whose = np.repeat(lot, symbols[lot])
        near = whose[order[1:]] == whose[order[:-1]]
        near[near] = _equal_starts(text, order[:-1][near], order[1:][near])
        runs = np.flatnonzero(np.append(True, ~near))
        ordered = string[order]
        least = np.minimum.reduceat(out[ordered], runs)
        out[ordered] = np.repeat(least, np.diff(np.append(runs, len(ordered))))
    return out


def _found(segments: DataFrame, n_buckets: int) -> DataFrame:
    """Byte ranges to remove and copies of what was sent, packed by document bucket."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= n_buckets:  # known already
            back = pa.array([bucket - n_buckets] * table.num_rows, pa.int32())
            return pa.table([back, *[table.column(c) for c in FOUND]], names=["bucket", *FOUND])
        grams, keys, names = (packed.gather(table, c, k) for c, k in (("grams", np.uint64), ("keys", np.int64), ("names", np.uint64)))
        places, counts, anchor = (
            packed.gather(table, c, k).astype(np.int64) for c, k in (("places", np.uint32), ("counts", np.uint8), ("offsets", np.int8))
        )
        sizes = counts + LENGTH - 1
        body = np.frombuffer(b"".join([zstandard.decompress(b) for b in table.column("body").to_pylist()]), np.uint8)
        offsets = np.append(0, np.cumsum(sizes))

        # Equal segments become one, with the smallest key.
        content = np.zeros(len(grams), np.uint64)
        for low, high in groups(sizes):
            local = offsets[low : high + 1] - offsets[low]
            content[low:high] = span_hashes(body[offsets[low] : offsets[high]], local[:-1], local[1:])
        content = mixed(content ^ grams)
        order = np.lexsort((keys, content, grams))
        fresh = np.append(True, (content[order][1:] != content[order][:-1]) | (grams[order][1:] != grams[order][:-1]))
        one = order[fresh]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(fresh) - 1
        least = _split_and_sort(body, offsets[one], sizes[one], counts[one], anchor[one], grams[one], keys[one])

        # Strings of a segment with a smaller key elsewhere, as ranges of bytes.
        string_offsets = np.append(0, np.cumsum(counts[one]))
        segment = np.repeat(np.arange(len(grams)), counts)
        string = ranges(string_offsets[which], counts)
        within = string - string_offsets[which][segment]
        hit = least[string] < keys[segment]
        segment, at = segment[hit], (places[segment] + within)[hit]
        head = np.flatnonzero(np.append(True, (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1))) if len(at) else at
        last = np.append(head[1:], len(at)) - 1 if len(at) else at
        columns = {"names": names[segment[head]], "starts": at[head], "ends": at[last] + LENGTH}
        rows = _padded(packed.split(bucket_of(columns["names"], n_buckets), columns, n_buckets))
        return pa.Table.from_batches([rows]).select(["bucket", *FOUND])

    return segments.groupBy("bucket").applyInArrow(run, packed.schema(FOUND))


FOUND = ["names", "starts", "ends", "copies"]


def _passed_on(names: np.ndarray, starts: np.ndarray, ends: np.ndarray, copies: np.ndarray):
    """The ranges, in order of name and start, and those that copies take over from the segments that were sent."""
    owner, source = copies[:, 0], copies[:, 2]
    place, at, count = (copies[:, k].astype(np.int64) for k in (1, 3, 4))
    known = np.unique(names)
    if not len(known):
        return names, starts, ends
    number = np.searchsorted(known, source)
    number[number == len(known)] = 0
    there = known[number] == source
    line = np.searchsorted(known, names).astype(np.int64) << 32 | starts
    low, high = (np.searchsorted(line, number << 32 | to) for to in (at, at + count))
    times = np.where(there, high - low, 0)
    which, shift = ranges(low, times), np.repeat(place - at, times)
    names, starts, ends = (
        np.append(names, np.repeat(owner, times)), np.append(starts, starts[which] + shift), np.append(ends, ends[which] + shift)
    )
    order = np.lexsort((starts, names))
    return names[order], starts[order], ends[order]


def _split_and_sort(body, starts, sizes, counts, anchor, grams, keys) -> np.ndarray:
    """Smallest keys of all strings; anchors with many segments are split first."""
    heads = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    many = np.repeat(np.diff(np.append(heads, len(grams))) > SPLIT, np.diff(np.append(heads, len(grams))))
    string_offsets = np.append(0, np.cumsum(counts))
    least = np.repeat(keys, counts)

    def sort(first, number, group, key, place):
        """Segments as (first byte, strings, group, key, place of the results)."""
        order = np.argsort(group, kind="stable")
        first, number, group, key, place = (x[order] for x in (first, number, group, key, place))
        size = number + LENGTH - 1
        text = body[ranges(first, size)]
        found = least_keys(text, np.append(0, np.cumsum(size)), number, group, key)
        least[ranges(place, number)] = found

    few = np.flatnonzero(~many)
    if len(few):
        sort(starts[few], counts[few], grams[few], keys[few], string_offsets[few])
    if many.any():
        own = np.flatnonzero(many)
        # A string whose anchor lies at most SIDE bytes behind its start has SIDE bytes behind the anchor, the others
        # have them in front. ``anchor`` counts from the segment's first string; later strings lie nearer to it.
        right = np.clip(anchor[own] - SIDE, 0, counts[own])  # strings from here on have the bytes behind
        gram_at = starts[own] + anchor[own]
        for side, first, number, bytes_at in (
            (1, np.zeros(len(own), np.int64), right, gram_at - SIDE),
            (2, right, counts[own] - right, gram_at + GRAM),
        ):
            some = np.flatnonzero(number > 0)
            if len(some):
                near = span_hashes_at(body, bytes_at[some], SIDE)
                group = mixed(grams[own[some]] * np.uint64(3) + near * np.uint64(5) + np.uint64(side))
                at = own[some]
                sort(starts[at] + first[some], number[some], group, keys[at], string_offsets[at] + first[some])
    return least


def span_hashes_at(body: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` bytes from each start on."""
    total = np.full(len(starts), size, np.uint64)
    for k in range(size):
        total = mixed(total * np.uint64(257) + body[starts + k].astype(np.uint64))
    return total


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges covered by ranges in order of their starts."""
    reach = np.maximum.accumulate(ends)
    head = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return starts[head], reach[np.append(head[1:], len(starts)) - 1]


OUTPUTS = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string", "kept_text": "string"}


def _cut(texts: DataFrame, found: DataFrame, outputs: list[str], carried: StructType) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"key": [], **{c: [] for c in outputs}}
        if left.num_rows:
            keys, names, offsets, data = _unpacked_texts(left)
            who, starts, ends = (
                (packed.gather(right, c, k) for c, k in (("names", np.uint64), ("starts", np.int64), ("ends", np.int64)))
                if right.num_rows
                else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            )
            order = np.lexsort((starts, who))
            who, starts, ends = who[order], starts[order], ends[order]
            if right.num_rows:
                who, starts, ends = _passed_on(who, starts, ends, packed.gather(right, "copies", np.uint64, 5))
            low, high = np.searchsorted(who, names, "left"), np.searchsorted(who, names, "right")
            for i in range(len(keys)):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                parts, at, n_removed, n_spans = [], 0, 0, 0
                if low[i] < high[i]:
                    a, b = merged(starts[low[i] : high[i]], ends[low[i] : high[i]])
                    n_removed, n_spans = int((b - a).sum()), len(a)
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        parts.append(text[at:x])
                        at = y
                parts.append(text[at:])
                kept = b"".join(parts)
                made = {
                    "n_bytes": len(text),
                    "n_removed": n_removed,
                    "n_spans": n_spans,
                    "kept_sha256": hashlib.sha256(kept).hexdigest() if "kept_sha256" in out else "",
                    # A cut may fall inside a character; what is left of it goes, too.
                    "kept_text": kept.decode("utf-8", "ignore") if "kept_text" in out else "",
                }
                out["key"].append(None if keys[i] == LAST else int(keys[i]))
                for c in outputs:
                    out[c].append(made[c])
        kinds = [pa.int64(), *[pa.string() if OUTPUTS[c] == "string" else pa.int64() for c in outputs]]
        made = pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))
        if not len(carried):
            return made
        streams = [pa.ipc.open_stream(zstandard.decompress(m)).read_all() for m in left.column("more").to_pylist()]
        more = pa.concat_tables(streams) if streams else to_arrow_schema(carried).empty_table()
        return pa.table([*made.columns, *more.columns], names=[*made.schema.names, *carried.names])

    schema = StructType([*StructType.fromDDL(", ".join(["key long", *[f"{c} {OUTPUTS[c]}" for c in outputs]])), *carried])
    return texts.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(run, schema)


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    outputs: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept_text"),
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: the key, the asked outputs and the columns in ``carry``. Keys are long integers."""
    carry = carry or []
    rows = _rows(docs, key, text, carry)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(64, -(-total // (BUCKET_ANCHORS * WIDTH // 2)))
    texts = _texts(rows, n_buckets)
    rows = rows.select("key", "text")
    shared = _shared(_anchor_rows(rows, n_buckets), n_buckets)
    found = _found(_segments(texts, shared, n_buckets), n_buckets)
    kinds = {f.name: f for f in docs.schema.fields}
    carried = StructType([StructField(f"c{i}", kinds[c].dataType) for i, c in enumerate(carry)])
    names = [c for c in OUTPUTS if c in outputs]
    cut = _cut(texts, found, names, carried)
    return cut.select(
        F.col("key").alias(key), *names, *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)]
    )
