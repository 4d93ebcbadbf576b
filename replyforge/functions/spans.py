"""Words of many texts at once as arrays: places, hashes, and exact look-ups."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Bytes up to which a span is hashed lane by lane together with all others.
LANE_BYTES = 256


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) one after another, and where each text starts and ends."""
    values = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    content = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return content[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of True, cut where texts end."""
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    held = np.zeros(n + 2, bool)
    held[1:-1] = inside
    starts = np.flatnonzero(inside & (~held[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside & (~held[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def scrambled(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hash_spans(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``content[starts:ends]``, a byte array; equal spans have equal hashes wherever they lie.

    Every eight bytes go through a permutation that is no sum over places, so spans of a regular build do not meet as
    they do in polynomial hashes. Equal hashes still do not prove equal spans.
    """
    sizes = ends - starts
    found = scrambled(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    padded = np.zeros(len(content) + 8, np.uint8)
    padded[: len(content)] = content
    lanes = np.ndarray(len(content) + 1, "<u8", padded, strides=(1,))
    own = np.flatnonzero((sizes > 0) & (sizes <= LANE_BYTES))
    at, left, state = starts[own], sizes[own], found[own]
    while len(own):
        lane = lanes[at]
        short = left < 8
        lane[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        state = scrambled(state * np.uint64(0x9FB21C651E98DF25) ^ lane)
        more = left > 8
        found[own[~more]] = state[~more]
        own, at, left, state = own[more], at[more] + 8, left[more] - 8, state[more]
    for i in np.flatnonzero(sizes > LANE_BYTES).tolist():
        found[i] = int.from_bytes(blake2b(content[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return found


def gathered(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of spans one after another, and where each starts and ends there."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return content[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)], offsets


def distinct_words(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each span, equal for equal content, and the bytes of the distinct ones with their offsets."""
    data, offsets = gathered(content, starts, ends)
    buffers = [None, pa.py_buffer(offsets * content.itemsize), pa.py_buffer(np.ascontiguousarray(data))]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    words = coded.dictionary
    places = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    bytes_ = words.buffers()[2]
    held = np.frombuffer(bytes_, np.uint8) if bytes_ else np.zeros(0, np.uint8)
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), held, places


class WordTable:
    """Numbers of a fixed set of words: a sorted array of hashes, with the words' bytes to compare."""

    @classmethod
    def of(cls, words: pa.Array) -> WordTable:
        """The table of a column of distinct texts."""
        return cls(*text_bytes(words))

    def __init__(self, content: np.ndarray, offsets: np.ndarray):
        hashes = hash_spans(content, offsets[:-1], offsets[1:])
        self.numbers = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.numbers]
        self.content, self.starts, self.ends = content, offsets[:-1][self.numbers], offsets[1:][self.numbers]
        same = np.append(np.flatnonzero(np.append(len(hashes) > 0, self.hashes[1:] != self.hashes[:-1])), len(hashes))
        #: Words that share a hash with others, at most.
        self.most = int(np.diff(same).max(initial=0))

    def find(self, content: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for those not in the table."""
        found = np.full(len(offsets) - 1, -1, np.int64)
        if not len(self.hashes):
            return found
        starts, ends = offsets[:-1], offsets[1:]
        hashes = hash_spans(content, starts, ends)
        first = np.searchsorted(self.hashes, hashes)
        for step in range(self.most):
            place = np.minimum(first + step, len(self.hashes) - 1)
            maybe = np.flatnonzero((found < 0) & (self.hashes[place] == hashes) & (self.ends[place] - self.starts[place] == ends - starts))
            here = place[maybe]
            ours, cuts = gathered(content, starts[maybe], ends[maybe])
            theirs, _ = gathered(self.content, self.starts[here], self.ends[here])
            wrong = np.append(0, np.cumsum(ours != theirs))
            equal = wrong[cuts[1:]] == wrong[cuts[:-1]]
            found[maybe[equal]] = self.numbers[here[equal]]
        return found


def fnv_hashes(content: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """32-bit FNV-1a of words, bytes taken as signed ones, as signed numbers: what public n-gram models bucket by."""
    starts, sizes = offsets[:-1], np.diff(offsets)
    # Offset basis and prime of the 32-bit hash.
    basis, prime = 2166136261, 16777619
    state = np.full(len(starts), basis, np.uint32)
    signed = content.view(np.int8).astype(np.int32).view(np.uint32)
    own = np.flatnonzero((sizes > 0) & (sizes <= LANE_BYTES))
    for k in range(int(sizes[own].max(initial=0))):
        own = own[sizes[own] > k]
        state[own] = (state[own] ^ signed[starts[own] + k]) * np.uint32(prime)
    for i in np.flatnonzero(sizes > LANE_BYTES).tolist():
        h = basis
        for byte in signed[starts[i] : starts[i] + sizes[i]].tolist():
            h = (h ^ byte) * prime & 0xFFFFFFFF
        state[i] = h
    return state.view(np.int32)


def run_buckets(hashes: np.ndarray, rows: np.ndarray, longest: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and buckets of all runs of 2 to ``longest`` words: the rolling hash of the words' hashes modulo ``n_buckets``."""
    # Fixed value: multiplier of the rolling hash.
    step = np.uint64(116049371)
    wide = hashes.astype(np.int64).view(np.uint64)
    rolled, found_rows, found = wide.copy(), [], []
    for n in range(2, longest + 1):
        count = len(wide) - n + 1
        if count <= 0:
            break
        rolled = rolled[:count] * step + wide[n - 1 :]
        whole = rows[:count] == rows[n - 1 :]
        found_rows.append(rows[:count][whole])
        found.append((rolled[whole] % np.uint64(n_buckets)).astype(np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_rows]), np.concatenate([none, *found])
