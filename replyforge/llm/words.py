"""Words of many texts as places and hashes."""

from __future__ import annotations

import numpy as np

from replyforge.functions.spans import hash_spans
from replyforge.llm.batches import groups, mixed, per_process


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def _solid() -> np.ndarray:
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def _alnum() -> np.ndarray:
    table = np.zeros(256, bool)
    table[ord("0") : ord("9") + 1] = table[ord("a") : ord("z") + 1] = table[0x80:] = True
    return table


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of True, cut at the texts' ends."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray, solid: bool):
    """Yield (first row, rows, word rows, starts, ends, hashes, bytes) for groups of texts.

    A-Z becomes lower case. With ``solid`` words are cut at white space, else they are runs of ASCII letters, digits
    and all that is not ASCII. Word rows, starts and ends count from the group's first row and byte.
    """
    lower = per_process("lower", _lower)
    inside = per_process("solid", _solid) if solid else per_process("alnum", _alnum)
    for low, high in groups(np.diff(offsets)):
        local = offsets[low : high + 1] - offsets[low]
        text = lower[data[offsets[low] : offsets[high]]]
        starts, ends, rows = spans(inside[text], local)
        yield low, high - low, rows, starts, ends, hash_spans(text, starts, ends), text


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of one text, and the place of their first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = mixed(total * np.uint64(0x2545F4914F6CDD1D) + hashes[k : k + n])
    whole = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return total[whole], whole
