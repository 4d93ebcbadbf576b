"""Helpers for Arrow steps: state of a worker process, texts as byte arrays, pieces of bounded size."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Characters or bytes worked on at a time; bounds the memory of the array steps.
CHUNK = 1 << 19


def per_process(key, make: Callable):
    """Build something once per Python worker, also when the code of a step is sent by value with every task."""
    holder = sys.modules.setdefault("_replyforge_llm_state", types.ModuleType("_replyforge_llm_state"))
    state = holder.__dict__.setdefault("state", {})
    if key not in state:
        state[key] = make()
    return state[key]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and its offsets, without a copy where Arrow allows."""
    values = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def groups(sizes: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Neighbouring rows whose sizes add up to about ``limit``; a larger row stands alone."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        base = ends[at] - sizes[at]
        end = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield at, end
        at = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


BASE = 0x9E3779B97F4A7C15 | 1


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse modulo 2**64, at least ``n`` of them; kept up to two chunks."""

    def made(size: int):
        up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)

    if n > 2 * CHUNK:
        return made(n)
    return per_process("powers", lambda: made(2 * CHUNK))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``symbols[starts:ends]``; equal spans get equal hashes wherever they lie."""
    up, down = powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    values = per_process("symbols", lambda: mixed(np.arange(1, 0x110001, dtype=np.uint64)))
    np.cumsum(values[symbols] * up[: len(symbols)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
