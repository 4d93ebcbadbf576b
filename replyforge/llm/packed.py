"""Exchanging many small values as few rows: arrays cut by bucket."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def split(buckets: np.ndarray, columns: dict[str, np.ndarray], n_buckets: int):
    """Rows ``bucket, <columns as bytes>``, one per bucket that has values; the order inside a bucket is kept."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.searchsorted(buckets[order], np.arange(n_buckets + 1))
    full = np.flatnonzero(np.diff(cuts))
    arrays = [pa.array(full.astype(np.int32))]
    for values in columns.values():
        content = np.ascontiguousarray(values[order])
        size = content.itemsize * (content.shape[1] if content.ndim > 1 else 1)
        # Empty buckets add nothing, so the ends of the full ones are the starts of the next.
        ends = np.append(cuts[full], cuts[-1]) * size
        buffers = [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(content.tobytes())]
        arrays.append(pa.Array.from_buffers(pa.large_binary(), len(full), buffers).cast(pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *columns])


def gather(table: pa.Table, name: str, kind, width: int = 1) -> np.ndarray:
    """All values of a packed column, one after another."""
    content = b"".join(table.column(name).to_pylist())
    values = np.frombuffer(content, kind)
    return values.reshape(-1, width) if width > 1 else values


def schema(columns: list[str]) -> str:
    return ", ".join(["bucket int", *[f"{c} binary" for c in columns]])
