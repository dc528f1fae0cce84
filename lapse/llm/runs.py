"""Maximal runs of chosen bytes in a batch of texts (numpy helpers called inside Spark tasks)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa


@dataclass
class Runs:
    """Runs of a batch: byte range of each within ``data``, and its text."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray

    def values(self, translate: np.ndarray | None = None) -> pa.LargeBinaryArray:
        """The bytes of each run, through a 256-entry table if one is given."""
        n = self.end - self.start
        offsets = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=offsets[1:])
        take = np.repeat(self.start - offsets[:-1], n) + np.arange(offsets[-1])
        body = self.data[take]
        if translate is not None:
            body = translate[body]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each, one more than texts); a null text has none."""
    arr = texts.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8))[off[0] : off[-1]]
    return data, off - off[0]


def byte_runs(texts: pa.Array, member: np.ndarray, at_least: int = 1) -> Runs:
    """Maximal runs of bytes with ``member[byte]`` of ``at_least`` bytes, none across two texts."""
    data, off = raw_bytes(texts)
    inside = member[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if at_least > 1:
        long = end - start >= at_least
        start, end = start[long], end[long]
    return Runs(data, off, start, end, np.searchsorted(off, start, side="right") - 1)
