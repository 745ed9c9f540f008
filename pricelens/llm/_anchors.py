"""Winnowed anchors: of every window of ``n`` neighbouring units (words, bytes)
one run of ``k`` units is chosen by its hash, so equal windows have the same
anchor at the same place wherever they stand. Spans of windows on documents are
kept as packed (start, count) pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import _words as W

_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
SPAN = np.dtype([("a", "<u4"), ("n", "<u4")])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (w - have)], x[w - have:]) if w > have else x


def anchors(grams: np.ndarray, offsets: np.ndarray, n: int, k: int) -> tuple[np.ndarray, ...]:
    """(place, first window, number of windows, text) of the anchors of all
    windows that lie inside a text; ``grams`` are the hashes of all ``k``-runs.
    Of equal hashes in a window the first counts."""
    w = n - k + 1
    if len(grams) < w:
        return (np.zeros(0, np.int64),) * 4
    chosen = sliding_min((grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), w)
    place = (chosen & _LOW).astype(np.int64)
    text = W.text_of(np.arange(len(place)), offsets)
    inside = np.flatnonzero(np.arange(len(place)) + n <= offsets[text + 1])
    place, text = place[inside], text[inside]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return place[first], inside[first], np.diff(np.append(first, len(place))), text[first]


def joined_spans(key: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """One row per key with its spans of window starts, neighbours joined."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order].astype(np.int64), (start[order].astype(np.int64) + count[order])
    new = np.ones(len(key), bool)
    if len(key) > 1:
        # the furthest end so far within the key
        _, group = np.unique(key, return_inverse=True)
        far = np.maximum.accumulate(end + group * (1 << 40)) - group * (1 << 40)
        new[1:] = (key[1:] != key[:-1]) | (start[1:] > far[:-1])
        end = far
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(key)) - 1 if len(first) else first
    span = np.zeros(len(first), SPAN)
    span["a"], span["n"] = start[first], end[last] - start[first]
    per_key = np.flatnonzero(np.r_[True, key[first][1:] != key[first][:-1]]) if len(first) else first
    return _rows(key[first][per_key], span, per_key)


def _rows(keys: np.ndarray, records: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    offsets = (np.append(first, len(records)) * records.dtype.itemsize).astype(np.int32)
    pack = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(records.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pack], names=["_ll_key", "spans"])


def by_key(keys: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
    """One row per key with its packed records."""
    order = np.argsort(keys, kind="stable")
    keys, records = keys[order], records[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return _rows(keys[first], records, first)


def of_rows(lists: pa.Array, dtype: np.dtype) -> Iterator[np.ndarray]:
    """The packed records of each row of a list-of-binary column."""
    for row in lists:
        yield np.frombuffer(b"".join(row.as_py() or []), dtype)
