"""Dealing fixed-width records to hash buckets in packed form.

A map task packs the records that it has for a bucket into one binary value, so
a record costs its own bytes and no more, and a reduce task sees a bucket's
packs together. The number of buckets follows the number of records, so a
bucket stays at some 10 to 30 MB whatever the input. Callers combine records of
one key within a batch first; a hot key then sends one record per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "key bigint, pack binary"
#: Records in a bucket, roughly, and buckets at least.
BUCKET_RECORDS, BUCKETS = 1 << 20, 256


def buckets_for(records: float) -> int:
    """A power of two of buckets for so many records."""
    return max(BUCKETS, 1 << max(0, int(np.ceil(np.log2(max(records, 1) / BUCKET_RECORDS)))))


def packs(hashes: np.ndarray, records: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The records, dealt by the top bits of their hashes; ``records`` is a
    structured array as long as ``hashes``."""
    key = (hashes >> np.uint64(64 - int(buckets).bit_length() + 1)).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, raw, width = key[order], records[order].tobytes(), records.dtype.itemsize
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    offsets = np.append(first, len(key)) * width
    if offsets[-1] >= 1 << 31:
        raise ValueError("a batch has more than 2 GB of records")
    pack = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])
    return pa.RecordBatch.from_arrays([pa.array(key[first]), pack], names=["key", "pack"])


def tabled_packs(hashes: np.ndarray, records: np.ndarray, buckets: int, table: np.ndarray) -> pa.RecordBatch:
    """Like :func:`packs` for records whose field ``doc`` numbers a row of
    ``table``; each pack starts with the table's rows that it needs."""
    key = (hashes >> np.uint64(64 - int(buckets).bit_length() + 1)).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, records = key[order], records[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    out = []
    for a, b in zip(first, np.append(first[1:], len(key))):
        part = records[a:b].copy()
        docs, part["doc"] = np.unique(part["doc"], return_inverse=True)
        out.append(np.uint32(len(docs)).tobytes() + table[docs].tobytes() + part.tobytes())
    return pa.RecordBatch.from_arrays([pa.array(key[first], pa.int64()), pa.array(out, pa.binary())], names=["key", "pack"])


def open_tabled(pack: bytes, table: np.dtype, record: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(pack, "<u4", 1)[0])
    return np.frombuffer(pack, table, n, 4), np.frombuffer(pack, record, -1, 4 + n * table.itemsize)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that 16 bits number them."""
    for b in batches:
        for a in range(0, len(b), rows):
            yield b.slice(a, rows)


def aside(records: np.ndarray, spread: int) -> pa.RecordBatch:
    """Records that are results already: they pass under negative keys."""
    if not len(records):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.binary())], names=["key", "pack"])
    return pa.RecordBatch.from_arrays([pa.array([-1 - spread % 65_521], pa.int64()), pa.array([records.tobytes()], pa.binary())], names=["key", "pack"])


def exchange(packed: DataFrame, reduce: Callable[[int, list[bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring each bucket's packs together; ``reduce(key, packs)`` yields batches of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for b in batches:
            keys, values = b.column(0).to_numpy(), b.column(1)
            for i in range(len(keys)):
                if last is not None and keys[i] != last:
                    yield from reduce(last, held)
                    held = []
                last = int(keys[i])
                held.append(values[i].as_py())
        if held:
            yield from reduce(last, held)

    return packed.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


def groups(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of each group of equal neighbours, and the group of each position."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1
