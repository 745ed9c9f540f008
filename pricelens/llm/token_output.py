"""Token-id output as Arrow IPC files of equal-length sequences.

Documents are range-partitioned and sorted by id, encoded, ended with an end id
and packed one after the other into sequences of ``length`` ids. A file holds
record batches of fixed-size lists (ids and a mask that is false only on the
padding of the file's last sequence), so a memory-mapped file gives any
sequence without copying. Beside each sequence stand the documents that start
in it, which makes a file self-contained.

Every attempt of a task writes files with names of its own; only the files
named in the manifest, which Spark commits, are ever read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import filesystem, settle
from ._tokens import encoder

LENGTH, BATCH_SEQUENCES, FILE_TOKENS = 2048, 256, 1 << 26


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) range-partitioned and sorted by id; equal ids are ordered by
    their texts' hashes and may be spread over partitions."""
    tie = [F.xxhash64("_ll_text"), F.monotonically_increasing_id()]
    narrow = docs.select(F.col(id_col).alias("_ll_id"), F.col(text_col).alias("_ll_text"))
    keyed = narrow.select("*", tie[0].alias("_ll_hash"), tie[1].alias("_ll_tie"))
    order = ["_ll_id", "_ll_hash", "_ll_tie"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("_ll_id", "_ll_text")


class _File:
    """One Arrow file that is being written."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, id_type: pa.DataType, length: int):
        self.path, self.dtype, self.length = f"{folder}/{name}", dtype, length
        kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.doc = pa.struct([("id", id_type), ("at", pa.int64()), ("n", pa.int64())])
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length)), ("docs", pa.list_(self.doc))])
        fs, where = filesystem(self.path)
        fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.sink = fs.open_output_stream(where, compression=None)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.waiting, self.bytes, self.sequences, self.tokens, self.docs = [], 0, 0, 0, []
        self.n_docs, self.first, self.last = 0, None, None

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.docs.append((doc_id, self.tokens, n))
        self.first, self.last, self.n_docs = (doc_id if not self.n_docs else self.first), doc_id, self.n_docs + 1
        self.tokens += n
        self.waiting.append(ids)
        self.bytes += len(ids)
        if self.bytes >= BATCH_SEQUENCES * self.length * self.dtype.itemsize:
            self.flush()

    def flush(self, last: bool = False) -> None:
        have = np.frombuffer(b"".join(self.waiting), self.dtype)
        n = -(-len(have) // self.length) if last else len(have) // (self.length * BATCH_SEQUENCES) * BATCH_SEQUENCES
        take = have[:n * self.length]
        rest = have[n * self.length:]
        for a in range(0, n, BATCH_SEQUENCES):
            rows = min(BATCH_SEQUENCES, n - a)
            part = take[a * self.length:(a + rows) * self.length]
            mask = np.arange(rows * self.length) < len(part)
            part = np.concatenate([part, np.zeros(rows * self.length - len(part), self.dtype)])
            begin = (self.sequences + np.arange(rows + 1)) * self.length
            mine = [d for d in self.docs if d[1] < begin[-1]]
            self.docs = self.docs[len(mine):]
            at = np.searchsorted([d[1] for d in mine], begin).astype(np.int32) if mine else np.zeros(rows + 1, np.int32)
            at[0] = 0
            items = pa.StructArray.from_arrays([pa.array([d[i] for d in mine], self.doc.field(i).type) for i in range(3)], fields=list(self.doc))
            self.writer.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(part), type=self.schema.field("ids").type),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field("mask").type),
                pa.ListArray.from_arrays(pa.array(at), items)], schema=self.schema))
            self.sequences += rows
        self.waiting, self.bytes = [rest.tobytes()], rest.nbytes

    def close(self) -> None:
        self.flush(last=True)
        self.writer.close()
        self.sink.close()


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          length: int = LENGTH, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write ``docs`` below ``folder``; returns the manifest, one row per file in
    order: path, part, seq, n_docs, n_tokens, n_sequences and tokens_before.

    A null text is an empty document (its end id only); a null id ranks first;
    repeated rows are written each time; an empty table writes no file. Columns
    other than id and text are not written. The manifest is itself a table in
    the shared folder, and the files that it does not name are leftovers of
    failed attempts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, attempt, out, made = encoder(tokenizer), TaskContext.get().partitionId(), uuid.uuid4().hex[:12], None, []
        end = np.array([end_id], e.dtype).tobytes()
        for b in batches:
            ids = b.column(0)
            for i, own in enumerate(e.encode(b.column(1))):
                if out is None or out.tokens >= file_tokens:
                    if out is not None:
                        out.close()
                    out = _File(folder, f"tokens-{part:06d}-{len(made):04d}-{attempt}.arrow", e.dtype, ids.type, length)
                    made.append(out)
                out.add(ids[i].as_py(), own + end)
        if out is not None:
            out.close()
        if made:
            yield pa.RecordBatch.from_arrays([
                pa.array([f.path for f in made]), pa.array([part] * len(made), pa.int32()), pa.array(range(len(made)), pa.int32()),
                *[pa.array([getattr(f, k) for f in made], pa.int64()) for k in ("n_docs", "tokens", "sequences")]],
                names=["path", "part", "seq", "n_docs", "n_tokens", "n_sequences"])

    files = in_order(docs, id_col, text_col).mapInArrow(encode, "path string, part int, seq int, n_docs bigint, n_tokens bigint, n_sequences bigint")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return settle(files, "token-files").withColumn("tokens_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per document of the files: doc_id, start (ids before it in the
    whole output), n_tokens and ids_crc32 of its ids as 32-bit integers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, where = filesystem(path)
                with fs.open_input_file(where) as f:
                    reader = pa.ipc.open_file(f)
                    open_docs, crc, left, ids, at, n, sums = [], 0, 0, [], [], [], []
                    for k in range(reader.num_record_batches):
                        r = reader.get_batch(k)
                        valid = r.column(1).flatten().to_numpy(zero_copy_only=False)
                        tokens = r.column(0).flatten().to_numpy()[valid].astype("<u4")
                        open_docs += [(d["id"], d["at"], d["n"]) for d in r.column(2).flatten().to_pylist()]
                        pos, done = 0, 0
                        while pos < len(tokens):
                            doc = open_docs[done]
                            take = min(left or doc[2], len(tokens) - pos)
                            left = (left or doc[2]) - take
                            crc = zlib.crc32(tokens[pos:pos + take], crc)
                            pos += take
                            if not left:
                                ids.append(doc[0]), at.append(before + doc[1]), n.append(doc[2]), sums.append(crc)
                                crc, done = 0, done + 1
                        open_docs = open_docs[done:]
                        if ids:
                            yield pa.RecordBatch.from_arrays([pa.array(ids, types["doc_id"]), *[pa.array(x, pa.int64()) for x in (at, n, sums)]], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                            ids, at, n, sums = [], [], [], []

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    types = {"doc_id": to_arrow_type(_parse_datatype_string(id_type))}
    files = manifest.select("path", "tokens_before")
    files = files.repartition(max(1, files.count()), "path")  # a task for each file; paths alone would be coalesced
    return files.mapInArrow(scan, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def sequence(path: str, index: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``index`` of a local file, by memory map: the
    ids are a view of the file."""
    reader = pa.ipc.open_file(pa.memory_map(path.removeprefix("file://")))
    batch = reader.get_batch(index // BATCH_SEQUENCES)
    i = index % BATCH_SEQUENCES
    return batch.column(0)[i].values.to_numpy(), batch.column(1)[i].values.to_numpy(zero_copy_only=False)
