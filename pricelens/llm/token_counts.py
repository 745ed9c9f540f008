"""Token counts of flat, unindexed token files.

A file is nothing but little-endian token ids; a document ends with the
separator id. Files are cut into blocks of fixed length whatever they hold;
each block is searched for separators with one vectorised comparison, and a
prefix scan over the blocks of a file (the last separator before each block,
and how many came before) stitches the documents that cross blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import filesystem, settle
from ._tokens import encoder

BLOCK_TOKENS, FILE_BYTES = 1 << 20, 1 << 28
#: Blocks that a task searches, roughly.
TASK_BLOCKS = 8


def write_flat(docs: DataFrame, tokenizer: str, folder: str, separator: int, id_col: str = "doc_id", text_col: str = "text",
               file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write flat token files in the order of the table, without moving a text;
    returns one row per document with its place: path, part, seq, ordinal (its
    number in the file) and doc_id.

    Special tokens' strings are encoded as ordinary text, so the separator
    occurs only at the ends. A null text is an empty document; null ids are
    allowed; repeated rows are written each time; an empty table writes nothing.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, attempt, seq = encoder(tokenizer, True), TaskContext.get().partitionId(), uuid.uuid4().hex[:12], -1
        end, sink, size, n = np.array([separator], e.dtype).tobytes(), None, 0, 0
        try:
            for b in batches:
                where, seqs, number = [], [], []
                for own in e.encode(b.column(1)):
                    if sink is None or size >= file_bytes:
                        if sink is not None:
                            sink.close()
                        seq, size, n = seq + 1, 0, 0
                        path = f"{folder}/flat-{part:06d}-{seq:04d}-{attempt}.bin"
                        fs, local = filesystem(path)
                        fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
                        sink = fs.open_output_stream(local, compression=None, buffer_size=1 << 20)
                    sink.write(own + end)
                    where.append(path), seqs.append(seq), number.append(n)
                    size, n = size + len(own) + len(end), n + 1
                yield pa.RecordBatch.from_arrays([pa.array(where, pa.string()), pa.array([part] * len(where), pa.int32()), pa.array(seqs, pa.int32()), pa.array(number, pa.int64()), b.column(0)],
                                                 names=["path", "part", "seq", "ordinal", "doc_id"])
        finally:
            if sink is not None:
                sink.close()

    narrow = docs.select(F.col(id_col).alias("_ll_id"), F.col(text_col).alias("_ll_text"))
    return settle(narrow.mapInArrow(encode, f"path string, part int, seq int, ordinal bigint, doc_id {id_type}"), "flat-documents")


def file_sizes(paths: DataFrame) -> DataFrame:
    """(path, n_bytes) of the files named in ``paths``."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = []
            for path in b.column(0).to_pylist():
                fs, local = filesystem(path)
                sizes.append(fs.get_file_info(local).size)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["path", "n_bytes"])

    n = paths.count()
    return paths.select("path").repartition(max(1, -(-n // 100)), "path").mapInArrow(look, "path string, n_bytes bigint")


def count_tokens(paths: DataFrame, separator: int, item_bytes: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document of the flat files in ``paths``: path, ordinal, start
    (token position in its file), n_tokens (without the separator), terminated.

    Tokens after the last separator are a document that is not terminated; a
    file without tokens has no document. Paths named twice are read once.
    """
    dtype = np.dtype({2: "<u2", 4: "<u4"}[item_bytes])
    files = settle(file_sizes(paths.select("path").distinct()).withColumn("n", F.floor(F.col("n_bytes") / item_bytes).cast("long")), "flat-files")
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block_tokens).cast("long")))
    blocks = files.where("n > 0").select("path", "n", cut.alias("block"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for path, n, block in zip(*(c.to_pylist() for c in b.columns)):
                fs, local = filesystem(path)
                first = block * block_tokens
                with fs.open_input_file(local) as f:
                    ids = np.frombuffer(f.read_at(min(block_tokens, n - first) * item_bytes, first * item_bytes), dtype)
                found.append(np.flatnonzero(ids == separator) + first)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int64()))], names=["path", "n", "block", "ends"])

    total = blocks.count()
    blocks = blocks.repartition(max(1, -(-total // TASK_BLOCKS)), "path", "block")
    ends = settle(blocks.mapInArrow(search, "path string, n bigint, block bigint, ends array<bigint>"), "separators")
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = ends.select("path", "n", "block", F.size("ends").alias("found"), F.try_element_at("ends", F.lit(-1)).alias("final"))
    carried = summary.select("path", "block", F.coalesce(F.last("final", ignorenulls=True).over(earlier), F.lit(-1)).alias("carry"), F.coalesce(F.sum("found").over(earlier), F.lit(0)).alias("numbered"))
    stitched = ends.join(carried, ["path", "block"])
    each = stitched.select("path", "carry", "numbered", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("carry") + 1).otherwise(F.try_element_at("ends", F.col("i")) + 1)
    whole = each.select("path", (F.col("numbered") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("end") - start).alias("n_tokens"), F.lit(True).alias("terminated"))
    last = summary.groupBy("path", "n").agg(F.coalesce(F.max("final"), F.lit(-1)).alias("final"), F.sum("found").alias("ordinal")).where("n - 1 > final")
    return whole.unionByName(last.select("path", F.col("ordinal").cast("long").alias("ordinal"), (F.col("final") + 1).alias("start"), (F.col("n") - 1 - F.col("final")).alias("n_tokens"), F.lit(False).alias("terminated")))
