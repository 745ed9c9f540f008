"""Incremental load of arriving feed files (PIPE-3).

:func:`stream_pipeline` runs the whole of Path A on each chunk of files;
:func:`stream_feeds` is the loop by itself, for a handler of the caller's.

A Structured Streaming file source hands each micro-batch to ``foreachBatch``,
which runs the batch pipeline and writes with dynamic partition overwrite
keyed by a batch id derived from the stream's epoch id, so a retried epoch
overwrites its own output (idempotent by (batch, row)). The checkpoint lives
in the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.plans import pipeline as P
from pricelens.session import checkpoint_dir
from pricelens.sources import store as ST


def stream_feeds(spark: SparkSession, src_dir: str, schema: T.StructType, out_dir: str,
                 handle: Callable[[DataFrame, str], DataFrame], fmt: str = "csv",
                 max_files: int = 8, name: str = "feeds"):
    """Run ``handle(batch_df, batch_id)`` on every arriving chunk of files and
    write its result under ``out_dir`` partitioned by ``source_batch_id``.

    ``trigger(availableNow=True)``: process what is there in bounded chunks,
    then stop; a restart resumes from the checkpoint.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(src_dir)

    def each(batch: DataFrame, epoch_id: int) -> None:
        bid = f"{name}-{epoch_id:08d}"
        out = handle(batch, bid).withColumn("source_batch_id", F.lit(bid))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_batch_id").parquet(out_dir))

    # one checkpoint per source folder: a restart on the same folder resumes,
    # a different folder never inherits another stream's offsets
    tag = hashlib.sha1(src_dir.encode()).hexdigest()[:16]
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{tag}"
    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


#: What the file source tells of each file; contents are not read to list files.
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_pipeline(spark: SparkSession, src_dir: str, ctx: P.Context, registry: DataFrame, models: DataFrame, store: ST.Store,
                    partner: str | Column, max_files: int = 8, name: str = "feeds", pattern: str = "*.csv", **match):
    """PIPE-3: every chunk of at most ``max_files`` arriving CSV files goes through
    Path A (parse, match, rules, facts, history, anomalies) and is published in
    ``store`` as one batch, ``<name>-<epoch>``.

    The commit of a chunk names its epoch, so a chunk that was committed before the
    stream could note it is not loaded twice, and one that died before its commit
    left nothing that shows. History goes from chunk to chunk through the store.
    The driver sees the names of a chunk's files. Runs until the files that are
    there are done; a restart goes on from the checkpoint.
    """
    files = (spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files).load(src_dir).select("path", "length"))

    def each(chunk: DataFrame, epoch: int) -> None:
        paths = sorted(r["path"] for r in chunk.where("length > 0").select("path").collect())
        if paths:
            batch = f"{name}-{epoch:08d}"
            P.run_feeds(spark, [(paths, partner, batch)], replace(ctx, run_id=batch), registry, models, store, fence=(name, epoch), **match)

    tag = hashlib.sha1(f"{src_dir} {store.path}".encode()).hexdigest()[:16]
    q = (files.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{tag}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
