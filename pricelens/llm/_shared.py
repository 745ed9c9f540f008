"""Helpers that several operators share: scratch tables, remote files, word grams."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import checkpoint_dir

#: Words of the plain-text contracts: runs of anything but ASCII white space.
BLANK_WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (nothing is created yet)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: one
    computation however often it is used, and it outlives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: it does so when
    the driver collects its garbage, which a small driver heap may put off until
    a long job has ended. The driver's heap and Arrow's pool shrink as well to what
    is in use."""
    import pyarrow as pa

    jvm = getattr(getattr(spark, "sparkContext", None), "_jvm", None)
    for _ in range(2):  # the second time what the first has let go of
        gc.collect()
        if jvm is not None:
            jvm.System.gc()
            time.sleep(0.2)
    pa.default_memory_pool().release_unused()


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI; a bare path is local storage, which
    only a local session gets from :func:`pricelens.session.checkpoint_dir`."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on ``keys`` under which NULL equals NULL; still an equi-join."""
    on = F.lit(True)
    for i, k in enumerate(keys):
        same = left[k].eqNullSafe(right[k])
        on = same if i == 0 else on & same
    return on


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on ``keys`` with NULL equal to NULL; the keys
    come from ``left`` once. ``right`` must hold only keys and new columns."""
    renamed = right.select(*[F.col(k).alias(f"_ll_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"_ll_r_{k}"))
        on = same if i == 0 else on & same
    return left.join(renamed, on, how).drop(*[f"_ll_r_{k}" for k in keys])
