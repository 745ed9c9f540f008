"""Session construction and cluster-shared locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

#: What the library wants where nobody has said otherwise.
WANTED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "pricelens", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and skew handling on.

    Settings that are configured already (submit arguments, defaults file) stay
    as they are; the master, the memory and the number of shuffle partitions
    are set only when the caller names them, as ``bench.py`` and tests do.
    """
    if SparkContext._jvm is None:  # what was submitted is known once the JVM runs
        start = SparkConf(loadDefaults=False)
        if driver_memory:
            start.set("spark.driver.memory", driver_memory)
        SparkContext._ensure_initialized(conf=start)
    have = SparkConf()
    builder = SparkSession.builder
    if not have.contains("spark.app.name") or have.get("spark.app.name") == "pyspark-shell":
        builder = builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in WANTED.items():
        if not have.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """One JVM does all the work, so a folder of this machine is seen by all of it."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name storage that the driver and all
    executors share; it is used as is. Only a local session without the setting
    (tests) gets a private folder; anything else is an error, because executors
    would write to their own disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_pricelens_checkpoint", None)
    if not current:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = spark._pricelens_checkpoint = tempfile.mkdtemp(prefix="pricelens-ckpt-")
    spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df, spark: SparkSession | None = None, name: str = "stage"):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and
    return a DataFrame reading it back.

    One computation, columnar storage, and the result survives executor loss
    (unlike a local checkpoint); later steps start from the table instead of
    the whole lineage. :func:`drop_lineage` removes a session's tables.
    """
    spark = spark or df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    kept = getattr(spark, "_pricelens_tables", None)
    if kept is None:
        kept = spark._pricelens_tables = []
    kept.append(path)
    return spark.read.parquet(path)


def cut_and_deal(df, by: list[str], name: str = "dealt"):
    """:func:`cut_lineage` for a table that is grouped and joined by ``by`` several times:
    rows are dealt to buckets by it once, and later steps on all of these columns read
    the buckets as they are, without a shuffle of their own. A group should be small,
    since its rows are in one bucket. The table is an external one of the session's
    catalog, its files lie in the shared checkpoint folder."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{table}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *by).write.bucketBy(n, *by).sortBy(*by).option("compression", "zstd").option("path", path).format("parquet").saveAsTable(table)
    kept = getattr(spark, "_pricelens_tables", None)
    if kept is None:
        kept = spark._pricelens_tables = []
    kept.append(path)
    return spark.table(table)


def drop_lineage(spark: SparkSession) -> int:
    """Delete the tables that :func:`cut_lineage` wrote in this session, once
    their results are published; returns how many."""
    kept = getattr(spark, "_pricelens_tables", [])
    jvm = spark.sparkContext._jvm
    for path in kept:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    n = len(kept)
    kept.clear()
    return n
