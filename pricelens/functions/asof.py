"""Previous-row lookups ("as of strictly before") without one window per key.

A key can hold a third of all rows, so rows are split into (key, time bucket)
partitions: inside a bucket a growing window frame finds the latest earlier
row; the last row of every earlier bucket comes from a small per-bucket table
(one row per key and bucket) with its own window. A key's work is spread over
its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_before(df: DataFrame, keys: list[str], ts: str, carry: list[str],
                    tiebreak: str, bucket: Column | None = None) -> DataFrame:
    """Add ``prev_<c>`` for each column of ``carry``: the values of the latest row
    of the same key with a strictly smaller ``ts`` (ties broken by ``tiebreak``)."""
    b = bucket if bucket is not None else F.to_date(F.col(ts))
    d = df.withColumn("_b", b).withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    packed = F.struct(F.col("_t"), F.col(tiebreak).alias("_tb"), *[F.col(c).alias(c) for c in carry])
    w_in = Window.partitionBy(*keys, "_b").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.max(packed).over(w_in))
    last = d.groupBy(*keys, "_b").agg(F.max(packed).alias("_last"))
    w_b = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry_in = last.select(*keys, "_b", F.max("_last").over(w_b).alias("_carry"))
    out = d.join(carry_in, keys + ["_b"], "left")
    best = F.coalesce(F.col("_in"), F.col("_carry"))
    out = out.withColumn("_best", best)
    for c in carry:
        out = out.withColumn(f"prev_{c}", F.col(f"_best.{c}"))
    return out.drop("_b", "_t", "_in", "_carry", "_best")
