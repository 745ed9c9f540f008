"""Writers: partitioned fact, staging and DQ tables (SNK-1, SNK-3..5), dimension
appends (SRC-5), product dimensions (SRC-6) and daily FX rows (SRC-7).

Writes use dynamic partition overwrite on partitions that belong to one batch
(or one run of it), so re-running a batch replaces only its own rows and a
retried task rewrites its own files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _overwrite_partitions(df: DataFrame, path: str, *parts: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*parts).parquet(path))


def write_fact(df: DataFrame, path: str) -> None:
    """SNK-1: facts stored by (crawl month, batch): pruning on time, and a load
    replaces its own batch's rows only, whichever months it shares with others.

    Rows are range-partitioned by month, batch, model and crawl time, so a month
    that holds most rows is split over tasks, and each file is clustered for
    row-group skipping. Rows without a crawl time go to the month ``none``.
    """
    out = df.withColumn("crawl_month", F.coalesce(F.date_format("crawl_ts_utc", "yyyy-MM"), F.lit("none")))
    order = ["crawl_month", "source_batch_id", "product_model_id", "crawl_ts_utc"]
    out = out.repartitionByRange(*order).sortWithinPartitions(*order)
    _overwrite_partitions(out, path, "crawl_month", "source_batch_id")


def write_staging(df: DataFrame, path: str) -> None:
    """SNK-3: staging keyed by (batch, row); re-writing a batch replaces it."""
    _overwrite_partitions(df, path, "source_batch_id")


def write_dq(output: DataFrame, bad: DataFrame, path: str) -> None:
    """SNK-5: rule results and bad records, appended run by run: a partition holds
    one run of one batch, so a retried run replaces itself and earlier runs stay."""
    _overwrite_partitions(output, f"{path}/dq_output", "source_batch_id", "run_id")
    _overwrite_partitions(bad, f"{path}/dq_bad_records", "source_batch_id", "run_id")


def drop_batch(df: DataFrame, batch_id) -> DataFrame:
    """SNK-4: the table without one batch's rows (write it as the next version);
    rows without a batch id stay."""
    return df.filter(~F.col("source_batch_id").eqNullSafe(F.lit(batch_id)))


def drop_batch_footprint(tables: dict[str, DataFrame], batch_id) -> dict[str, DataFrame]:
    """SNK-4 over a batch's whole footprint: every given table that carries the
    batch id (staging, facts, rule output, bad records, summary, ...) without
    that batch's rows; anomalies, which carry only the offer, lose the offers
    that the batch's facts had."""
    out = {n: drop_batch(t, batch_id) if "source_batch_id" in t.columns else t for n, t in tables.items()}
    if "facts" in tables and "anomalies" in tables and "source_batch_id" not in tables["anomalies"].columns:
        gone = tables["facts"].filter(F.col("source_batch_id").eqNullSafe(F.lit(batch_id))).select("offer_id").distinct()
        out["anomalies"] = tables["anomalies"].join(gone, "offer_id", "left_anti")
    return out


def append_new(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """SRC-5: rows whose key is not in the target yet (one per key)."""
    return rows.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def build_product_dims(registry: DataFrame, categories: DataFrame):
    """SRC-6: model dimension (one row per signature, known category only) and SKU
    dimension (each SKU points at its model)."""
    cats = categories.select(F.col("category_code").alias("entry_category")).distinct()
    models = registry.join(cats, "entry_category").select(
        F.col("model_key"), F.col("entry_category").alias("category_code"), "canonical_name",
        "storage_gb", "chip", "connectivity", "size_inch", "registry_order")
    skus = registry.join(cats, "entry_category").select(
        "model_key", F.explode("sku_ids").alias("ref_product_id"))
    return models, skus


def daily_fx(rates: DataFrame, start, end) -> DataFrame:
    """SRC-7: one row per currency per day of [start, end] with that currency's rate;
    the ends are dates or columns of ``rates``."""
    s, e = (x if isinstance(x, Column) else F.lit(x) for x in (start, end))
    return rates.select("from_currency_code", "to_currency_code", "rate",
                        F.explode(F.sequence(s.cast("date"), e.cast("date"))).alias("effective_date"))
