"""Batch summaries, funnels and dashboard reports (AGG-6/7/10/11/12, RPT-1/3/6..10/12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens import config
from pricelens.operators.review import newest_first


def batch_summary(stg: DataFrame, fact: DataFrame, bad: DataFrame,
                  anomalies: DataFrame | None = None, batch_col: str = "source_batch_id") -> DataFrame:
    """AGG-6: one row per batch.

    total staged, loaded facts, bad = violation count (a row failing two rules
    counts twice), unchanged = max(0, total - loaded - bad), load rate
    (1.0 when empty), tier counts, HIGH share of loaded, distinct models,
    distinct offers with an anomaly. Each input is reduced per batch before
    the joins, so the joins are on tiny tables.
    """
    t = stg.groupBy(batch_col).agg(F.count(F.lit(1)).alias("total_records"))
    conf = F.col("harmonise_confidence")
    f = fact.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("loaded_records"),
        F.count(F.when(conf == "HIGH", 1)).alias("harmonise_high"),
        F.count(F.when(conf == "MEDIUM", 1)).alias("harmonise_medium"),
        F.count(F.when(conf == "LOW", 1)).alias("harmonise_low"),
        F.countDistinct("product_model_id").alias("unique_products_covered"))
    b = bad.groupBy(batch_col).agg(F.count(F.lit(1)).alias("bad_records_count"))
    out = t.join(f, batch_col, "left").join(b, batch_col, "left")
    if anomalies is not None:
        a = anomalies.groupBy(batch_col).agg(F.countDistinct("offer_id").alias("anomalies_detected"))
        out = out.join(a, batch_col, "left")
    else:
        out = out.withColumn("anomalies_detected", F.lit(None).cast("bigint"))
    z = F.lit(0).cast("bigint")
    out = out.select(
        batch_col, "total_records",
        F.coalesce("loaded_records", z).alias("loaded_records"),
        F.coalesce("bad_records_count", z).alias("bad_records_count"),
        F.coalesce("harmonise_high", z).alias("harmonise_high"),
        F.coalesce("harmonise_medium", z).alias("harmonise_medium"),
        F.coalesce("harmonise_low", z).alias("harmonise_low"),
        F.coalesce("unique_products_covered", z).alias("unique_products_covered"),
        F.coalesce("anomalies_detected", z).alias("anomalies_detected"))
    tot, load = F.col("total_records"), F.col("loaded_records")
    return (out.withColumn("rows_unchanged", F.greatest(z, tot - load - F.col("bad_records_count")))
               .withColumn("load_success_rate", F.when(tot == 0, F.lit(1.0))
                           .otherwise(F.round(load.cast("double") / tot, 4)))
               .withColumn("harmonise_high_pct", F.when(load == 0, F.lit(0.0))
                           .otherwise(F.round(F.col("harmonise_high").cast("double") / load, 4))))


def upsert_summary(store: DataFrame, new: DataFrame, batch_col: str = "source_batch_id") -> DataFrame:
    """Replace the rows of re-run batches, keep the others."""
    return store.join(new.select(batch_col), batch_col, "left_anti").unionByName(new)


def low_success_batches(summary: DataFrame, bar: float = config.LOW_SUCCESS_BAR) -> DataFrame:
    """AGG-7: batches whose load rate is below the bar."""
    return summary.filter(F.col("load_success_rate") < bar)


def daily_batches(summary: DataFrame) -> DataFrame:
    """AGG-11: daily rollup of batch summaries per partner."""
    return summary.groupBy("partner_id", F.to_date("loaded_at").alias("load_date")).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("total_records").cast("bigint").alias("total_records"),
        F.sum("loaded_records").cast("bigint").alias("loaded_records"),
        F.sum("bad_records_count").cast("bigint").alias("bad_records_count"))


def recent_batches(summary: DataFrame, n: int = 3) -> DataFrame:
    """AGG-12: the n most recent batches of each partner (ties by batch id)."""
    w = Window.partitionBy("partner_id").orderBy(F.desc("loaded_at"), F.desc("source_batch_id"))
    return summary.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= n)


def batch_funnel(stg: DataFrame, fact: DataFrame, bad: DataFrame,
                 batch_col: str = "source_batch_id", keys=("offer_id",)) -> DataFrame:
    """AGG-10: staged → in fact → flagged (distinct rows with a bad record) per batch."""
    s = stg.groupBy(batch_col).agg(F.count(F.lit(1)).alias("staged"))
    f = fact.groupBy(batch_col).agg(F.count(F.lit(1)).alias("in_fact"))
    b = bad.select(batch_col, *keys).distinct().groupBy(batch_col).agg(F.count(F.lit(1)).alias("flagged"))
    z = F.lit(0).cast("bigint")
    return (s.join(f, batch_col, "left").join(b, batch_col, "left")
            .select(batch_col, "staged", F.coalesce("in_fact", z).alias("in_fact"),
                    F.coalesce("flagged", z).alias("flagged")))


def funnel(stg: DataFrame, fact: DataFrame, history: DataFrame) -> DataFrame:
    """RPT-6: staged, ingest-passed, matched, pre-fact-passed, fact, history counts
    as (step, step_order, rows)."""
    s = stg.agg(F.count(F.lit(1)).alias("staged"),
                F.count(F.when(F.col("dq_status").isin("INGEST_PASSED", "PRE_FACT_PASSED"), 1)).alias("ingest_passed"),
                F.count(F.when(F.col("product_model_id").isNotNull(), 1)).alias("matched"),
                F.count(F.when(F.col("dq_status") == "PRE_FACT_PASSED", 1)).alias("prefact_passed"))
    s = s.selectExpr("stack(4, 'staged', 1, staged, 'ingest_passed', 2, ingest_passed, "
                     "'matched', 3, matched, 'prefact_passed', 4, prefact_passed) AS (step, step_order, rows)")
    f = fact.agg(F.lit("fact").alias("step"), F.lit(5).alias("step_order"), F.count(F.lit(1)).alias("rows"))
    h = history.agg(F.lit("history").alias("step"), F.lit(6).alias("step_order"),
                    F.count(F.lit(1)).alias("rows"))
    return s.unionByName(f).unionByName(h)


def confidence_distribution(fact: DataFrame, spark) -> DataFrame:
    """RPT-3: tier counts with every bucket present."""
    tiers = spark.createDataFrame([(t,) for t in ("HIGH", "MEDIUM", "LOW", "MANUAL")], "harmonise_confidence string")
    c = fact.groupBy("harmonise_confidence").agg(F.count(F.lit(1)).alias("offers"))
    return F.broadcast(tiers).join(c, "harmonise_confidence", "left").select(
        "harmonise_confidence", F.coalesce("offers", F.lit(0).cast("bigint")).alias("offers"))


def recent_bad(bad: DataFrame, cat: DataFrame, n: int = 20, order=None) -> DataFrame:
    """RPT-7: newest n bad records with their stage (a top-n report), by the time of
    detection where they are stamped with it."""
    c = F.broadcast(cat.select("rule_id", "target_stage"))
    return bad.join(c, "rule_id").orderBy(*[F.desc(o) for o in order or newest_first(bad)]).limit(n)


def blocked_rows(bad: DataFrame, cat: DataFrame, keys=("source_batch_id", "offer_id")) -> DataFrame:
    """RPT-8: first PRE_FACT violation per row: the earliest detected where records
    are stamped with the time, then the smallest rule id."""
    pre = F.broadcast(cat.filter(F.col("target_stage") == "PRE_FACT").select("rule_id"))
    b = bad.join(pre, "rule_id", "left_semi")
    by = [c for c in ("detected_at", "rule_id") if c in bad.columns]
    first = F.min_by(F.struct("rule_id", "failed_field", "error_message"), F.struct(*by))
    return b.groupBy(*keys).agg(first.alias("f")).select(*keys, "f.*")


def low_confidence(bad: DataFrame) -> DataFrame:
    """RPT-9: LOW-confidence bad records."""
    return bad.filter(F.col("rule_id") == "DQ_HARM_001")


def rule_trend(output: DataFrame, order_col: str = "source_batch_id") -> DataFrame:
    """RPT-12: pass rate per rule run with the previous run's rate and the change.

    Window per rule over its runs: bounded by the number of runs.
    """
    w = Window.partitionBy("rule_id").orderBy(order_col)
    prev = F.lag("pass_rate").over(w)
    return output.select("rule_id", order_col, "pass_rate", prev.alias("prev_pass_rate"),
                         F.round(F.col("pass_rate") - prev, 4).alias("pass_rate_change"))


def report_totals(stg: DataFrame, fact: DataFrame, history: DataFrame, bad: DataFrame,
                  cat: DataFrame) -> DataFrame:
    """RPT-1: table sizes, batches, active rules, HIGH share of facts."""
    parts = [stg.agg(F.lit("staging_rows").alias("metric"), F.count(F.lit(1)).cast("double").alias("value")),
             fact.agg(F.lit("fact_rows").alias("metric"), F.count(F.lit(1)).cast("double").alias("value")),
             history.agg(F.lit("history_rows").alias("metric"), F.count(F.lit(1)).cast("double").alias("value")),
             bad.agg(F.lit("bad_records").alias("metric"), F.count(F.lit(1)).cast("double").alias("value")),
             stg.agg(F.lit("batches").alias("metric"), F.countDistinct("source_batch_id").cast("double").alias("value")),
             cat.agg(F.lit("active_rules").alias("metric"),
                     F.count(F.when(F.col("is_active"), 1)).cast("double").alias("value")),
             fact.agg(F.lit("high_share").alias("metric"),
                      F.round(F.count(F.when(F.col("harmonise_confidence") == "HIGH", 1)).cast("double")
                              / F.count(F.lit(1)), 4).alias("value"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_names(fact: DataFrame, name_col: str = "raw_product_name") -> DataFrame:
    """RPT-10 (picking): one name per stratum — top-scoring HIGH (shortest on
    ties), longest HIGH of at least 60 characters (skipped if it is the same
    name), best MEDIUM, lowest LOW. One global aggregate with partial
    aggregation; no stratum is gathered into one task."""
    n, sc, conf = F.col(name_col), F.col("harmonise_score"), F.col("harmonise_confidence")
    ln = F.length(n)
    picks = fact.agg(
        F.min_by(n, F.when(conf == "HIGH", F.struct(-sc, ln, n))).alias("top_high"),
        F.min_by(n, F.when((conf == "HIGH") & (ln >= 60), F.struct(-ln, n))).alias("verbose_high"),
        F.min_by(n, F.when(conf == "MEDIUM", F.struct(-sc, n))).alias("medium"),
        F.min_by(n, F.when(conf == "LOW", F.struct(sc, n))).alias("low"))
    rows = picks.selectExpr("stack(4, 'top_high', 1, top_high, 'verbose_high', 2, "
                            "CASE WHEN verbose_high = top_high THEN NULL ELSE verbose_high END, "
                            "'medium', 3, medium, 'low', 4, low) AS (stratum, stratum_order, name)")
    return rows.filter(F.col("name").isNotNull())


def harmonise_samples(fact: DataFrame, registry: DataFrame, match, name_col: str = "raw_product_name") -> DataFrame:
    """RPT-10: the stratum samples re-scored with the full signal breakdown.

    ``match(names_df) -> top-1 matches`` is the matcher to use (see
    ``operators.harmonise.match_top_k``)."""
    s = sample_names(fact, name_col)
    m = match(s.select("name"))
    return s.join(m, "name")
