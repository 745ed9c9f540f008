"""Data-quality rules and the staged rule engine (DQ-1..13, DQE-1..9).

A rule is a boolean column plus a message column. All active rules of one
stage are evaluated in a single projection over the input, so a stage costs
one scan and one small aggregation, whatever the number of rules. Rule
results are per (batch, rule); bad records are one row per (row, rule) hit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import config


@dataclass(frozen=True)
class Rule:
    rule_id: str
    stage: str
    failed_field: str
    predicate: Column
    message: Column


def _s(c):
    return F.coalesce(F.col(c).cast("string"), F.lit("NULL"))


def _blank(c):
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def rules() -> list[Rule]:
    """Every rule of the catalogue as column expressions.

    Input columns (staging): crawl_ts_utc, country_name, country_code,
    raw_product_name, payment_type, full_price, monthly_amount,
    instalment_months, currency_code, product_model_id; PRE_FACT also needs
    expected_currency, partner_code, partner_country (see
    ``prepare_prefact``). SEMANTIC input is fact rows with
    harmonise_confidence, harmonise_score, category_code, effective_total_usd,
    min_usd, max_usd (see ``prepare_semantic``).
    """
    full = F.col("payment_type") == "FULL"
    inst = F.col("payment_type") == "INSTALMENT"
    return [
        Rule("DQ_NULL_001", "INGEST", "crawl_ts_utc", F.col("crawl_ts_utc").isNull(),
             F.lit("crawl_ts is NULL or failed to parse as ISO 8601")),
        Rule("DQ_NULL_002", "INGEST", "country_name", _blank("country_name"),
             F.lit("country is NULL or empty")),
        Rule("DQ_NULL_004", "INGEST", "raw_product_name", _blank("raw_product_name"),
             F.lit("product name is NULL or empty")),
        Rule("DQ_FMT_001", "INGEST", "country_code",
             F.col("country_name").isNotNull() & F.col("country_code").isNull(),
             F.concat(F.lit('country_name "'), _s("country_name"),
                      F.lit('" did not resolve to an ISO code'))),
        Rule("DQ_RANGE_001", "INGEST", "full_price",
             full & (F.col("full_price").isNull() | (F.col("full_price") <= 0)),
             F.concat(F.lit("full_price must be > 0, got "), _s("full_price"))),
        Rule("DQ_RANGE_002", "INGEST", "monthly_amount",
             inst & (F.col("monthly_amount").isNull() | (F.col("monthly_amount") <= 0)),
             F.concat(F.lit("monthly_amount must be > 0 for INSTALMENT, got "), _s("monthly_amount"))),
        Rule("DQ_RANGE_003", "INGEST", "instalment_months",
             inst & (F.col("instalment_months").isNull() | (F.col("instalment_months") < 1)
                     | (F.col("instalment_months") > 60)),
             F.concat(F.lit("instalment_months must be 1..60, got "), _s("instalment_months"))),
        Rule("DQ_COND_001", "INGEST", "payment_type",
             (full & (F.col("monthly_amount").isNotNull() | F.col("instalment_months").isNotNull()))
             | (inst & F.col("full_price").isNotNull()),
             F.when(full, F.lit("FULL payment requires full_price but has instalment fields set"))
              .otherwise(F.lit("INSTALMENT payment requires monthly + months but has full_price set"))),
        Rule("DQ_CONS_001", "PRE_FACT", "currency_code",
             F.col("expected_currency").isNotNull() & F.col("currency_code").isNotNull()
             & (F.col("currency_code") != F.col("expected_currency")),
             F.concat(F.lit("country="), _s("country_code"), F.lit(" expected "),
                      _s("expected_currency"), F.lit(" but got "), _s("currency_code"))),
        Rule("DQ_CONS_002", "PRE_FACT", "country_code",
             F.col("partner_country").isNotNull() & F.col("country_code").isNotNull()
             & (F.col("partner_country") != F.col("country_code")),
             F.concat(F.lit("partner "), _s("partner_code"), F.lit(" registered under "),
                      _s("partner_country"), F.lit(" but row claims "), _s("country_code"))),
        Rule("DQ_HARM_002", "PRE_FACT", "product_model_id", F.col("product_model_id").isNull(),
             F.concat(F.lit('no harmonise match: raw="'), _s("raw_product_name"), F.lit('"'))),
        Rule("DQ_HARM_001", "SEMANTIC", "harmonise_confidence",
             F.col("harmonise_confidence") == "LOW",
             F.concat(F.lit("low harmonise confidence (score="), _s("harmonise_score"),
                      F.lit('): raw="'), _s("raw_product_name"), F.lit('"'))),
        Rule("DQ_PRICE_001", "SEMANTIC", "effective_total_usd",
             F.col("min_usd").isNotNull()
             & ((F.col("effective_total_usd") < F.col("min_usd"))
                | (F.col("effective_total_usd") > F.col("max_usd"))),
             F.concat(F.lit("category="), _s("category_code"), F.lit(": price "),
                      _s("effective_total_usd"), F.lit(" outside expected ["), _s("min_usd"),
                      F.lit(", "), _s("max_usd"), F.lit("]"))),
    ]


def catalog(spark: SparkSession, inactive: tuple[str, ...] = ()) -> DataFrame:
    """DQE-3: the rule catalogue with its activation switch (13 rows)."""
    rows = [(rid, name, cat, sev, stage, rid not in inactive)
            for rid, name, cat, sev, stage in config.RULES]
    return spark.createDataFrame(
        rows, "rule_id string, rule_name string, rule_category string, severity string, "
              "target_stage string, is_active boolean")


def active_rules(cat: DataFrame) -> DataFrame:
    return cat.filter(F.col("is_active"))


def price_bands(spark: SparkSession, bands=None) -> DataFrame:
    return spark.createDataFrame(bands or config.PRICE_BANDS,
                                 "band_category string, min_usd int, max_usd int")


def prepare_prefact(stg: DataFrame, countries: DataFrame, partners: DataFrame) -> DataFrame:
    """Attach expected currency of the row country and the partner's country.

    ``countries`` is a fixed small dimension (broadcast); ``partners`` is
    joined plainly so the planner picks broadcast only when its size allows.
    """
    exp = F.broadcast(countries.select(F.col("country_code").alias("_cc"),
                                       F.col("currency_code").alias("expected_currency")))
    par = partners.select(F.col("partner_id").alias("_pid"),
                          F.col("country_code").alias("partner_country"))
    out = stg.join(exp, stg.country_code.eqNullSafe(exp._cc), "left").drop("_cc")
    return out.join(par, out.partner_id == par._pid, "left").drop("_pid")


def prepare_semantic(fact: DataFrame, bands: DataFrame) -> DataFrame:
    b = F.broadcast(bands)
    return fact.join(b, fact.category_code == b.band_category, "left").drop("band_category")


def _none_fails(stage_rules: list[Rule]) -> Column:
    ok = F.lit(True)
    for r in stage_rules:
        ok = ok & ~F.coalesce(r.predicate, F.lit(False))
    return ok


def passes(stage: str) -> Column:
    """No rule of the stage fails, from the predicates alone: ``size(_hits) = 0``
    without the messages, so that filters on a status stay small wherever the
    optimiser puts them (code beyond the JVM's limit for a method runs interpreted)."""
    return _none_fails([r for r in rules() if r.stage == stage])


def evaluate(df: DataFrame, stage: str, active_ids: list[str] | None = None,
             eligible: Column | None = None) -> DataFrame:
    """Add ``_hits``: array of (rule_id, failed_field, error_message) structs.

    ``eligible`` restricts which rows the stage's rules look at (PRE_FACT only
    checks INGEST_PASSED rows); other rows get an empty array.
    """
    stage_rules = [r for r in rules() if r.stage == stage
                   and (active_ids is None or r.rule_id in active_ids)]
    none = F.array().cast("array<struct<rule_id:string,failed_field:string,error_message:string>>")
    hits = [F.when(F.coalesce(r.predicate, F.lit(False)),
                   F.struct(F.lit(r.rule_id).alias("rule_id"),
                            F.lit(r.failed_field).alias("failed_field"),
                            r.message.alias("error_message")))
            for r in stage_rules]
    # the predicates decide first; messages are made for failing rows only
    some = ~_none_fails(stage_rules)
    if eligible is not None:
        some = F.coalesce(eligible, F.lit(False)) & some
    arr = F.when(some, F.filter(F.array(*hits), lambda x: x.isNotNull())).otherwise(none) if hits else none
    return df.withColumn("_hits", arr)


def _has_rule(rid: str) -> Column:
    return F.exists("_hits", lambda h: h.rule_id == F.lit(rid))


def stage_output(evaluated: DataFrame, stage: str, cat: DataFrame,
                 batch_col: str = "source_batch_id", batches: DataFrame | None = None) -> DataFrame:
    """Per (batch, active rule of stage): total, failed, pass_rate.

    One partial-aggregated group-by on the batch column; the wide per-rule
    counts are unpivoted with ``stack``. pass_rate = round(1 - failed/total, 4)
    and 1.0 for a batch without rows in this stage. ``batches`` (one column,
    the batch ids) names batches that must have rows even if the stage got none
    of theirs.
    """
    stage_ids = [r.rule_id for r in rules() if r.stage == stage]
    aggs = [F.count(F.lit(1)).alias("total_records")] + [
        F.sum(F.when(_has_rule(rid), 1).otherwise(0)).alias(f"f_{rid}") for rid in stage_ids]
    wide = evaluated.groupBy(batch_col).agg(*aggs)
    if batches is not None:
        ids = batches.select(F.col(batch_col).alias("_b")).distinct()
        counts = [c for c in wide.columns if c != batch_col]
        wide = ids.join(wide, F.col("_b").eqNullSafe(F.col(batch_col)), "left").select(
            F.col("_b").alias(batch_col), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    pairs = ", ".join(f"'{rid}', f_{rid}" for rid in stage_ids)
    long = wide.selectExpr(batch_col, "total_records",
                           f"stack({len(stage_ids)}, {pairs}) AS (rule_id, failed_records)")
    c = F.broadcast(active_rules(cat).filter(F.col("target_stage") == stage)
                    .select("rule_id", "rule_name", "rule_category", "severity", "target_stage"))
    out = long.join(c, "rule_id")
    rate = F.when(F.col("total_records") == 0, F.lit(1.0)).otherwise(
        F.round(F.lit(1.0) - F.col("failed_records").cast("double") / F.col("total_records"), 4))
    return out.select(batch_col, "rule_id", "rule_name", "rule_category", "severity",
                      "target_stage", F.col("total_records").cast("bigint").alias("total_records"),
                      F.col("failed_records").cast("bigint").alias("failed_records"),
                      rate.alias("pass_rate"))


def bad_records(evaluated: DataFrame, cat: DataFrame, keys: list[str],
                batch_col: str = "source_batch_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per (row, failed rule), status NEW; severity from the catalogue.
    ``carry`` names further columns of the rows, put last."""
    ex = evaluated.where(F.size("_hits") > 0).select(batch_col, *keys, *carry, F.explode("_hits").alias("h"))
    c = F.broadcast(cat.select("rule_id", "severity"))
    bad = ex.select(batch_col, *keys, "h.rule_id", "h.failed_field", "h.error_message", *carry).join(c, "rule_id").withColumn("status", F.lit("NEW"))
    return bad.select(*[x for x in bad.columns if x not in carry], *carry)


def with_payload(bad: DataFrame, rows: DataFrame, keys: list[str], batch_col: str = "source_batch_id") -> DataFrame:
    """Bad records with the raw payload of their rows (one row per batch and key)."""
    p = rows.select(F.col(batch_col).alias("_b"), *[F.col(k).alias(f"_k_{k}") for k in keys], "raw_payload")
    on = bad[batch_col].eqNullSafe(p["_b"])
    for k in keys:
        on = on & bad[k].eqNullSafe(p[f"_k_{k}"])
    return bad.join(p, on, "left").drop("_b", *[f"_k_{k}" for k in keys])


def stamped(df: DataFrame, run_id: str | None, run_ts, column: str) -> DataFrame:
    """Rule output or bad records of one run: its id, and its time as ``column``."""
    if run_id is None:
        return df
    return df.withColumn("run_id", F.lit(run_id)).withColumn(column, F.lit(run_ts).cast("timestamp"))


def run_stage(df: DataFrame, stage: str, cat: DataFrame, keys: list[str],
              eligible: Column | None = None, batch_col: str = "source_batch_id",
              batches: DataFrame | None = None, run_id: str | None = None, run_ts=None):
    """DQE-1: run all active rules of one stage → (rule output, bad records).

    With ``run_id`` and ``run_ts`` both outputs are stamped (run_ts, detected_at),
    so that several runs of one batch can be kept side by side. Catalogue
    activation is applied by the joins in both outputs.
    """
    ev = evaluate(df, stage, eligible=eligible)
    return (stamped(stage_output(ev, stage, cat, batch_col, batches), run_id, run_ts, "run_ts"),
            stamped(bad_records(ev, active_rules(cat), keys, batch_col), run_id, run_ts, "detected_at"))


def ingest_status(stg_eval: DataFrame) -> Column:
    """DQE-4 in the same scan: INGEST_PASSED when no INGEST rule hit."""
    return F.when(passes("INGEST"), F.lit("INGEST_PASSED")).otherwise(F.lit("PENDING"))


def mark_passed(stg: DataFrame, bad: DataFrame, keys: list[str], status: str,
                only_from: str | None = None, rule_ids: list[str] | None = None) -> DataFrame:
    """DQE-4/5 with a stored bad-record table: promote rows with no bad record.

    An anti-join on the row key (not ``NOT IN``, which turns every row away
    when the list holds a NULL).
    """
    b = bad
    if rule_ids is not None:
        b = b.filter(F.col("rule_id").isin(rule_ids))
    failing = b.select(*keys).distinct().withColumn("_fail", F.lit(True))
    out = stg.join(failing, keys, "left")
    ok = F.col("_fail").isNull()
    if only_from is not None:
        ok = ok & (F.col("dq_status") == only_from)
    return out.withColumn("dq_status", F.when(ok, F.lit(status)).otherwise(F.col("dq_status"))) \
              .drop("_fail")


def run_all(stg: DataFrame, countries: DataFrame, partners: DataFrame,
            fact_builder, bands: DataFrame, cat: DataFrame, keys: list[str],
            batch_col: str = "source_batch_id", batches: DataFrame | None = None,
            run_id: str | None = None, run_ts=None):
    """DQE-2: INGEST → PRE_FACT → SEMANTIC for a staged batch.

    ``fact_builder`` turns PRE_FACT_PASSED staging rows into fact rows. Every
    staged batch (and every one in ``batches``) has a row per active rule in
    each stage, also when no row reached it. Bad records carry the row's raw
    payload where staging has it. Returns (staging with dq_status, facts, rule
    output, bad records).
    """
    payload = ("raw_payload",) if "raw_payload" in stg.columns else ()
    ids = stg.select(batch_col)
    batches = ids.distinct() if batches is None else batches.select(batch_col).unionByName(ids).distinct()
    ing = evaluate(stg, "INGEST")
    out_i = stage_output(ing, "INGEST", cat, batch_col, batches)
    bad_i = bad_records(ing, active_rules(cat), keys, batch_col, payload)
    stg1 = ing.withColumn("dq_status", ingest_status(ing)).drop("_hits")
    pre = evaluate(prepare_prefact(stg1, countries, partners), "PRE_FACT",
                   eligible=F.col("dq_status") == "INGEST_PASSED")
    out_p = stage_output(pre, "PRE_FACT", cat, batch_col, batches)
    bad_p = bad_records(pre, active_rules(cat), keys, batch_col, payload)
    stg2 = pre.withColumn("dq_status", F.when(
        (F.col("dq_status") == "INGEST_PASSED") & passes("PRE_FACT"),
        F.lit("PRE_FACT_PASSED")).otherwise(F.col("dq_status"))) \
        .drop("_hits", "expected_currency", "partner_country")
    fact = fact_builder(stg2.filter(F.col("dq_status") == "PRE_FACT_PASSED"))
    sem = evaluate(prepare_semantic(fact, bands), "SEMANTIC")
    out_s = stage_output(sem, "SEMANTIC", cat, batch_col, batches)
    there = all(x in sem.columns for x in payload)
    bad_s = bad_records(sem, active_rules(cat), keys, batch_col, payload if there else ())
    if not there:
        bad_s = with_payload(bad_s, stg, keys, batch_col)
    bad = bad_i.unionByName(bad_p).unionByName(bad_s)
    return (stg2, fact, stamped(out_i.unionByName(out_p).unionByName(out_s), run_id, run_ts, "run_ts"),
            stamped(bad, run_id, run_ts, "detected_at"))


# ---------------------------------------------------------------------------
# Reports over rule output and bad records
# ---------------------------------------------------------------------------

def latest_rule_results(output: DataFrame, order_col: str = "run_ts") -> DataFrame:
    """DQE-6: newest result row per rule (ties broken by batch id, then run id)."""
    cols = [c for c in output.columns if c != "rule_id"]
    order = [c for c in (order_col, "source_batch_id", "run_id") if c in cols]
    best = F.max_by(F.struct(*cols), F.struct(*order))
    return output.groupBy("rule_id").agg(best.alias("r")).select("rule_id", "r.*")


def dq_by_stage(output: DataFrame, spark: SparkSession) -> DataFrame:
    """DQE-8: failed records per stage, always all three stages."""
    stages = spark.createDataFrame([(s, i) for i, s in enumerate(config.STAGES)],
                                   "target_stage string, stage_order int")
    agg = output.groupBy("target_stage").agg(
        F.sum("failed_records").cast("bigint").alias("failed_records"),
        F.sum("total_records").cast("bigint").alias("total_records"))
    return (F.broadcast(stages).join(agg, "target_stage", "left")
            .select("target_stage", "stage_order",
                    F.coalesce("failed_records", F.lit(0)).cast("bigint").alias("failed_records"),
                    F.coalesce("total_records", F.lit(0)).cast("bigint").alias("total_records")))


def rule_pass_rates(cat: DataFrame, output: DataFrame) -> DataFrame:
    """RPT-5: pass rate per active rule over all runs, rules that never ran included."""
    agg = output.groupBy("rule_id").agg(
        F.sum("total_records").alias("t"), F.sum("failed_records").alias("f"))
    out = active_rules(cat).join(agg, "rule_id", "left")
    t = F.coalesce(F.col("t"), F.lit(0))
    f = F.coalesce(F.col("f"), F.lit(0))
    return out.select(
        "rule_id", "rule_name", "target_stage", "severity",
        t.cast("bigint").alias("total_records"), f.cast("bigint").alias("failed_records"),
        F.when(t == 0, F.lit(1.0)).otherwise(F.round(F.lit(1.0) - f.cast("double") / t, 4))
         .alias("pass_rate"))


def dq_summary(output: DataFrame) -> DataFrame:
    """DQE-7: rules run, largest total, violations by severity (unknown → MEDIUM)."""
    sev = F.when(F.col("severity").isin("HIGH", "MEDIUM", "LOW"), F.col("severity")).otherwise("MEDIUM")
    o = output.withColumn("_sev", sev)
    return o.agg(
        F.countDistinct("rule_id").alias("rules_run"),
        F.max("total_records").cast("bigint").alias("max_total_records"),
        *[F.coalesce(F.sum(F.when(F.col("_sev") == s, F.col("failed_records"))), F.lit(0))
           .cast("bigint").alias(f"violations_{s.lower()}") for s in ("HIGH", "MEDIUM", "LOW")])


def clean_facts(fact: DataFrame, bad: DataFrame, keys: list[str]) -> DataFrame:
    """DQE-9: fact rows that have no bad record."""
    return fact.join(bad.select(*keys), keys, "left_anti")


def blocked_count(bad: DataFrame, cat: DataFrame, keys: list[str]) -> DataFrame:
    """RPT-2: distinct rows blocked at PRE_FACT (a row failing two rules counts once)."""
    pre = F.broadcast(cat.filter(F.col("target_stage") == "PRE_FACT").select("rule_id"))
    return bad.join(pre, "rule_id", "left_semi").select(
        F.countDistinct(*keys).alias("blocked_rows"))


def violation_breakdown(bad: DataFrame, cat: DataFrame) -> DataFrame:
    """RPT-4: violations by severity and stage."""
    c = F.broadcast(cat.select("rule_id", "target_stage"))
    return (bad.join(c, "rule_id").groupBy("target_stage", "severity")
            .agg(F.count(F.lit(1)).alias("violations")))


def violations_by(bad: DataFrame, *keys: str) -> DataFrame:
    """AGG-9: violation counts grouped by any columns (rule, status, stage)."""
    return bad.groupBy(*keys).agg(F.count(F.lit(1)).alias("violations"))
