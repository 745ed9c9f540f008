"""Registered queries over the testbed, each with an independent SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the library operators on
the whole testbed; ``ORACLE[name]`` is the same question written directly in
SQL (DuckDB dialect). Column names and types agree between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import config
from pricelens.operators import facts as FX
from pricelens.operators import history as H
from pricelens.operators import quality as Q
from pricelens.plans import testbed as T
from pricelens.session import cut_and_deal, cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


KEYS = "product_model_id, partner_id, country_code, payment_type"

# ---------------------------------------------------------------------------
# Shared building blocks (Spark side)
# ---------------------------------------------------------------------------


def testbed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse daily FX table derived from all orders per customer region; the days
    left without a rate follow a fixed rule on the derived table."""
    o = T.read(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    c = T.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = F.broadcast(T.read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
    return (j.groupBy(F.concat(F.lit("CUR"), F.col("n_regionkey").cast("string")).alias("from_currency_code"),
                      F.to_date("o_orderdate").alias("effective_date"))
             .agg((F.lit(0.5) + (F.round(F.min("o_totalprice")).cast("bigint") % 997) / F.lit(1000.0))
                  .cast("decimal(16,8)").alias("rate"))
             .withColumn("to_currency_code", F.lit("USD"))
             .filter(F.pmod(F.datediff("effective_date", F.lit("1970-01-01").cast("date")) * 3
                            + F.substring("from_currency_code", 4, 9).cast("int"), F.lit(5)) < 2))


RATES_SQL = """
rates AS (
  SELECT 'CUR' || CAST(n_regionkey AS VARCHAR) AS from_currency_code,
         CAST(o_orderdate AS DATE) AS effective_date,
         CAST(0.5 + (CAST(round(min(o_totalprice)) AS BIGINT) % 997) / 1000.0 AS DECIMAL(16,8)) AS rate,
         'USD' AS to_currency_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_regionkey, CAST(o_orderdate AS DATE)
  HAVING ((CAST(o_orderdate AS DATE) - DATE '1970-01-01') * 3 + n_regionkey) % 5 < 2
)"""


def staging_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The testbed's staging written once (step 1 of the reference stores staging before
    any rule runs), for queries that read it several times."""
    return cut_lineage(T.staging(spark, sf_dir), name="staging")


def staged(spark: SparkSession, sf_dir: str, stg: DataFrame | None = None) -> DataFrame:
    """Testbed staging with dq_status after INGEST and PRE_FACT."""
    stg = T.staging(spark, sf_dir) if stg is None else stg
    s1 = stg.withColumn("dq_status", Q.ingest_status(stg))
    pre = Q.prepare_prefact(s1, T.countries(spark, sf_dir), T.partners(spark, sf_dir))
    return pre.withColumn("dq_status", F.when(
        (F.col("dq_status") == "INGEST_PASSED") & Q.passes("PRE_FACT"),
        F.lit("PRE_FACT_PASSED")).otherwise(F.col("dq_status"))) \
        .drop("expected_currency", "partner_country")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.scd2_rebuild(T.offers(spark, sf_dir))


# ---------------------------------------------------------------------------
# Shared building blocks (SQL side)
# ---------------------------------------------------------------------------

INGEST_FLAGS = {
    "DQ_NULL_001": "crawl_ts_utc IS NULL",
    "DQ_NULL_002": "country_name IS NULL OR trim(country_name) = ''",
    "DQ_NULL_004": "raw_product_name IS NULL OR trim(raw_product_name) = ''",
    "DQ_FMT_001": "country_name IS NOT NULL AND country_code IS NULL",
    "DQ_RANGE_001": "payment_type = 'FULL' AND (full_price IS NULL OR full_price <= 0)",
    "DQ_RANGE_002": "payment_type = 'INSTALMENT' AND (monthly_amount IS NULL OR monthly_amount <= 0)",
    "DQ_RANGE_003": "payment_type = 'INSTALMENT' AND (instalment_months IS NULL OR instalment_months < 1 OR instalment_months > 60)",
    "DQ_COND_001": "(payment_type = 'FULL' AND (monthly_amount IS NOT NULL OR instalment_months IS NOT NULL)) OR (payment_type = 'INSTALMENT' AND full_price IS NOT NULL)",
}
PREFACT_FLAGS = {
    "DQ_CONS_001": "expected_currency IS NOT NULL AND currency_code IS NOT NULL AND currency_code <> expected_currency",
    "DQ_CONS_002": "partner_country IS NOT NULL AND country_code IS NOT NULL AND partner_country <> country_code",
    "DQ_HARM_002": "product_model_id IS NULL",
}


def _flag_cols(flags: dict[str, str]) -> str:
    return ",\n    ".join(f"COALESCE(({p}), FALSE) AS f_{rid}" for rid, p in flags.items())


CATALOG_SQL = "catalog AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{rid}', '{name}', '{cat}', '{sev}', '{stage}')" for rid, name, cat, sev, stage in config.RULES
) + ") t(rule_id, rule_name, rule_category, severity, target_stage))"

STAGED_SQL = f"""
ing AS (
  SELECT *, {_flag_cols(INGEST_FLAGS)}
  FROM staging
),
ing_status AS (
  SELECT *, CASE WHEN NOT ({' OR '.join('f_' + r for r in INGEST_FLAGS)}) THEN 'INGEST_PASSED' ELSE 'PENDING' END AS ingest_status
  FROM ing
),
pre AS (
  SELECT s.*, c.currency_code AS expected_currency, p.country_code AS partner_country
  FROM ing_status s
  LEFT JOIN countries c ON s.country_code = c.country_code
  LEFT JOIN partners p ON s.partner_id = p.partner_id
),
pre_flags AS (
  SELECT *, {', '.join(f"COALESCE(ingest_status = 'INGEST_PASSED' AND ({p}), FALSE) AS f_{rid}" for rid, p in PREFACT_FLAGS.items())}
  FROM pre
),
staged AS (
  SELECT *, CASE WHEN ingest_status = 'INGEST_PASSED' AND NOT ({' OR '.join('f_' + r for r in PREFACT_FLAGS)})
                 THEN 'PRE_FACT_PASSED' ELSE ingest_status END AS dq_status
  FROM pre_flags
)"""

HISTORY_SQL = f"""
daily AS (
  SELECT * FROM (
    SELECT {KEYS}, crawl_date AS valid_from_date, currency_code, effective_total_local, effective_total_usd,
           row_number() OVER (PARTITION BY {KEYS}, crawl_date ORDER BY crawl_ts_utc DESC, offer_id DESC) AS rn
    FROM offers) WHERE rn = 1
),
chg AS (
  SELECT *, lag(effective_total_usd) OVER (PARTITION BY {KEYS} ORDER BY valid_from_date) AS prev
  FROM daily
),
history AS (
  SELECT {KEYS}, currency_code, effective_total_local, effective_total_usd, valid_from_date,
         lead(valid_from_date) OVER (PARTITION BY {KEYS} ORDER BY valid_from_date) - 1 AS valid_to_date
  FROM chg WHERE prev IS NULL OR prev <> effective_total_usd
)"""


def _stage_sql(flags: dict[str, str], src: str) -> str:
    sums = ", ".join(f"CAST(sum(CASE WHEN f_{r} THEN 1 ELSE 0 END) AS BIGINT) AS {r}" for r in flags)
    return f"""
agg AS (SELECT source_batch_id, CAST(count(*) AS BIGINT) AS total_records, {sums}
        FROM {src} GROUP BY source_batch_id),
longf AS (UNPIVOT agg ON {', '.join(flags)} INTO NAME rule_id VALUE failed_records)
SELECT l.source_batch_id, l.rule_id, c.rule_name, c.rule_category, c.severity, c.target_stage,
       l.total_records, l.failed_records,
       CASE WHEN l.total_records = 0 THEN 1.0
            ELSE round(1.0 - CAST(l.failed_records AS DOUBLE) / l.total_records, 4) END AS pass_rate
FROM longf l JOIN catalog c USING (rule_id)
"""


# ---------------------------------------------------------------------------
# DQ
# ---------------------------------------------------------------------------

@query("dq_ingest_rules", T.with_sql(T.OFFERS_SQL, T.STAGING_SQL, CATALOG_SQL, f"""
ing AS (SELECT source_batch_id, {_flag_cols(INGEST_FLAGS)} FROM staging)""")
       + "," + _stage_sql(INGEST_FLAGS, "ing"))
def q_dq_ingest(spark, sf_dir):
    """DQ-1..8 + DQE-1: INGEST rule results per batch."""
    ev = Q.evaluate(T.staging(spark, sf_dir), "INGEST")
    return Q.stage_output(ev, "INGEST", Q.catalog(spark))


@query("dq_prefact_rules", T.with_sql(T.OFFERS_SQL, T.STAGING_SQL, T.COUNTRIES_SQL,
                                      T.PARTNERS_SQL, CATALOG_SQL, STAGED_SQL)
       + "," + _stage_sql(PREFACT_FLAGS, "staged"))
def q_dq_prefact(spark, sf_dir):
    """DQ-9..11 + DQE-1: PRE_FACT rules on INGEST_PASSED rows, total = all staged rows."""
    stg = T.staging(spark, sf_dir)
    ing = Q.evaluate(stg, "INGEST")
    s1 = ing.withColumn("dq_status", Q.ingest_status(ing)).drop("_hits")
    pre = Q.evaluate(Q.prepare_prefact(s1, T.countries(spark, sf_dir), T.partners(spark, sf_dir)),
                     "PRE_FACT", eligible=F.col("dq_status") == "INGEST_PASSED")
    return Q.stage_output(pre, "PRE_FACT", Q.catalog(spark))


FACTS_SQL = """
elig AS (
  SELECT *,
    CAST(CASE WHEN payment_type = 'FULL' THEN COALESCE(full_price, 0)
              ELSE COALESCE(monthly_amount, 0) * COALESCE(instalment_months, 0) END AS DECIMAL(12,2))
      AS effective_total_local,
    CAST(crawl_ts_utc AS DATE) AS crawl_date
  FROM staged
  WHERE {gate} payment_type IS NOT NULL AND crawl_ts_utc IS NOT NULL
    AND country_code IS NOT NULL AND product_model_id IS NOT NULL
),
facts AS (
  SELECT e.*, r.rate AS fx_rate, r.effective_date AS rate_date
  FROM (SELECT * FROM elig WHERE effective_total_local > 0) e
  ASOF LEFT JOIN rates r ON e.currency_code = r.from_currency_code AND e.crawl_date >= r.effective_date
)"""

FACT_COLS_SQL = """
SELECT offer_id, source_batch_id, payment_type, effective_total_local,
       CAST(round(effective_total_local * COALESCE(fx_rate, CAST(1 AS DECIMAL(16,8))), 2) AS DECIMAL(12,2)) AS effective_total_usd,
       COALESCE(fx_rate, CAST(1 AS DECIMAL(16,8))) AS fx_rate_to_usd,
       COALESCE(rate_date, crawl_date) AS fx_rate_date,
       fx_rate IS NULL AS fx_missing,
       crawl_date AS crawl_date_local
FROM facts
"""


def _fact_cols(f: DataFrame) -> DataFrame:
    return f.select("offer_id", "source_batch_id", "payment_type", "effective_total_local",
                    "effective_total_usd", "fx_rate_to_usd", "fx_rate_date", "fx_missing",
                    "crawl_date_local")


@query("facts_gated", T.with_sql(T.OFFERS_SQL, T.STAGING_SQL, T.COUNTRIES_SQL, T.PARTNERS_SQL,
                                 STAGED_SQL, RATES_SQL,
                                 FACTS_SQL.format(gate="dq_status = 'PRE_FACT_PASSED' AND"))
       + FACT_COLS_SQL)
def q_facts_gated(spark, sf_dir):
    """FACT-1 + FX-1 + PRJ-5/6: PRE_FACT_PASSED rows → USD facts at the as-of rate."""
    f = FX.build_facts(staged(spark, sf_dir), testbed_rates(spark, sf_dir), gate=True)
    return _fact_cols(f)


@query("facts_ungated", T.with_sql(T.OFFERS_SQL, T.STAGING_SQL, T.COUNTRIES_SQL, T.PARTNERS_SQL,
                                   STAGED_SQL, RATES_SQL, FACTS_SQL.format(gate=""))
       + FACT_COLS_SQL)
def q_facts_ungated(spark, sf_dir):
    """FACT-2: same completeness filters, no DQ gate."""
    f = FX.build_facts(staged(spark, sf_dir), testbed_rates(spark, sf_dir), gate=False)
    return _fact_cols(f)


# ---------------------------------------------------------------------------
# History
# ---------------------------------------------------------------------------

@query("scd2_rebuild", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + "SELECT * FROM history")
def q_scd2_rebuild(spark, sf_dir):
    """HIS-3: day-grain SCD-2 history of every (model, partner, country, payment)."""
    return history(spark, sf_dir)


@query("current_prices", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + """
SELECT product_model_id, country_code, payment_type,
       count(DISTINCT partner_id) AS partner_count,
       min(effective_total_usd) AS cheapest_price_usd,
       CAST(max(effective_total_usd) - min(effective_total_usd) AS DECIMAL(12,2)) AS price_spread_usd,
       CASE WHEN avg(CAST(effective_total_usd AS DOUBLE)) > 0
            THEN round(CAST(max(effective_total_usd) - min(effective_total_usd) AS DOUBLE)
                       / avg(CAST(effective_total_usd AS DOUBLE)), 6) END AS price_spread_pct
FROM history WHERE valid_to_date IS NULL
GROUP BY product_model_id, country_code, payment_type
""")
def q_current_prices(spark, sf_dir):
    """HIS-5: current market snapshot per (model, country, payment)."""
    return H.current_prices(history(spark, sf_dir))


@query("latest_per_key", T.with_sql(T.OFFERS_SQL) + f"""
SELECT {KEYS}, currency_code, effective_total_local, effective_total_usd, valid_from_date
FROM (SELECT *, crawl_date AS valid_from_date,
             row_number() OVER (PARTITION BY {KEYS} ORDER BY crawl_ts_utc DESC, offer_id DESC) AS rn
      FROM offers) WHERE rn = 1
""")
def q_latest_per_key(spark, sf_dir):
    """HIS-1: latest offer per history key."""
    return H.latest_per_key(T.offers(spark, sf_dir))


# ---------------------------------------------------------------------------
# Anomalies
# ---------------------------------------------------------------------------

from pricelens.operators import anomalies as A  # noqa: E402
from pricelens.operators import baselines as B  # noqa: E402

SEV_SQL = ("CASE WHEN {p} >= 0.25 THEN 'HIGH' WHEN {p} >= 0.15 THEN 'MEDIUM' "
           "WHEN {p} >= 0.10 THEN 'LOW' END")
C_SQL = "CAST({x} * 100 AS BIGINT)"

STAT_SQL = T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + f""",
hagg AS (
  SELECT product_model_id, country_code, valid_from_date AS d, count(*) AS hn,
         CAST(sum({C_SQL.format(x='effective_total_usd')}) AS HUGEINT) AS hs,
         sum(CAST({C_SQL.format(x='effective_total_usd')} AS HUGEINT) * {C_SQL.format(x='effective_total_usd')}) AS hss
  FROM history GROUP BY 1, 2, 3
),
probes AS (SELECT DISTINCT product_model_id, country_code, crawl_date FROM offers),
stats AS (
  SELECT p.product_model_id, p.country_code, p.crawl_date,
         sum(hn) AS n, sum(hs) AS s, sum(hss) AS ss
  FROM probes p JOIN hagg h
    ON p.product_model_id = h.product_model_id AND p.country_code = h.country_code
   AND h.d >= p.crawl_date - 30
  GROUP BY 1, 2, 3 HAVING sum(hn) >= 2
),
scored AS (
  SELECT o.offer_id, o.effective_total_usd, s.n, s.s, s.ss,
         CAST(abs(CAST({C_SQL.format(x='o.effective_total_usd')} AS HUGEINT) * s.n - s.s) AS DOUBLE)
           / CAST(s.s AS DOUBLE) AS p
  FROM offers o JOIN stats s USING (product_model_id, country_code, crawl_date)
  WHERE s.s > 0
)
SELECT offer_id, 'STATISTICAL' AS anomaly_type, {SEV_SQL.format(p='p')} AS severity,
       round(least(p, 1.0), 3) AS signal_score, effective_total_usd AS observed_price_usd,
       CAST(((s * 2 + n) // (n * 2)) / 100 AS DECIMAL(12,2)) AS baseline_mean,
       round(sqrt(CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE) / 10000.0), 2) AS baseline_stddev,
       CAST(n AS BIGINT) AS sample_size
FROM scored WHERE p >= 0.10
"""


@query("anom_statistical", STAT_SQL)
def q_anom_statistical(spark, sf_dir):
    """ANO-1: offers vs the 30-day (model, country) history mean."""
    o = T.offers(spark, sf_dir)
    return A.detect_statistical(o, H.scd2_rebuild(o)).select(
        *A.ANOMALY_COLS, "baseline_mean", "baseline_stddev", "sample_size")


@query("anom_temporal", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + f""",
probes AS (SELECT DISTINCT {KEYS}, crawl_date FROM offers),
ref AS (
  SELECT p.*, h.effective_total_usd AS ref_usd, h.valid_from_date AS ref_date
  FROM probes p ASOF JOIN history h
    ON p.product_model_id = h.product_model_id AND p.partner_id = h.partner_id
   AND p.country_code = h.country_code AND p.payment_type = h.payment_type
   AND p.crawl_date > h.valid_from_date
),
scored AS (
  SELECT o.offer_id, o.effective_total_usd, r.ref_usd, r.ref_date,
         CAST(abs({C_SQL.format(x='o.effective_total_usd')} - {C_SQL.format(x='r.ref_usd')}) AS DOUBLE)
           / CAST({C_SQL.format(x='r.ref_usd')} AS DOUBLE) AS p
  FROM offers o JOIN ref r USING ({KEYS}, crawl_date)
  WHERE r.ref_usd <> 0
)
SELECT offer_id, 'TEMPORAL' AS anomaly_type, {SEV_SQL.format(p='p')} AS severity,
       round(least(p, 1.0), 3) AS signal_score, effective_total_usd AS observed_price_usd,
       ref_usd, ref_date
FROM scored WHERE p >= 0.10
""")
def q_anom_temporal(spark, sf_dir):
    """ANO-2: offers vs the key's last price that started strictly before the crawl day."""
    o = T.offers(spark, sf_dir)
    return A.detect_temporal(o, H.scd2_rebuild(o)).select(*A.ANOMALY_COLS, "ref_usd", "ref_date")


@query("anom_cross_partner", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + f""",
cur AS (SELECT * FROM history WHERE valid_to_date IS NULL),
mkt AS (SELECT product_model_id, country_code, payment_type, count(DISTINCT partner_id) AS partner_count
        FROM cur GROUP BY 1, 2, 3),
peers AS (
  SELECT o.offer_id, o.effective_total_usd, count(*) AS peer_count,
         CAST(2 * median(CAST({C_SQL.format(x='c.effective_total_usd')} AS DOUBLE)) AS BIGINT) AS pair_c
  FROM offers o
  JOIN mkt m ON o.product_model_id = m.product_model_id AND o.country_code = m.country_code
            AND o.payment_type = m.payment_type AND m.partner_count >= 2
  JOIN cur c ON o.product_model_id = c.product_model_id AND o.country_code = c.country_code
            AND o.payment_type = c.payment_type AND c.partner_id <> o.partner_id
  GROUP BY o.offer_id, o.effective_total_usd
),
scored AS (
  SELECT *, CAST(abs({C_SQL.format(x='effective_total_usd')} * 2 - pair_c) AS DOUBLE) / CAST(pair_c AS DOUBLE) AS p
  FROM peers WHERE pair_c > 0
)
SELECT offer_id, 'CROSS_PARTNER' AS anomaly_type, {SEV_SQL.format(p='p')} AS severity,
       round(least(p, 1.0), 3) AS signal_score, effective_total_usd AS observed_price_usd,
       CAST(pair_c * 0.005 AS DECIMAL(13,3)) AS peer_median, CAST(peer_count AS BIGINT) AS peer_count
FROM scored WHERE p >= 0.10
""")
def q_anom_cross_partner(spark, sf_dir):
    """ANO-3: offers vs the median of the other partners' current prices."""
    o = T.offers(spark, sf_dir)
    return A.detect_cross_partner(o, H.scd2_rebuild(o)).select(
        *A.ANOMALY_COLS, "peer_median", "peer_count")


VARIANCE_GROUP = ["product_model_id", "country_code", "payment_type", "crawl_month"]

VARIANCE_SQL = T.with_sql(T.OFFERS_SQL) + f""",
o2 AS (SELECT *, date_trunc('month', crawl_date) AS crawl_month FROM offers),
mom AS (
  SELECT product_model_id, country_code, payment_type, crawl_month, count(*) AS gn,
         CAST(sum({C_SQL.format(x='effective_total_usd')}) AS HUGEINT) AS gs,
         sum(CAST({C_SQL.format(x='effective_total_usd')} AS HUGEINT) * {C_SQL.format(x='effective_total_usd')}) AS gss
  FROM o2 GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3
),
mom2 AS (SELECT *, sqrt(CAST(gn * gss - gs * gs AS DOUBLE) / CAST(gn * (gn - 1) AS DOUBLE)) AS gstd_c FROM mom),
scored AS (
  SELECT o.offer_id, o.effective_total_usd, m.gn, m.gs, m.gstd_c,
         CAST(abs(CAST({C_SQL.format(x='o.effective_total_usd')} AS HUGEINT) * m.gn - m.gs) AS DOUBLE)
           / CAST(m.gn AS DOUBLE) / m.gstd_c AS z
  FROM o2 o JOIN mom2 m USING (product_model_id, country_code, payment_type, crawl_month)
  WHERE m.gstd_c > 0
)
SELECT offer_id, 'SKU_VARIANCE' AS anomaly_type,
       CASE WHEN z >= 4.0 THEN 'HIGH' WHEN z >= 2.5 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       round(least(z / 10, 1.0), 3) AS signal_score, effective_total_usd AS observed_price_usd,
       CAST(gn AS BIGINT) AS group_size,
       CAST(((gs * 2 + gn) // (gn * 2)) / 100 AS DECIMAL(12,2)) AS group_mean,
       round(gstd_c / 100, 2) AS group_stddev, round(z, 6) AS z_score
FROM scored WHERE z >= 1.5
"""


def _variance(spark, sf_dir, o=None):
    o = (T.offers(spark, sf_dir) if o is None else o).withColumn("crawl_month", F.trunc("crawl_date", "month"))
    return A.detect_sku_variance(o, VARIANCE_GROUP)


@query("anom_variance", VARIANCE_SQL)
def q_anom_variance(spark, sf_dir):
    """ANO-4: z-score outliers within (model, country, payment, month) groups."""
    return _variance(spark, sf_dir).select(*A.ANOMALY_COLS, "group_size", "group_mean",
                                           "group_stddev", "z_score")


# ---------------------------------------------------------------------------
# Baselines and time aggregates
# ---------------------------------------------------------------------------

AS_OF = "2000-06-30"

BASELINE_SQL = T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + f""",
win AS (SELECT * FROM (VALUES (7), (30), (90)) t(window_days)),
days AS (
  SELECT window_days, CAST(unnest(generate_series(DATE '{AS_OF}' - (window_days - 1), DATE '{AS_OF}',
                                                  INTERVAL 1 DAY)) AS DATE) AS obs_date
  FROM win
),
dp AS (
  SELECT d.window_days, h.product_model_id, h.country_code, {C_SQL.format(x='h.effective_total_usd')} AS pc
  FROM days d JOIN history h
    ON d.obs_date BETWEEN h.valid_from_date AND COALESCE(h.valid_to_date, DATE '{AS_OF}')
)
SELECT DATE '{AS_OF}' AS baseline_as_of, product_model_id, country_code, window_days,
       count(*) AS sample_size,
       CAST(((CAST(sum(pc) AS HUGEINT) * 2 + count(*)) // (count(*) * 2)) / 100 AS DECIMAL(12,2)) AS mean_price_usd,
       round(sqrt(CAST(count(*) * sum(CAST(pc AS HUGEINT) * pc) - CAST(sum(pc) AS HUGEINT) * sum(pc) AS DOUBLE)
                  / CAST(count(*) * (count(*) - 1) AS DOUBLE)) / 100, 2) AS stddev_price_usd,
       CAST(round(quantile_cont(CAST(pc AS DOUBLE), 0.05), 0) / 100 AS DECIMAL(12,2)) AS p05_price_usd,
       CAST(round(quantile_cont(CAST(pc AS DOUBLE), 0.50), 0) / 100 AS DECIMAL(12,2)) AS p50_price_usd,
       CAST(round(quantile_cont(CAST(pc AS DOUBLE), 0.95), 0) / 100 AS DECIMAL(12,2)) AS p95_price_usd
FROM dp GROUP BY product_model_id, country_code, window_days HAVING count(*) >= 3
"""


@query("baselines", BASELINE_SQL)
def q_baselines(spark, sf_dir):
    """AGG-1: 7/30/90-day rolling baselines per (model, country) as of a fixed day."""
    return B.baselines(history(spark, sf_dir), AS_OF)


DAILY_SQL = T.with_sql(T.OFFERS_SQL) + f"""
SELECT CAST(crawl_ts_utc AS DATE) AS utc_date, partner_id, country_code, product_model_id, payment_type,
       count(*) AS offer_count,
       min(effective_total_usd) AS min_price_usd,
       CAST(((CAST(sum({C_SQL.format(x='effective_total_usd')}) AS HUGEINT) * 2 + count(*)) // (count(*) * 2)) / 100
            AS DECIMAL(12,2)) AS avg_price_usd,
       CAST(round(quantile_cont(CAST({C_SQL.format(x='effective_total_usd')} AS DOUBLE), 0.5), 0) / 100
            AS DECIMAL(12,2)) AS median_price_usd,
       max(effective_total_usd) AS max_price_usd,
       CASE WHEN count(*) >= 2 THEN
         round(sqrt(CAST(count(*) * sum(CAST({C_SQL.format(x='effective_total_usd')} AS HUGEINT) * {C_SQL.format(x='effective_total_usd')})
                    - CAST(sum({C_SQL.format(x='effective_total_usd')}) AS HUGEINT) * sum({C_SQL.format(x='effective_total_usd')}) AS DOUBLE)
                    / CAST(count(*) * (count(*) - 1) AS DOUBLE)) / 100, 2) END AS stddev_price_usd
FROM offers GROUP BY 1, 2, 3, 4, 5
"""


@query("daily_prices", DAILY_SQL)
def q_daily_prices(spark, sf_dir):
    """AGG-3: daily UTC aggregate per (partner, country, model, payment)."""
    return B.daily_prices(T.offers(spark, sf_dir))


HOURLY_SQL_CTE = f"""
hourly AS (
  SELECT date_trunc('hour', crawl_ts_utc) AS utc_hour, partner_id, country_code, product_model_id, payment_type,
         count(*) AS offer_count, sum({C_SQL.format(x='effective_total_usd')}) AS sum_cents,
         CAST(((sum({C_SQL.format(x='effective_total_usd')}) * 2 + count(*)) // (count(*) * 2)) / 100 AS DECIMAL(12,2)) AS avg_price_usd,
         min(effective_total_usd) AS min_price_usd, max(effective_total_usd) AS max_price_usd
  FROM offers GROUP BY 1, 2, 3, 4, 5
)"""


@query("hourly_prices", T.with_sql(T.OFFERS_SQL, HOURLY_SQL_CTE) + """
SELECT utc_hour, partner_id, country_code, product_model_id, payment_type, offer_count,
       CAST(sum_cents AS BIGINT) AS sum_cents, avg_price_usd, min_price_usd, max_price_usd FROM hourly
""")
def q_hourly_prices(spark, sf_dir):
    """AGG-4: hourly UTC aggregate."""
    return B.hourly_prices(T.offers(spark, sf_dir))


@query("rezone_daily", T.with_sql(T.OFFERS_SQL, HOURLY_SQL_CTE) + f"""
SELECT CAST(timezone('America/New_York', utc_hour AT TIME ZONE 'UTC') AS DATE) AS local_date,
       partner_id, country_code, product_model_id, payment_type,
       CAST(sum(offer_count) AS BIGINT) AS offer_count,
       CAST(((CAST(sum({C_SQL.format(x='avg_price_usd')}) AS HUGEINT) * 2 + count(*)) // (count(*) * 2)) / 100
            AS DECIMAL(12,2)) AS avg_of_hourly_avg
FROM hourly GROUP BY 1, 2, 3, 4, 5
""")
def q_rezone_daily(spark, sf_dir):
    """AGG-5: hourly aggregates re-cut into New York days."""
    return B.rezone_daily(B.hourly_prices(T.offers(spark, sf_dir)), "America/New_York")


CAL_SQL = """
bounds AS (SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events),
cal AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date_value FROM bounds)"""


def _events_calendar(spark, sf_dir):
    ev = T.read(spark, sf_dir, "events")
    bounds = ev.agg(F.to_date(F.min("ts")).alias("start_date"), F.to_date(F.max("ts")).alias("end_date"))
    return B.calendar_from(bounds)


@query("calendar", "WITH " + CAL_SQL.strip() + """
SELECT date_value, CAST(year(date_value) AS INTEGER) AS year, CAST(quarter(date_value) AS INTEGER) AS quarter,
       CAST(month(date_value) AS INTEGER) AS month, monthname(date_value) AS month_name,
       CAST(weekofyear(date_value) AS INTEGER) AS iso_week, CAST(isodow(date_value) AS INTEGER) AS iso_day_of_week,
       dayname(date_value) AS day_name, isodow(date_value) >= 6 AS is_weekend
FROM cal
""")
def q_calendar(spark, sf_dir):
    """SRC-8: calendar dimension over the span of the events table."""
    return _events_calendar(spark, sf_dir)


@query("fiscal", "WITH " + CAL_SQL.strip() + """
SELECT date_value,
       CAST(year(date_value + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year,
       CAST(quarter(date_value + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter,
       CAST(month(date_value + INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month,
       month(date_value) IN (3, 6, 9, 12) AND date_value = last_day(date_value) AS is_fiscal_quarter_end
FROM cal
""")
def q_fiscal(spark, sf_dir):
    """AGG-8: fiscal calendar (FQ1 = Oct–Dec) over the span of the events table."""
    return B.fiscal_calendar(_events_calendar(spark, sf_dir)).select(
        "date_value", "fiscal_year", "fiscal_quarter", "fiscal_month", "is_fiscal_quarter_end")


# ---------------------------------------------------------------------------
# Product-name matching
# ---------------------------------------------------------------------------

from pricelens.functions import text as X  # noqa: E402
from pricelens.operators import harmonise as HM  # noqa: E402

# FIXED VALUES (testbed) — category keywords of the part-name test dictionary
TEST_CATEGORIES = [("anvil", "ANVIL"), ("bolt", "BOLT"), ("gear", "GEAR"), ("gizmo", "GIZMO"),
                   ("plate", "PLATE"), ("ring", "RING"), ("rod", "ROD"), ("widget", "WIDGET")]
TEST_DICT = X.DEFAULT.with_categories(TEST_CATEGORIES)


def testbed_registry_rows(spark, sf_dir):
    """Registry CSV shape from ``part``: category, short and long description, id."""
    p = T.read(spark, sf_dir, "part")
    return p.select(F.col("p_type").alias("category"), F.col("p_name").alias("short_desc"),
                    F.concat_ws(" ", F.upper("p_name"), F.concat(F.col("p_size").cast("string"), F.lit("GB")),
                                F.col("p_brand")).alias("long_desc"),
                    F.col("p_partkey").alias("product_id"), F.col("p_partkey").alias("ord"))


def testbed_names(spark, sf_dir):
    """Offer names as partners would write them: part name plus size in GB."""
    li = T.read(spark, sf_dir, "lineitem").select("l_partkey")
    p = T.read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_size").cast("string"), F.lit("gb")).alias("name"))


def _sql_list(xs):
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _sql_re(p: str) -> str:
    return p.replace("(?U)", "").replace("'", "''")


def _sql_rep(r: str) -> str:
    return r.replace("$1", "\\1").replace("'", "''")


def normalise_sql(src: str, col: str, d=TEST_DICT) -> str:
    """CTE chain (DuckDB) turning ``src.col`` into ``tokens``; keeps all src columns."""
    pats = d.pattern_expansions
    steps = [f"n0 AS (SELECT *, regexp_replace(lower(coalesce({col}, '')), '[,()+\\[\\]{{}}]', ' ', 'g') AS s FROM {src})"]
    cur = "n0"
    for i, (p, r) in enumerate(pats[:3]):
        steps.append(f"na{i} AS (SELECT * REPLACE (regexp_replace(s, '{_sql_re(p)}', '{_sql_rep(r)}', 'g') AS s) FROM {cur})")
        cur = f"na{i}"
    steps.append(
        f"ntb AS (SELECT * REPLACE (array_to_string(list_transform(string_split("
        f"regexp_replace(s, '{_sql_re(d.terabyte_pattern)}', chr(1) || '\\1' || chr(1), 'g'), chr(1)), "
        f"lambda x, i: CASE WHEN i % 2 = 0 THEN CAST(CAST(x AS HUGEINT) * 1024 AS VARCHAR) || 'gb' ELSE x END), '') AS s) FROM {cur})")
    cur = "ntb"
    for i, (p, r) in enumerate(pats[3:]):
        steps.append(f"nb{i} AS (SELECT * REPLACE (regexp_replace(s, '{_sql_re(p)}', '{_sql_rep(r)}', 'g') AS s) FROM {cur})")
        cur = f"nb{i}"
    arms = " ".join(f"WHEN t = '{k}' THEN {_sql_list(v.split())}" for k, v in d.token_abbreviations.items())
    steps.append(
        f"ntok AS (SELECT * EXCLUDE (s), list_filter(flatten(list_transform(list_filter(list_transform("
        f"list_filter(regexp_split_to_array(s, '\\s+'), lambda t: t <> ''), "
        f"lambda t: regexp_replace(t, '^[\\-.,;:''\"]+|[\\-.,;:''\"]+$', '', 'g')), lambda t: t <> ''), "
        f"lambda t: CASE {arms} ELSE [t] END)), lambda t: NOT list_contains({_sql_list(d.noise_words)}, t)) AS tokens "
        f"FROM {cur})")
    return ",\n".join(steps)


def attributes_sql(src: str, d=TEST_DICT) -> str:
    """CTE (DuckDB) adding category … model_line from ``tokens``; output CTE ``attrs``."""
    cat = " ".join(f"WHEN contains(j, '{k}') THEN '{c}'" for k, c in d.category_keywords)
    sizes = ", ".join(str(s) for s in d.storage_sizes)
    chip = " ".join(
        f"WHEN regexp_matches(j, '{_sql_re(p)}') THEN " +
        (f"'{lab}'" if g is None else f"'{lab}' || regexp_extract(j, '{_sql_re(p)}', {g})")
        for p, lab, g in d.chip_patterns)
    conn = " ".join(f"WHEN contains(j, '{k}') THEN '{lab}'" for k, lab in d.connectivity)
    by_cat = {}
    for k, c in d.category_keywords:
        by_cat.setdefault(c, []).append(k)
    cskip = " ".join(f"WHEN '{c}' THEN {_sql_list(ks)}" for c, ks in by_cat.items())
    sint = "CASE WHEN size_inch = floor(size_inch) THEN CAST(CAST(floor(size_inch) AS BIGINT) AS VARCHAR) ELSE CAST(size_inch AS VARCHAR) END"
    return f"""
a0 AS (SELECT *, array_to_string(tokens, ' ') AS j FROM {src}),
a1 AS (
  SELECT *,
    CASE {cat} END AS category,
    CASE WHEN regexp_extract(j, '{_sql_re(d.storage_pattern)}', 1) <> ''
         THEN TRY_CAST(regexp_extract(j, '{_sql_re(d.storage_pattern)}', 1) AS BIGINT)
         ELSE TRY_CAST(list_filter(tokens, lambda t: regexp_matches(t, '^[0-9]+$') AND TRY_CAST(t AS BIGINT) IN ({sizes}))[1] AS BIGINT) END AS storage_gb,
    CASE WHEN regexp_extract(j, '{_sql_re(d.size_pattern)}', 1) <> ''
         THEN TRY_CAST(regexp_extract(j, '{_sql_re(d.size_pattern)}', 1) AS DOUBLE) END AS size_inch,
    CASE {chip} END AS chip,
    CASE {conn} END AS connectivity
  FROM a0
),
a2 AS (
  SELECT *, list_concat(
      COALESCE(CASE category {cskip} END, []::VARCHAR[]),
      CASE WHEN storage_gb IS NOT NULL AND storage_gb <> 0 THEN ['gb', CAST(storage_gb AS VARCHAR)] ELSE []::VARCHAR[] END,
      CASE WHEN connectivity IS NOT NULL THEN [lower(connectivity)] ELSE []::VARCHAR[] END,
      CASE WHEN size_inch IS NOT NULL AND size_inch <> 0 THEN [{sint} || 'inch', {sint}] ELSE []::VARCHAR[] END) AS skip
  FROM a1
),
a3 AS (SELECT *, list_filter(tokens, lambda t: NOT list_contains(skip, t)) AS kept FROM a2),
attrs AS (
  SELECT * EXCLUDE (j, skip, kept),
    CASE WHEN len(kept) > 0 THEN array_to_string(list_filter(kept, lambda x, i: list_position(kept, x) = i), ' ') END AS model_line
  FROM a3
)"""


def signature_sql() -> str:
    stext = "CASE WHEN size_inch = floor(size_inch) THEN CAST(CAST(floor(size_inch) AS BIGINT) AS VARCHAR) || '.0' ELSE CAST(size_inch AS VARCHAR) END"
    return ("array_to_string(list_filter([lower(COALESCE(category, '?')), "
            "lower(replace(COALESCE(model_line, ''), ' ', '_')), lower(COALESCE(chip, '')), "
            "CASE WHEN storage_gb IS NOT NULL AND storage_gb <> 0 THEN CAST(storage_gb AS VARCHAR) || 'gb' ELSE '' END, "
            "lower(COALESCE(connectivity, '')), "
            f"CASE WHEN size_inch IS NOT NULL AND size_inch <> 0 THEN {stext} || 'in' ELSE '' END], "
            "lambda x: x <> ''), '|')")


NAMES_SQL = """
names_src AS (
  SELECT DISTINCT p_name || ' ' || CAST(p_size AS VARCHAR) || 'gb' AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

REG_SRC_SQL = """
reg_src AS (
  SELECT trim(p_type) AS _cat, trim(p_name) AS _short,
         trim(concat_ws(' ', upper(p_name), CAST(p_size AS VARCHAR) || 'GB', p_brand)) AS _long,
         p_partkey AS _pid, p_partkey AS _ord,
         concat_ws(' ', trim(p_type), trim(p_name), trim(concat_ws(' ', upper(p_name), CAST(p_size AS VARCHAR) || 'GB', p_brand))) AS combined
  FROM part
)"""


def _registry_sql() -> str:
    fallback = ("CASE WHEN lower(trim(_cat)) = 'iphone' THEN 'IPHONE' WHEN lower(trim(_cat)) = 'ipad' THEN 'IPAD' "
                "WHEN lower(trim(_cat)) = 'airpods' THEN 'AIRPODS' WHEN lower(trim(_cat)) = 'watch' THEN 'WATCH' "
                "WHEN starts_with(lower(trim(_cat)), 'mac') THEN 'MAC' END")
    return (REG_SRC_SQL.strip() + ",\n" + normalise_sql("reg_src", "combined") + ",\n"
            + attributes_sql("ntok").strip() + f""",
reg1 AS (SELECT * REPLACE (COALESCE(category, {fallback}) AS category) FROM attrs),
reg2 AS (SELECT *, {signature_sql()} AS model_key FROM reg1),
registry AS (
  SELECT model_key, arg_min(_short, _ord) AS canonical_name,
         arg_min(COALESCE(category, _cat), _ord) AS entry_category,
         arg_min(category, _ord) AS category, arg_min(storage_gb, _ord) AS storage_gb,
         arg_min(chip, _ord) AS chip, arg_min(model_line, _ord) AS model_line,
         arg_min(connectivity, _ord) AS connectivity, arg_min(size_inch, _ord) AS size_inch,
         arg_min(tokens, _ord) AS tokens, min(_ord) AS registry_order, count(*) AS n_skus
  FROM reg2 GROUP BY model_key
)""")


def _registry(spark, sf_dir):
    return HM.build_registry(testbed_registry_rows(spark, sf_dir), TEST_DICT)


@query("name_tokens", "WITH " + NAMES_SQL.strip() + ",\n" + normalise_sql("names_src", "name") + """
SELECT name, array_to_string(tokens, ' ') AS token_text, CAST(len(tokens) AS INTEGER) AS n_tokens FROM ntok
""")
def q_name_tokens(spark, sf_dir):
    """HRM-1: normalised tokens of every distinct offer name."""
    n = testbed_names(spark, sf_dir).distinct()
    t = HM.normalise_names(n, "name", TEST_DICT)
    return t.select("name", F.array_join("tokens", " ").alias("token_text"),
                    F.size("tokens").alias("n_tokens"))


@query("name_attributes", "WITH " + NAMES_SQL.strip() + ",\n" + normalise_sql("names_src", "name") + ","
       + attributes_sql("ntok") + f"""
SELECT name, category, storage_gb, size_inch, chip, connectivity, model_line, {signature_sql()} AS signature
FROM attrs
""")
def q_name_attributes(spark, sf_dir):
    """HRM-2/3/4: attributes, model line and signature of every distinct offer name."""
    n = HM.prepare_names(testbed_names(spark, sf_dir), "name", TEST_DICT)
    return n.select("name", "category", "storage_gb", "size_inch", "chip", "connectivity",
                    "model_line", X.signature().alias("signature"))


@query("registry", "WITH " + _registry_sql() + """
SELECT model_key, canonical_name, entry_category, category, storage_gb, chip, model_line,
       connectivity, size_inch, array_to_string(tokens, ' ') AS token_text, registry_order,
       CAST(n_skus AS INTEGER) AS n_skus
FROM registry
""")
def q_registry(spark, sf_dir):
    """HRM-4 / SRC-4: SKU rows collapsed into one registry entry per model signature."""
    r = _registry(spark, sf_dir)
    return r.select("model_key", "canonical_name", "entry_category", "category", "storage_gb", "chip",
                    "model_line", "connectivity", "size_inch",
                    F.array_join("tokens", " ").alias("token_text"), "registry_order",
                    F.size("sku_ids").alias("n_skus"))


@query("registry_summary", "WITH " + _registry_sql() + """
SELECT COALESCE(entry_category, 'UNKNOWN') AS category, count(*) AS models, CAST(sum(n_skus) AS BIGINT) AS skus
FROM registry GROUP BY 1
UNION ALL
SELECT 'TOTAL', count(*), CAST(sum(n_skus) AS BIGINT) FROM registry
""")
def q_registry_summary(spark, sf_dir):
    """HRM-11: models and SKUs per category."""
    return HM.registry_summary(_registry(spark, sf_dir))


TOPK = 3


def _topk_sql(names_cte: str = NAMES_SQL) -> str:
    eq = ("CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL WHEN {a} IS NULL OR {b} IS NULL THEN 0.5::DOUBLE "
          "WHEN {a} = {b} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")
    ml = ("CASE WHEN q.model_line IS NULL AND r.model_line IS NULL THEN NULL "
          "WHEN q.model_line IS NULL OR r.model_line IS NULL THEN 0.5::DOUBLE "
          "WHEN q.model_line = r.model_line OR (len(list_distinct(string_split(q.model_line, ' '))) = len(list_intersect(list_distinct(string_split(q.model_line, ' ')), list_distinct(string_split(r.model_line, ' ')))) "
          "  AND len(list_distinct(string_split(r.model_line, ' '))) = len(list_intersect(list_distinct(string_split(q.model_line, ' ')), list_distinct(string_split(r.model_line, ' '))))) THEN 1.0::DOUBLE "
          "ELSE CAST(len(list_intersect(list_distinct(string_split(q.model_line, ' ')), list_distinct(string_split(r.model_line, ' ')))) AS DOUBLE) "
          "     / greatest(len(list_distinct(string_split(q.model_line, ' '))), len(list_distinct(string_split(r.model_line, ' ')))) END")
    sims = [("category", eq.format(a="q.category", b="r.category"), 1.5),
            ("storage_gb", eq.format(a="q.storage_gb", b="r.storage_gb"), 2.0),
            ("chip", eq.format(a="q.chip", b="r.chip"), 1.0),
            ("model_line", ml, 1.5),
            ("connectivity", eq.format(a="q.connectivity", b="r.connectivity"), 0.5),
            ("size_inch", eq.format(a="q.size_inch", b="r.size_inch"), 0.5)]
    sim_cols = ", ".join(f"{s} AS s_{n}" for n, s, _ in sims)
    earned = "0.0::DOUBLE" + "".join(f" + CASE WHEN s_{n} IS NOT NULL THEN s_{n} * {w} ELSE 0.0::DOUBLE END" for n, _, w in sims)
    possible = "0.0::DOUBLE" + "".join(f" + CASE WHEN s_{n} IS NOT NULL THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for n, _, w in sims)
    return ("WITH " + names_cte.strip() + ",\n" + normalise_sql("names_src", "name") + ","
            + attributes_sql("ntok").replace("attrs AS (", "qattrs AS (")
              .replace("a0 AS (", "qa0 AS (").replace("FROM a0", "FROM qa0")
              .replace("a1 AS (", "qa1 AS (").replace("FROM a1", "FROM qa1")
              .replace("a2 AS (", "qa2 AS (").replace("FROM a2", "FROM qa2")
              .replace("a3 AS (", "qa3 AS (").replace("FROM a3", "FROM qa3")
            + ",\n" + _registry_sql().replace("n0 AS (", "rn0 AS (").replace("FROM n0", "FROM rn0")
              .replace("na0 AS (", "rna0 AS (").replace("FROM na0", "FROM rna0")
              .replace("na1 AS (", "rna1 AS (").replace("FROM na1", "FROM rna1")
              .replace("na2 AS (", "rna2 AS (").replace("FROM na2", "FROM rna2")
              .replace("ntb AS (", "rntb AS (").replace("FROM ntb", "FROM rntb")
              .replace("nb", "rnb").replace("ntok AS (", "rntok AS (").replace("FROM ntok", "FROM rntok")
            + f""",
pairs AS (
  SELECT q.name, r.model_key, r.registry_order, {sim_cols},
         CASE WHEN len(q.tokens) = 0 OR len(r.tokens) = 0 THEN 0.0::DOUBLE
              ELSE CAST(len(list_intersect(list_distinct(q.tokens), list_distinct(r.tokens))) AS DOUBLE)
                   / len(list_distinct(list_concat(q.tokens, r.tokens))) END AS jacc,
         CASE WHEN length(array_to_string(q.tokens, ' ')) = 0 OR length(array_to_string(r.tokens, ' ')) = 0 THEN 0.0::DOUBLE
              ELSE 1.0 - CAST(levenshtein(array_to_string(q.tokens, ' '), array_to_string(r.tokens, ' ')) AS DOUBLE)
                   / greatest(length(array_to_string(q.tokens, ' ')), length(array_to_string(r.tokens, ' '))) END AS fuzz,
         q.category AS qc, r.category AS rc
  FROM qattrs q JOIN registry r ON q.category IS NULL OR r.category IS NULL OR q.category = r.category
),
scored AS (
  SELECT *, CASE WHEN possible > 0 THEN earned / possible ELSE 0.0::DOUBLE END AS attr
  FROM (SELECT *, {earned} AS earned, {possible} AS possible FROM pairs)
),
comb AS (SELECT *, 0.5 * attr + 0.3 * jacc + 0.2 * fuzz AS c FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY round(c, 3) DESC, registry_order ASC) AS rank
  FROM comb
)
SELECT name, CAST(rank AS INTEGER) AS rank, model_key, round(c, 3) AS score,
       CASE WHEN attr >= 0.95 THEN 'HIGH' WHEN c >= 0.85 THEN 'HIGH' WHEN c >= 0.60 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
       round(attr, 3) AS attr_match, round(jacc, 3) AS token_jaccard, round(fuzz, 3) AS char_fuzz
FROM ranked WHERE rank <= {TOPK}
""")


@query("name_topk", _topk_sql())
def q_name_topk(spark, sf_dir):
    """HRM-5..9: top-3 registry matches per distinct offer name (Levenshtein character signal)."""
    m = HM.match_top_k(testbed_names(spark, sf_dir), _registry(spark, sf_dir), TOPK, None, TEST_DICT,
                       "levenshtein")
    return m.select("name", "rank", "model_key", "score", "confidence", "attr_match",
                    "token_jaccard", "char_fuzz")


@query("name_match_exact")
def q_name_match_exact(spark, sf_dir):
    """HRM-7/8/10: top match per name with the matching-block ratio as character signal (no SQL form)."""
    m = HM.match_top_k(testbed_names(spark, sf_dir), _registry(spark, sf_dir), 1, None, TEST_DICT, "blocks")
    return m.select("name", "model_key", "score", "confidence", "attr_match", "token_jaccard", "char_fuzz")


@query("name_color", "SELECT p_partkey, CASE list_filter(string_split_regex(upper(COALESCE(p_name, '')), '\\s+'), "
       "lambda t: list_contains(" + _sql_list(list(config.COLOR_CODES)) + ", t))[1] "
       + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in config.COLOR_CODES.items()) + " END AS color FROM part")
def q_name_color(spark, sf_dir):
    """PRJ-9: colour from the upper-cased description (first token in the colour-code map)."""
    p = T.read(spark, sf_dir, "part")
    return p.select("p_partkey", X.extract_color(F.col("p_name")).alias("color"))


# ---------------------------------------------------------------------------
# DQ reports, payments, FX, local time, history reports
# ---------------------------------------------------------------------------

SEM_FLAGS = {
    "DQ_HARM_001": "harmonise_confidence = 'LOW'",
    "DQ_PRICE_001": "min_usd IS NOT NULL AND (effective_total_usd < min_usd OR effective_total_usd > max_usd)",
}
BANDS_SQL = "bands AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', {lo}, {hi})" for c, lo, hi in T.TESTBED_PRICE_BANDS) + ") t(band_category, min_usd, max_usd))"

GATED_FACTS_SQL = T.with_sql(T.OFFERS_SQL, T.STAGING_SQL, T.COUNTRIES_SQL, T.PARTNERS_SQL, CATALOG_SQL,
                             STAGED_SQL, RATES_SQL, BANDS_SQL,
                             FACTS_SQL.format(gate="dq_status = 'PRE_FACT_PASSED' AND")) + f""",
gated AS (
  SELECT f.offer_id, f.source_batch_id, f.category_code, f.harmonise_confidence, f.harmonise_score,
         f.raw_product_name, f.product_model_id, f.partner_id, f.country_code, f.payment_type,
         CAST(round(f.effective_total_local * COALESCE(f.fx_rate, CAST(1 AS DECIMAL(16,8))), 2) AS DECIMAL(12,2)) AS effective_total_usd
  FROM facts f
),
sem AS (
  SELECT g.*, b.min_usd, b.max_usd, {_flag_cols(SEM_FLAGS)}
  FROM gated g LEFT JOIN bands b ON g.category_code = b.band_category
)"""


def gated_facts(spark, sf_dir, stg=None):
    return FX.build_facts(staged(spark, sf_dir, stg), testbed_rates(spark, sf_dir), gate=True)


def semantic_eval(spark, sf_dir, stg=None):
    return Q.evaluate(Q.prepare_semantic(gated_facts(spark, sf_dir, stg),
                                         Q.price_bands(spark, T.TESTBED_PRICE_BANDS)), "SEMANTIC")


@query("dq_semantic_rules", GATED_FACTS_SQL + "," + _stage_sql(SEM_FLAGS, "sem"))
def q_dq_semantic(spark, sf_dir):
    """DQ-12/13 + DQE-1: SEMANTIC rules on gated facts; total = fact rows."""
    return Q.stage_output(semantic_eval(spark, sf_dir), "SEMANTIC", Q.catalog(spark))


ALL_OUTPUT_SQL_PARTS = {
    "ing": (INGEST_FLAGS, "ing_all"),
    "pre": (PREFACT_FLAGS, "staged"),
    "sem": (SEM_FLAGS, "sem"),
}


def _long_sql(flags, src, tag):
    sums = ", ".join(f"CAST(sum(CASE WHEN f_{r} THEN 1 ELSE 0 END) AS BIGINT) AS {r}" for r in flags)
    return (f"agg_{tag} AS (SELECT source_batch_id, CAST(count(*) AS BIGINT) AS total_records, {sums} "
            f"FROM {src} GROUP BY source_batch_id),\n"
            f"long_{tag} AS (UNPIVOT agg_{tag} ON {', '.join(flags)} INTO NAME rule_id VALUE failed_records)")


ALL_OUTPUT_SQL = GATED_FACTS_SQL + f""",
ing_all AS (SELECT source_batch_id, {_flag_cols(INGEST_FLAGS)} FROM staging),
{_long_sql(INGEST_FLAGS, 'ing_all', 'i')},
{_long_sql(PREFACT_FLAGS, 'staged', 'p')},
{_long_sql(SEM_FLAGS, 'sem', 's')},
dq_output AS (
  SELECT l.source_batch_id, l.rule_id, c.rule_name, c.rule_category, c.severity, c.target_stage,
         l.total_records, l.failed_records
  FROM (SELECT * FROM long_i UNION ALL SELECT * FROM long_p UNION ALL SELECT * FROM long_s) l
  JOIN catalog c USING (rule_id)
)"""


def dq_output(spark, sf_dir, stg=None):
    cat = Q.catalog(spark)
    stg = staging_table(spark, sf_dir) if stg is None else stg
    out_i = Q.stage_output(Q.evaluate(stg, "INGEST"), "INGEST", cat)
    stg_ing = Q.evaluate(stg, "INGEST")
    s1 = stg_ing.withColumn("dq_status", Q.ingest_status(stg_ing)).drop("_hits")
    pre = Q.evaluate(Q.prepare_prefact(s1, T.countries(spark, sf_dir), T.partners(spark, sf_dir)),
                     "PRE_FACT", eligible=F.col("dq_status") == "INGEST_PASSED")
    out_p = Q.stage_output(pre, "PRE_FACT", cat)
    out_s = Q.stage_output(semantic_eval(spark, sf_dir, stg), "SEMANTIC", cat)
    return out_i.unionByName(out_p).unionByName(out_s)


@query("dq_pass_rates", ALL_OUTPUT_SQL + """
SELECT c.rule_id, c.rule_name, c.target_stage, c.severity,
       CAST(COALESCE(sum(o.total_records), 0) AS BIGINT) AS total_records,
       CAST(COALESCE(sum(o.failed_records), 0) AS BIGINT) AS failed_records,
       CASE WHEN COALESCE(sum(o.total_records), 0) = 0 THEN 1.0
            ELSE round(1.0 - CAST(COALESCE(sum(o.failed_records), 0) AS DOUBLE) / sum(o.total_records), 4) END AS pass_rate
FROM catalog c LEFT JOIN dq_output o USING (rule_id)
GROUP BY c.rule_id, c.rule_name, c.target_stage, c.severity
""")
def q_dq_pass_rates(spark, sf_dir):
    """RPT-5: pass rate per active rule over all batches (rules that never ran included)."""
    return Q.rule_pass_rates(Q.catalog(spark), dq_output(spark, sf_dir))


@query("dq_by_stage", ALL_OUTPUT_SQL + """
SELECT s.target_stage, s.stage_order,
       CAST(COALESCE(sum(o.failed_records), 0) AS BIGINT) AS failed_records,
       CAST(COALESCE(sum(o.total_records), 0) AS BIGINT) AS total_records
FROM (VALUES ('INGEST', 0), ('PRE_FACT', 1), ('SEMANTIC', 2)) s(target_stage, stage_order)
LEFT JOIN dq_output o USING (target_stage)
GROUP BY s.target_stage, s.stage_order
""")
def q_dq_by_stage(spark, sf_dir):
    """DQE-8: failed records per stage, all three stages present."""
    return Q.dq_by_stage(dq_output(spark, sf_dir), spark)


@query("dq_latest", ALL_OUTPUT_SQL + f""",
runs AS (
  SELECT *, 'first' AS run_id, TIMESTAMP '2024-01-01 00:00:00' AS run_ts FROM dq_output
  UNION ALL
  SELECT *, 'again', TIMESTAMP '2024-01-02 00:00:00' FROM dq_output WHERE source_batch_id <= 1996 AND target_stage <> 'SEMANTIC'
)
SELECT rule_id, run_id, run_ts, source_batch_id, failed_records, total_records FROM (
  SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY run_ts DESC, source_batch_id DESC) AS rn FROM runs) WHERE rn = 1
""")
def q_dq_latest(spark, sf_dir):
    """DQE-6: the newest result per rule, where some batches and stages have been run twice."""
    out = dq_output(spark, sf_dir)
    again = out.filter((F.col("source_batch_id") <= 1996) & (F.col("target_stage") != "SEMANTIC"))
    runs = Q.stamped(out, "first", "2024-01-01 00:00:00", "run_ts").unionByName(Q.stamped(again, "again", "2024-01-02 00:00:00", "run_ts"))
    return Q.latest_rule_results(runs).select("rule_id", "run_id", "run_ts", "source_batch_id", "failed_records", "total_records")


@query("dq_summary", ALL_OUTPUT_SQL + """
SELECT count(DISTINCT rule_id) AS rules_run, CAST(max(total_records) AS BIGINT) AS max_total_records,
       CAST(COALESCE(sum(CASE WHEN severity = 'HIGH' THEN failed_records END), 0) AS BIGINT) AS violations_high,
       CAST(COALESCE(sum(CASE WHEN severity NOT IN ('HIGH', 'LOW') THEN failed_records END), 0) AS BIGINT) AS violations_medium,
       CAST(COALESCE(sum(CASE WHEN severity = 'LOW' THEN failed_records END), 0) AS BIGINT) AS violations_low
FROM dq_output
""")
def q_dq_summary(spark, sf_dir):
    """DQE-7: rules run, largest total, violations by severity."""
    return Q.dq_summary(dq_output(spark, sf_dir))


BAD_SQL = ALL_OUTPUT_SQL + f""",
bad AS (
  SELECT source_batch_id, offer_id, rule_id FROM (
    SELECT source_batch_id, offer_id, {', '.join('f_' + r for r in INGEST_FLAGS)} FROM (
      SELECT offer_id, source_batch_id, {_flag_cols(INGEST_FLAGS)} FROM staging))
  UNPIVOT (hit FOR rule_id IN ({', '.join('f_' + r for r in INGEST_FLAGS)})) WHERE hit
  UNION ALL
  SELECT source_batch_id, offer_id, rule_id FROM (
    SELECT source_batch_id, offer_id, {', '.join('f_' + r for r in PREFACT_FLAGS)} FROM staged)
  UNPIVOT (hit FOR rule_id IN ({', '.join('f_' + r for r in PREFACT_FLAGS)})) WHERE hit
  UNION ALL
  SELECT source_batch_id, offer_id, rule_id FROM (
    SELECT source_batch_id, offer_id, {', '.join('f_' + r for r in SEM_FLAGS)} FROM sem)
  UNPIVOT (hit FOR rule_id IN ({', '.join('f_' + r for r in SEM_FLAGS)})) WHERE hit
),
bad_records AS (
  SELECT b.source_batch_id, b.offer_id, substr(b.rule_id, 3) AS rule_id, c.severity, c.target_stage
  FROM bad b JOIN catalog c ON substr(b.rule_id, 3) = c.rule_id
)"""


def bad_records(spark, sf_dir, stg=None):
    cat = Q.catalog(spark)
    stg = staging_table(spark, sf_dir) if stg is None else stg
    ing = Q.evaluate(stg, "INGEST")
    s1 = ing.withColumn("dq_status", Q.ingest_status(ing))
    pre = Q.evaluate(Q.prepare_prefact(s1.drop("_hits"), T.countries(spark, sf_dir), T.partners(spark, sf_dir)),
                     "PRE_FACT", eligible=F.col("dq_status") == "INGEST_PASSED")
    keys = ["offer_id"]
    return (Q.bad_records(ing, cat, keys).unionByName(Q.bad_records(pre, cat, keys))
            .unionByName(Q.bad_records(semantic_eval(spark, sf_dir, stg), cat, keys)))


@query("violations_by", BAD_SQL + """
SELECT rule_id, target_stage, severity, 'NEW' AS status, count(*) AS violations
FROM bad_records GROUP BY 1, 2, 3
""")
def q_violations_by(spark, sf_dir):
    """AGG-9 / RPT-4: violations per rule, stage, severity and status."""
    c = F.broadcast(Q.catalog(spark).select("rule_id", "target_stage"))
    return Q.violations_by(bad_records(spark, sf_dir).join(c, "rule_id"),
                           "rule_id", "target_stage", "severity", "status")


@query("blocked_count", BAD_SQL + """
SELECT count(DISTINCT (source_batch_id, offer_id)) AS blocked_rows FROM bad_records WHERE target_stage = 'PRE_FACT'
""")
def q_blocked_count(spark, sf_dir):
    """RPT-2: distinct rows blocked at PRE_FACT."""
    return Q.blocked_count(bad_records(spark, sf_dir), Q.catalog(spark), ["source_batch_id", "offer_id"])


@query("clean_facts", BAD_SQL + """
SELECT g.source_batch_id, count(*) AS clean_offers
FROM gated g WHERE NOT EXISTS (SELECT 1 FROM bad_records b WHERE b.offer_id = g.offer_id)
GROUP BY g.source_batch_id
""")
def q_clean_facts(spark, sf_dir):
    """DQE-9: gated facts without any bad record, counted per batch."""
    stg = staging_table(spark, sf_dir)
    clean = Q.clean_facts(gated_facts(spark, sf_dir, stg), bad_records(spark, sf_dir, stg), ["offer_id"])
    return clean.groupBy("source_batch_id").agg(F.count(F.lit(1)).alias("clean_offers"))


@query("payment_split", T.with_sql(T.OFFERS_SQL) + """
SELECT offer_id, payment_type,
       CASE WHEN payment_type = 'FULL' THEN full_price END AS pay_full_price,
       CASE WHEN payment_type = 'INSTALMENT' THEN monthly_amount END AS pay_monthly_amount,
       CASE WHEN payment_type = 'INSTALMENT' THEN instalment_months END AS pay_instalment_months
FROM offers
""")
def q_payment_split(spark, sf_dir):
    """SNK-2: split payments into child tables and re-join them 1:1."""
    o = T.offers(spark, sf_dir)
    full, inst = FX.split_payments(o)
    return FX.with_payment(o.select("offer_id", "payment_type"), full, inst)


@query("effective_totals", T.with_sql(T.OFFERS_SQL) + """
SELECT offer_id,
       CAST(CASE WHEN payment_type = 'FULL' THEN COALESCE(full_price, 0)
                 ELSE COALESCE(monthly_amount, 0) * COALESCE(instalment_months, 0) END AS DECIMAL(12,2)) AS effective_total_local
FROM offers
""")
def q_effective_totals(spark, sf_dir):
    """PRJ-5: effective local total (full price, or monthly × months)."""
    o = T.offers(spark, sf_dir)
    return o.select("offer_id", FX.effective_total(o).alias("effective_total_local"))


@query("asof_fx", T.with_sql(T.OFFERS_SQL, RATES_SQL) + """
SELECT o.offer_id, r.rate AS fx_rate, r.effective_date AS fx_rate_date
FROM offers o ASOF LEFT JOIN rates r ON o.currency_code = r.from_currency_code AND o.crawl_date >= r.effective_date
""")
def q_asof_fx(spark, sf_dir):
    """FX-1: latest rate on or before each offer's crawl day (rows without one kept)."""
    return FX.asof_fx(T.offers(spark, sf_dir), testbed_rates(spark, sf_dir)).select(
        "offer_id", "fx_rate", "fx_rate_date")


@query("cross_rate", T.with_sql(RATES_SQL) + """,
iv AS (SELECT *, lead(effective_date) OVER (PARTITION BY from_currency_code ORDER BY effective_date) AS nxt FROM rates),
daily AS (
  SELECT from_currency_code, CAST(unnest(generate_series(effective_date, COALESCE(nxt - 1, effective_date), INTERVAL 1 DAY)) AS DATE) AS rate_day, rate
  FROM iv
)
SELECT a.from_currency_code, 'CUR0' AS to_currency_code, a.rate_day,
       round(CAST(a.rate AS DOUBLE) / CAST(b.rate AS DOUBLE), 8) AS cross_rate
FROM daily a JOIN daily b ON a.rate_day = b.rate_day AND b.from_currency_code = 'CUR0'
""")
def q_cross_rate(spark, sf_dir):
    """FX-2/3: forward-filled daily rates, expressed in units of CUR0."""
    return FX.cross_rate(FX.daily_rates(testbed_rates(spark, sf_dir)), "CUR0")


# FIXED VALUES (testbed) — market time zone per region
REGION_TZ = [(0, "Africa/Cairo"), (1, "America/New_York"), (2, "Asia/Tokyo"),
             (3, "Europe/London"), (4, "Asia/Dubai")]


@query("local_time", T.with_sql(T.OFFERS_SQL) + """,
zones AS (SELECT * FROM (VALUES """ + ", ".join(f"({k}, '{z}')" for k, z in REGION_TZ) + """) t(country_code, iana_name))
SELECT o.offer_id, timezone(COALESCE(z.iana_name, 'UTC'), o.crawl_ts_utc AT TIME ZONE 'UTC') AS crawl_ts_local,
       CAST(timezone(COALESCE(z.iana_name, 'UTC'), o.crawl_ts_utc AT TIME ZONE 'UTC') AS DATE) AS crawl_date_local
FROM offers o LEFT JOIN zones z USING (country_code)
""")
def q_local_time(spark, sf_dir):
    """PRJ-7: market-local crawl time and day through the country's zone."""
    zones = spark.createDataFrame(REGION_TZ, "country_code int, iana_name string")
    return FX.with_local_time(T.offers(spark, sf_dir), zones, "market").select(
        "offer_id", "crawl_ts_local", "crawl_date_local")


@query("price_as_of", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + f"""
SELECT * FROM history
WHERE valid_from_date <= DATE '{AS_OF}' AND (valid_to_date IS NULL OR valid_to_date >= DATE '{AS_OF}')
""")
def q_price_as_of(spark, sf_dir):
    """HIS-4: history rows valid on a fixed day."""
    return H.price_as_of(history(spark, sf_dir), AS_OF)


@query("top_spreads", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + """,
cur AS (
  SELECT product_model_id, country_code, payment_type, count(DISTINCT partner_id) AS partner_count,
         min(effective_total_usd) AS cheapest_price_usd,
         CAST(max(effective_total_usd) - min(effective_total_usd) AS DECIMAL(12,2)) AS price_spread_usd,
         CASE WHEN avg(CAST(effective_total_usd AS DOUBLE)) > 0
              THEN round(CAST(max(effective_total_usd) - min(effective_total_usd) AS DOUBLE)
                         / avg(CAST(effective_total_usd AS DOUBLE)), 6) END AS price_spread_pct
  FROM history WHERE valid_to_date IS NULL GROUP BY 1, 2, 3
)
SELECT * FROM cur WHERE partner_count > 1
ORDER BY price_spread_pct DESC NULLS LAST, product_model_id, country_code, payment_type LIMIT 10
""")
def q_top_spreads(spark, sf_dir):
    """HIS-7: the ten widest cross-partner spreads (a top-k report)."""
    return H.top_spreads(H.current_prices(history(spark, sf_dir)), 10)


@query("history_timeline", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + """
SELECT *, CASE WHEN valid_to_date IS NULL THEN 'CURRENT' ELSE 'HISTORICAL' END AS status FROM history
""")
def q_history_timeline(spark, sf_dir):
    """HIS-6: history with CURRENT/HISTORICAL labels."""
    return H.price_timeline(history(spark, sf_dir))


@query("history_rows", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + f""",
touched AS (SELECT DISTINCT source_batch_id, {KEYS} FROM offers),
per_key AS (SELECT {KEYS}, count(*) AS n FROM history GROUP BY ALL)
SELECT t.source_batch_id, CAST(sum(p.n) AS BIGINT) AS history_rows
FROM touched t JOIN per_key p USING ({KEYS}) GROUP BY t.source_batch_id
""")
def q_history_rows(spark, sf_dir):
    """HIS-8: history rows for the keys each batch touched."""
    return H.history_rows_for_batch(history(spark, sf_dir), T.offers(spark, sf_dir))


INCR_BATCH = 2001


@query("scd2_incremental", T.with_sql(T.OFFERS_SQL) + ",\n" + HISTORY_SQL
       .replace("FROM offers) WHERE rn = 1", f"FROM offers WHERE source_batch_id < {INCR_BATCH}) WHERE rn = 1")
       + f""",
latest AS (
  SELECT {KEYS}, currency_code, effective_total_local, effective_total_usd, crawl_date AS valid_from_date FROM (
    SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY crawl_ts_utc DESC, offer_id DESC) AS rn
    FROM offers WHERE source_batch_id = {INCR_BATCH}) WHERE rn = 1
),
changed AS (
  SELECT l.*, e.effective_total_usd AS e_usd FROM latest l
  LEFT JOIN (SELECT * FROM history WHERE valid_to_date IS NULL) e USING ({KEYS})
  WHERE e.effective_total_usd IS NULL
     OR (e.effective_total_usd <> l.effective_total_usd AND l.valid_from_date > e.valid_from_date)
)
SELECT h.{KEYS.replace(', ', ', h.')}, h.currency_code, h.effective_total_local, h.effective_total_usd, h.valid_from_date,
       CASE WHEN h.valid_to_date IS NULL AND c.valid_from_date IS NOT NULL AND c.e_usd IS NOT NULL
                 AND h.effective_total_usd <> c.effective_total_usd
            THEN c.valid_from_date - 1 ELSE h.valid_to_date END AS valid_to_date
FROM history h LEFT JOIN changed c USING ({KEYS})
UNION ALL
SELECT {KEYS}, currency_code, effective_total_local, effective_total_usd, valid_from_date, NULL FROM changed
""")
def q_scd2_incremental(spark, sf_dir):
    """HIS-2: history of earlier batches, then one batch merged in."""
    o = T.offers(spark, sf_dir)
    base = H.scd2_rebuild(o.filter(F.col("source_batch_id") < INCR_BATCH))
    return H.scd2_apply(base, o.filter(F.col("source_batch_id") == INCR_BATCH))


# ---------------------------------------------------------------------------
# Batch summaries, funnels, review, config context, calibration, pipeline
# ---------------------------------------------------------------------------

from pricelens.operators import context as CX  # noqa: E402
from pricelens.operators import reports as R  # noqa: E402
from pricelens.operators import review as RV  # noqa: E402
from pricelens.plans import pipeline as P  # noqa: E402

SUMMARY_SQL = BAD_SQL + f""",
tot AS (SELECT source_batch_id, count(*) AS total_records FROM staging GROUP BY 1),
ld AS (SELECT source_batch_id, count(*) AS loaded_records,
              count(*) FILTER (WHERE harmonise_confidence = 'HIGH') AS harmonise_high,
              count(*) FILTER (WHERE harmonise_confidence = 'MEDIUM') AS harmonise_medium,
              count(*) FILTER (WHERE harmonise_confidence = 'LOW') AS harmonise_low,
              count(DISTINCT product_model_id) AS unique_products_covered
       FROM gated GROUP BY 1),
bd AS (SELECT source_batch_id, count(*) AS bad_records_count FROM bad_records GROUP BY 1),
summary AS (
  SELECT t.source_batch_id, t.total_records,
         COALESCE(l.loaded_records, 0) AS loaded_records, COALESCE(b.bad_records_count, 0) AS bad_records_count,
         COALESCE(l.harmonise_high, 0) AS harmonise_high, COALESCE(l.harmonise_medium, 0) AS harmonise_medium,
         COALESCE(l.harmonise_low, 0) AS harmonise_low,
         COALESCE(l.unique_products_covered, 0) AS unique_products_covered,
         CAST(0 AS BIGINT) AS anomalies_detected,
         greatest(0, t.total_records - COALESCE(l.loaded_records, 0) - COALESCE(b.bad_records_count, 0)) AS rows_unchanged,
         CASE WHEN t.total_records = 0 THEN 1.0 ELSE round(CAST(COALESCE(l.loaded_records, 0) AS DOUBLE) / t.total_records, 4) END AS load_success_rate,
         CASE WHEN COALESCE(l.loaded_records, 0) = 0 THEN 0.0
              ELSE round(CAST(l.harmonise_high AS DOUBLE) / l.loaded_records, 4) END AS harmonise_high_pct
  FROM tot t LEFT JOIN ld l USING (source_batch_id) LEFT JOIN bd b USING (source_batch_id)
)"""


def testbed_summary(spark, sf_dir):
    stg = staging_table(spark, sf_dir)
    return R.batch_summary(stg, gated_facts(spark, sf_dir, stg), bad_records(spark, sf_dir, stg))


@query("batch_summary", SUMMARY_SQL + "\nSELECT * FROM summary")
def q_batch_summary(spark, sf_dir):
    """AGG-6: per-batch load summary (anomaly count filled by the pipeline)."""
    return testbed_summary(spark, sf_dir)


@query("low_success", SUMMARY_SQL + "\nSELECT source_batch_id, load_success_rate FROM summary WHERE load_success_rate < 0.95")
def q_low_success(spark, sf_dir):
    """AGG-7: batches whose load rate is below a bar (0.95 on the testbed)."""
    return R.low_success_batches(testbed_summary(spark, sf_dir), 0.95).select(
        "source_batch_id", "load_success_rate")


@query("batch_funnel", BAD_SQL + """
SELECT s.source_batch_id, s.staged, COALESCE(f.in_fact, 0) AS in_fact, COALESCE(b.flagged, 0) AS flagged
FROM (SELECT source_batch_id, count(*) AS staged FROM staging GROUP BY 1) s
LEFT JOIN (SELECT source_batch_id, count(*) AS in_fact FROM gated GROUP BY 1) f USING (source_batch_id)
LEFT JOIN (SELECT source_batch_id, count(DISTINCT offer_id) AS flagged FROM bad_records GROUP BY 1) b USING (source_batch_id)
""")
def q_batch_funnel(spark, sf_dir):
    """AGG-10: staged → in fact → flagged per batch."""
    stg = staging_table(spark, sf_dir)
    return R.batch_funnel(stg, gated_facts(spark, sf_dir, stg), bad_records(spark, sf_dir, stg))


GATED_HISTORY_SQL = f"""
gated_history AS (
  SELECT * FROM (
    SELECT *, lag(usd) OVER (PARTITION BY {KEYS} ORDER BY crawl_date) AS prev FROM (
      SELECT {KEYS}, crawl_date,
             CAST(round(effective_total_local * COALESCE(fx_rate, CAST(1 AS DECIMAL(16,8))), 2) AS DECIMAL(12,2)) AS usd,
             row_number() OVER (PARTITION BY {KEYS}, crawl_date ORDER BY crawl_ts_utc DESC, offer_id DESC) AS rn
      FROM facts) WHERE rn = 1)
  WHERE prev IS NULL OR prev <> usd
)"""


def gated_history(spark, sf_dir):
    """SCD-2 history of the gated facts."""
    return H.scd2_rebuild(gated_facts(spark, sf_dir).withColumn("crawl_date", F.to_date("crawl_ts_utc")))


@query("funnel", GATED_FACTS_SQL + "," + GATED_HISTORY_SQL + """
SELECT 'staged' AS step, 1 AS step_order, count(*) AS rows FROM staged
UNION ALL SELECT 'ingest_passed', 2, count(*) FILTER (WHERE dq_status IN ('INGEST_PASSED', 'PRE_FACT_PASSED')) FROM staged
UNION ALL SELECT 'matched', 3, count(*) FILTER (WHERE product_model_id IS NOT NULL) FROM staged
UNION ALL SELECT 'prefact_passed', 4, count(*) FILTER (WHERE dq_status = 'PRE_FACT_PASSED') FROM staged
UNION ALL SELECT 'fact', 5, count(*) FROM gated
UNION ALL SELECT 'history', 6, count(*) FROM gated_history
""")
def q_funnel(spark, sf_dir):
    """RPT-6: staged → ingest-passed → matched → pre-fact-passed → fact → history."""
    return R.funnel(staged(spark, sf_dir), gated_facts(spark, sf_dir), gated_history(spark, sf_dir))


@query("review_page", BAD_SQL + """
SELECT source_batch_id, offer_id, rule_id, severity FROM bad_records
WHERE severity = 'HIGH'
ORDER BY source_batch_id DESC, offer_id DESC, rule_id DESC LIMIT 25 OFFSET 50
""")
def q_review_page(spark, sf_dir):
    """REV-1: third page (25 per page) of the HIGH-severity queue, newest first."""
    page, _ = RV.review_queue(bad_records(spark, sf_dir), status="NEW", severity="HIGH", page=3, size=25)
    return page.select("source_batch_id", "offer_id", "rule_id", "severity")


@query("resolutions", BAD_SQL + """
SELECT rule_id, CASE WHEN rule_id = 'DQ_NULL_002' THEN 'RESOLVED' WHEN rule_id = 'DQ_FMT_001' THEN 'IGNORED'
                     ELSE 'NEW' END AS status, count(*) AS records
FROM bad_records GROUP BY 1, 2
""")
def q_resolutions(spark, sf_dir):
    """REV-2: resolve every blank-country record, ignore every unknown-country record."""
    bad = bad_records(spark, sf_dir)
    acts = bad.filter(F.col("rule_id").isin("DQ_NULL_002", "DQ_FMT_001")).select(
        "offer_id", "rule_id",
        F.when(F.col("rule_id") == "DQ_NULL_002", "RESOLVED").otherwise("IGNORED").alias("action"),
        F.lit("reviewed").alias("notes"), F.lit(None).cast("timestamp").alias("resolved_at"))
    out, _ = RV.apply_resolutions(bad, acts)
    return out.groupBy("rule_id", "status").agg(F.count(F.lit(1)).alias("records"))


@query("rule_trend", ALL_OUTPUT_SQL + """
SELECT rule_id, source_batch_id,
       CASE WHEN total_records = 0 THEN 1.0 ELSE round(1.0 - CAST(failed_records AS DOUBLE) / total_records, 4) END AS pass_rate,
       lag(CASE WHEN total_records = 0 THEN 1.0 ELSE round(1.0 - CAST(failed_records AS DOUBLE) / total_records, 4) END)
         OVER (PARTITION BY rule_id ORDER BY source_batch_id) AS prev_pass_rate,
       round((CASE WHEN total_records = 0 THEN 1.0 ELSE round(1.0 - CAST(failed_records AS DOUBLE) / total_records, 4) END)
             - lag(CASE WHEN total_records = 0 THEN 1.0 ELSE round(1.0 - CAST(failed_records AS DOUBLE) / total_records, 4) END)
               OVER (PARTITION BY rule_id ORDER BY source_batch_id), 4) AS pass_rate_change
FROM dq_output
""")
def q_rule_trend(spark, sf_dir):
    """RPT-12: pass rate per rule and batch with the previous batch's rate."""
    return R.rule_trend(dq_output(spark, sf_dir).withColumn(
        "pass_rate", F.when(F.col("total_records") == 0, F.lit(1.0)).otherwise(
            F.round(F.lit(1.0) - F.col("failed_records").cast("double") / F.col("total_records"), 4))))


# FIXED VALUES (testbed) — threshold config rows (key, value, category?, country?)
TEST_THRESHOLDS = [("stat_bar", 0.25, None, None), ("stat_bar", 0.30, "MAC", None),
                   ("stat_bar", 0.20, None, 2), ("stat_bar", 0.35, "WATCH", 3),
                   ("z_bar", 1.5, None, None), ("z_bar", 2.0, "IPAD", None)]


def _sql_v(v):
    return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))


@query("thresholds", T.with_sql(T.OFFERS_SQL) + """,
cfg AS (SELECT * FROM (VALUES """ + ", ".join(
    f"('{k}', {v}::DOUBLE, {_sql_v(c)}::VARCHAR, {_sql_v(n)}::INTEGER)" for k, v, c, n in TEST_THRESHOLDS) + """)
        t(config_key, config_value, c_cat, c_cty)),
keys AS (SELECT DISTINCT category_code, country_code FROM offers),
m AS (
  SELECT k.category_code, k.country_code, c.config_key, c.config_value,
         (CASE WHEN c.c_cat IS NOT NULL THEN 2 ELSE 0 END) + (CASE WHEN c.c_cty IS NOT NULL THEN 1 ELSE 0 END) AS specificity
  FROM keys k JOIN cfg c ON (c.c_cat IS NULL OR c.c_cat = k.category_code) AND (c.c_cty IS NULL OR c.c_cty = k.country_code)
)
SELECT config_key, category_code, country_code, arg_max(config_value, specificity) AS config_value,
       max(specificity) AS specificity
FROM m GROUP BY 1, 2, 3
""")
def q_thresholds(spark, sf_dir):
    """ANO-13: most specific threshold per (key, category, country) in the offers."""
    cfg = spark.createDataFrame(TEST_THRESHOLDS, "config_key string, config_value double, "
                                                 "category_code string, country_code int")
    return CX.resolve_thresholds(cfg, T.offers(spark, sf_dir))


# FIXED VALUES (testbed) — lifecycle months per testbed category
TEST_LIFECYCLE = [(code, months) for code, months, _ in config.CATEGORY_LIFECYCLE]
LIFE_AS_OF = "1996-01-10"


@query("lifecycle", T.with_sql(T.OFFERS_SQL) + """,
cats AS (SELECT * FROM (VALUES """ + ", ".join(f"('{c}', {m})" for c, m in TEST_LIFECYCLE) + """) t(category_code, lifecycle_months)),
models AS (SELECT product_model_id, category_code, partner_id, min(crawl_date) AS launch_date,
                  CAST(NULL AS DATE) AS eol_date FROM offers GROUP BY 1, 2, 3)
SELECT m.product_model_id, m.partner_id, m.launch_date,
       CASE WHEN m.launch_date IS NULL THEN 'STABLE'
            WHEN DATE '""" + LIFE_AS_OF + """' - m.launch_date < 14 THEN 'NEW'
            WHEN m.eol_date IS NOT NULL AND m.eol_date < DATE '""" + LIFE_AS_OF + """' THEN 'EOL'
            WHEN c.lifecycle_months IS NOT NULL AND m.launch_date + to_months(c.lifecycle_months - 3) < DATE '""" + LIFE_AS_OF + """' THEN 'LEGACY'
            ELSE 'STABLE' END AS lifecycle_status
FROM models m LEFT JOIN cats c USING (category_code)
""")
def q_lifecycle(spark, sf_dir):
    """ANO-14: lifecycle status of each (model, partner) line, launch = first offer day."""
    o = T.offers(spark, sf_dir)
    models = o.groupBy("product_model_id", "category_code", "partner_id").agg(
        F.min("crawl_date").alias("launch_date")).withColumn("eol_date", F.lit(None).cast("date"))
    cats = spark.createDataFrame(TEST_LIFECYCLE, "category_code string, lifecycle_months int")
    return CX.lifecycle_status(models, cats, LIFE_AS_OF).select(
        "product_model_id", "partner_id", "launch_date", "lifecycle_status")


@query("calibrate_cross_partner", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + """,
m AS (SELECT product_model_id, country_code, payment_type, count(DISTINCT partner_id) AS k,
             min(effective_total_usd) AS mn, max(effective_total_usd) AS mx
      FROM history WHERE valid_to_date IS NULL GROUP BY 1, 2, 3),
s AS (SELECT CAST(mx - mn AS DOUBLE) / CAST(mn AS DOUBLE) AS spread FROM m WHERE k >= 2 AND mn > 0)
SELECT round(quantile_cont(spread, 0.5), 6) AS p50, round(quantile_cont(spread, 0.9), 6) AS p90,
       round(quantile_cont(spread, 0.99), 6) AS p99, count(*) AS n FROM s
""")
def q_calibrate_cross_partner(spark, sf_dir):
    """CAL-1: cross-partner spread percentiles over open prices."""
    return CX.calibrate_cross_partner(history(spark, sf_dir))


@query("calibrate_temporal", T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + f""",
c AS (SELECT CAST(abs(effective_total_usd - lag(effective_total_usd) OVER w) AS DOUBLE) AS d,
             CAST(lag(effective_total_usd) OVER w AS DOUBLE) AS p
      FROM history WINDOW w AS (PARTITION BY {KEYS} ORDER BY valid_from_date)),
s AS (SELECT d / p AS change FROM c WHERE p IS NOT NULL AND p > 0)
SELECT round(quantile_cont(change, 0.5), 6) AS p50, round(quantile_cont(change, 0.9), 6) AS p90,
       round(quantile_cont(change, 0.99), 6) AS p99, count(*) AS n FROM s
""")
def q_calibrate_temporal(spark, sf_dir):
    """CAL-2: percentiles of relative change between successive prices."""
    return CX.calibrate_temporal(history(spark, sf_dir))


@query("calibrate_severity", STAT_SQL.split("\nSELECT offer_id, 'STATISTICAL'")[0] + """
SELECT round(quantile_cont(round(least(p, 1.0), 3), 0.80), 6) AS medium_bar,
       round(quantile_cont(round(least(p, 1.0), 3), 0.95), 6) AS high_bar, count(*) AS n
FROM scored WHERE p >= 0.10
""")
def q_calibrate_severity(spark, sf_dir):
    """CAL-4: severity bars from the STATISTICAL score distribution."""
    o = T.offers(spark, sf_dir)
    return CX.calibrate_severity(A.detect_statistical(o, H.scd2_rebuild(o)))


# ---------------------------------------------------------------------------
# Rollups, reports, dimension builds, promotions, detector union
# ---------------------------------------------------------------------------

from pricelens.sources import sinks as SK  # noqa: E402

PARTNER_BATCH_SQL = """
pb AS (
  SELECT t.*, COALESCE(l.loaded_records, 0) AS loaded_records, COALESCE(b.bad_records_count, 0) AS bad_records_count
  FROM (SELECT partner_id, source_batch_id, max(crawl_ts_utc) AS loaded_at, count(*) AS total_records FROM offers GROUP BY 1, 2) t
  LEFT JOIN (SELECT partner_id, source_batch_id, count(*) AS loaded_records FROM gated GROUP BY 1, 2) l USING (partner_id, source_batch_id)
  LEFT JOIN (SELECT s.partner_id, b.source_batch_id, count(*) AS bad_records_count
             FROM bad_records b JOIN staging s USING (offer_id) GROUP BY 1, 2) b USING (partner_id, source_batch_id)
)"""


def partner_batches(spark, sf_dir):
    """One summary row per (partner, batch) of the testbed, loaded at its last crawl,
    with its gated facts and its bad records."""
    grain = ["partner_id", "source_batch_id"]
    total = T.offers(spark, sf_dir).groupBy(*grain).agg(F.max("crawl_ts_utc").alias("loaded_at"), F.count(F.lit(1)).alias("total_records"))
    stg = staging_table(spark, sf_dir)
    loaded = gated_facts(spark, sf_dir, stg).groupBy(*grain).agg(F.count(F.lit(1)).alias("loaded_records"))
    whose = stg.select("offer_id", "partner_id")
    bad = bad_records(spark, sf_dir, stg).join(whose, "offer_id").groupBy(*grain).agg(F.count(F.lit(1)).alias("bad_records_count"))
    return total.join(loaded, grain, "left").join(bad, grain, "left").na.fill(0, ["loaded_records", "bad_records_count"])


@query("daily_batches", BAD_SQL + "," + PARTNER_BATCH_SQL + """
SELECT partner_id, CAST(loaded_at AS DATE) AS load_date, count(*) AS batches,
       CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(loaded_records) AS BIGINT) AS loaded_records,
       CAST(sum(bad_records_count) AS BIGINT) AS bad_records_count
FROM pb GROUP BY 1, 2
""")
def q_daily_batches(spark, sf_dir):
    """AGG-11: batch summaries rolled up per partner and load day."""
    return R.daily_batches(partner_batches(spark, sf_dir)).select(
        "partner_id", "load_date", "batches", "total_records", "loaded_records", "bad_records_count")


@query("recent_batches", BAD_SQL + "," + PARTNER_BATCH_SQL + """
SELECT partner_id, source_batch_id, loaded_at, loaded_records, bad_records_count, CAST(recency AS INTEGER) AS recency FROM (
  SELECT *, row_number() OVER (PARTITION BY partner_id ORDER BY loaded_at DESC, source_batch_id DESC) AS recency
  FROM pb) WHERE recency <= 3
""")
def q_recent_batches(spark, sf_dir):
    """AGG-12: the three most recent batches of each partner."""
    return R.recent_batches(partner_batches(spark, sf_dir), 3).select(
        "partner_id", "source_batch_id", "loaded_at", "loaded_records", "bad_records_count", "recency")


@query("regional_daily", T.with_sql(T.OFFERS_SQL) + """,
zones AS (SELECT * FROM (VALUES """ + ", ".join(f"({k}, '{z}')" for k, z in REGION_TZ) + """) t(country_code, iana_name))
SELECT o.country_code, CAST(timezone(z.iana_name, o.crawl_ts_utc AT TIME ZONE 'UTC') AS DATE) AS crawl_date_local,
       count(*) AS offer_count
FROM offers o JOIN zones z USING (country_code) GROUP BY 1, 2
""")
def q_regional_daily(spark, sf_dir):
    """AGG-13: offers per country and market-local day."""
    zones = spark.createDataFrame(REGION_TZ, "country_code int, iana_name string")
    return B.regional_daily(FX.with_local_time(T.offers(spark, sf_dir), zones, "market"))


@query("confidence_distribution", GATED_FACTS_SQL + """
SELECT t.harmonise_confidence, COALESCE(c.offers, 0) AS offers
FROM (VALUES ('HIGH'), ('MEDIUM'), ('LOW'), ('MANUAL')) t(harmonise_confidence)
LEFT JOIN (SELECT harmonise_confidence, count(*) AS offers FROM gated GROUP BY 1) c USING (harmonise_confidence)
""")
def q_confidence_distribution(spark, sf_dir):
    """RPT-3: gated facts per match tier, every tier present."""
    return R.confidence_distribution(gated_facts(spark, sf_dir), spark)


@query("report_totals", BAD_SQL + "," + GATED_HISTORY_SQL + """,
t AS (
  SELECT 'staging_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM staging
  UNION ALL SELECT 'fact_rows', CAST(count(*) AS DOUBLE) FROM gated
  UNION ALL SELECT 'history_rows', CAST(count(*) AS DOUBLE) FROM gated_history
  UNION ALL SELECT 'bad_records', CAST(count(*) AS DOUBLE) FROM bad_records
  UNION ALL SELECT 'batches', CAST(count(DISTINCT source_batch_id) AS DOUBLE) FROM staging
  UNION ALL SELECT 'active_rules', CAST(count(*) AS DOUBLE) FROM catalog
  UNION ALL SELECT 'high_share', round(CAST(count(*) FILTER (WHERE harmonise_confidence = 'HIGH') AS DOUBLE) / count(*), 4) FROM gated
)
SELECT * FROM t
""")
def q_report_totals(spark, sf_dir):
    """RPT-1: table sizes, history rows, batches, active rules and HIGH share."""
    return R.report_totals(T.staging(spark, sf_dir), gated_facts(spark, sf_dir), gated_history(spark, sf_dir),
                           bad_records(spark, sf_dir), Q.catalog(spark))


@query("recent_bad", BAD_SQL + """
SELECT source_batch_id, offer_id, rule_id, target_stage FROM bad_records
ORDER BY source_batch_id DESC, offer_id DESC, rule_id DESC LIMIT 20
""")
def q_recent_bad(spark, sf_dir):
    """RPT-7: the twenty newest bad records with their stage (a top-n report)."""
    return R.recent_bad(bad_records(spark, sf_dir), Q.catalog(spark), 20).select(
        "source_batch_id", "offer_id", "rule_id", "target_stage")


@query("blocked_rows", BAD_SQL + """
SELECT source_batch_id, offer_id, min(rule_id) AS rule_id FROM bad_records
WHERE target_stage = 'PRE_FACT' GROUP BY 1, 2
""")
def q_blocked_rows(spark, sf_dir):
    """RPT-8: first PRE_FACT violation of every blocked row."""
    return R.blocked_rows(bad_records(spark, sf_dir), Q.catalog(spark)).select(
        "source_batch_id", "offer_id", "rule_id")


# When the testbed's bad records were detected: a rerun within the year, and the first
# PRE_FACT rule a month after the others, so that time follows neither batch nor rule id.
LATE_RULE = min(PREFACT_FLAGS)
STAMPED_SQL = BAD_SQL + f""",
stamped AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(COALESCE(TRY_CAST(split_part(offer_id, ':', 1) AS BIGINT), 0) % 365 + CASE WHEN rule_id = '{LATE_RULE}' THEN 30 ELSE 0 END AS INTEGER)) AS detected_at
  FROM bad_records
)"""


def stamped_records(spark, sf_dir):
    first = F.split_part(F.col("offer_id"), F.lit(":"), F.lit(1)).try_cast("bigint")
    days = F.coalesce(first, F.lit(0)) % 365 + F.when(F.col("rule_id") == LATE_RULE, 30).otherwise(0)
    return bad_records(spark, sf_dir).withColumn(
        "detected_at", F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days.cast("int")))


@query("review_newest", STAMPED_SQL + """
SELECT source_batch_id, offer_id, rule_id, severity, strftime(detected_at, '%Y-%m-%d') AS detected_on FROM stamped
WHERE severity = 'HIGH'
ORDER BY detected_at DESC, source_batch_id DESC, offer_id DESC, rule_id DESC LIMIT 25 OFFSET 25
""")
def q_review_newest(spark, sf_dir):
    """REV-1: second page (25 per page) of the HIGH-severity queue, by time of detection."""
    page, _ = RV.review_queue(stamped_records(spark, sf_dir), status="NEW", severity="HIGH", page=2, size=25)
    return page.select("source_batch_id", "offer_id", "rule_id", "severity",
                       F.date_format("detected_at", "yyyy-MM-dd").alias("detected_on"))


@query("recent_bad_newest", STAMPED_SQL + """
SELECT source_batch_id, offer_id, rule_id, target_stage, strftime(detected_at, '%Y-%m-%d') AS detected_on FROM stamped
ORDER BY detected_at DESC, source_batch_id DESC, offer_id DESC, rule_id DESC LIMIT 20
""")
def q_recent_bad_newest(spark, sf_dir):
    """RPT-7: the twenty bad records detected last, with their stage (a top-n report)."""
    return R.recent_bad(stamped_records(spark, sf_dir), Q.catalog(spark), 20).select(
        "source_batch_id", "offer_id", "rule_id", "target_stage",
        F.date_format("detected_at", "yyyy-MM-dd").alias("detected_on"))


@query("blocked_first", STAMPED_SQL + """
SELECT source_batch_id, offer_id, arg_min(rule_id, (detected_at, rule_id)) AS rule_id FROM stamped
WHERE target_stage = 'PRE_FACT' GROUP BY 1, 2
""")
def q_blocked_first(spark, sf_dir):
    """RPT-8: the PRE_FACT violation of every blocked row that was detected first."""
    return R.blocked_rows(stamped_records(spark, sf_dir), Q.catalog(spark)).select(
        "source_batch_id", "offer_id", "rule_id")


@query("low_confidence", BAD_SQL + """
SELECT source_batch_id, offer_id FROM bad_records WHERE rule_id = 'DQ_HARM_001'
""")
def q_low_confidence(spark, sf_dir):
    """RPT-9: offers flagged for LOW match confidence."""
    return R.low_confidence(bad_records(spark, sf_dir)).select("source_batch_id", "offer_id")


@query("batch_rule_report", ALL_OUTPUT_SQL + f"""
SELECT source_batch_id, rule_id, target_stage, failed_records,
       CASE WHEN total_records = 0 THEN 1.0 ELSE round(1.0 - CAST(failed_records AS DOUBLE) / total_records, 4) END AS pass_rate
FROM dq_output WHERE source_batch_id = {INCR_BATCH}
""")
def q_batch_rule_report(spark, sf_dir):
    """RPT-11: rule results of one batch with their stage."""
    out = dq_output(spark, sf_dir).filter(F.col("source_batch_id") == INCR_BATCH)
    return out.select("source_batch_id", "rule_id", "target_stage", "failed_records",
                      F.when(F.col("total_records") == 0, F.lit(1.0)).otherwise(
                          F.round(F.lit(1.0) - F.col("failed_records").cast("double") / F.col("total_records"), 4))
                      .alias("pass_rate"))


@query("promotions", BAD_SQL + """
SELECT s.source_batch_id, s.offer_id,
       CASE WHEN i.offer_id IS NULL AND p.offer_id IS NULL THEN 'PRE_FACT_PASSED'
            WHEN i.offer_id IS NULL THEN 'INGEST_PASSED' ELSE 'PENDING' END AS dq_status
FROM staging s
LEFT JOIN (SELECT DISTINCT offer_id FROM bad_records WHERE target_stage = 'INGEST') i USING (offer_id)
LEFT JOIN (SELECT DISTINCT offer_id FROM bad_records WHERE target_stage = 'PRE_FACT') p USING (offer_id)
""")
def q_promotions(spark, sf_dir):
    """DQE-4/5: promotions driven by a stored bad-record table (anti-join on the row key)."""
    stg = staging_table(spark, sf_dir)
    bad = bad_records(spark, sf_dir, stg)
    cat = Q.catalog(spark)
    ing_ids = [r[0] for r in config.RULES if r[4] == "INGEST"]
    pre_ids = [r[0] for r in config.RULES if r[4] == "PRE_FACT"]
    s = stg.select("source_batch_id", "offer_id").withColumn("dq_status", F.lit("PENDING"))
    s = Q.mark_passed(s, bad, ["offer_id"], "INGEST_PASSED", rule_ids=ing_ids)
    s = Q.mark_passed(s, bad, ["offer_id"], "PRE_FACT_PASSED", only_from="INGEST_PASSED", rule_ids=pre_ids)
    return s.select("source_batch_id", "offer_id", "dq_status")


@query("ffill_fx", T.with_sql(RATES_SQL) + """,
bounds AS (SELECT min(effective_date) AS s, max(effective_date) + 30 AS e FROM rates),
cur AS (SELECT DISTINCT from_currency_code AS currency_code FROM rates),
grid AS (SELECT currency_code, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM cur, bounds)
SELECT g.currency_code, g.day, r.rate AS fx_rate, r.effective_date AS fx_rate_date
FROM grid g ASOF LEFT JOIN rates r ON g.currency_code = r.from_currency_code AND g.day >= r.effective_date
""")
def q_ffill_fx(spark, sf_dir):
    """FX-2: one forward-filled rate per currency and day, through 30 days past the last rate."""
    rates = testbed_rates(spark, sf_dir)
    start = rates.select(F.min("effective_date")).scalar()
    end = rates.select(F.date_add(F.max("effective_date"), 30)).scalar()
    return FX.ffill_fx(rates, start, end).select("currency_code", "day", "fx_rate", "fx_rate_date")


@query("daily_fx", T.with_sql(RATES_SQL) + """,
last AS (SELECT from_currency_code, arg_max(rate, effective_date) AS rate, max(effective_date) AS d FROM rates GROUP BY 1)
SELECT from_currency_code, 'USD' AS to_currency_code, rate,
       CAST(unnest(generate_series(d, d + 6, INTERVAL 1 DAY)) AS DATE) AS effective_date
FROM last
""")
def q_daily_fx(spark, sf_dir):
    """SRC-7: seven daily rows per currency from its latest rate."""
    rates = testbed_rates(spark, sf_dir)
    last = FX.last_rates(rates).select("from_currency_code", F.lit("USD").alias("to_currency_code"),
                                       F.col("last_rate").alias("rate"), "last_date")
    return SK.daily_fx(last, F.col("last_date"), F.date_add("last_date", 6))


@query("product_dims", "WITH " + _registry_sql() + """
SELECT r.model_key, r.entry_category AS category_code, CAST(r.n_skus AS INTEGER) AS n_skus
FROM registry r WHERE r.entry_category IS NOT NULL
""")
def q_product_dims(spark, sf_dir):
    """SRC-6: model and SKU dimensions for the registry entries of known categories."""
    known = _registry(spark, sf_dir).select(F.col("entry_category").alias("category_code")).where("category_code IS NOT NULL").distinct()
    cats = known.unionByName(spark.createDataFrame([("NOT SOLD",)], "category_code string"))
    models, skus = SK.build_product_dims(_registry(spark, sf_dir), cats)
    n = skus.groupBy("model_key").agg(F.count(F.lit(1)).cast("int").alias("n_skus"))
    return models.join(n, "model_key").select("model_key", "category_code", "n_skus")


@query("append_new", T.with_sql(T.PARTNERS_SQL) + """
SELECT DISTINCT partner_code FROM partners WHERE country_code >= 2
  AND partner_code NOT IN (SELECT partner_code FROM partners WHERE country_code < 2)
""")
def q_append_new(spark, sf_dir):
    """SRC-5: rows of one region's partners not yet in the dimension of the other regions."""
    pa = T.partners(spark, sf_dir)
    target = pa.filter(F.col("country_code") < 2).select("partner_code")
    rows = pa.filter(F.col("country_code") >= 2).select("partner_code")
    return SK.append_new(target, rows, ["partner_code"])


def _offers_month(spark, sf_dir):
    return T.offers(spark, sf_dir).withColumn("crawl_month", F.trunc("crawl_date", "month"))


def stored_offers(spark, sf_dir, *more):
    """Offers with their month, dealt by key and day, and their history, written once:
    history, probes and joins with what is known of a key on a day need no further
    shuffle of the offers. ``more`` names further columns of the offers."""
    o = T.offers(spark, sf_dir, names=False).select("offer_id", *H.KEY, "effective_total_usd", "crawl_ts_utc", "crawl_date", "source_batch_id", *more)
    o = cut_and_deal(o, [*H.KEY, "crawl_date"], name="offers")
    return o.withColumn("crawl_month", F.trunc("crawl_date", "month")), cut_lineage(H.scd2_rebuild(o, value=["effective_total_usd"]), name="history")


def _all_anoms(spark, sf_dir, min_sev="MEDIUM"):
    return A.detect(*stored_offers(spark, sf_dir), "live", min_sev, sku_group=VARIANCE_GROUP)


def _sub(sql: str) -> str:
    return "(" + sql + ")"


ANOM_ALL_SQL = ("SELECT offer_id, anomaly_type, severity, signal_score, observed_price_usd FROM " + _sub(STAT_SQL)
                + " UNION ALL SELECT offer_id, anomaly_type, severity, signal_score, observed_price_usd FROM "
                + _sub(ORACLE["anom_temporal"])
                + " UNION ALL SELECT offer_id, anomaly_type, severity, signal_score, observed_price_usd FROM "
                + _sub(ORACLE["anom_cross_partner"])
                + " UNION ALL SELECT offer_id, anomaly_type, severity, signal_score, observed_price_usd FROM "
                + _sub(VARIANCE_SQL))


@query("anom_all", "SELECT * FROM (" + ANOM_ALL_SQL + ") WHERE severity IN ('HIGH', 'MEDIUM')")
def q_anom_all(spark, sf_dir):
    """ANO-6: all four detectors, minimum severity MEDIUM, one row per (offer, signal)."""
    return _all_anoms(spark, sf_dir).select(*A.ANOMALY_COLS)


# offers as the pipeline sees them: its own gated facts at USD
PIPELINE_OFFERS_SQL = ",\n".join(c.strip() for c in (
    T.OFFERS_SQL.replace("offers AS (", "raw_offers AS (", 1), T.STAGING_SQL.replace("FROM offers)", "FROM raw_offers)"),
    T.COUNTRIES_SQL, T.PARTNERS_SQL, STAGED_SQL, RATES_SQL, FACTS_SQL.format(gate="dq_status = 'PRE_FACT_PASSED' AND"))) + """,
offers AS (
  SELECT * REPLACE (CAST(round(effective_total_local * COALESCE(fx_rate, CAST(1 AS DECIMAL(16,8))), 2) AS DECIMAL(12,2)) AS effective_total_usd)
  FROM (SELECT *, CAST(NULL AS DECIMAL(12,2)) AS effective_total_usd FROM facts)
)"""
PIPELINE_ANOMS_SQL = ANOM_ALL_SQL.replace(T.OFFERS_SQL.strip(), PIPELINE_OFFERS_SQL)
assert PIPELINE_ANOMS_SQL != ANOM_ALL_SQL


@query("pipeline_summary", SUMMARY_SQL + ",\nfound AS (SELECT DISTINCT offer_id FROM (" + PIPELINE_ANOMS_SQL + """)),
per AS (SELECT s.source_batch_id, count(*) AS k FROM found JOIN staging s USING (offer_id) GROUP BY 1)
SELECT s.* REPLACE (COALESCE(p.k, 0) AS anomalies_detected) FROM summary s LEFT JOIN per p USING (source_batch_id)
""")
def q_pipeline_summary(spark, sf_dir):
    """PIPE-1: full Path A over the testbed staging (all batches), summary rows."""
    ctx = P.Context(countries=T.countries(spark, sf_dir), partners=T.partners(spark, sf_dir),
                    rates=testbed_rates(spark, sf_dir),
                    bands=Q.price_bands(spark, T.TESTBED_PRICE_BANDS), catalog=Q.catalog(spark),
                    sku_group=tuple(VARIANCE_GROUP), run_id="run-1", run_ts="2024-01-01 00:00:00")
    return P.run_pipeline(T.staging(spark, sf_dir), ctx)["summary"]


@query("anom_counts", """
SELECT anomaly_type, count(*) FILTER (WHERE severity = 'HIGH') AS n_high, count(*) FILTER (WHERE severity = 'MEDIUM') AS n_medium,
       count(*) FILTER (WHERE severity = 'LOW') AS n_low
FROM (""" + ANOM_ALL_SQL + """) GROUP BY 1
""")
def q_anom_counts(spark, sf_dir):
    """ANO-7: anomaly counts by type and severity, all four signals."""
    return A.anomaly_counts(_all_anoms(spark, sf_dir, "LOW"))


@query("fact_store", T.with_sql(T.OFFERS_SQL) + """
SELECT strftime(crawl_ts_utc, '%Y-%m') AS crawl_month, CAST(l_orderkey % 3 AS INTEGER) AS source_batch_id, count(*) AS facts,
       CAST(sum(CAST(effective_total_usd * 100 AS BIGINT)) AS BIGINT) AS total_cents
FROM offers GROUP BY 1, 2
""")
def q_fact_store(spark, sf_dir):
    """SNK-1: three batches that share every month, written one after the other, the
    first of them twice; all rows read back."""
    from pricelens.session import checkpoint_dir
    import uuid
    path = f"{checkpoint_dir(spark).rstrip('/')}/facts-{uuid.uuid4().hex}"
    o = T.offers(spark, sf_dir).withColumn("source_batch_id", F.pmod("l_orderkey", F.lit(3)).cast("int"))
    for batch in (0, 1, 2, 0):
        SK.write_fact(o.filter(F.col("source_batch_id") == batch), path)
    back = spark.read.schema("effective_total_usd decimal(12,2), crawl_month string, source_batch_id int").parquet(path)
    return back.groupBy("crawl_month", "source_batch_id").agg(
        F.count(F.lit(1)).alias("facts"), F.sum((F.col("effective_total_usd") * 100).cast("bigint")).alias("total_cents"))


@query("anom_top", "WITH a AS (SELECT * FROM (" + ANOM_ALL_SQL + """)),
j AS (SELECT a.*, o.crawl_ts_utc FROM a JOIN (""" + T.with_sql(T.OFFERS_SQL) + """ SELECT offer_id, crawl_ts_utc FROM offers) o USING (offer_id)),
w AS (SELECT * FROM j WHERE crawl_ts_utc >= (SELECT max(crawl_ts_utc) FROM j) - INTERVAL 30 DAY)
SELECT offer_id, anomaly_type, severity, signal_score FROM w
ORDER BY CASE severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END DESC, signal_score DESC,
         crawl_ts_utc DESC, offer_id DESC, anomaly_type DESC
LIMIT 20
""")
def q_anom_top(spark, sf_dir):
    """ANO-18: the twenty most severe anomalies of the last 30 days (a top-n report)."""
    from pricelens.session import cut_lineage
    a = cut_lineage(_all_anoms(spark, sf_dir, "LOW"), name="anomalies")  # read for the newest crawl and for the cut
    return A.top_anomalies(a, n=20).select("offer_id", "anomaly_type", "severity", "signal_score")


# ---------------------------------------------------------------------------
# Anomaly bookkeeping, context and calibration
# ---------------------------------------------------------------------------

LIVE_SEV = "CASE WHEN p >= 0.25 THEN 'HIGH' WHEN p >= 0.15 THEN 'MEDIUM' WHEN p >= 0.10 THEN 'LOW' END"
CONFIG_SEV = "CASE WHEN p >= 0.8 THEN 'HIGH' WHEN p >= 0.5 THEN 'MEDIUM' WHEN p >= 0.25 THEN 'LOW' END"
TEMPORAL_CONFIG_SQL = ORACLE["anom_temporal"].replace(LIVE_SEV, CONFIG_SEV).replace("WHERE p >= 0.10", "WHERE p >= 0.25")
assert TEMPORAL_CONFIG_SQL != ORACLE["anom_temporal"]


def _temporal(spark, sf_dir, profile="live"):
    o = T.offers(spark, sf_dir)
    return A.detect_temporal(o, H.scd2_rebuild(o), profile)


@query("anom_upsert", "WITH st AS (SELECT *, CASE WHEN severity = 'HIGH' THEN 'IN_REVIEW' ELSE 'NEW' END AS status, "
       "CASE WHEN severity = 'HIGH' THEN 'analyst-1' END AS assignee FROM (" + ORACLE["anom_temporal"] + ") "
       "WHERE CAST(substr(split_part(offer_id, ':', 5), 1, 4) AS INTEGER) < " + str(INCR_BATCH) + "), "
       "nw AS (SELECT * FROM (" + TEMPORAL_CONFIG_SQL + """))
SELECT COALESCE(nw.offer_id, st.offer_id) AS offer_id, COALESCE(nw.anomaly_type, st.anomaly_type) AS anomaly_type,
       CASE WHEN nw.severity IS NOT NULL THEN nw.severity ELSE st.severity END AS severity,
       CASE WHEN nw.severity IS NOT NULL THEN nw.signal_score ELSE st.signal_score END AS signal_score,
       COALESCE(st.status, 'NEW') AS status, st.assignee,
       CASE WHEN nw.severity IS NOT NULL THEN TIMESTAMP '2021-01-01 00:00:00' ELSE TIMESTAMP '2020-01-01 00:00:00' END AS detected_at
FROM st FULL OUTER JOIN nw ON st.offer_id = nw.offer_id AND st.anomaly_type = nw.anomaly_type
""")
def q_anom_upsert(spark, sf_dir):
    """ANO-8: earlier-batch anomalies under review, merged with a re-run under the config bars."""
    o, h = stored_offers(spark, sf_dir)
    old = A.detect_temporal(o, h).filter(F.col("source_batch_id") < INCR_BATCH)
    old = old.select("offer_id", "anomaly_type", "severity", "signal_score", "observed_price_usd",
                     F.when(F.col("severity") == "HIGH", "IN_REVIEW").otherwise("NEW").alias("status"),
                     F.when(F.col("severity") == "HIGH", "analyst-1").alias("assignee"),
                     F.lit(None).cast("string").alias("resolution_notes"),
                     F.lit("2020-01-01 00:00:00").cast("timestamp").alias("detected_at"))
    new = A.detect_temporal(o, h, "config").withColumn("detected_at", F.lit("2021-01-01 00:00:00").cast("timestamp"))
    up = A.upsert_anomalies(old, new)
    return up.select("offer_id", "anomaly_type", "severity", "signal_score", "status", "assignee", "detected_at")


_LIVE_BARS = "'{\"profile\":\"live\",\"low\":0.1,\"medium\":0.15,\"high\":0.25}' AS threshold_snapshot"


@query("anom_explained", """
SELECT offer_id, anomaly_type, CAST(round(p * 100, 1) AS VARCHAR) || '% jump from last valid price ($' || format('{:,.2f}', ref_usd)
       || ' on ' || CAST(ref_date AS VARCHAR) || ')' AS explanation, """ + _LIVE_BARS + """
FROM (""" + ORACLE["anom_temporal"].replace("ref_usd, ref_date\nFROM scored", "ref_usd, ref_date, p\nFROM scored") + """)
UNION ALL
SELECT offer_id, anomaly_type, CAST(round(p * 100, 1) AS VARCHAR) || '% deviation from 30-day mean ($' || format('{:,.2f}', baseline_mean) || ')', """ + _LIVE_BARS + """
FROM (""" + STAT_SQL.replace("AS sample_size\nFROM scored", "AS sample_size, p\nFROM scored") + """)
UNION ALL
SELECT offer_id, anomaly_type, CAST(round(p * 100, 1) AS VARCHAR) || '% off the ' || CAST(peer_count AS VARCHAR) || '-peer median ($'
       || format('{:,.2f}', round(peer_median, 2)) || ')', """ + _LIVE_BARS + """
FROM (""" + ORACLE["anom_cross_partner"].replace("AS peer_count\nFROM scored", "AS peer_count, p\nFROM scored") + """)
UNION ALL
SELECT offer_id, anomaly_type, CAST(round(z_score, 1) AS VARCHAR) || 'σ outlier within ' || CAST(group_size AS VARCHAR) || '-observation same-model group (mean $'
       || format('{:,.2f}', group_mean) || ', σ $' || format('{:,.2f}', group_stddev) || ')',
       '{"profile":"z","low":1.5,"medium":2.5,"high":4.0}'
FROM (""" + VARIANCE_SQL + ")")
def q_anom_explained(spark, sf_dir):
    """ANO-9/10: explanation text and frozen thresholds of all four signals."""
    o, h = stored_offers(spark, sf_dir)
    days = cut_and_deal(A.day_context(o, h), [*H.KEY, "crawl_date"], name="days")  # lies like the offers: no shuffle to join them
    out = None
    for found in (A.detect_temporal(o, h, days=days), A.detect_statistical(o, h), A.detect_cross_partner(o, h, days=days), A.detect_sku_variance(o, VARIANCE_GROUP)):
        a = A.explain_anomalies(A.with_snapshots(found)).select(
            "offer_id", "anomaly_type", "explanation", F.to_json("threshold_snapshot").alias("threshold_snapshot"))
        out = a if out is None else out.unionByName(a)
    return out


@query("anom_series", "WITH s AS (" + STAT_SQL.replace(
    "SELECT offer_id, 'STATISTICAL' AS anomaly_type,",
    "SELECT offer_id, product_model_id, partner_id, country_code, payment_type, crawl_ts_utc, 'STATISTICAL' AS anomaly_type,")
    .replace("  SELECT o.offer_id, o.effective_total_usd, s.n, s.s, s.ss,",
             "  SELECT o.offer_id, o.effective_total_usd, o.product_model_id, o.partner_id, o.country_code, o.payment_type, o.crawl_ts_utc, s.n, s.s, s.ss,")
    + """),
top AS (SELECT * FROM s ORDER BY CASE severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END DESC,
        signal_score DESC, crawl_ts_utc DESC, offer_id DESC LIMIT 1),
hist AS (""" + T.with_sql(T.OFFERS_SQL, HISTORY_SQL) + """ SELECT * FROM history)
SELECT t.offer_id, h.valid_from_date AS point_date, h.effective_total_usd AS price_usd, FALSE AS is_anomaly,
       round(greatest(0.0, CAST(t.baseline_mean AS DOUBLE) - t.baseline_stddev), 2) AS band_lower,
       round(CAST(t.baseline_mean AS DOUBLE) + t.baseline_stddev, 2) AS band_upper
FROM top t JOIN hist h USING (product_model_id, partner_id, country_code, payment_type)
WHERE h.valid_from_date >= CAST(t.crawl_ts_utc AS DATE) - 30 AND h.valid_from_date <= CAST(t.crawl_ts_utc AS DATE)
UNION ALL
SELECT offer_id, CAST(crawl_ts_utc AS DATE), observed_price_usd, TRUE,
       round(greatest(0.0, CAST(baseline_mean AS DOUBLE) - baseline_stddev), 2),
       round(CAST(baseline_mean AS DOUBLE) + baseline_stddev, 2)
FROM top
""")
def q_anom_series(spark, sf_dir):
    """ANO-11: chart rows (30-day partner series, anomaly point, band) of the top STATISTICAL anomaly."""
    o, h = stored_offers(spark, sf_dir)
    a = A.detect_statistical(o, h)
    top = A.top_anomalies(a, as_of=None, n=1, days=None)
    return A.anomaly_series(top, h)


@query("baseline_illustration", BAD_SQL + """,
clean AS (SELECT * FROM gated g WHERE NOT EXISTS (SELECT 1 FROM bad_records b WHERE b.rule_id = 'DQ_PRICE_001' AND b.offer_id = g.offer_id)),
grp AS (
  SELECT product_model_id, partner_id, country_code, payment_type, count(*) AS n,
         CAST(count(*) * sum(CAST(CAST(effective_total_usd * 100 AS BIGINT) AS HUGEINT) * CAST(effective_total_usd * 100 AS BIGINT))
              - CAST(sum(CAST(effective_total_usd * 100 AS BIGINT)) AS HUGEINT) * sum(CAST(effective_total_usd * 100 AS BIGINT)) AS DOUBLE)
           / CAST(count(*) * (count(*) - 1) AS DOUBLE) AS var_c
  FROM clean GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3
),
best AS (SELECT * FROM grp ORDER BY var_c > 0 DESC, var_c DESC, n DESC, product_model_id, partner_id, country_code, payment_type LIMIT 1),
daily AS (
  SELECT CAST(f.crawl_date AS DATE) AS series_date,
         CAST(((sum(CAST(f.effective_total_usd * 100 AS BIGINT)) * 2 + count(*)) // (count(*) * 2)) / 100 AS DECIMAL(12,2)) AS price_usd
  FROM (SELECT c.*, CAST(c2.crawl_ts_utc AS DATE) AS crawl_date FROM clean c JOIN facts c2 USING (offer_id)) f
  JOIN best b USING (product_model_id, partner_id, country_code, payment_type)
  GROUP BY 1
),
m AS (SELECT count(*) AS n, CAST(sum(CAST(price_usd * 100 AS BIGINT)) AS HUGEINT) AS s,
             sum(CAST(CAST(price_usd * 100 AS BIGINT) AS HUGEINT) * CAST(price_usd * 100 AS BIGINT)) AS ss FROM daily),
band AS (SELECT CAST(s AS DOUBLE) / n AS mean_c,
                CASE WHEN n > 1 THEN sqrt(CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) ELSE 0.0 END AS std_c FROM m)
SELECT d.series_date, d.price_usd, round(mean_c / 100, 2) AS band_mean,
       round(greatest(0.0, (mean_c - std_c) / 100), 2) AS band_lower, round((mean_c + std_c) / 100, 2) AS band_upper
FROM daily d, band
""")
def q_baseline_illustration(spark, sf_dir):
    """ANO-12: daily prices and band of the most volatile clean (model, partner, country, payment) group.

    The operator reads its inputs several times (ranking, series, band), so the
    facts and the price flags are written once to the shared checkpoint folder.
    """
    from pricelens.session import cut_lineage
    stg = staging_table(spark, sf_dir)
    fact = cut_lineage(gated_facts(spark, sf_dir, stg).select(
        "offer_id", "product_model_id", "partner_id", "country_code", "payment_type",
        "effective_total_usd", "crawl_ts_utc"), name="illustration-facts")
    flags = cut_lineage(bad_records(spark, sf_dir, stg).filter(F.col("rule_id") == "DQ_PRICE_001")
                        .select("offer_id", "rule_id"), name="illustration-flags")
    return A.baseline_illustration(fact, flags)


EVENTS_SQL = """
mevents AS (
  SELECT o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS event_date,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'APPLE_LAUNCH' WHEN '2-HIGH' THEN 'BLACK_FRIDAY' ELSE 'BOXING_DAY' END AS event_type,
         CASE WHEN o_orderstatus = 'F' THEN n_regionkey END AS affected_country_code,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'IPHONE' END AS affected_category_code,
         3 AS suppression_window_days,
         CASE o_orderpriority WHEN '1-URGENT' THEN 0.40 WHEN '2-HIGH' THEN 0.50 ELSE 0.50 END::DOUBLE AS suppression_factor
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def market_events(spark, sf_dir):
    """Market events derived from all orders (type by priority, scope by status): many
    overlap on a day with different scopes."""
    o = T.read(spark, sf_dir, "orders")
    c = T.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = F.broadcast(T.read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
    pr = F.col("o_orderpriority")
    etype = F.when(pr == "1-URGENT", "APPLE_LAUNCH").when(pr == "2-HIGH", "BLACK_FRIDAY").otherwise("BOXING_DAY")
    fac = F.create_map(*[x for k, v in config.EVENT_SUPPRESSION.items() for x in (F.lit(k), F.lit(v))])
    return j.select(F.col("o_orderkey").alias("event_id"), F.to_date("o_orderdate").alias("event_date"),
                    etype.alias("event_type"),
                    F.when(F.col("o_orderstatus") == "F", F.col("n_regionkey")).alias("affected_country_code"),
                    F.when(pr == "3-MEDIUM", F.lit("IPHONE")).alias("affected_category_code"),
                    F.lit(3).alias("suppression_window_days"), fac[etype].alias("suppression_factor"))


OFFER_COLS = ["category_code", "country_code", "crawl_date", "crawl_ts_utc"]


def namesakes(offers, cols):
    """Offer ids that occur more than once, with ``cols`` of each of their rows. Only
    hashes of the ids are shuffled to find them; most tables have none."""
    h = F.xxhash64("offer_id")
    again = cut_lineage(offers.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") > 1).select("_h"), name="again")
    rows = offers.filter(F.col("offer_id").isNotNull()).join(again, h == again["_h"], "left_semi")
    same = rows.groupBy("offer_id").agg(F.collect_list(F.struct(*cols)).alias("_same"))
    return cut_lineage(same.filter(F.size("_same") > 1), name="namesakes")


def join_namesakes(a, cols):
    """The inner join of ``a`` with the offers on the offer id for ``cols``, where ``a`` has
    its own offer's values and ``_same`` (see :func:`namesakes`, NULL: its own only)."""
    a = a.withColumn("_of", F.explode(F.coalesce("_same", F.array(F.struct(*A_COLS)))))
    return a.select(*[c for c in a.columns if c not in [*cols, "_of"]], *[F.col("_of")[c].alias(c) for c in cols])


A_COLS = [*OFFER_COLS, "product_model_id", "partner_id"]


def _anoms_with_offer(spark, sf_dir):
    """Anomalies joined with the offers of their offer id, and the stored offers."""
    o, h = stored_offers(spark, sf_dir, "category_code")
    a = A.detect(o, h, "live", "MEDIUM", sku_group=VARIANCE_GROUP, keep=("category_code", "crawl_date"))
    a = a.select(*A.ANOMALY_COLS, *A_COLS).filter(F.col("offer_id").isNotNull()).join(namesakes(o, A_COLS), "offer_id", "left")
    return join_namesakes(a, OFFER_COLS), o


ANOMS_WITH_OFFER_SQL = ("aw AS (SELECT a.*, o.category_code, o.country_code, o.crawl_date, o.crawl_ts_utc FROM ("
                        + "SELECT * FROM (" + ANOM_ALL_SQL + ") WHERE severity IN ('HIGH', 'MEDIUM')) a JOIN ("
                        + T.with_sql(T.OFFERS_SQL) + " SELECT * FROM offers) o USING (offer_id))")


@query("suppression", "WITH " + EVENTS_SQL.strip() + ",\n" + ANOMS_WITH_OFFER_SQL.replace("aw AS (", "aw AS MATERIALIZED (", 1) + """,
days AS (
  SELECT event_id, suppression_factor, affected_country_code AS cty, affected_category_code AS cat,
         CAST(unnest(generate_series(event_date - suppression_window_days, event_date + suppression_window_days, INTERVAL 1 DAY)) AS DATE) AS day
  FROM mevents
),
scoped AS (SELECT day, cty, cat, min(suppression_factor) AS f, min(event_id) FILTER (WHERE first) AS ev
           FROM (SELECT *, suppression_factor = min(suppression_factor) OVER (PARTITION BY day, cty, cat) AS first FROM days)
           GROUP BY day, cty, cat),
asked AS (SELECT DISTINCT crawl_date, country_code, category_code FROM aw),
m AS (
  SELECT asked.*, s.f, s.ev
  FROM asked JOIN scoped s ON asked.crawl_date = s.day
   AND (s.cty IS NULL OR s.cty = asked.country_code) AND (s.cat IS NULL OR s.cat = asked.category_code)
),
best AS (SELECT crawl_date, country_code, category_code, min(f) AS f, min(ev) FILTER (WHERE first) AS ev
         FROM (SELECT *, f = min(f) OVER (PARTITION BY crawl_date, country_code, category_code) AS first FROM m) GROUP BY 1, 2, 3)
SELECT aw.offer_id, aw.anomaly_type, COALESCE(b.f, 1.0) AS suppression_factor, b.ev AS suppressing_event_id,
       b.ev IS NOT NULL AS suppression_applied
FROM aw LEFT JOIN best b ON aw.crawl_date = b.crawl_date AND aw.country_code IS NOT DISTINCT FROM b.country_code
 AND aw.category_code IS NOT DISTINCT FROM b.category_code
""")
def q_suppression(spark, sf_dir):
    """ANO-15: anomalies inside a market event window of their country/category; lowest factor wins."""
    a, o = _anoms_with_offer(spark, sf_dir)
    s = CX.suppress_events(a, market_events(spark, sf_dir), o)
    return s.select("offer_id", "anomaly_type", "suppression_factor", "suppressing_event_id", "suppression_applied")


# FIXED VALUES (testbed) — alert policies
# (policy_id, min_severity, anomaly_type, country_code, category_code, channel, recipient,
#  quiet_start, quiet_end (minutes), is_active)
TEST_POLICIES = [
    (1, "HIGH", None, None, None, "slack", "team-high", 1320, 360, True),
    (2, "MEDIUM", "CROSS_PARTNER", None, None, "email", "team-cross", None, None, True),
    (3, "LOW", "SKU_VARIANCE", 2, None, "teams", "team-region-2", 0, 480, True),
    (4, "MEDIUM", None, None, "MAC", "webhook", "team-mac", None, None, True),
    (5, "LOW", None, None, None, "email", "team-all", None, None, False),
]


@query("alert_routes", "WITH " + ANOMS_WITH_OFFER_SQL + """,
pol AS (SELECT * FROM (VALUES """ + ", ".join(
    "(" + ", ".join(_sql_v(v) if not isinstance(v, bool) else ("TRUE" if v else "FALSE") for v in row) + ")"
    for row in TEST_POLICIES) + """) t(policy_id, min_severity, p_type, p_country, p_category, channel, recipient,
                                    quiet_start, quiet_end, is_active)),
r AS (SELECT CASE severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END AS lvl, * FROM aw)
SELECT r.offer_id, r.anomaly_type, p.policy_id, p.channel,
       CASE WHEN p.quiet_start IS NULL OR p.quiet_end IS NULL THEN FALSE
            WHEN p.quiet_start <= p.quiet_end THEN (hour(r.crawl_ts_utc) * 60 + minute(r.crawl_ts_utc)) >= p.quiet_start
                                               AND (hour(r.crawl_ts_utc) * 60 + minute(r.crawl_ts_utc)) < p.quiet_end
            ELSE (hour(r.crawl_ts_utc) * 60 + minute(r.crawl_ts_utc)) >= p.quiet_start
              OR (hour(r.crawl_ts_utc) * 60 + minute(r.crawl_ts_utc)) < p.quiet_end END AS in_quiet_hours
FROM r JOIN pol p
  ON p.is_active AND r.lvl >= CASE p.min_severity WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END
 AND (p.p_type IS NULL OR p.p_type = r.anomaly_type)
 AND (p.p_country IS NULL OR p.p_country = r.country_code)
 AND (p.p_category IS NULL OR p.p_category = r.category_code)
""")
def q_alert_routes(spark, sf_dir):
    """ANO-17: every active policy each anomaly matches, with the quiet-hours flag."""
    pol = spark.createDataFrame(TEST_POLICIES, "policy_id int, min_severity string, anomaly_type string, "
                                               "country_code int, category_code string, channel string, "
                                               "recipient string, quiet_start int, quiet_end int, is_active boolean")
    a, o = _anoms_with_offer(spark, sf_dir)
    kinds = [F.explode(F.array(*map(F.lit, v))).alias(c) for c, v in (
        ("anomaly_type", ("STATISTICAL", "TEMPORAL", "CROSS_PARTNER", "SKU_VARIANCE")), ("severity", ("HIGH", "MEDIUM")))]
    asked = o.select("country_code", "category_code").distinct().select("*", kinds[0]).select("*", kinds[1])
    r = CX.route_alerts(a, pol, asked)
    return r.select("offer_id", "anomaly_type", "policy_id", "channel", "in_quiet_hours")


PREV_DAY = "2000-06-29"


@query("baselines_dedup", "WITH nw AS (SELECT * FROM (" + BASELINE_SQL + ")), st AS (SELECT * FROM ("
       + BASELINE_SQL.replace(AS_OF, PREV_DAY) + """))
SELECT n.* FROM nw n
WHERE NOT EXISTS (SELECT 1 FROM st s WHERE s.baseline_as_of + 1 = n.baseline_as_of
                  AND s.product_model_id = n.product_model_id AND s.country_code = n.country_code
                  AND s.window_days = n.window_days AND s.mean_price_usd = n.mean_price_usd
                  AND s.stddev_price_usd = n.stddev_price_usd AND s.p95_price_usd = n.p95_price_usd)
  AND NOT EXISTS (SELECT 1 FROM st s WHERE s.baseline_as_of = n.baseline_as_of
                  AND s.product_model_id = n.product_model_id AND s.country_code = n.country_code
                  AND s.window_days = n.window_days)
""")
def q_baselines_dedup(spark, sf_dir):
    """AGG-2: today's baselines to append (unchanged-from-yesterday rows skipped)."""
    h = history(spark, sf_dir)
    return B.append_baselines(B.baselines(h, PREV_DAY), B.baselines(h, AS_OF))


@query("volatility", "WITH b AS (SELECT * FROM (" + BASELINE_SQL + ")), " + T.OFFERS_SQL.strip() + """,
cats AS (SELECT DISTINCT product_model_id, category_code FROM offers),
per AS (SELECT c.category_code, round(stddev_samp(CAST(b.stddev_price_usd AS DOUBLE) / CAST(b.mean_price_usd AS DOUBLE)), 6) AS volatility
        FROM b JOIN cats c USING (product_model_id) WHERE b.window_days = 30 GROUP BY 1)
SELECT category_code, volatility,
       CASE ntile(3) OVER (ORDER BY volatility, category_code) WHEN 1 THEN 'LOW' WHEN 2 THEN 'MEDIUM' ELSE 'HIGH' END AS volatility_class
FROM per
""")
def q_volatility(spark, sf_dir):
    """CAL-3: category volatility from 30-day baselines, split into terciles."""
    cats = T.offers(spark, sf_dir).select("product_model_id", "category_code").distinct()
    return CX.calibrate_volatility(B.baselines(history(spark, sf_dir), AS_OF), cats)


# ---------------------------------------------------------------------------
# Feeds, batch harmonisation, as-of events, streaming, Path B, replay
# ---------------------------------------------------------------------------

from pricelens.functions import asof as AS  # noqa: E402
from pricelens.sources import feeds as FD  # noqa: E402
from pricelens.streaming import feeds as ST  # noqa: E402

# FIXED VALUES (testbed) — how each region writes its country in the feed
FEED_COUNTRY = [(0, "Australia"), (1, "NZ"), (2, "United States"), (3, "GB"), (4, "Atlantis")]


def feed_text(spark, sf_dir, *keep):
    """The testbed rendered as a partner feed: every column text, as in the CSV;
    ``keep`` names further columns of the offers."""
    o = T.offers(spark, sf_dir)
    p = T.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("sku_id"), "p_name")
    o = o.join(p, "sku_id")
    country = None
    for k, v in FEED_COUNTRY:
        country = F.when(F.col("country_code") == k, v) if country is None else country.when(F.col("country_code") == k, v)
    k = F.col("l_orderkey")
    full = F.col("payment_type") == "FULL"
    return o.select(
        "offer_id", F.col("l_orderkey").alias("row_num"),
        F.when(k % 97 == 0, F.lit("not-a-date")).otherwise(
            F.date_format("crawl_ts_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("CRAWL_TS"),
        country.alias("COUNTRY_VAL"), F.col("partner_code").alias("PARTNER"),
        F.col("p_name").alias("PRODUCT_NAME_VAL"),
        F.when(full, F.when(k % 67 == 0, F.lit("abc")).otherwise(F.col("full_price").cast("string")))
         .otherwise(F.lit("")).alias("FULL PRICE"),
        F.when(~full, F.col("monthly_amount").cast("string")).otherwise(F.lit("")).alias("MONTHLY_INSTALMENT_AMT"),
        F.when(~full, F.when(k % 61 == 0, F.lit("0")).otherwise(F.col("instalment_months").cast("string")))
         .otherwise(F.lit("")).alias("INSTALMENT_MONTH"),
        F.upper(F.split("p_name", " ").getItem(0)).alias("COLOR"), *keep)


FEED_TEXT_SQL = """
feed AS (
  SELECT o.offer_id, o.l_orderkey AS row_num,
         CASE WHEN o.l_orderkey % 97 = 0 THEN 'not-a-date' ELSE strftime(o.crawl_ts_utc, '%Y-%m-%dT%H:%M:%SZ') END AS CRAWL_TS,
         CASE o.country_code """ + " ".join(f"WHEN {k} THEN '{v}'" for k, v in FEED_COUNTRY) + """ END AS COUNTRY_VAL,
         o.partner_code AS PARTNER, p.p_name AS PRODUCT_NAME_VAL,
         CASE WHEN o.payment_type = 'FULL' THEN CASE WHEN o.l_orderkey % 67 = 0 THEN 'abc' ELSE CAST(o.full_price AS VARCHAR) END ELSE '' END AS "FULL PRICE",
         CASE WHEN o.payment_type <> 'FULL' THEN CAST(o.monthly_amount AS VARCHAR) ELSE '' END AS MONTHLY_INSTALMENT_AMT,
         CASE WHEN o.payment_type <> 'FULL' THEN CASE WHEN o.l_orderkey % 61 = 0 THEN '0' ELSE CAST(o.instalment_months AS VARCHAR) END ELSE '' END AS INSTALMENT_MONTH,
         upper(split_part(p.p_name, ' ', 1)) AS COLOR
  FROM offers o JOIN part p ON o.sku_id = p.p_partkey
)"""

CMAP_SQL = "CASE trim(COUNTRY_VAL) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in config.COUNTRY_NAME_TO_CODE.items()) + " END"
CUR_SQL = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in config.COUNTRY_CURRENCY.items()) + " END"
NUM_SQL = ("CASE WHEN regexp_matches(trim({x}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
           "THEN TRY_CAST(TRY_CAST(trim({x}) AS DOUBLE) AS DECIMAL(12,2)) END")


@query("feed_parse", T.with_sql(T.OFFERS_SQL, FEED_TEXT_SQL) + f"""
SELECT offer_id, {CMAP_SQL} AS country_code, {CUR_SQL.format(c=CMAP_SQL)} AS currency_code,
       TRY_STRPTIME(CRAWL_TS, '%Y-%m-%dT%H:%M:%SZ') AS crawl_ts_utc,
       CASE WHEN "FULL PRICE" IS NOT NULL AND "FULL PRICE" <> '' THEN 'FULL'
            WHEN MONTHLY_INSTALMENT_AMT IS NOT NULL AND MONTHLY_INSTALMENT_AMT <> '' THEN 'INSTALMENT' END AS payment_type,
       CASE WHEN "FULL PRICE" <> '' THEN {NUM_SQL.format(x='"FULL PRICE"')} END AS full_price,
       CASE WHEN NOT ("FULL PRICE" <> '') AND MONTHLY_INSTALMENT_AMT <> '' THEN {NUM_SQL.format(x='MONTHLY_INSTALMENT_AMT')} END AS monthly_amount,
       CASE WHEN NOT ("FULL PRICE" <> '') AND MONTHLY_INSTALMENT_AMT <> ''
             AND regexp_matches(trim(INSTALMENT_MONTH), '^[+-]?[0-9]+$') AND TRY_CAST(trim(INSTALMENT_MONTH) AS INTEGER) <> 0
            THEN TRY_CAST(trim(INSTALMENT_MONTH) AS INTEGER) END AS instalment_months,
       PRODUCT_NAME_VAL || CASE WHEN trim(COLOR) <> '' THEN ' ' || trim(COLOR) ELSE '' END AS match_text,
       COLOR AS color_field
FROM feed
""")
def q_feed_parse(spark, sf_dir):
    """SRC-1..3, PRJ-1..4, PRJ-8, PRJ-10: typed staging from the all-text feed."""
    raw = feed_text(spark, sf_dir)
    t = FD.payment_fields(FD.with_raw_payload(raw, exclude=("row_num", "offer_id")))
    code = FD.country_code(F.col("COUNTRY_VAL"))
    return t.select("offer_id", code.alias("country_code"), FD.currency_code(code).alias("currency_code"),
                    FD.parse_crawl_ts(F.col("CRAWL_TS")).alias("crawl_ts_utc"),
                    "payment_type", "full_price", "monthly_amount", "instalment_months",
                    HM.harmonise_text(t, "PRODUCT_NAME_VAL").alias("match_text"),
                    FD.payload_field(t, "COLOR").alias("color_field"))


def _offer_names(spark, sf_dir):
    """Offer rows whose product text is the partner-style name (part name + size)."""
    o = T.offers(spark, sf_dir).select("offer_id", "sku_id")
    p = T.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("sku_id"), "p_name", "p_size")
    return o.join(p, "sku_id").select(
        "offer_id", F.concat(F.col("p_name"), F.lit(" "), F.col("p_size").cast("string"), F.lit("gb"))
        .alias("match_text"))


@query("harmonise_batch", "WITH top1 AS (" + ORACLE["name_topk"].replace(f"WHERE rank <= {TOPK}", "WHERE rank <= 1")
       + "), o AS (" + T.with_sql(T.OFFERS_SQL) + """ SELECT o.offer_id, p.p_name || ' ' || CAST(p.p_size AS VARCHAR) || 'gb' AS match_text
        FROM offers o JOIN part p ON o.sku_id = p.p_partkey)
SELECT o.offer_id, t.model_key, CASE WHEN m.registry_order % 7 <> 0 THEN 'M-' || t.model_key END AS product_model_id,
       CAST(t.score AS DECIMAL(4,3)) AS harmonise_score, t.confidence AS harmonise_confidence
FROM o LEFT JOIN top1 t ON o.match_text = t.name
LEFT JOIN (WITH """ + _registry_sql() + """ SELECT model_key, registry_order FROM registry) m ON m.model_key = t.model_key
""")
def q_harmonise_batch(spark, sf_dir):
    """HRM-10: every offer gets its top registry match (distinct names scored once, joined
    back) and the id of that model, where the model dimension has it."""
    reg = _registry(spark, sf_dir)
    models = reg.filter(F.col("registry_order") % 7 != 0).select("model_key", F.concat(F.lit("M-"), "model_key").alias("product_model_id"))
    h = HM.harmonise_batch(_offer_names(spark, sf_dir), reg, models, TEST_DICT, "levenshtein")
    return h.select("offer_id", "model_key", "product_model_id", "harmonise_score", "harmonise_confidence")


@query("asof_events", """
SELECT e.event_id, p.event_id AS prev_event_id, p.ts AS prev_ts, p.value AS prev_value
FROM events e ASOF LEFT JOIN events p ON e.user_id = p.user_id AND e.ts > p.ts
""")
def q_asof_events(spark, sf_dir):
    """ANO-2 shape on events: the same user's latest earlier event (user × day buckets)."""
    ev = T.read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    ev = ev.withColumn("event_ts", F.col("ts"))
    out = AS.previous_before(ev, ["user_id"], "ts", ["event_id", "event_ts", "value"], "event_id")
    return out.select("event_id", F.col("prev_event_id"), F.col("prev_event_ts").alias("prev_ts"),
                      F.col("prev_value"))


@query("stream_events", "SELECT event_type, count(*) AS events, round(sum(value), 2) AS total_value FROM events GROUP BY 1")
def q_stream_events(spark, sf_dir):
    """PIPE-3, the loop alone: events written as files, loaded by the streaming loader in
    bounded chunks (availableNow), then summarised; equals the batch result."""
    import uuid
    from pyspark.sql import types as TT
    from pricelens.session import checkpoint_dir
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    ev = T.read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    ev.repartition(4).write.option("header", True).csv(f"{base}/src")
    schema = TT.StructType([TT.StructField(c, TT.StringType()) for c in ("event_id", "event_type", "value")])
    ST.stream_feeds(spark, f"{base}/src", schema, f"{base}/out", lambda b, bid: b, max_files=1, name="events")
    out = spark.read.parquet(f"{base}/out")
    cents_sum = F.sum(F.round(F.col("value").cast("double") * 100).cast("bigint"))
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                         (cents_sum / 100).cast("double").alias("total_value"))


UNGATED_SEM_SQL = ALL_OUTPUT_SQL.replace("dq_status = 'PRE_FACT_PASSED' AND", "")


@query("path_b_rules", UNGATED_SEM_SQL + """
SELECT target_stage, rule_id, CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(failed_records) AS BIGINT) AS failed_records
FROM dq_output GROUP BY 1, 2
""")
def q_path_b_rules(spark, sf_dir):
    """PIPE-2: Path B — ungated load, then the rules of all three stages."""
    ctx = P.Context(countries=T.countries(spark, sf_dir), partners=T.partners(spark, sf_dir),
                    rates=testbed_rates(spark, sf_dir), bands=Q.price_bands(spark, T.TESTBED_PRICE_BANDS),
                    catalog=Q.catalog(spark))
    stg = staged(spark, sf_dir)
    fact = P.load_batch(stg, ctx)["facts"]
    out = P.check_batch(stg.drop("dq_status"), fact, ctx)["dq_output"]
    return out.groupBy("target_stage", "rule_id").agg(F.sum("total_records").cast("bigint").alias("total_records"),
                                                      F.sum("failed_records").cast("bigint").alias("failed_records"))


REPLAY_BATCH = 1999


@query("replay_ingest", T.with_sql(T.OFFERS_SQL, T.STAGING_SQL) + f""",
fixed AS (SELECT * REPLACE (CASE WHEN country_name = 'Atlantis' THEN 0 ELSE country_code END AS country_code)
          FROM staging WHERE source_batch_id = {REPLAY_BATCH}),
ing AS (SELECT source_batch_id, {_flag_cols(INGEST_FLAGS)} FROM fixed)
SELECT rule_id, failed_records FROM (
  SELECT {', '.join(f'CAST(sum(CASE WHEN f_{r} THEN 1 ELSE 0 END) AS BIGINT) AS {r}' for r in INGEST_FLAGS)} FROM ing)
UNPIVOT (failed_records FOR rule_id IN ({', '.join(INGEST_FLAGS)}))
""")
def q_replay_ingest(spark, sf_dir):
    """REV-3, one stage: re-run one batch's INGEST rules from its stored rows with an updated
    country map (the unknown name now resolves)."""
    def run(b):
        b = b.withColumn("country_code", F.when(F.col("country_name") == "Atlantis", F.lit(0))
                         .otherwise(F.col("country_code")))
        return Q.stage_output(Q.evaluate(b, "INGEST"), "INGEST", Q.catalog(spark))
    out = RV.replay_batch(T.staging(spark, sf_dir), REPLAY_BATCH, run)
    return out.select("rule_id", "failed_records")


# FIXED VALUES (testbed) — price volatility class per testbed category
TEST_VOLATILITY = {"IPHONE": "MEDIUM", "IPAD": "LOW", "MAC": "LOW", "AIRPODS": "HIGH",
                   "WATCH": "MEDIUM", "ACCESSORY": "HIGH"}


@query("adjusted_scores", "WITH sup AS (" + ORACLE["suppression"] + "), life AS (" + ORACLE["lifecycle"] + "), "
       + ANOMS_WITH_OFFER_SQL.replace("o.crawl_ts_utc FROM", "o.crawl_ts_utc, o.product_model_id AS pm, o.partner_id AS pid FROM") + """,
x AS (
  SELECT aw.offer_id, aw.anomaly_type, aw.signal_score,
         CASE l.lifecycle_status """ + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in config.LIFECYCLE_FACTORS.items()) + """ END AS lf,
         s.suppression_factor AS sf,
         CASE aw.category_code """ + " ".join(f"WHEN '{k}' THEN {config.CATEGORY_SENSITIVITY[v]}::DOUBLE" for k, v in TEST_VOLATILITY.items()) + """ END AS cs
  FROM aw
  LEFT JOIN life l ON l.product_model_id = aw.pm AND l.partner_id = aw.pid
  LEFT JOIN sup s ON s.offer_id = aw.offer_id AND s.anomaly_type = aw.anomaly_type
)
SELECT offer_id, anomaly_type,
       round(signal_score * COALESCE(lf, 1.0) * COALESCE(sf, 1.0) / COALESCE(cs, 1.0), 3) AS adjusted_score,
       CASE WHEN round(signal_score * COALESCE(lf, 1.0) * COALESCE(sf, 1.0) / COALESCE(cs, 1.0), 3) >= 0.8 THEN 'HIGH'
            WHEN round(signal_score * COALESCE(lf, 1.0) * COALESCE(sf, 1.0) / COALESCE(cs, 1.0), 3) >= 0.5 THEN 'MEDIUM'
            WHEN round(signal_score * COALESCE(lf, 1.0) * COALESCE(sf, 1.0) / COALESCE(cs, 1.0), 3) >= 0.25 THEN 'LOW' END AS adjusted_severity
FROM x
""")
def q_adjusted_scores(spark, sf_dir):
    """ANO-16: signal × lifecycle factor × event suppression ÷ category sensitivity, config bars."""
    # suppression keeps every anomaly column, so the detectors run once
    a, o = _anoms_with_offer(spark, sf_dir)
    sup = CX.suppress_events(a.withColumnsRenamed({c: f"_a_{c}" for c in ("product_model_id", "partner_id")}), market_events(spark, sf_dir), o)
    models = o.groupBy("product_model_id", "category_code", "partner_id").agg(
        F.min("crawl_date").alias("launch_date")).withColumn("eol_date", F.lit(None).cast("date"))
    cats = spark.createDataFrame(TEST_LIFECYCLE, "category_code string, lifecycle_months int")
    life = CX.lifecycle_status(models, cats, LIFE_AS_OF)
    lmap = F.create_map(*[x for k, v in config.LIFECYCLE_FACTORS.items() for x in (F.lit(k), F.lit(v))])
    life = life.select("product_model_id", "partner_id", lmap[F.col("lifecycle_status")].alias("lifecycle_factor"))
    smap = F.create_map(*[x for k, v in TEST_VOLATILITY.items()
                          for x in (F.lit(k), F.lit(config.CATEGORY_SENSITIVITY[v]))])
    life = cut_lineage(life, name="lifecycles")
    keyed = sup.withColumn("_of", F.explode(F.coalesce(
        F.transform("_same", lambda x: F.struct(x["product_model_id"].alias("product_model_id"), x["partner_id"].alias("partner_id"))),
        F.array(F.struct(F.col("_a_product_model_id").alias("product_model_id"), F.col("_a_partner_id").alias("partner_id"))))))
    keyed = keyed.select(*sup.columns, "_of.product_model_id", "_of.partner_id")
    x = (keyed.join(life, ["product_model_id", "partner_id"], "left")
              .withColumn("category_sensitivity", smap[F.col("category_code")]))
    return CX.adjust_scores(x, "config").select("offer_id", "anomaly_type", "adjusted_score", "adjusted_severity")



SAMPLES_CTE = """
names_src AS (
  SELECT name FROM (""" + GATED_FACTS_SQL + """,
  g AS (SELECT raw_product_name AS name, harmonise_score AS sc, harmonise_confidence AS conf FROM gated),
  picks AS (
    SELECT 'top_high' AS stratum, 1 AS stratum_order, (SELECT name FROM g WHERE conf = 'HIGH' ORDER BY sc DESC, length(name), name LIMIT 1) AS name
    UNION ALL SELECT 'verbose_high', 2, (SELECT name FROM g WHERE conf = 'HIGH' AND length(name) >= 60 ORDER BY length(name) DESC, name LIMIT 1)
    UNION ALL SELECT 'medium', 3, (SELECT name FROM g WHERE conf = 'MEDIUM' ORDER BY sc DESC, name LIMIT 1)
    UNION ALL SELECT 'low', 4, (SELECT name FROM g WHERE conf = 'LOW' ORDER BY sc ASC, name LIMIT 1)
  )
  SELECT p.* FROM picks p WHERE p.name IS NOT NULL
    AND NOT (p.stratum = 'verbose_high' AND p.name = (SELECT name FROM picks WHERE stratum = 'top_high')))
)"""

SAMPLES_PICKS_SQL = SAMPLES_CTE.replace("names_src AS (\n  SELECT name FROM (", "picks_src AS (\n  SELECT * FROM (")


@query("harmonise_samples", "WITH " + SAMPLES_PICKS_SQL.strip() + ", top1 AS ("
       + _topk_sql(SAMPLES_CTE).replace(f"WHERE rank <= {TOPK}", "WHERE rank <= 1") + """)
SELECT p.stratum, CAST(p.stratum_order AS INTEGER) AS stratum_order, p.name, t.model_key, t.score, t.confidence,
       t.attr_match, t.token_jaccard, t.char_fuzz
FROM picks_src p JOIN top1 t ON p.name = t.name
""")
def q_harmonise_samples(spark, sf_dir):
    """RPT-10: stratified sample names from the gated facts, re-scored against the registry."""
    reg = _registry(spark, sf_dir)
    out = R.harmonise_samples(gated_facts(spark, sf_dir), reg,
                              lambda names: HM.match_top_k(names, reg, 1, None, TEST_DICT, "levenshtein"))
    return out.select("stratum", F.col("stratum_order").cast("int").alias("stratum_order"), "name",
                      "model_key", "score", "confidence", "attr_match", "token_jaccard", "char_fuzz")


from pricelens.plans import feed_queries as feed_queries  # noqa: E402  registers its queries here
