"""Price-offer testbed derived from the driver's TPC-H-style tables.

Each offer is one ``lineitem`` row:

* model = ``p_type``, SKU = ``p_partkey``, raw product name = ``p_name``
* partner = ``l_suppkey`` (code ``s_name``), country = the supplier's region
* payment = INSTALMENT when ``l_returnflag = 'R'``, else FULL
* price = ``l_extendedprice`` as decimal(12,2); instalments pay
  ``price / quantity`` (whole cents, half up) for ``quantity`` months
* crawl time = ``l_shipdate``; batch = its year

The same view is written twice: as DataFrame code (what the library runs)
and as SQL text (what the DuckDB oracle runs). Both must stay identical.

The source tables are clean, so the staging view derives dirty columns with
fixed arithmetic rules on the keys; every row is still present.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import cut_lineage

# FIXED VALUES (testbed) — part type -> product category
TYPE_CATEGORY = {
    "ECONOMY": "AIRPODS",
    "SMALL": "WATCH",
    "MEDIUM": "IPHONE",
    "LARGE": "MAC",
    "STANDARD": "IPAD",
    "PROMO": "ACCESSORY",
}

# FIXED VALUES (testbed) — USD price band per category for DQ_PRICE_001;
# the testbed prices run from about 900 to 105,000
TESTBED_PRICE_BANDS = [
    ("IPHONE", 2000, 90000),
    ("IPAD", 1500, 95000),
    ("MAC", 5000, 100000),
    ("AIRPODS", 1000, 60000),
    ("WATCH", 3000, 80000),
]

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _category_col(col):
    expr = None
    for k, v in TYPE_CATEGORY.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


def _category_sql(col: str) -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in TYPE_CATEGORY.items())
    return f"CASE {arms} END"


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partner dimension: supplier with its region as registered country.

    ``nation`` has 25 rows by definition, so broadcasting it is bounded. The result
    is written once: for a join the planner knows no size, and would shuffle the
    offers to partners however few these are.
    """
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return cut_lineage(s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
                       .select(F.col("s_suppkey").alias("partner_id"),
                               F.col("s_name").alias("partner_code"),
                               F.col("n_regionkey").alias("country_code")), name="partners")


def offers(spark: SparkSession, sf_dir: str, names: bool = True) -> DataFrame:
    """Clean offers, one per lineitem row (the fact-table shape). Without ``names``
    there is no raw product name, and the parts' types are written once: the planner
    then knows how small they are, and shuffles no offers to them as long as they are.
    """
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    p = read(spark, sf_dir, "part").select("p_partkey", *["p_name"] * names, "p_type")
    if not names:
        p = cut_lineage(p, name="types")
    pa = partners(spark, sf_dir)
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(pa, li.l_suppkey == pa.partner_id))
    inst = F.col("l_returnflag") == "R"
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    score = (F.lit(1) - F.col("l_discount") * 5).cast("decimal(4,3)")
    return j.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.date_format("l_shipdate", "yyyyMMdd"),
                    F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("offer_id"),
        F.year("l_shipdate").alias("source_batch_id"),
        F.col("l_orderkey"),
        F.col("partner_id"),
        F.col("partner_code"),
        F.col("country_code"),
        F.concat(F.lit("CUR"), F.col("country_code").cast("string")).alias("currency_code"),
        F.col("p_type").alias("product_model_id"),
        _category_col(F.col("p_type")).alias("category_code"),
        F.col("p_partkey").alias("sku_id"),
        *[F.col("p_name").alias("raw_product_name")] * names,
        F.when(inst, "INSTALMENT").otherwise("FULL").alias("payment_type"),
        price.alias("effective_total_local"),
        price.alias("effective_total_usd"),
        F.when(~inst, price).alias("full_price"),
        F.when(inst, F.expr(
            "CAST(((CAST(round(l_extendedprice * 100) AS BIGINT) * 2 + CAST(l_quantity AS BIGINT))"
            " div (2 * CAST(l_quantity AS BIGINT))) * 0.01 AS DECIMAL(12,2))")).alias("monthly_amount"),
        F.when(inst, F.col("l_quantity").cast("int")).alias("instalment_months"),
        F.col("l_shipdate").alias("crawl_ts_utc"),
        F.to_date("l_shipdate").alias("crawl_date"),
        score.alias("harmonise_score"),
        F.when(score >= 0.85, "HIGH").when(score >= 0.60, "MEDIUM").otherwise("LOW")
         .alias("harmonise_confidence"),
    )


OFFERS_SQL = f"""
offers AS (
  SELECT
    concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey,
              strftime(l_shipdate, '%Y%m%d'),
              CAST(round(l_extendedprice * 100) AS BIGINT)) AS offer_id,
    CAST(year(l_shipdate) AS INTEGER) AS source_batch_id,
    l_orderkey,
    s_suppkey AS partner_id,
    s_name AS partner_code,
    n_regionkey AS country_code,
    'CUR' || CAST(n_regionkey AS VARCHAR) AS currency_code,
    p_type AS product_model_id,
    {_category_sql('p_type')} AS category_code,
    p_partkey AS sku_id,
    p_name AS raw_product_name,
    CASE WHEN l_returnflag = 'R' THEN 'INSTALMENT' ELSE 'FULL' END AS payment_type,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS effective_total_local,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS effective_total_usd,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS full_price,
    CASE WHEN l_returnflag = 'R' THEN
      CAST(((CAST(round(l_extendedprice * 100) AS BIGINT) * 2 + CAST(l_quantity AS BIGINT))
            // (2 * CAST(l_quantity AS BIGINT))) * 0.01 AS DECIMAL(12,2)) END AS monthly_amount,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) END AS instalment_months,
    l_shipdate AS crawl_ts_utc,
    CAST(l_shipdate AS DATE) AS crawl_date,
    CAST(1 - l_discount * 5 AS DECIMAL(4,3)) AS harmonise_score,
    CASE WHEN CAST(1 - l_discount * 5 AS DECIMAL(4,3)) >= 0.85 THEN 'HIGH'
         WHEN CAST(1 - l_discount * 5 AS DECIMAL(4,3)) >= 0.60 THEN 'MEDIUM'
         ELSE 'LOW' END AS harmonise_confidence
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

PARTNERS_SQL = """
partners AS (
  SELECT s_suppkey AS partner_id, s_name AS partner_code, n_regionkey AS country_code
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country dimension for the testbed: one row per region (5 by definition)."""
    r = read(spark, sf_dir, "region")
    return r.select(
        F.col("r_name").alias("country_name"),
        F.col("r_regionkey").alias("country_code"),
        F.concat(F.lit("CUR"), F.col("r_regionkey").cast("string")).alias("currency_code"))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows with deterministic defects, for the DQ rules.

    Defects are keyed on ``l_orderkey`` residues so both engines agree:
    97 → no timestamp, 89 → blank country, 83 → unknown country,
    79 → wrong currency, 73 → row claims the next region, 71 → blank name,
    67 → negative full price, 61 → 61 months, 59 → FULL row also carries
    instalment fields, 53 (PROMO only) → no model match.
    """
    o = offers(spark, sf_dir)
    r = F.broadcast(read(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    k = F.col("l_orderkey")
    claimed = F.when(k % 73 == 0, (F.col("country_code") + 1) % 5).otherwise(F.col("country_code"))
    o = o.withColumn("claimed_region", claimed)
    o = o.join(r, o.claimed_region == r.r_regionkey)
    country_name = (F.when(k % 89 == 0, F.lit(""))
                     .when(k % 83 == 0, F.lit("Atlantis"))
                     .otherwise(F.col("r_name")))
    full = F.col("payment_type") == "FULL"
    return o.select(
        "offer_id", "source_batch_id", "partner_id", "partner_code",
        country_name.alias("country_name"),
        F.when((k % 89 != 0) & (k % 83 != 0), F.col("claimed_region")).alias("country_code"),
        F.when(k % 79 == 0, F.lit("XXX")).otherwise(
            F.concat(F.lit("CUR"), F.col("claimed_region").cast("string"))).alias("currency_code"),
        F.when(k % 71 == 0, F.lit("")).otherwise(F.col("raw_product_name")).alias("raw_product_name"),
        F.when(k % 97 != 0, F.col("crawl_ts_utc")).alias("crawl_ts_utc"),
        "payment_type",
        F.when(full & (k % 67 == 0), -F.col("full_price")).otherwise(F.col("full_price")).alias("full_price"),
        F.when(full & (k % 59 == 0), F.col("full_price")).otherwise(F.col("monthly_amount")).alias("monthly_amount"),
        F.when(~full & (k % 61 == 0), F.lit(61)).otherwise(F.col("instalment_months")).alias("instalment_months"),
        F.when((F.col("product_model_id") == "PROMO") & (k % 53 == 0), F.lit(None).cast("string"))
         .otherwise(F.col("product_model_id")).alias("product_model_id"),
        "category_code", "harmonise_score", "harmonise_confidence",
    )


STAGING_SQL = """
staging AS (
  SELECT
    offer_id, source_batch_id, partner_id, partner_code,
    CASE WHEN l_orderkey % 89 = 0 THEN '' WHEN l_orderkey % 83 = 0 THEN 'Atlantis'
         ELSE r_name END AS country_name,
    CASE WHEN l_orderkey % 89 <> 0 AND l_orderkey % 83 <> 0 THEN claimed_region END AS country_code,
    CASE WHEN l_orderkey % 79 = 0 THEN 'XXX' ELSE 'CUR' || CAST(claimed_region AS VARCHAR) END AS currency_code,
    CASE WHEN l_orderkey % 71 = 0 THEN '' ELSE raw_product_name END AS raw_product_name,
    CASE WHEN l_orderkey % 97 <> 0 THEN crawl_ts_utc END AS crawl_ts_utc,
    payment_type,
    CASE WHEN payment_type = 'FULL' AND l_orderkey % 67 = 0 THEN -full_price ELSE full_price END AS full_price,
    CASE WHEN payment_type = 'FULL' AND l_orderkey % 59 = 0 THEN full_price ELSE monthly_amount END AS monthly_amount,
    CASE WHEN payment_type <> 'FULL' AND l_orderkey % 61 = 0 THEN 61 ELSE instalment_months END AS instalment_months,
    CASE WHEN product_model_id = 'PROMO' AND l_orderkey % 53 = 0 THEN NULL ELSE product_model_id END AS product_model_id,
    category_code, harmonise_score, harmonise_confidence
  FROM (SELECT *, CASE WHEN l_orderkey % 73 = 0 THEN (country_code + 1) % 5 ELSE country_code END AS claimed_region
        FROM offers) o
  JOIN region ON claimed_region = r_regionkey
)"""

COUNTRIES_SQL = """
countries AS (
  SELECT r_name AS country_name, r_regionkey AS country_code,
         'CUR' || CAST(r_regionkey AS VARCHAR) AS currency_code
  FROM region
)"""


def with_sql(*ctes: str) -> str:
    """Prefix for an oracle query: ``WITH`` plus the named testbed views."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
