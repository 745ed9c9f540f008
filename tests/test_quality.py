"""One failing and one passing row per DQ rule, and the stage engine's counts."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from pricelens.operators import quality as Q

TS = dt.datetime(2025, 10, 1, 10, 0)

STG = ("offer_id string, source_batch_id string, crawl_ts_utc timestamp, country_name string, "
       "country_code string, raw_product_name string, payment_type string, full_price decimal(12,2), "
       "monthly_amount decimal(12,2), instalment_months int, currency_code string, "
       "product_model_id string, partner_id long, partner_code string")

GOOD = dict(crawl_ts_utc=TS, country_name="Australia", country_code="AU", raw_product_name="iPhone 17",
            payment_type="FULL", full_price=D("1999.00"), monthly_amount=None, instalment_months=None,
            currency_code="AUD", product_model_id="m1", partner_id=1, partner_code="PARTNER_A")
GOOD_INST = dict(GOOD, payment_type="INSTALMENT", full_price=None, monthly_amount=D("50.00"), instalment_months=24)

CASES = {
    "DQ_NULL_001": dict(GOOD, crawl_ts_utc=None),
    "DQ_NULL_002": dict(GOOD, country_name="  ", country_code="AU"),
    "DQ_NULL_004": dict(GOOD, raw_product_name=""),
    "DQ_FMT_001": dict(GOOD, country_name="Atlantis", country_code=None),
    "DQ_RANGE_001": dict(GOOD, full_price=D("-5.00")),
    "DQ_RANGE_002": dict(GOOD_INST, monthly_amount=None),
    "DQ_RANGE_003": dict(GOOD_INST, instalment_months=61),
    "DQ_COND_001": dict(GOOD, monthly_amount=D("10.00")),
    "DQ_CONS_001": dict(GOOD, currency_code="NZD"),
    "DQ_CONS_002": dict(GOOD, country_code="NZ", currency_code="NZD", country_name="New Zealand"),
    "DQ_HARM_002": dict(GOOD, product_model_id=None),
}
ORDER = ["crawl_ts_utc", "country_name", "country_code", "raw_product_name", "payment_type", "full_price",
         "monthly_amount", "instalment_months", "currency_code", "product_model_id", "partner_id", "partner_code"]


def _df(spark, rows):
    return spark.createDataFrame([(f"r{i}", "b1", *[r[c] for c in ORDER]) for i, r in enumerate(rows)], STG)


def _dims(spark):
    countries = spark.createDataFrame([("AU", "AUD"), ("NZ", "NZD")], "country_code string, currency_code string")
    partners = spark.createDataFrame([(1, "PARTNER_A", "AU")], "partner_id long, partner_code string, country_code string")
    return countries, partners


def _hits(spark, row, stage):
    df = _df(spark, [row])
    if stage == "PRE_FACT":
        c, p = _dims(spark)
        df = Q.prepare_prefact(df, c, p)
    return {h["rule_id"] for h in Q.evaluate(df, stage).first()["_hits"]}


@pytest.mark.parametrize("rule", sorted(CASES))
def test_rule_fires_only_on_its_bad_row(spark, rule):
    stage = [r for r in Q.rules() if r.rule_id == rule][0].stage
    assert rule in _hits(spark, CASES[rule], stage)
    assert rule not in _hits(spark, GOOD, stage)
    assert rule not in _hits(spark, GOOD_INST, stage)


def test_semantic_rules(spark):
    fact = spark.createDataFrame(
        [("f1", "b1", "LOW", D("0.412"), "x", "IPHONE", D("1000.00")),
         ("f2", "b1", "HIGH", D("0.990"), "y", "IPHONE", D("9000.00")),
         ("f3", "b1", "HIGH", D("0.990"), "z", "IPHONE", D("1000.00"))],
        "offer_id string, source_batch_id string, harmonise_confidence string, harmonise_score decimal(4,3), "
        "raw_product_name string, category_code string, effective_total_usd decimal(12,2)")
    ev = Q.evaluate(Q.prepare_semantic(fact, Q.price_bands(spark)), "SEMANTIC")
    hits = {r["offer_id"]: {h["rule_id"] for h in r["_hits"]} for r in ev.collect()}
    assert hits == {"f1": {"DQ_HARM_001"}, "f2": {"DQ_PRICE_001"}, "f3": set()}
    msg = [h["error_message"] for h in ev.filter("offer_id = 'f2'").first()["_hits"]][0]
    assert msg == "category=IPHONE: price 9000.00 outside expected [400, 3500]"


def test_stage_output_counts_and_pass_rate(spark):
    rows = [GOOD, GOOD_INST, CASES["DQ_NULL_001"], CASES["DQ_RANGE_001"], CASES["DQ_RANGE_001"]]
    out = Q.stage_output(Q.evaluate(_df(spark, rows), "INGEST"), "INGEST", Q.catalog(spark))
    got = {r["rule_id"]: (r["total_records"], r["failed_records"], r["pass_rate"]) for r in out.collect()}
    assert got["DQ_RANGE_001"] == (5, 2, 0.6)
    assert got["DQ_NULL_001"] == (5, 1, 0.8)
    assert got["DQ_NULL_004"] == (5, 0, 1.0)
    assert len(got) == 8


def test_inactive_rule_is_not_reported(spark):
    cat = Q.catalog(spark, inactive=("DQ_NULL_001",))
    out = Q.stage_output(Q.evaluate(_df(spark, [CASES["DQ_NULL_001"]]), "INGEST"), "INGEST", cat)
    assert "DQ_NULL_001" not in {r["rule_id"] for r in out.collect()}


def test_promotion_ignores_null_keys(spark):
    """Anti-join promotion: a NULL key among bad records must not block every row."""
    stg = _df(spark, [GOOD, GOOD]).withColumn("dq_status", F.lit("PENDING"))
    bad = spark.createDataFrame([(None, "DQ_HARM_001")], "offer_id string, rule_id string")
    out = Q.mark_passed(stg, bad, ["offer_id"], "INGEST_PASSED")
    assert {r["dq_status"] for r in out.collect()} == {"INGEST_PASSED"}
