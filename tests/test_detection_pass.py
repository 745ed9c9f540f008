"""Detection in one pass: the rows of the four detectors, and few shuffles."""

import datetime as dt
import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from pricelens.operators import anomalies as A
from pricelens.operators import history as H
from pricelens.operators import quality as Q
from pricelens.plans import catalog as C
from pricelens.session import cut_and_deal, cut_lineage

SCHEMA = ("offer_id string, source_batch_id int, product_model_id string, partner_id long, country_code int, payment_type string, "
          "currency_code string, effective_total_local decimal(12,2), effective_total_usd decimal(12,2), crawl_ts_utc timestamp, "
          "crawl_date date, category_code string")
GROUP = ["product_model_id", "country_code"]


def _offers(spark, n=700):
    r = random.Random(5)
    rows = []
    for i in range(n):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(60))
        usd = D(r.choice([0, 90, 100, 101, 120, 300, 5000])) + D(r.randrange(100)) / 100 if i % 17 else None
        ts = dt.datetime.combine(day, dt.time(r.randrange(24))) if i % 13 else None
        rows.append((f"o{i if i % 9 else 0}", 1, r.choice(["m1", "m2", None]) if i % 3 else "m1", r.choice([1, 2, 3, None]) if i % 4 else 1,
                     r.choice([1, 2, None]), r.choice(["FULL", "INSTALMENT"]), "USD", usd, usd, ts, day if ts else None,
                     r.choice(["MAC", "IPAD"])))
    return cut_lineage(spark.createDataFrame(rows, SCHEMA))


def _rows(df):
    return sorted(map(str, df.collect()))


def test_one_pass_equals_the_four_detectors(spark):
    o = _offers(spark)
    h = cut_lineage(H.scd2_rebuild(o))
    cols = A.ANOMALY_COLS + ["product_model_id", "partner_id", "country_code", "payment_type", "crawl_ts_utc", "source_batch_id"]
    apart = None
    for d in (A.detect_statistical(o, h), A.detect_temporal(o, h), A.detect_cross_partner(o, h), A.detect_sku_variance(o, GROUP)):
        apart = d.select(*cols) if apart is None else apart.unionByName(d.select(*cols))
    together = A.detect(o, h, sku_group=GROUP)
    assert {r[0] for r in together.select("anomaly_type").distinct().collect()} == {"STATISTICAL", "TEMPORAL", "CROSS_PARTNER", "SKU_VARIANCE"}
    assert _rows(together.select(*cols)) == _rows(apart)
    high = apart.filter(F.col("severity").isin("HIGH", "MEDIUM"))
    assert _rows(A.detect(o, h, min_severity="MEDIUM", sku_group=GROUP).select(*cols)) == _rows(high)
    # an offer is shuffled with its id once, not by each detector
    plan = together._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [offer_id" in line for line in plan.splitlines()) <= 2, plan
    assert sum("Relation [offer_id" in line for line in apart._jdf.queryExecution().optimizedPlan().toString().splitlines()) > 2


def test_anomalies_meet_every_offer_of_their_id(spark):
    o = _offers(spark).withColumn("crawl_month", F.trunc("crawl_date", "month"))
    h = cut_lineage(H.scd2_rebuild(o))
    a = A.detect(o, h, keep=("category_code", "crawl_date"))
    want = a.select(*A.ANOMALY_COLS).join(o.select("offer_id", *C.OFFER_COLS), "offer_id")
    mine = a.select(*A.ANOMALY_COLS, *C.A_COLS).join(C.namesakes(o, C.A_COLS), "offer_id", "left")
    got = C.join_namesakes(mine, C.OFFER_COLS).select(*want.columns)
    assert _rows(got) == _rows(want)


def test_status_is_told_without_messages(spark):
    df = spark.createDataFrame([("Australia", 1), ("", 2), (None, 3)], "country_name string, i int")
    for c, t in (("crawl_ts_utc", "timestamp"), ("country_code", "string"), ("raw_product_name", "string"), ("payment_type", "string"),
                 ("full_price", "decimal(12,2)"), ("monthly_amount", "decimal(12,2)"), ("instalment_months", "int")):
        df = df.withColumn(c, F.lit("2024-01-01" if t == "timestamp" else "5").cast(t))
    df = df.withColumn("payment_type", F.lit("FULL")).withColumn("monthly_amount", F.lit(None).cast("decimal(12,2)")).withColumn("instalment_months", F.lit(None).cast("int"))
    ev = Q.evaluate(df, "INGEST")
    status = ev.withColumn("dq_status", Q.ingest_status(ev)).select("i", "dq_status", F.size("_hits").alias("n"))
    assert sorted(map(tuple, status.collect())) == [(1, "INGEST_PASSED", 0), (2, "PENDING", 1), (3, "PENDING", 1)]
    passed = status.filter("dq_status = 'INGEST_PASSED'").drop("n")
    assert "error_message" not in passed._jdf.queryExecution().optimizedPlan().toString()


def _plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_dealt_offers_are_not_shuffled_again(spark, capsys):
    """History and the previous price move days, not offers."""
    o = cut_and_deal(_offers(spark), [*H.KEY, "crawl_date"])
    assert _rows(o) == _rows(_offers(spark))
    assert _plan(H.daily_latest(o), capsys).count("Exchange") == 0
    h = cut_lineage(H.scd2_rebuild(o))
    assert _rows(h) == _rows(H.scd2_rebuild(_offers(spark)))
    found = A.detect_temporal(o.hint("merge"), h)
    assert _plan(found, capsys).count("Exchange hashpartitioning") == 2  # days to their key, and back
    assert _rows(found) == _rows(A.detect_temporal(_offers(spark), h))


def test_stored_days_serve_both_detectors(spark, capsys):
    o = cut_and_deal(_offers(spark), [*H.KEY, "crawl_date"])
    h = cut_lineage(H.scd2_rebuild(o))
    days = cut_and_deal(A.day_context(o, h), [*H.KEY, "crawl_date"], name="days")
    for detect in (A.detect_temporal, A.detect_cross_partner):
        with_days = detect(o, h, days=days)
        assert _rows(with_days.select(*A.ANOMALY_COLS)) == _rows(detect(o, h).select(*A.ANOMALY_COLS))
        assert with_days.count() > 0
    assert "Exchange" not in _plan(A.detect_temporal(o.hint("merge"), h, days=days), capsys)


def test_the_chart_derives_the_offers_once(spark, monkeypatch):
    from tests.conftest import SMALL

    calls, real = [], C.T.offers
    monkeypatch.setattr(C.T, "offers", lambda *a, **b: calls.append(1) or real(*a, **b))
    read = [line for line in C.q_anom_series(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "l_orderkey" in line]
    assert len(calls) == 1 and not read
