"""Hot-key inputs (one key holds a third of all rows) against brute force."""

import datetime as dt
from decimal import Decimal as D

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pricelens.functions import asof as AS
from pricelens.operators import anomalies as A
from pricelens.operators import history as H


def _skewed(spark, n=1800, seed=7):
    rng = np.random.default_rng(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        key = ("m0", 1, "AU", "FULL") if hot else ("m1", int(rng.integers(2, 20)), "NZ", "FULL")
        day = int(rng.integers(0, 120))
        ts = base + dt.timedelta(days=day, minutes=int(rng.integers(0, 1440)))
        price = D(str(100 + int(rng.integers(0, 4)) * 5)) if hot else D(str(200 + int(rng.integers(0, 40))))
        rows.append((f"o{i:05d}", *key, "USD", price, price, ts, ts.date()))
    df = spark.createDataFrame(rows, "offer_id string, product_model_id string, partner_id long, country_code string, "
                                     "payment_type string, currency_code string, effective_total_local decimal(12,2), "
                                     "effective_total_usd decimal(12,2), crawl_ts_utc timestamp, crawl_date date")
    return df.withColumn("source_batch_id", F.year("crawl_ts_utc"))


def _brute_history(pdf):
    out = []
    for key, g in pdf.groupby(H.KEY):
        g = g.sort_values(["crawl_ts_utc", "offer_id"])
        daily = g.groupby("crawl_date").tail(1).sort_values("crawl_date")
        prev = None
        starts = []
        for _, r in daily.iterrows():
            if prev is None or r["effective_total_usd"] != prev:
                starts.append((r["crawl_date"], r["effective_total_usd"]))
            prev = r["effective_total_usd"]
        for i, (d0, p) in enumerate(starts):
            end = starts[i + 1][0] - dt.timedelta(days=1) if i + 1 < len(starts) else None
            out.append((*key, float(p), d0, end))
    return sorted(out, key=repr)


def test_scd2_with_hot_key_matches_brute_force(spark):
    offers = _skewed(spark)
    got = sorted(((r["product_model_id"], r["partner_id"], r["country_code"], r["payment_type"],
                   float(r["effective_total_usd"]), r["valid_from_date"], r["valid_to_date"])
                  for r in H.scd2_rebuild(offers).collect()), key=repr)
    assert got == _brute_history(offers.toPandas())


def test_temporal_with_hot_key_matches_brute_force(spark):
    offers = _skewed(spark)
    hist = H.scd2_rebuild(offers)
    got = {r["offer_id"]: (r["severity"], r["signal_score"])
           for r in A.detect_temporal(offers, hist).collect()}
    hp = hist.toPandas()
    want = {}
    for _, o in offers.toPandas().iterrows():
        h = hp[(hp.product_model_id == o.product_model_id) & (hp.partner_id == o.partner_id)
               & (hp.country_code == o.country_code) & (hp.payment_type == o.payment_type)
               & (hp.valid_from_date < o.crawl_date)]
        if h.empty:
            continue
        ref = float(h.sort_values("valid_from_date").iloc[-1].effective_total_usd)
        p = abs(float(o.effective_total_usd) - ref) / ref
        if p < 0.10:
            continue
        sev = "HIGH" if p >= 0.25 else "MEDIUM" if p >= 0.15 else "LOW"
        want[o.offer_id] = (sev, round(min(p, 1.0), 3))
    assert got == want


def test_previous_before_hot_user_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, 0 if i % 3 == 0 else int(rng.integers(1, 50)),
             base + dt.timedelta(minutes=int(rng.integers(0, 60 * 24 * 20))), float(i)) for i in range(1500)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double")
    got = {r["event_id"]: r["prev_event_id"]
           for r in AS.previous_before(ev, ["user_id"], "ts", ["event_id"], "event_id").collect()}
    pdf = pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "value"])
    want = {}
    for _, e in pdf.iterrows():
        prior = pdf[(pdf.user_id == e.user_id) & (pdf.ts < e.ts)]
        want[e.event_id] = None if prior.empty else int(prior.sort_values(["ts", "event_id"]).iloc[-1].event_id)
    assert got == want
