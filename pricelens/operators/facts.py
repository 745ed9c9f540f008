"""FX rates, fact building and payment child tables (FX-1..3, FACT-1/2, PRJ-5..7, SNK-2).

As-of FX is an equi-join, not a range join: rates are expanded to one row per
(currency, day) between consecutive rate dates (bounded by the calendar, not
by the data), so each offer finds its rate with a hash lookup on
(currency, day). Days after a currency's last rate take that last rate from a
one-row-per-currency table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.session import cut_lineage


def rate_intervals(rates: DataFrame, to_currency: str = "USD") -> DataFrame:
    """[effective_date, next_date) per source currency, from a sparse rate table.

    Window per currency over rate rows: one row per (currency, rate date),
    so a partition is bounded by the number of rate dates.
    """
    r = rates.filter(F.col("to_currency_code") == to_currency)
    w = Window.partitionBy("from_currency_code").orderBy("effective_date")
    return r.select("from_currency_code", "rate", "effective_date",
                    F.lead("effective_date").over(w).alias("next_date"))


def daily_rates(rates: DataFrame, to_currency: str = "USD") -> DataFrame:
    """FX-2: forward-filled rate for every day from a currency's first to its last rate date."""
    iv = rate_intervals(rates, to_currency)
    last_day = F.coalesce(F.date_sub("next_date", 1), F.col("effective_date"))
    return iv.select(
        "from_currency_code",
        F.explode(F.sequence("effective_date", last_day)).alias("rate_day"),
        "rate", F.col("effective_date").alias("rate_date"))


def last_rates(rates: DataFrame, to_currency: str = "USD") -> DataFrame:
    r = rates.filter(F.col("to_currency_code") == to_currency)
    return r.groupBy("from_currency_code").agg(
        F.max_by(F.struct("rate", "effective_date"), "effective_date").alias("l")
    ).select("from_currency_code", F.col("l.rate").alias("last_rate"),
             F.col("l.effective_date").alias("last_date"))


def asof_fx(df: DataFrame, rates: DataFrame, currency_col: str = "currency_code",
            date_col: str = "crawl_date", to_currency: str = "USD") -> DataFrame:
    """FX-1: latest rate with effective_date <= the row's date; rows are kept.

    Adds fx_rate (NULL when no earlier rate exists) and fx_rate_date. The rates
    are written once, so that the planner knows the size of the daily table (a
    row per currency and day) and need not shuffle the rows to it where it is small.
    """
    rates = cut_lineage(rates, name="rates")
    d = cut_lineage(daily_rates(rates, to_currency), name="daily-rates")
    last = F.broadcast(last_rates(rates, to_currency))   # a row per currency
    out = df.join(d, (df[currency_col] == d.from_currency_code) & (df[date_col] == d.rate_day),
                  "left").drop("from_currency_code", "rate_day")
    out = out.join(last, out[currency_col] == last.from_currency_code, "left") \
             .drop("from_currency_code")
    after = F.col(date_col) > F.col("last_date")
    return (out.withColumn("fx_rate", F.coalesce(F.col("rate"), F.when(after, F.col("last_rate"))))
               .withColumn("fx_rate_date", F.coalesce(F.col("rate_date"),
                                                      F.when(after, F.col("last_date"))))
               .drop("rate", "rate_date", "last_rate", "last_date"))


def ffill_fx(rates: DataFrame, start, end, to_currency: str = "USD") -> DataFrame:
    """FX-2: one row per (currency, day) in [start, end], carrying the last known rate.

    Days before the first rate have a NULL rate.
    """
    cur = rates.filter(F.col("to_currency_code") == to_currency).select("from_currency_code").distinct()
    s = start if isinstance(start, Column) else F.lit(start)
    e = end if isinstance(end, Column) else F.lit(end)
    grid = cur.select(
        F.col("from_currency_code").alias("currency_code"),
        F.explode(F.sequence(s.cast("date"), e.cast("date"))).alias("day"))
    r = asof_fx(grid, rates,
                "currency_code", "day", to_currency)
    return r.select("currency_code", "day", "fx_rate", "fx_rate_date")


def cross_rate(daily: DataFrame, base: str) -> DataFrame:
    """FX-3: rate of every currency in units of ``base`` per day: (A→USD)/(base→USD).

    Linear in the daily table: one join against the base currency's days.
    """
    b = daily.filter(F.col("from_currency_code") == base).select(
        F.col("rate_day").alias("_d"), F.col("rate").alias("_base_rate"))
    j = daily.join(b, daily.rate_day == b._d).drop("_d")
    return j.select(F.col("from_currency_code"), F.lit(base).alias("to_currency_code"),
                    "rate_day",
                    F.round(F.col("rate").cast("double") / F.col("_base_rate").cast("double"), 8)
                     .alias("cross_rate"))


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------

def effective_total(df: DataFrame) -> Column:
    """PRJ-5: full price, or monthly × months (missing parts count as 0)."""
    return F.when(F.col("payment_type") == "FULL",
                  F.coalesce(F.col("full_price"), F.lit(0).cast("decimal(12,2)"))) \
            .otherwise(F.coalesce(F.col("monthly_amount"), F.lit(0).cast("decimal(12,2)"))
                       * F.coalesce(F.col("instalment_months"), F.lit(0))).cast("decimal(12,2)")


def to_usd(local, rate) -> tuple:
    """PRJ-6: (usd, rate used, missing flag); a missing rate counts as 1.0."""
    used = F.coalesce(rate, F.lit(1).cast("decimal(16,8)"))
    return F.round(local * used, 2).cast("decimal(12,2)"), used, rate.isNull()


def with_local_time(df: DataFrame, zones: DataFrame, mode: str = "market",
                    ts_col: str = "crawl_ts_utc") -> DataFrame:
    """PRJ-7: market-local timestamp and date through country → IANA zone.

    ``zones`` is (country_code, iana_name), a fixed small dimension.
    ``mode='utc'`` reproduces storing UTC with the zone dropped.
    """
    if mode == "utc":
        return df.withColumn("crawl_ts_local", F.col(ts_col)) \
                 .withColumn("crawl_date_local", F.to_date(ts_col))
    z = F.broadcast(zones.select(F.col("country_code").alias("_zc"), "iana_name"))
    out = df.join(z, df.country_code == z._zc, "left").drop("_zc")
    local = F.from_utc_timestamp(F.col(ts_col), F.coalesce(F.col("iana_name"), F.lit("UTC")))
    return out.withColumn("crawl_ts_local", local) \
              .withColumn("crawl_date_local", F.to_date(local)).drop("iana_name")


def build_facts(stg: DataFrame, rates: DataFrame, gate: bool = True,
                zones: DataFrame | None = None, local_time: str = "utc") -> DataFrame:
    """FACT-1 (gate=True) / FACT-2 (gate=False): staging rows → fact rows.

    Completeness filter (payment, timestamp, country, model present), gated on
    PRE_FACT_PASSED when ``gate``; local total > 0; USD at the as-of rate,
    falling back to 1.0 with the crawl date as rate date.
    """
    ok = (F.col("payment_type").isNotNull() & F.col("crawl_ts_utc").isNotNull()
          & F.col("country_code").isNotNull() & F.col("product_model_id").isNotNull())
    if gate:
        ok = ok & (F.col("dq_status") == "PRE_FACT_PASSED")
    s = stg.filter(ok).withColumn("crawl_date", F.to_date("crawl_ts_utc"))
    s = s.withColumn("effective_total_local", effective_total(s)) \
         .filter(F.col("effective_total_local") > 0)
    s = asof_fx(s, rates)
    usd, used, missing = to_usd(F.col("effective_total_local"), F.col("fx_rate"))
    s = (s.withColumn("effective_total_usd", usd)
          .withColumn("fx_missing", missing)
          .withColumn("fx_rate_to_usd", used)
          .withColumn("fx_rate_date", F.coalesce(F.col("fx_rate_date"), F.col("crawl_date")))
          .drop("fx_rate"))
    if zones is not None or local_time == "utc":
        s = with_local_time(s, zones, "utc" if zones is None else local_time)
    return s


def split_payments(fact: DataFrame, key: str = "offer_id"):
    """SNK-2: child tables per payment type, no sparse columns."""
    full = fact.filter(F.col("payment_type") == "FULL").select(key, "crawl_ts_utc", "full_price")
    inst = fact.filter(F.col("payment_type") == "INSTALMENT").select(
        key, "crawl_ts_utc", "monthly_amount", "instalment_months")
    return full, inst


def with_payment(fact: DataFrame, full: DataFrame, inst: DataFrame, key: str = "offer_id") -> DataFrame:
    """Re-join the child tables 1:1 onto the parent fact."""
    f = full.select(key, F.col("full_price").alias("pay_full_price"))
    i = inst.select(key, F.col("monthly_amount").alias("pay_monthly_amount"),
                    F.col("instalment_months").alias("pay_instalment_months"))
    return fact.join(f, key, "left").join(i, key, "left")
