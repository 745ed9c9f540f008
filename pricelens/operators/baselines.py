"""Rolling baselines and time-grain aggregates (AGG-1..5, AGG-8, SRC-8).

Baselines never expand history into days. An interval clipped to the window
contributes ``days`` identical daily prices, so the table is first reduced to
(model, country, window, price) → day count, and count, mean, stddev and exact
percentiles are computed from those weighted rows (``percentile`` with a
frequency argument). Money is handled in whole cents so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.operators.anomalies import cents


def _from_cents_rounded(v: Column) -> Column:
    """A value in cents (double) → currency, rounded half-up to the cent."""
    return (F.round(v, 0) / 100).cast("decimal(12,2)")


def _weighted_moments(df: DataFrame, keys: list[str], value_c: Column, weight: Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(weight).cast("bigint").alias("n"),
        F.sum(value_c.cast("decimal(38,0)") * weight).alias("s"),
        F.sum(value_c.cast("decimal(38,0)") * value_c * weight).alias("ss"))


def _mean_std(n: Column, s: Column, ss: Column):
    mean = (F.floor((s * 2 + n) / (n * 2)) / 100).cast("decimal(12,2)")
    var_c = (n.cast("decimal(38,0)") * ss - s * s).cast("double") / (n * (n - 1)).cast("double")
    std = F.when(n >= 2, F.round(F.sqrt(var_c) / 100, 2))
    return mean, std


def baselines(history: DataFrame, as_of, windows=(7, 30, 90), min_n: int = 3,
              keys=("product_model_id", "country_code")) -> DataFrame:
    """AGG-1: per (model, country, window): n, mean, sample stddev, p05/p50/p95.

    Every day of the last ``window`` days up to ``as_of`` counts once per
    history row valid that day (open rows are valid through ``as_of``).
    """
    keys = list(keys)
    a = F.lit(as_of).cast("date")
    parts = []
    for w in windows:
        start = F.date_sub(a, w - 1)
        lo = F.greatest(F.col("valid_from_date"), start)
        hi = F.least(F.coalesce(F.col("valid_to_date"), a), a)
        parts.append(history.select(*keys, F.lit(w).alias("window_days"),
                                    cents("effective_total_usd").alias("pc"),
                                    (F.datediff(hi, lo) + 1).alias("days")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.filter(F.col("days") > 0)
    g = keys + ["window_days"]
    per_price = u.groupBy(*g, "pc").agg(F.sum("days").cast("bigint").alias("days"))
    pc = F.col("pc").cast("double")
    agg = per_price.groupBy(*g).agg(
        F.sum("days").cast("bigint").alias("n"),
        F.sum(F.col("pc").cast("decimal(38,0)") * F.col("days")).alias("s"),
        F.sum(F.col("pc").cast("decimal(38,0)") * F.col("pc") * F.col("days")).alias("ss"),
        F.percentile(pc, F.lit(0.05), F.col("days")).alias("q05"),
        F.percentile(pc, F.lit(0.50), F.col("days")).alias("q50"),
        F.percentile(pc, F.lit(0.95), F.col("days")).alias("q95"))
    agg = agg.filter(F.col("n") >= min_n)
    mean, std = _mean_std(F.col("n"), F.col("s"), F.col("ss"))
    return agg.select(a.alias("baseline_as_of"), *g, F.col("n").alias("sample_size"),
                      mean.alias("mean_price_usd"), std.alias("stddev_price_usd"),
                      _from_cents_rounded(F.col("q05")).alias("p05_price_usd"),
                      _from_cents_rounded(F.col("q50")).alias("p50_price_usd"),
                      _from_cents_rounded(F.col("q95")).alias("p95_price_usd"))


def append_baselines(store: DataFrame, new: DataFrame,
                     keys=("product_model_id", "country_code", "window_days")) -> DataFrame:
    """AGG-2: rows of ``new`` to append: not equal to the previous day's row on
    mean, stddev and p95 (a NULL stddev never compares equal), and not already
    stored for the same as-of date."""
    keys = list(keys)
    prev = store.select(F.date_add("baseline_as_of", 1).alias("baseline_as_of"), *keys,
                        F.col("mean_price_usd").alias("_m"), F.col("stddev_price_usd").alias("_s"),
                        F.col("p95_price_usd").alias("_p"))
    same = (new.join(prev, ["baseline_as_of"] + keys)
            .filter((F.col("mean_price_usd") == F.col("_m")) & (F.col("stddev_price_usd") == F.col("_s"))
                    & (F.col("p95_price_usd") == F.col("_p")))
            .select("baseline_as_of", *keys))
    out = new.join(same, ["baseline_as_of"] + keys, "left_anti")
    return out.join(store.select("baseline_as_of", *keys), ["baseline_as_of"] + keys, "left_anti")


GRAIN = ["partner_id", "country_code", "product_model_id", "payment_type"]


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their group over ``spark.sql.shuffle.partitions`` tasks, before
    they are aggregated. Groups here are about as many as rows, so an aggregation in
    the task that reads a file holds a whole row group in its hash map and sends as
    many rows as it got; and without a number of partitions AQE would merge them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def daily_prices(fact: DataFrame) -> DataFrame:
    """AGG-3: per UTC day and grain: count, min, avg, median, max, stddev.

    Rows are first reduced to (day, grain, price) counts, so the median's
    working set is the distinct prices of a group, not its rows.
    """
    g = ["utc_date"] + GRAIN
    base = fact.select(F.to_date("crawl_ts_utc").alias("utc_date"), *GRAIN,
                       cents("effective_total_usd").alias("pc"))
    # both aggregations find the groups dealt already
    per = _spread(base, *g).groupBy(*g, "pc").agg(F.count(F.lit(1)).alias("k"))
    pc = F.col("pc").cast("double")
    med = F.percentile(pc, F.lit(0.5), F.col("k"))
    agg = per.groupBy(*g).agg(
        F.sum("k").cast("bigint").alias("n"),
        F.sum(F.col("pc").cast("decimal(38,0)") * F.col("k")).alias("s"),
        F.sum(F.col("pc").cast("decimal(38,0)") * F.col("pc") * F.col("k")).alias("ss"),
        F.min("pc").alias("mn"), F.max("pc").alias("mx"), med.alias("md"))
    mean, std = _mean_std(F.col("n"), F.col("s"), F.col("ss"))
    return agg.select(*g, F.col("n").alias("offer_count"),
                      (F.col("mn") / 100).cast("decimal(12,2)").alias("min_price_usd"),
                      mean.alias("avg_price_usd"),
                      _from_cents_rounded(F.col("md")).alias("median_price_usd"),
                      (F.col("mx") / 100).cast("decimal(12,2)").alias("max_price_usd"),
                      std.alias("stddev_price_usd"))


def hourly_prices(fact: DataFrame) -> DataFrame:
    """AGG-4: per UTC hour and grain: count, avg, min, max (exact cent sums kept
    so hours can be re-aggregated into any day)."""
    g = ["utc_hour"] + GRAIN
    c = cents("effective_total_usd")
    base = fact.select(F.date_trunc("hour", "crawl_ts_utc").alias("utc_hour"), *GRAIN, c.alias("pc"))
    agg = (_spread(base, *g).groupBy(*g).agg(F.count(F.lit(1)).alias("offer_count"),
                                F.sum("pc").alias("sum_cents"),
                                F.min("pc").alias("mn"), F.max("pc").alias("mx")))
    n = F.col("offer_count")
    return agg.select(*g, "offer_count", "sum_cents",
                      (F.floor((F.col("sum_cents") * 2 + n) / (n * 2)) / 100).cast("decimal(12,2)")
                      .alias("avg_price_usd"),
                      (F.col("mn") / 100).cast("decimal(12,2)").alias("min_price_usd"),
                      (F.col("mx") / 100).cast("decimal(12,2)").alias("max_price_usd"))


def rezone_daily(hourly: DataFrame, tz: str) -> DataFrame:
    """AGG-5: hours → days of any zone: summed counts, average of hourly averages."""
    local_day = F.to_date(F.from_utc_timestamp("utc_hour", tz))
    g = ["local_date"] + GRAIN
    hours = hourly.select(local_day.alias("local_date"), *GRAIN, "offer_count", "avg_price_usd")
    agg = (_spread(hours, *g).groupBy(*g)
           .agg(F.sum("offer_count").cast("bigint").alias("offer_count"),
                F.count(F.lit(1)).alias("_k"),
                F.sum(cents("avg_price_usd")).alias("_s")))
    k = F.col("_k")
    return agg.select("local_date", *GRAIN, "offer_count",
                      (F.floor((F.col("_s") * 2 + k) / (k * 2)) / 100).cast("decimal(12,2)")
                      .alias("avg_of_hourly_avg"))


def calendar(spark, start, end) -> DataFrame:
    """SRC-8: calendar dimension (year, quarter, month names, ISO week, weekday, weekend)."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start_date"),
                                   F.lit(end).cast("date").alias("end_date"))
    return calendar_from(bounds)


def calendar_from(bounds: DataFrame) -> DataFrame:
    """Calendar rows for every (start_date, end_date) row of ``bounds``."""
    d = bounds.select(F.explode(F.sequence("start_date", "end_date")).alias("date_value"))
    dow = F.weekday("date_value") + 1   # Monday = 1 … Sunday = 7
    return d.select(
        "date_value",
        F.year("date_value").alias("year"),
        F.quarter("date_value").alias("quarter"),
        F.month("date_value").alias("month"),
        F.date_format("date_value", "MMMM").alias("month_name"),
        F.weekofyear("date_value").alias("iso_week"),
        dow.alias("iso_day_of_week"),
        F.date_format("date_value", "EEEE").alias("day_name"),
        (dow >= 6).alias("is_weekend"))


def fiscal_calendar(cal: DataFrame) -> DataFrame:
    """AGG-8: fiscal year ending late September (FQ1 = Oct–Dec), month-aligned."""
    shifted = F.add_months("date_value", 3)
    return cal.select("*",
                      F.year(shifted).alias("fiscal_year"),
                      F.quarter(shifted).alias("fiscal_quarter"),
                      F.month(shifted).alias("fiscal_month"),
                      (F.month("date_value").isin(3, 6, 9, 12)
                       & (F.col("date_value") == F.last_day("date_value"))).alias("is_fiscal_quarter_end"))


def regional_daily(fact: DataFrame, country=None) -> DataFrame:
    """AGG-13: offers per country and market-local day."""
    f = fact if country is None else fact.filter(F.col("country_code") == country)
    return f.groupBy("country_code", "crawl_date_local").agg(
        F.count(F.lit(1)).alias("offer_count"))
