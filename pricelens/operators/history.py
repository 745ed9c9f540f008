"""Price history as slowly changing dimension type 2 (HIS-1..8).

Scale notes. Every per-key window here runs only after the offers have been
reduced to one row per (key, day) with a partial aggregate, so a key that
holds a third of all offers still yields at most one row per calendar day in
its window partition. The incremental merge is one shuffle on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["product_model_id", "partner_id", "country_code", "payment_type"]
VALUE = ["currency_code", "effective_total_local", "effective_total_usd"]


def latest_per_key(offers: DataFrame, key=KEY, date_col: str = "crawl_date",
                   order=("crawl_ts_utc", "offer_id")) -> DataFrame:
    """HIS-1: the latest offer per key (ties broken by offer id), with its day."""
    best = F.max_by(F.struct(*VALUE, F.col(date_col).alias("valid_from_date")),
                    F.struct(*order))
    return offers.groupBy(*key).agg(best.alias("l")).select(*key, "l.*")


def daily_latest(offers: DataFrame, key=KEY, date_col: str = "crawl_date",
                 order=("crawl_ts_utc", "offer_id"), value=VALUE) -> DataFrame:
    """Latest offer per (key, day): the pre-aggregation every rebuild starts from."""
    best = F.max_by(F.struct(*value), F.struct(*order))
    return (offers.groupBy(*key, F.col(date_col).alias("valid_from_date"))
                  .agg(best.alias("l")).select(*key, "valid_from_date", "l.*"))


def scd2_rebuild(offers: DataFrame, key=KEY, date_col: str = "crawl_date", value=VALUE) -> DataFrame:
    """HIS-3: full history from all offers at day grain; ``value`` names the columns to
    carry (the USD price among them).

    A new interval starts on a day whose latest USD price differs from the
    previous day's; it ends the day before the next start (open = NULL).
    """
    d = daily_latest(offers, key, date_col, value=value)
    w = Window.partitionBy(*key).orderBy("valid_from_date")
    prev = F.lag("effective_total_usd").over(w)
    starts = d.withColumn("_chg", prev.isNull() | (prev != F.col("effective_total_usd"))) \
              .filter("_chg").drop("_chg")
    return starts.withColumn(
        "valid_to_date", F.date_sub(F.lead("valid_from_date").over(w), 1))


def scd2_apply(history: DataFrame, batch_offers: DataFrame, key=KEY,
               date_col: str = "crawl_date") -> DataFrame:
    """HIS-2: merge one batch into history and return the full new history.

    New key → insert. Changed USD with a newer start → close the open row on
    the day before and insert. Otherwise (same price, or a late row) → nothing.
    """
    latest = latest_per_key(batch_offers, key, date_col)
    cols = key + VALUE + ["valid_from_date", "valid_to_date"]
    hist = history.select(*cols)
    open_ = hist.filter(F.col("valid_to_date").isNull())
    closed_before = hist.filter(F.col("valid_to_date").isNotNull())
    e = open_.select(*key, F.col("effective_total_usd").alias("_e_usd"),
                     F.col("valid_from_date").alias("_e_from"))
    j = latest.join(e, key, "left")
    changed = j.filter(F.col("_e_usd").isNull()
                       | ((F.col("_e_usd") != F.col("effective_total_usd"))
                          & (F.col("valid_from_date") > F.col("_e_from"))))
    inserts = changed.select(*key, *VALUE, "valid_from_date",
                             F.lit(None).cast("date").alias("valid_to_date"))
    close_at = changed.filter(F.col("_e_usd").isNotNull()).select(
        *key, F.date_sub("valid_from_date", 1).alias("_close"),
        F.col("effective_total_usd").alias("_new_usd"))
    o = open_.join(close_at, key, "left")
    o = o.withColumn("valid_to_date", F.when(
        F.col("_close").isNotNull() & (F.col("effective_total_usd") != F.col("_new_usd")),
        F.col("_close")).otherwise(F.col("valid_to_date"))).select(*cols)
    return closed_before.unionByName(o).unionByName(inserts.select(*cols))


def scd2_fold(history: DataFrame, offers: DataFrame, key=KEY, date_col: str = "crawl_date", batch_col: str = "source_batch_id") -> DataFrame:
    """HIS-2 for several batches in one pass: what :func:`scd2_apply` gives for them
    one after the other, in the order of their first crawl (ties by batch id).

    Per key the batches' latest offers, one a batch, are folded onto the open row;
    closed rows pass by untouched. Two shuffles on the key, whatever the number of
    batches; a key's list is as long as the batches of the call.
    """
    cols = list(key) + VALUE + ["valid_from_date", "valid_to_date"]
    first = offers.groupBy(F.col(batch_col).alias("_of")).agg(F.min("crawl_ts_utc").alias("_first"))
    latest = latest_per_key(offers.withColumn("_batch", F.col(batch_col)), [*key, "_batch"], date_col)
    latest = latest.join(first, F.col("_batch").eqNullSafe(F.col("_of")))
    row = F.struct(*VALUE, "valid_from_date")
    found = latest.groupBy(*[F.col(k).alias(f"_n_{k}") for k in key]).agg(F.array_sort(F.collect_list(F.struct(F.col("_first").alias("t"), F.col("_batch").alias("b"), row.alias("r")))).alias("_l"))
    history = history.select(*cols)
    open_ = history.filter(F.col("valid_to_date").isNull()).select(*[F.col(k).alias(f"_o_{k}") for k in key], row.alias("_open"))
    on = None
    for k in key:
        same = F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}"))
        on = same if on is None else on & same
    j = open_.join(found, on, "full").select(*[F.coalesce(f"_o_{k}", f"_n_{k}").alias(k) for k in key], "_open", "_l")
    news = F.transform(F.coalesce("_l", F.expr("array()").cast(found.schema["_l"].dataType)), lambda x: x["r"])
    start = F.when(F.col("_open").isNotNull(), F.array("_open")).otherwise(F.slice(news, 1, 1))

    def accept(rows, x):
        last = F.element_at(rows, -1)
        newer = (x["effective_total_usd"] != last["effective_total_usd"]) & (x["valid_from_date"] > last["valid_from_date"])
        return F.when(newer, F.concat(rows, F.array(x))).otherwise(rows)

    j = j.select(*key, F.aggregate(news, start, accept).alias("_rows"))
    r = j.select(*key, "_rows", F.posexplode("_rows").alias("_i", "_r"))
    ends = F.date_sub(F.get("_rows", F.col("_i") + 1)["valid_from_date"], 1)
    return history.filter(F.col("valid_to_date").isNotNull()).unionByName(
        r.select(*key, *[F.col("_r")[v].alias(v) for v in [*VALUE, "valid_from_date"]], ends.alias("valid_to_date")).select(*cols))


def price_as_of(history: DataFrame, as_of) -> DataFrame:
    """HIS-4: the row valid on a date."""
    d = F.lit(as_of).cast("date")
    return history.filter((F.col("valid_from_date") <= d)
                          & (F.col("valid_to_date").isNull() | (F.col("valid_to_date") >= d)))


def current_prices(history: DataFrame, partners: DataFrame | None = None,
                   with_map: bool = False) -> DataFrame:
    """HIS-5: market snapshot per (model, country, payment) over open rows.

    Distinct partners, cheapest price, spread, spread ÷ mean. ``with_map``
    adds the partner-code → price map (one entry per partner of the group).
    """
    h = history.filter(F.col("valid_to_date").isNull())
    usd = F.col("effective_total_usd")
    aggs = [F.countDistinct("partner_id").alias("partner_count"),
            F.min(usd).alias("cheapest_price_usd"),
            (F.max(usd) - F.min(usd)).cast("decimal(12,2)").alias("price_spread_usd"),
            F.when(F.avg(usd.cast("double")) > 0,
                   F.round((F.max(usd) - F.min(usd)).cast("double") / F.avg(usd.cast("double")), 6))
             .alias("price_spread_pct")]
    if with_map:
        h = h.join(partners.select("partner_id", "partner_code"), "partner_id")
        aggs.append(F.map_from_entries(F.array_sort(F.collect_list(
            F.struct("partner_code", "effective_total_usd")))).alias("partner_prices"))
    return h.groupBy("product_model_id", "country_code", "payment_type").agg(*aggs)


def price_timeline(history: DataFrame, model=None) -> DataFrame:
    """HIS-6: history rows with CURRENT/HISTORICAL label, in time order."""
    h = history if model is None else history.filter(F.col("product_model_id") == model)
    return h.withColumn("status", F.when(F.col("valid_to_date").isNull(), "CURRENT")
                        .otherwise("HISTORICAL")).orderBy(*KEY, "valid_from_date")


def top_spreads(current: DataFrame, n: int = 10) -> DataFrame:
    """HIS-7: widest cross-partner spreads (top-n report; partner_count > 1)."""
    return (current.filter(F.col("partner_count") > 1)
            .orderBy(F.desc_nulls_last("price_spread_pct"), "product_model_id",
                     "country_code", "payment_type")
            .limit(n))


def history_rows_for_batch(history: DataFrame, offers: DataFrame, key=KEY,
                           batch_col: str = "source_batch_id") -> DataFrame:
    """HIS-8: number of history rows for the keys each batch touched."""
    touched = offers.select(batch_col, *key).distinct()
    per_key = history.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return (touched.join(per_key, key)
            .groupBy(batch_col).agg(F.sum("_n").cast("bigint").alias("history_rows")))
