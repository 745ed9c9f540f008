"""Price anomaly detectors and their bookkeeping (ANO-1..12, ANO-18).

Common rule: relative deviation p = |obs - ref| / ref; p < LOW bar is not an
anomaly; severity from the bars; score = round(min(p, 1), 3).

Scale notes.
* Money is summed as whole cents (exact integers), so partial aggregates are
  order-independent and mean, variance and p are computed from exact sums.
* No detector puts an offer group into one window partition. STATISTICAL and
  TEMPORAL first reduce offers to distinct probes ((key, day) pairs: at most
  one row per key per calendar day), solve the window problem on probes plus
  day-grain history, then equi-join back to the offers. SKU_VARIANCE uses a
  partially aggregated group-by and joins the group moments back.
* CROSS_PARTNER ranks the current prices of one (model, country, payment)
  market; that partition holds one row per partner, so it is bounded by the
  partner dimension, and only three middle values per market are kept.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens import config
from pricelens.session import cut_lineage

CENTS = "bigint"


def cents(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c * 100).cast(CENTS)


def severity(p: Column, profile: str = "live", bars=None) -> Column:
    """ANO-5: LOW/MEDIUM/HIGH from a relative deviation (NULL below the LOW bar)."""
    low, med, high = bars or config.SEVERITY_PROFILES[profile]
    return (F.when(p >= high, "HIGH").when(p >= med, "MEDIUM").when(p >= low, "LOW"))


def z_severity(z: Column, bars=config.Z_BARS) -> Column:
    low, med, high = bars
    return F.when(z >= high, "HIGH").when(z >= med, "MEDIUM").when(z >= low, "LOW")


def _score(p: Column) -> Column:
    return F.round(F.least(p, F.lit(1.0)), 3)


def _finish(df: DataFrame, kind: str, p: Column, profile: str) -> DataFrame:
    return (df.withColumn("_p", p)
              .withColumn("severity", severity(F.col("_p"), profile))
              .filter(F.col("severity").isNotNull())
              .withColumn("anomaly_type", F.lit(kind))
              .withColumn("signal_score", _score(F.col("_p")))
              .withColumn("observed_price_usd", F.col("effective_total_usd"))
              .withColumnRenamed("_p", "deviation"))


def _round_half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) half up for non-negative integers, as an integer."""
    return F.floor((num * 2 + den) / (den * 2))


def _std(n: Column, s: Column, ss: Column) -> Column:
    """Sample stddev in currency units from exact cent moments (NULL for n < 2)."""
    num = (n.cast("decimal(38,0)") * ss - s.cast("decimal(38,0)") * s)
    return F.when(n >= 2, F.sqrt(num.cast("double") / (n * (n - 1)).cast("double") / F.lit(10000.0)))


# ---------------------------------------------------------------------------
# STATISTICAL
# ---------------------------------------------------------------------------

def statistical_context(offers: DataFrame, history: DataFrame, window_days: int = config.STATISTICAL_WINDOW_DAYS,
                        min_samples: int = 2) -> DataFrame:
    """Count, sum and sum of squares (cents) of the window of every (model, country,
    crawl day) of ``offers``."""
    mk = ["product_model_id", "country_code"]
    day = F.datediff(F.col("d"), F.lit("1970-01-01"))
    h = (history.groupBy(*mk, F.col("valid_from_date").alias("d"))
                .agg(F.count(F.lit(1)).alias("hn"),
                     F.sum(cents("effective_total_usd")).cast("decimal(38,0)").alias("hs"),
                     F.sum(cents("effective_total_usd").cast("decimal(38,0)")
                           * cents("effective_total_usd")).alias("hss"))
                .withColumn("probe", F.lit(False)))
    probes = (offers.select(*mk, F.col("crawl_date").alias("d")).distinct()
              .select(*mk, "d", F.lit(None).cast("bigint").alias("hn"),
                      F.lit(None).cast("decimal(38,0)").alias("hs"),
                      F.lit(None).cast("decimal(38,0)").alias("hss"), F.lit(True).alias("probe")))
    u = h.unionByName(probes).withColumn("dn", day)
    # descending order turns the open-ended suffix into a growing prefix frame,
    # which Spark evaluates incrementally (an unbounded-following frame is
    # recomputed for every row)
    w = Window.partitionBy(*mk).orderBy(F.desc("dn")).rangeBetween(Window.unboundedPreceding, window_days)
    return (u.select(*mk, "d", "probe",
                     F.sum("hn").over(w).alias("n"), F.sum("hs").over(w).alias("s"),
                     F.sum("hss").over(w).alias("ss"))
             .filter(F.col("probe") & (F.col("n") >= min_samples))
             .select(*mk, F.col("d").alias("crawl_date"), "n", "s", "ss"))


def statistical_deviation(usd: Column, n: Column, s: Column) -> Column:
    return F.abs(cents(usd).cast("decimal(38,0)") * n - s).cast("double") / s.cast("double")


def detect_statistical(offers: DataFrame, history: DataFrame, profile: str = "live",
                       window_days: int = config.STATISTICAL_WINDOW_DAYS,
                       min_samples: int = 2) -> DataFrame:
    """ANO-1: vs the mean of history rows of (model, country) starting on or after
    crawl day − window_days (no upper bound); needs ``min_samples`` rows."""
    mk = ["product_model_id", "country_code"]
    stats = cut_lineage(statistical_context(offers, history, window_days, min_samples), name="statistics")
    j = offers.join(stats, mk + ["crawl_date"])
    p = statistical_deviation(F.col("effective_total_usd"), F.col("n"), F.col("s"))
    out = _finish(j.filter(F.col("s") > 0), "STATISTICAL", p, profile)
    return out.withColumn("baseline_mean", (_round_half_up_div(F.col("s"), F.col("n")) / 100)
                          .cast("decimal(12,2)")) \
              .withColumn("baseline_stddev", F.round(_std(F.col("n"), F.col("s"), F.col("ss")), 2)) \
              .withColumn("sample_size", F.col("n").cast("bigint")) \
              .withColumn("window_days", F.lit(window_days)) \
              .drop("n", "s", "ss")


# ---------------------------------------------------------------------------
# TEMPORAL
# ---------------------------------------------------------------------------

def price_context(offers: DataFrame, history: DataFrame, key: list[str], ranks: DataFrame | None = None) -> DataFrame:
    """For every (key, crawl day) of ``offers``: price and start of the most recent
    history row that started strictly before (NULL: none), and the key's rank where
    ``ranks`` (key, rk; a row per key) has one."""
    no_rank = F.lit(None).cast("int").alias("rk")
    probes = offers.select(*key, F.col("crawl_date").alias("d")).distinct().select(
        *key, "d", F.lit(0).alias("kind"), F.lit(None).cast("decimal(12,2)").alias("usd"), no_rank)
    h = history.select(*key, F.col("valid_from_date").alias("d"), F.lit(1).alias("kind"),
                       F.col("effective_total_usd").alias("usd"), no_rank)
    u = probes.unionByName(h)
    if ranks is not None:   # without a day, so before all others of the key
        u = u.unionByName(ranks.select(*key, F.lit(None).cast("date").alias("d"), F.lit(-1).alias("kind"),
                                       F.lit(None).cast("decimal(12,2)").alias("usd"), F.col("rk").cast("int").alias("rk")))
    # history rows of the same day sort after the probe, so they are not "before"
    w = Window.partitionBy(*key).orderBy("d", "kind").rowsBetween(Window.unboundedPreceding, 0)
    from_d = F.when(F.col("kind") == 1, F.col("d"))
    return (u.select(*key, "d", "kind", F.last("usd", ignorenulls=True).over(w).alias("ref_usd"),
                     F.last(from_d, ignorenulls=True).over(w).alias("ref_date"), F.max("rk").over(w).alias("rk"))
             .filter(F.col("kind") == 0)
             .select(*key, F.col("d").alias("crawl_date"), "ref_usd", "ref_date", "rk"))


def day_context(offers: DataFrame, history: DataFrame, key=("product_model_id", "partner_id", "country_code", "payment_type")) -> DataFrame:
    """:func:`price_context` with the partner's rank in its market: what TEMPORAL and
    CROSS_PARTNER look up of a key on a day, for callers that store it for both."""
    _, ranks = market_middles(history.filter(F.col("valid_to_date").isNull()))
    return price_context(offers, history, list(key), ranks)


def temporal_deviation(usd: Column, ref: Column) -> Column:
    return F.abs(cents(usd) - cents(ref)).cast("double") / cents(ref).cast("double")


def detect_temporal(offers: DataFrame, history: DataFrame, profile: str = "live",
                    key=("product_model_id", "partner_id", "country_code", "payment_type"), days: DataFrame | None = None) -> DataFrame:
    """ANO-2: vs the most recent history price of the same key that started
    strictly before the crawl day. ``days`` is the stored :func:`day_context` of these
    offers and this history."""
    key = list(key)
    ref = (price_context(offers, history, key) if days is None else days).filter(F.col("ref_usd") != 0).drop("rk")
    j = offers.join(ref, key + ["crawl_date"])
    return _finish(j, "TEMPORAL", temporal_deviation(F.col("effective_total_usd"), F.col("ref_usd")), profile)


# ---------------------------------------------------------------------------
# CROSS_PARTNER
# ---------------------------------------------------------------------------

def market_middles(current_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per market (model, country, payment): partner count n and the values at
    ranks lo..lo+2 where lo = (n-2) div 2 + 1; plus each partner's rank.

    Those three values, as an array, give the median of the market with any one
    partner left out, and of the whole market.
    """
    mk = ["product_model_id", "country_code", "payment_type"]
    w = Window.partitionBy(*mk).orderBy("effective_total_usd", "partner_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = current_rows.select(*mk, "partner_id", "effective_total_usd",
                            F.row_number().over(w).alias("rk"),
                            F.count(F.lit(1)).over(whole).alias("n"))
    lo = F.floor((F.col("n") - 2) / 2).cast("int") + 1
    r = r.withColumn("lo", lo)
    mid = r.groupBy(*mk).agg(
        F.first("n").alias("n"),
        F.array(*[F.max(F.when(F.col("rk") == F.col("lo") + i, F.col("effective_total_usd"))) for i in range(3)]).alias("v"))
    ranks = r.select(*mk, "partner_id", "rk")
    return mid, ranks


def peers(n: Column, rk: Column, middles: str) -> tuple[Column, Column]:
    """Number of peers and twice their median (cents), from the market's partner count,
    the own rank (NULL: not in it) and its three middle values."""
    lo = F.floor((n - 2) / 2).cast("int") + 1
    # peers m = n - 1 when self is present; positions are 1-based ranks
    m = F.when(rk.isNotNull(), n - 1).otherwise(n)
    k1 = F.floor((m - 1) / 2).cast("int") + 1
    k2 = F.floor(m / 2).cast("int") + 1

    def at(k):
        shifted = F.when(rk.isNotNull() & (k >= rk), k + 1).otherwise(k)
        return F.get(middles, (shifted - lo).cast("int"))

    return m, cents(at(k1)) + cents(at(k2))


def cross_deviation(usd: Column, pair: Column) -> Column:
    return F.abs(cents(usd) * 2 - pair).cast("double") / pair.cast("double")


def detect_cross_partner(offers: DataFrame, history: DataFrame, profile: str = "live", days: DataFrame | None = None) -> DataFrame:
    """ANO-3: vs the median of the other partners' current prices in the market;
    needs at least two partners. With ``days`` (as in :func:`detect_temporal`) the
    offers meet their rank by key and day; only rows without a day meet it by key."""
    mk = ["product_model_id", "country_code", "payment_type"]
    cur = history.filter(F.col("valid_to_date").isNull())
    mid, ranks = market_middles(cur)
    mid = cut_lineage(mid.filter(F.col("n") >= 2), name="markets")
    key = mk + ["partner_id"]
    if days is None:
        j = offers.join(ranks, key, "left")
    else:
        dated = F.col("crawl_date").isNotNull()
        j = (offers.filter(dated).join(days.select(*key, "crawl_date", "rk"), key + ["crawl_date"], "left")
                   .unionByName(offers.filter(~dated).join(ranks, key, "left")))
    j = j.join(mid, mk)
    m, pair = peers(F.col("n"), F.col("rk"), "v")
    j = j.withColumn("_pair", pair).withColumn("peer_count", m.cast("bigint"))
    j = j.filter((F.col("peer_count") >= 1) & (F.col("_pair") > 0))
    p = cross_deviation(F.col("effective_total_usd"), F.col("_pair"))
    out = _finish(j, "CROSS_PARTNER", p, profile)
    return (out.withColumn("peer_median", (F.col("_pair").cast("decimal(20,0)") * F.lit(Decimal("0.005")))
                           .cast("decimal(13,3)"))
               .drop("_pair", "n", "v", "rk"))


# ---------------------------------------------------------------------------
# SKU_VARIANCE
# ---------------------------------------------------------------------------

def variance_context(offers: DataFrame, g: list[str], min_n: int = 3) -> DataFrame:
    """Count, sum and stddev (cents) of every group of at least ``min_n`` offers that vary."""
    c = cents("effective_total_usd")
    mom = offers.groupBy(*g).agg(
        F.count(F.lit(1)).alias("gn"),
        F.sum(c).cast("decimal(38,0)").alias("gs"),
        F.sum(c.cast("decimal(38,0)") * c).alias("gss"))
    return mom.filter(F.col("gn") >= min_n).withColumn("gstd_c", F.sqrt(
        (F.col("gn").cast("decimal(38,0)") * F.col("gss") - F.col("gs") * F.col("gs")).cast("double")
        / (F.col("gn") * (F.col("gn") - 1)).cast("double"))).filter(F.col("gstd_c") > 0)


def variance_z(c: Column, n: Column, s: Column, std_c: Column) -> Column:
    return F.abs(c.cast("decimal(38,0)") * n - s).cast("double") / n.cast("double") / std_c


def detect_sku_variance(offers: DataFrame, group_cols=None, min_n: int = 3,
                        z_bars=config.Z_BARS) -> DataFrame:
    """ANO-4: within-batch z-score per group (default: model, partner, country,
    payment, crawl day); n >= min_n and sample stddev > 0."""
    g = list(group_cols or ["product_model_id", "partner_id", "country_code",
                            "payment_type", "crawl_date"])
    c = cents("effective_total_usd")
    j = offers.join(cut_lineage(variance_context(offers, g, min_n), name="moments"), g)
    z = variance_z(c, F.col("gn"), F.col("gs"), F.col("gstd_c"))
    out = (j.withColumn("_z", z).withColumn("severity", z_severity(F.col("_z"), z_bars))
             .filter(F.col("severity").isNotNull())
             .withColumn("anomaly_type", F.lit("SKU_VARIANCE"))
             .withColumn("signal_score", F.round(F.least(F.col("_z") / 10, F.lit(1.0)), 3))
             .withColumn("observed_price_usd", F.col("effective_total_usd"))
             .withColumn("group_size", F.col("gn").cast("bigint"))
             .withColumn("group_mean", (_round_half_up_div(F.col("gs"), F.col("gn")) / 100)
                         .cast("decimal(12,2)"))
             .withColumn("group_stddev", F.round(F.col("gstd_c") / 100, 2))
             .withColumn("z_score", F.round(F.col("_z"), 6)))
    return out.drop("_z", "gn", "gs", "gss", "gstd_c")


# ---------------------------------------------------------------------------
# Orchestration and bookkeeping
# ---------------------------------------------------------------------------

ANOMALY_COLS = ["offer_id", "anomaly_type", "severity", "signal_score", "observed_price_usd"]


#: what :func:`detect` reads of history
HISTORY_COLS = ["product_model_id", "partner_id", "country_code", "payment_type", "valid_from_date", "valid_to_date", "effective_total_usd"]


def detect(offers: DataFrame, history: DataFrame, profile: str = "live",
           min_severity: str = "LOW", models=None, sku_group=None, keep=()) -> DataFrame:
    """ANO-6: all four detectors, optional model list and minimum severity; ``keep``
    names further offer columns to return.

    The rows of the four detectors, but offers are shuffled once instead of in each:
    window statistics, market middles and group moments are written as tables of
    their own, so that the planner knows their size, and what needs the offer's own
    key (previous price, own rank) comes from one window on (key, day). Both inputs
    are read several times, so they should be stored. History has one open row per
    key (as all functions that build it leave it).
    """
    if models is not None:
        offers = offers.filter(F.col("product_model_id").isin(list(models)))
    key = ["product_model_id", "partner_id", "country_code", "payment_type"]
    market = ["product_model_id", "country_code", "payment_type"]
    g = list(sku_group or [*key, "crawl_date"])
    extra = [c for c in [*key, "crawl_ts_utc", "source_batch_id"] if c in offers.columns]
    extra += [c for c in keep if c not in extra]
    o = offers.select("offer_id", "effective_total_usd", *dict.fromkeys([*extra, *key, "crawl_date", *g]))
    stats = cut_lineage(statistical_context(offers, history).filter(F.col("s") > 0).select(
        *[F.col(c).alias(f"_s_{c}") for c in ("product_model_id", "country_code", "crawl_date", "n", "s")]), name="statistics")
    mid, ranks = market_middles(history.filter(F.col("valid_to_date").isNull()))
    mid = cut_lineage(mid.filter(F.col("n") >= 2).select(*[F.col(c).alias(f"_m_{c}") for c in [*market, "n", "v"]]), name="markets")
    mom = variance_context(offers, g)
    mom = cut_lineage(mom.select(*[F.col(c).alias(f"_g_{c}") for c in [*g, "gn", "gs", "gstd_c"]]), name="moments")
    ctx = price_context(offers, history, key, ranks)
    ctx = ctx.select(*[F.col(c).alias(f"_k_{c}") for c in ctx.columns])

    def same(cols, prefix):
        on = F.lit(True)
        for c in cols:
            on = on & (F.col(c) == F.col(f"{prefix}{c}"))
        return on

    # a row without a day has no previous price, but a rank
    j = (o.join(ctx, same(key, "_k_") & F.col("crawl_date").eqNullSafe(F.col("_k_crawl_date")), "left")
          .join(stats, same(["product_model_id", "country_code", "crawl_date"], "_s_"), "left")
          .join(mid, same(market, "_m_"), "left")
          .join(mom, same(g, "_g_"), "left"))
    usd = F.col("effective_total_usd")
    m, pair = peers(F.col("_m_n"), F.col("_k_rk"), "_m_v")
    j = j.select(*o.columns, statistical_deviation(usd, F.col("_s_n"), F.col("_s_s")).alias("_stat"),
                 F.when(F.col("_k_ref_usd") != 0, temporal_deviation(usd, F.col("_k_ref_usd"))).alias("_temp"),
                 F.when(m >= 1, pair).alias("_pair"),
                 variance_z(cents(usd), F.col("_g_gn"), F.col("_g_gs"), F.col("_g_gstd_c")).alias("_z"))
    j = j.withColumn("_cross", F.when(F.col("_pair") > 0, cross_deviation(usd, F.col("_pair"))))
    found = []
    for kind, p in (("STATISTICAL", "_stat"), ("TEMPORAL", "_temp"), ("CROSS_PARTNER", "_cross")):
        found += [F.lit(kind), severity(F.col(p), profile), _score(F.col(p))]
    found += [F.lit("SKU_VARIANCE"), z_severity(F.col("_z")), _score(F.col("_z") / 10)]
    u = j.select("offer_id", *extra, usd.alias("observed_price_usd"),
                 F.stack(F.lit(4), *found).alias("anomaly_type", "severity", "signal_score"))
    rank = F.when(F.col("severity") == "HIGH", 3).when(F.col("severity") == "MEDIUM", 2).otherwise(1)
    u = u.filter(F.col("severity").isNotNull() & (rank >= config.SEVERITY_RANK[min_severity]))
    return u.select(*ANOMALY_COLS, *extra)


def anomaly_counts(anoms: DataFrame) -> DataFrame:
    """ANO-7: counts by type and severity (all three severities always present)."""
    return (anoms.groupBy("anomaly_type")
            .pivot("severity", ["HIGH", "MEDIUM", "LOW"]).count()
            .na.fill(0)
            .select("anomaly_type", *[F.col(s).cast("bigint").alias(f"n_{s.lower()}")
                                      for s in ("HIGH", "MEDIUM", "LOW")]))


def upsert_anomalies(store: DataFrame, new: DataFrame, now_col: Column | None = None) -> DataFrame:
    """ANO-8: merge on (offer_id, anomaly_type): measures from the new run,
    review fields (status, assignee, notes) kept from the store."""
    key = ["offer_id", "anomaly_type"]
    measures = ["severity", "signal_score", "observed_price_usd"]
    review = ["status", "assignee", "resolution_notes"]
    s = store.select(*key, *[F.col(c).alias(f"s_{c}") for c in measures + review + ["detected_at"]])
    n = new.select(*key, *[F.col(c).alias(f"n_{c}") for c in measures],
                   (now_col if now_col is not None else F.col("detected_at")).alias("n_detected_at"))
    j = s.join(n, key, "full")
    hit = F.col("n_severity").isNotNull()
    cols = [F.when(hit, F.col(f"n_{c}")).otherwise(F.col(f"s_{c}")).alias(c) for c in measures]
    cols += [F.coalesce(F.col(f"s_{c}"), F.lit("NEW") if c == "status" else F.lit(None))
              .alias(c) for c in review]
    cols.append(F.when(hit, F.col("n_detected_at")).otherwise(F.col("s_detected_at")).alias("detected_at"))
    return j.select(*key, *cols)


def with_snapshots(anoms: DataFrame, profile: str = "live") -> DataFrame:
    """ANO-9: freeze the bars used and the baseline with each anomaly. SKU_VARIANCE
    is graded by z-scores, so its own bars are frozen."""
    z = F.col("anomaly_type") == "SKU_VARIANCE"
    bars = [F.when(z, F.lit(float(b))).otherwise(F.lit(float(a))) for a, b in zip(config.SEVERITY_PROFILES[profile], config.Z_BARS)]
    thr = F.struct(F.when(z, F.lit("z")).otherwise(F.lit(profile)).alias("profile"), *[b.alias(n) for b, n in zip(bars, ("low", "medium", "high"))])
    cols = [c for c in ("window_days", "sample_size", "baseline_mean", "baseline_stddev")
            if c in anoms.columns]
    out = anoms.withColumn("threshold_snapshot", thr)
    if cols:
        out = out.withColumn("baseline_snapshot", F.struct(*cols))
    return out


def explain_anomalies(anoms: DataFrame) -> DataFrame:
    """ANO-10: explanation text per anomaly type (deviation in percent, one decimal)."""
    have = set(anoms.columns)

    def col(c):
        return F.col(c) if c in have else F.lit(None)

    pct = F.round(col("deviation") * 100, 1).cast("string")
    t = F.col("anomaly_type")
    money = lambda c: F.format_number(F.round(col(c), 2), 2)
    text = (F.when(t == "STATISTICAL", F.concat(pct, F.lit("% deviation from 30-day mean ($"),
                                                money("baseline_mean"), F.lit(")")))
             .when(t == "TEMPORAL", F.concat(pct, F.lit("% jump from last valid price ($"), money("ref_usd"),
                                             F.lit(" on "), col("ref_date").cast("string"), F.lit(")")))
             .when(t == "CROSS_PARTNER", F.concat(pct, F.lit("% off the "), col("peer_count").cast("string"),
                                                  F.lit("-peer median ($"), money("peer_median"), F.lit(")")))
             .when(t == "SKU_VARIANCE", F.concat(F.round(col("z_score"), 1).cast("string"),
                                                 F.lit("σ outlier within "), col("group_size").cast("string"),
                                                 F.lit("-observation same-model group (mean $"), money("group_mean"),
                                                 F.lit(", σ $"), money("group_stddev"), F.lit(")"))))
    return anoms.withColumn("explanation", text)


def top_anomalies(anoms: DataFrame, as_of=None, n: int = 20, days: int | None = 30,
                  ts_col: str = "crawl_ts_utc") -> DataFrame:
    """ANO-18: the n most severe anomalies of the ``days`` before ``as_of``
    (default: the newest crawl among them; ``days=None``: of all time), by
    severity, score, then time.

    The default as-of is a scalar subquery, evaluated once; the cut itself is
    a top-n sort (each task keeps its own n before the final merge).
    """
    rank = F.when(F.col("severity") == "HIGH", 3).when(F.col("severity") == "MEDIUM", 2).otherwise(1)
    recent = anoms
    if days is not None:
        a = F.lit(as_of).cast("timestamp") if as_of is not None else anoms.select(F.max(ts_col)).scalar()
        recent = anoms.filter(F.col(ts_col) >= a - F.expr(f"INTERVAL {int(days)} DAYS"))
    return recent.orderBy(rank.desc(), F.desc("signal_score"), F.desc(ts_col), F.desc("offer_id"),
                          F.desc("anomaly_type")).limit(n)


def anomaly_series(anoms: DataFrame, history: DataFrame, days: int = 30,
                   key=("product_model_id", "partner_id", "country_code", "payment_type")) -> DataFrame:
    """ANO-11: chart rows for STATISTICAL anomalies: the key's history prices that
    started in the ``days`` before the crawl day, the anomaly point itself, and
    the band mean ± 1σ (floored at 0). An equi-join on the key, then a filter on
    the day: bounded by one key's history per anomaly."""
    key = list(key)
    a = anoms.filter(F.col("anomaly_type") == "STATISTICAL").select(
        "offer_id", *key, F.to_date("crawl_ts_utc").alias("_d"), "observed_price_usd",
        "baseline_mean", "baseline_stddev")
    band_lo = F.greatest(F.lit(0.0), F.col("baseline_mean").cast("double") - F.col("baseline_stddev"))
    band_hi = F.col("baseline_mean").cast("double") + F.col("baseline_stddev")
    h = history.select(*key, "valid_from_date", "effective_total_usd")
    pts = (a.join(h, key)
            .filter((F.col("valid_from_date") >= F.date_sub("_d", days)) & (F.col("valid_from_date") <= F.col("_d")))
            .select("offer_id", F.col("valid_from_date").alias("point_date"),
                    F.col("effective_total_usd").alias("price_usd"), F.lit(False).alias("is_anomaly"),
                    F.round(band_lo, 2).alias("band_lower"), F.round(band_hi, 2).alias("band_upper")))
    me = a.select("offer_id", F.col("_d").alias("point_date"), F.col("observed_price_usd").alias("price_usd"),
                  F.lit(True).alias("is_anomaly"), F.round(band_lo, 2).alias("band_lower"),
                  F.round(band_hi, 2).alias("band_upper"))
    return pts.unionByName(me)


def baseline_illustration(fact: DataFrame, bad: DataFrame,
                          key=("product_model_id", "partner_id", "country_code", "payment_type")) -> DataFrame:
    """ANO-12: the group with n >= 3 and the largest price stddev (non-zero first,
    then n, then key), excluding offers flagged DQ_PRICE_001; its daily average
    prices and the band mean ± σ of those averages (floored at 0)."""
    key = list(key)
    flagged = bad.filter(F.col("rule_id") == "DQ_PRICE_001").select("offer_id")
    clean = fact.join(flagged, "offer_id", "left_anti")
    c = cents("effective_total_usd")
    g = clean.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum(c).cast("decimal(38,0)").alias("s"),
                                F.sum(c.cast("decimal(38,0)") * c).alias("ss"))
    g = g.filter(F.col("n") >= 3).withColumn(
        "var_c", ((F.col("n").cast("decimal(38,0)") * F.col("ss") - F.col("s") * F.col("s")).cast("double")
                  / (F.col("n") * (F.col("n") - 1)).cast("double")))
    best = g.orderBy((F.col("var_c") > 0).desc(), F.desc("var_c"), F.desc("n"), *key).limit(1).select(*key)
    daily = (clean.join(best, key)
                  .groupBy(F.to_date("crawl_ts_utc").alias("series_date"))
                  .agg(F.count(F.lit(1)).alias("_k"), F.sum(c).alias("_s")))
    daily = daily.withColumn("price_usd", (F.floor((F.col("_s") * 2 + F.col("_k")) / (F.col("_k") * 2)) / 100)
                             .cast("decimal(12,2)")).drop("_k", "_s")
    pc = cents("price_usd")
    m = daily.agg(F.count(F.lit(1)).alias("n"), F.sum(pc).cast("decimal(38,0)").alias("s"),
                  F.sum(pc.cast("decimal(38,0)") * pc).alias("ss"))
    st = m.select(F.struct("n", "s", "ss").alias("st")).scalar()   # one subquery, reused
    n, s, ss = st["n"], st["s"], st["ss"]
    mean_c = s.cast("double") / n
    std_c = F.when(n > 1, F.sqrt((n.cast("decimal(38,0)") * ss - s * s).cast("double")
                                 / (n * (n - 1)).cast("double"))).otherwise(F.lit(0.0))
    return daily.select("series_date", "price_usd",
                        F.round(mean_c / 100, 2).alias("band_mean"),
                        F.round(F.greatest(F.lit(0.0), (mean_c - std_c) / 100), 2).alias("band_lower"),
                        F.round((mean_c + std_c) / 100, 2).alias("band_upper"))
