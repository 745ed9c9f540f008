"""Config-driven context and calibration (ANO-13..17, CAL-1..4).

Config tables (thresholds, categories, events, alert policies) are small
dimensions by nature; they are broadcast explicitly only where their size is
fixed by definition, otherwise joined plainly and left to the planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens import config
from pricelens.session import cut_lineage


def match_wildcards(keys: DataFrame, rules: DataFrame, dims: dict[str, str], on: dict[str, str] | None = None) -> DataFrame:
    """Every pair of a key and a rule that agree in all of ``dims`` (key column to
    rule column) and are equal in ``on``; a NULL in a rule agrees with anything, a
    NULL in a key with such rules only. Column names must not clash.

    Rules are filed under the set of columns that they name. A key looks itself up
    once in each set that rules have, by its values in that set's columns, so this
    is one equi-join without nested loops; keys should be distinct.
    """
    bits = [(1 << i, k, r) for i, (k, r) in enumerate(dims.items())]
    filed = rules.withColumn("_names", sum((F.when(F.col(r).isNotNull(), b).otherwise(0) for b, _, r in bits), F.lit(0)))
    seek = keys.withColumn("_set", F.explode(F.sequence(F.lit(0), F.lit((1 << len(bits)) - 1))))
    match = F.col("_set") == F.col("_names")
    for b, k, r in bits:
        named = F.col("_set").bitwiseAND(b) != 0
        seek = seek.filter(~named | F.col(k).isNotNull()).withColumn(f"_at_{k}", F.when(named, F.col(k)))
        match = match & F.col(f"_at_{k}").eqNullSafe(F.col(r))
    for k, r in (on or {}).items():
        match = match & (F.col(k) == F.col(r))
    return seek.join(filed, match).drop("_set", "_names", *[f"_at_{k}" for _, k, _ in bits])


def resolve_thresholds(cfg: DataFrame, keys: DataFrame) -> DataFrame:
    """ANO-13: most specific config value per (config_key, category, country).

    A row matches when its category/country equal the key's or are NULL;
    category match outranks country match, which outranks global; of equally
    specific rows the largest value counts. ``keys`` has category_code,
    country_code; ``cfg`` has config_key, config_value, category_code?, country_code?.
    """
    c = cfg.select("config_key", "config_value", F.col("category_code").alias("c_cat"),
                   F.col("country_code").alias("c_cty"))
    k = keys.select("category_code", "country_code").distinct()
    j = match_wildcards(k, c, {"category_code": "c_cat", "country_code": "c_cty"})
    spec = F.when(F.col("c_cat").isNotNull(), 2).otherwise(0) + F.when(F.col("c_cty").isNotNull(), 1).otherwise(0)
    best = j.groupBy("config_key", "category_code", "country_code").agg(F.max(F.struct(spec.alias("s"), "config_value")).alias("_b"))
    return best.select("config_key", "category_code", "country_code", "_b.config_value", F.col("_b.s").alias("specificity"))


def lifecycle_status(models: DataFrame, categories: DataFrame, as_of) -> DataFrame:
    """ANO-14: NEW (launched within 14 days), EOL (end date passed), LEGACY
    (launch + lifecycle − 3 months passed), else STABLE; NULL launch → STABLE."""
    a = F.lit(as_of).cast("date")
    m = models.join(categories.select("category_code", "lifecycle_months"), "category_code", "left")
    launch = F.col("launch_date")
    status = (F.when(launch.isNull(), "STABLE")
               .when(F.datediff(a, launch) < 14, "NEW")
               .when(F.col("eol_date").isNotNull() & (F.col("eol_date") < a), "EOL")
               .when(F.col("lifecycle_months").isNotNull()
                     & (F.add_months(launch, F.col("lifecycle_months") - 3) < a), "LEGACY")
               .otherwise("STABLE"))
    return m.withColumn("lifecycle_status", status)


def suppress_events(anoms: DataFrame, events: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """ANO-15: anomalies within ± window days of a market event that covers
    their country and category (NULL = all); the lowest factor wins.

    Events are expanded to one row per covered day (bounded by the event
    calendar), reduced to one per day and scope, and joined on the crawl day, so
    no range join is needed and an anomaly keeps one row. Of equal factors the
    smallest event id counts; events that do not cover an anomaly leave it as it is.

    ``asked`` has the (crawl_date, country_code, category_code) of all anomalies, maybe
    more, for callers that know them without computing the anomalies twice. The hits, a
    row per day and scope at most, are written once, so that the planner knows their size.
    """
    e = events.select(F.explode(F.sequence(F.date_sub("event_date", F.col("suppression_window_days")),
                                           F.date_add("event_date", F.col("suppression_window_days"))))
                      .alias("crawl_date"),
                      F.col("affected_country_code").alias("_cty"),
                      F.col("affected_category_code").alias("_cat"),
                      "suppression_factor", "event_id")
    # the best event of each (day, country or all, category or all): at most a
    # row per day and scope, however many events fall on a day
    best = e.groupBy("crawl_date", "_cty", "_cat").agg(F.min(F.struct("suppression_factor", "event_id")).alias("_b"))
    # the best event for each (day, country, category) that anomalies ask for
    asked = (anoms if asked is None else asked).select("crawl_date", "country_code", "category_code").distinct()
    hit = match_wildcards(asked, best.withColumnRenamed("crawl_date", "_day"), {"country_code": "_cty", "category_code": "_cat"},
                          {"crawl_date": "_day"})
    hit = hit.groupBy("crawl_date", "country_code", "category_code").agg(F.min("_b").alias("_b"))
    hit = cut_lineage(hit.select(*[F.col(c).alias(f"_h_{c}") for c in ("crawl_date", "country_code", "category_code")], "_b"), name="event-hits")
    on = [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in ("crawl_date", "country_code", "category_code")]
    out = anoms.join(hit, on, "left")
    return out.select(*anoms.columns, F.coalesce("_b.suppression_factor", F.lit(1.0)).alias("suppression_factor"),
                      F.col("_b.event_id").alias("suppressing_event_id"),
                      F.col("_b").isNotNull().alias("suppression_applied"))


def adjust_scores(anoms: DataFrame, profile: str = "config") -> DataFrame:
    """ANO-16: adjusted = signal × lifecycle × suppression ÷ category sensitivity,
    severity from the profile's bars."""
    low, med, high = config.SEVERITY_PROFILES[profile]
    adj = (F.col("signal_score") * F.coalesce(F.col("lifecycle_factor"), F.lit(1.0))
           * F.coalesce(F.col("suppression_factor"), F.lit(1.0))
           / F.coalesce(F.col("category_sensitivity"), F.lit(1.0)))
    sev = F.when(F.col("adjusted_score") >= high, "HIGH").when(F.col("adjusted_score") >= med, "MEDIUM") \
           .when(F.col("adjusted_score") >= low, "LOW")
    return anoms.withColumn("adjusted_score", F.round(adj, 3)).withColumn("adjusted_severity", sev)


def route_alerts(anoms: DataFrame, policies: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """ANO-17: every active policy an anomaly matches (severity ≥ minimum;
    type, country, category equal or NULL), with a quiet-hours flag.

    Policies are looked up for the distinct scopes of the anomalies (type,
    country, category, severity) only; the anomalies then join on their scope.
    ``asked`` has these scopes, maybe more, for callers that know them without
    computing the anomalies twice.
    """
    rank = F.create_map(*[x for k, v in config.SEVERITY_RANK.items() for x in (F.lit(k), F.lit(v))])
    scope = ["anomaly_type", "country_code", "category_code", "severity"]
    p = policies.filter(F.col("is_active")).select(
        "policy_id", *[F.col(c).alias(f"_p_{c}") for c in scope[:3]], "channel", "recipient", "quiet_start", "quiet_end",
        # one row for each severity that it accepts (at most 3)
        F.explode(F.sequence(rank[F.col("min_severity")], F.lit(3))).alias("_p_lvl"))
    asked = (anoms if asked is None else asked).select(*[F.col(c).alias(f"_h_{c}") for c in scope]).distinct().withColumn("_lvl", rank[F.col("_h_severity")])
    hit = match_wildcards(asked, p, {f"_h_{c}": f"_p_{c}" for c in scope[:3]}, {"_lvl": "_p_lvl"})
    hit = cut_lineage(hit, name="routes")
    j = anoms.join(hit, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in scope])
    minute = F.hour("crawl_ts_utc") * 60 + F.minute("crawl_ts_utc")
    qs, qe = F.col("quiet_start"), F.col("quiet_end")
    quiet = F.when(qs.isNull() | qe.isNull(), F.lit(False)) \
             .when(qs <= qe, (minute >= qs) & (minute < qe)) \
             .otherwise((minute >= qs) | (minute < qe))
    return j.withColumn("in_quiet_hours", quiet).drop("_lvl", "_p_lvl", *[f"_h_{c}" for c in scope], *[f"_p_{c}" for c in scope[:3]])


def _pcts(df: DataFrame, col: str, ps=(0.5, 0.9, 0.99)) -> DataFrame:
    """Exact percentiles by rank: distinct values with their counts are range-
    partitioned, the partitions' totals (a row each) give the rank at which each
    starts, and only the values at the wanted ranks reach the final aggregate."""
    v = df.groupBy(col).agg(F.count(F.lit(1)).alias("_k"))
    # written once, so that the partition numbers are the same wherever they are read
    v = cut_lineage(v.repartitionByRange(col).withColumn("_part", F.spark_partition_id()), name="ranges")
    per = v.groupBy("_part").agg(F.sum("_k").alias("_of"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_part", F.coalesce(F.sum("_of").over(before), F.lit(0)).alias("_before"), F.sum("_of").over(Window.partitionBy()).alias("_n"))
    r = v.join(per, "_part").withColumn("_end", F.col("_before") + F.sum("_k").over(Window.partitionBy("_part").orderBy(col)))

    def at(pos):
        return F.max(F.when((F.col("_end") - F.col("_k") <= pos) & (pos < F.col("_end")), F.col(col)))

    places = [F.lit(float(p)) * (F.col("_n") - 1) for p in ps]
    got = r.agg(*[at(F.floor(x)).alias(f"lo{i}") for i, x in enumerate(places)], *[at(F.ceil(x)).alias(f"hi{i}") for i, x in enumerate(places)],
                F.max("_n").alias("_n"))
    out = []
    for i, p in enumerate(ps):
        x = F.lit(float(p)) * (F.col("_n") - 1)
        between = (F.ceil(x) - x) * F.col(f"lo{i}") + (x - F.floor(x)) * F.col(f"hi{i}")
        out.append(F.round(F.when(F.ceil(x) == F.floor(x), F.col(f"lo{i}")).otherwise(between), 6).alias(f"p{int(round(p * 100)):02d}"))
    return got.select(*out, F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"))


def calibrate_cross_partner(history: DataFrame) -> DataFrame:
    """CAL-1: p50/p90/p99 of market spread (max − min) ÷ min over open prices,
    markets with at least two partners."""
    cur = history.filter(F.col("valid_to_date").isNull())
    m = cur.groupBy("product_model_id", "country_code", "payment_type").agg(
        F.countDistinct("partner_id").alias("k"),
        F.min("effective_total_usd").alias("mn"), F.max("effective_total_usd").alias("mx"))
    m = m.filter((F.col("k") >= 2) & (F.col("mn") > 0)).withColumn(
        "spread", (F.col("mx") - F.col("mn")).cast("double") / F.col("mn").cast("double"))
    return _pcts(m, "spread")


def calibrate_temporal(history: DataFrame,
                       key=("product_model_id", "partner_id", "country_code", "payment_type")) -> DataFrame:
    """CAL-2: p50/p90/p99 of relative change between successive prices of a key."""
    w = Window.partitionBy(*key).orderBy("valid_from_date")
    prev = F.lag("effective_total_usd").over(w)
    ch = history.select(F.abs(F.col("effective_total_usd") - prev).cast("double").alias("d"),
                        prev.cast("double").alias("p"))
    ch = ch.filter(F.col("p").isNotNull() & (F.col("p") > 0)).withColumn("change", F.col("d") / F.col("p"))
    return _pcts(ch, "change")


def calibrate_volatility(baselines: DataFrame, models_category: DataFrame) -> DataFrame:
    """CAL-3: per category, stddev of (stddev ÷ mean) of 30-day baselines; terciles
    LOW/MEDIUM/HIGH."""
    b = baselines.filter(F.col("window_days") == 30).join(models_category, "product_model_id")
    b = b.withColumn("cv", F.col("stddev_price_usd").cast("double") / F.col("mean_price_usd").cast("double"))
    per = b.groupBy("category_code").agg(F.round(F.stddev_samp("cv"), 6).alias("volatility"))
    w = Window.orderBy("volatility", "category_code")   # one row per category: tiny
    t = F.ntile(3).over(w)
    return per.withColumn("volatility_class", F.when(t == 1, "LOW").when(t == 2, "MEDIUM").otherwise("HIGH"))


def calibrate_severity(anoms: DataFrame) -> DataFrame:
    """CAL-4: severity bars from the score distribution: p80 → MEDIUM, p95 → HIGH."""
    v = anoms.groupBy("signal_score").agg(F.count(F.lit(1)).alias("_k"))   # ≤ 1001 values
    return v.agg(F.round(F.percentile("signal_score", F.lit(0.80), F.col("_k")), 6).alias("medium_bar"),
                 F.round(F.percentile("signal_score", F.lit(0.95), F.col("_k")), 6).alias("high_bar"),
                 F.sum("_k").cast("bigint").alias("n"))
