"""Path A from CSV files to published tables; sinks that keep other batches and runs."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from pricelens.operators import context as CX
from pricelens.operators import harmonise as HM
from pricelens.operators import history as H
from pricelens.operators import quality as Q
from pricelens.operators import review as RV
from pricelens.plans import pipeline as P
from pricelens.sources import feeds as FD
from pricelens.sources import sinks as SK
from pricelens.sources import store as ST

HEAD = "CRAWL_TS,COUNTRY_VAL,PARTNER,PRODUCT_NAME_VAL,FULL PRICE,MONTHLY_INSTALMENT_AMT,INSTALMENT_MONTH,NOTE\n"


def feed(tmp_path, name, rows):
    p = tmp_path / name
    p.write_text(HEAD + "".join(rows))
    return str(p)


@pytest.fixture
def world(spark, tmp_path):
    reg = tmp_path / "registry.csv"
    reg.write_text("Product Category,Product Short Description,Product Long Description,Product ID,,\n"
                   "iPhone,iPhone 17 Pro 256GB,IPHONE 17 PRO 256GB BLUE,100,,\niPhone,iPhone 17 Pro 256GB,IPHONE 17 PRO 256GB SILVER,101,,\n"
                   "iPad,iPad Air 11 128GB,IPAD AIR 11 INCH 128GB,200,,\n,missing category,X,300,,\niPad,,no short text,301,,\n")
    registry = HM.build_registry(FD.read_registry(spark, str(reg)))
    models = registry.select("model_key", F.col("model_key").alias("product_model_id"), F.col("entry_category").alias("category_code"))
    ctx = P.Context(
        countries=spark.createDataFrame([("AU", "AUD"), ("NZ", "NZD")], "country_code string, currency_code string"),
        partners=spark.createDataFrame([(1, "PA", "AU"), (2, "PB", "NZ")], "partner_id long, partner_code string, country_code string"),
        rates=spark.createDataFrame([("AUD", "USD", D("0.65"), dt.date(2025, 9, 1)), ("NZD", "USD", D("0.60"), dt.date(2025, 9, 1))],
                                    "from_currency_code string, to_currency_code string, rate decimal(16,8), effective_date date"),
        bands=Q.price_bands(spark), catalog=Q.catalog(spark), run_id="run-1", run_ts="2025-11-01 00:00:00")
    return registry, models, ctx


def test_feeds_to_published_tables(spark, tmp_path, world):
    registry, models, ctx = world
    day = lambda i, price: f"2025-10-{i:02d}T10:00,Australia,x,iP 17 Pro 256GB,{price},,,\n"  # noqa: E731  no seconds
    a = feed(tmp_path, "a.csv", [day(1, 1999), day(2, 1999), day(3, 2199), 'bad,Atlantis,x,,abc,,,"a note\nover two lines"\n', "2025-10-04T09:00:00Z,Australia,x,iPad Air 11 128GB,,50.00,24,ok\n"])
    b = feed(tmp_path, "b.csv", ["2025-10-02T08:00:00Z,New Zealand,x,iPhone 17 Pro 256GB,2300,,,\n"])
    empty = feed(tmp_path, "c.csv", ["bad,Atlantis,x,,,,,\n"])
    store = ST.Store(spark, str(tmp_path / "store"))
    P.run_feeds(spark, [(a, "PA", "b1"), (b, "PB", "b2"), (empty, "PB", "b3")], ctx, registry, models, store)
    facts = store.read("facts")
    assert facts.groupBy("source_batch_id").count().orderBy("source_batch_id").collect() == [("b1", 4), ("b2", 1)]
    assert {str(r["crawl_month"])[:7] for r in facts.collect()} == {"2025-10"}
    hist = store.read("history")
    assert hist.filter("partner_id = 1 and payment_type = 'FULL'").count() == 2
    rules = store.read("dq_output")
    # every batch has a row for every active rule, also where nothing reached the stage
    assert rules.groupBy("source_batch_id").count().orderBy("source_batch_id").collect() == [("b1", 13), ("b2", 13), ("b3", 13)]
    nothing = rules.filter("source_batch_id = 'b3' and target_stage = 'SEMANTIC'").collect()
    assert nothing and all(r["total_records"] == 0 and r["pass_rate"] == 1.0 for r in nothing)
    bad = store.read("dq_bad_records").filter("source_batch_id = 'b1'").collect()
    assert {r["rule_id"] for r in bad} >= {"DQ_NULL_001", "DQ_NULL_004", "DQ_FMT_001"}
    assert {r["raw_payload"]["NOTE"] for r in bad if r["rule_id"] == "DQ_FMT_001"} == {"a note\nover two lines"}
    loads = {r["source_batch_id"]: (r["total_records"], r["loaded_records"]) for r in store.read("summary").collect()}
    assert loads == {"b1": (5, 4), "b2": (1, 1), "b3": (1, 0)}
    # a second run of one batch keeps the first run's rule output and the other batches' facts
    ctx.run_id, ctx.run_ts = "run-2", "2025-11-02 00:00:00"
    P.run_feeds(spark, [(b, "PB", "b2")], ctx, registry, models, store)
    assert store.read("facts").count() == 5
    rules = store.read("dq_output")
    assert rules.filter("source_batch_id = 'b2'").select("run_id").distinct().count() == 2
    latest = Q.latest_rule_results(rules).collect()
    assert len(latest) == 13 and {(r["run_id"], r["source_batch_id"]) for r in latest} == {("run-2", "b2")}
    assert sorted(map(str, store.read("history").select(*hist.columns).collect())) == sorted(map(str, hist.collect()))
    # the first batch comes again without its last day: facts, months and history go with it
    shorter = feed(tmp_path, "a2.csv", [day(1, 1999), day(2, 1999)])
    ctx.run_id, ctx.run_ts = "run-3", "2025-11-03 00:00:00"
    P.run_feeds(spark, [(shorter, "PA", "b1")], ctx, registry, models, store)
    assert store.read("facts").groupBy("source_batch_id").count().orderBy("source_batch_id").collect() == [("b1", 2), ("b2", 1)]
    assert store.read("history").filter("partner_id = 1").count() == 1 and store.read("history").filter("partner_id = 2").count() == 1
    # replay from the payload, under a country map that knows Atlantis
    ctx.run_id, ctx.run_ts, ctx.mapping = "run-4", "2025-11-04 00:00:00", {"Atlantis": "NZ", "Australia": "AU", "New Zealand": "NZ"}
    P.replay("b3", ctx, store, registry, models)
    rules = store.read("dq_output").filter("source_batch_id = 'b3' and run_id = 'run-4'")
    assert rules.count() == 13 and rules.filter("rule_id = 'DQ_FMT_001'").first()["failed_records"] == 0
    assert store.read("staging").filter("source_batch_id = 'b3'").first()["country_code"] == "NZ"
    with pytest.raises(KeyError):
        P.replay("b9", ctx, store, registry, models)


def test_streamed_chunks_equal_the_batch_after_a_restart(spark, tmp_path, world, monkeypatch):
    from pricelens.streaming.feeds import stream_pipeline
    registry, models, ctx = world
    ctx.run_ts = "2025-11-01 00:00:00"
    src = tmp_path / "src"
    src.mkdir()
    row = lambda d, p, price: f'2025-10-{d:02d}T10:00,{"Australia" if p == "PA" else "New Zealand"},{p},iP 17 Pro 256GB,{price},,,"n\n{d}"\n'
    for i, rows in enumerate(([row(1, "PA", 1999), row(2, "PB", 2300)], [row(3, "PA", 2199), "bad,Atlantis,PA,,,,,\n", row(6, "PB", 2100)])):
        feed(src, f"{i}.csv", rows)
        import os
        os.utime(src / f"{i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))  # oldest first
    store, publish, seen = ST.Store(spark, str(tmp_path / "store")), ST.Store.publish, []

    def dies(self, outputs, batches, run_id, *a, **k):
        seen.append(run_id)
        if len(seen) == 2:  # in the middle of the second chunk: data are written, nothing is committed
            for name, df in outputs.items():
                self.write(name, df, run_id)
            raise RuntimeError("killed")
        version = publish(self, outputs, batches, run_id, *a, **k)
        if len(seen) == 1:  # committed, but the stream does not hear of it
            raise RuntimeError("killed after its commit")
        return version

    monkeypatch.setattr(ST.Store, "publish", dies)
    for _ in range(2):
        with pytest.raises(Exception):
            stream_pipeline(spark, str(src), ctx, registry, models, store, F.col("PARTNER"), max_files=1, name="f")
    stream_pipeline(spark, str(src), ctx, registry, models, store, F.col("PARTNER"), max_files=1, name="f")
    assert seen == ["f-00000000", "f-00000001", "f-00000001"] and store.commit().version == 2
    monkeypatch.setattr(ST.Store, "publish", publish)
    whole = ST.Store(spark, str(tmp_path / "batch"))
    ctx.run_id = "all"
    P.run_feeds(spark, [([str(src / f"{i}.csv")], F.col("PARTNER"), f"f-{i:08d}") for i in range(2)], ctx, registry, models, whole)
    for table, off in (("facts", []), ("staging", []), ("history", []), ("summary", ["anomalies_detected"]), ("dq_bad_records", ["run_id"])):
        cols = sorted(set(whole.read(table).columns) - set(off) - {"raw_payload"})
        assert sorted(map(str, store.read(table).select(*cols).collect())) == sorted(map(str, whole.read(table).select(*cols).collect())), table
    assert store.read("facts").count() == 4


def offers(spark, rows):
    return spark.createDataFrame([(f"o{i}", "m", 1, "AU", "FULL", "USD", D(v), D(v), ts, ts.date(), b) for i, (v, ts, b) in enumerate(rows)],
                                 "offer_id string, product_model_id string, partner_id long, country_code string, payment_type string, currency_code string, "
                                 "effective_total_local decimal(12,2), effective_total_usd decimal(12,2), crawl_ts_utc timestamp, crawl_date date, source_batch_id string")


def test_several_batches_merge_like_one_by_one(spark):
    t = lambda d: dt.datetime(2025, 1, d)
    first = P.merge_history(None, offers(spark, [(100, t(1), "a")]))
    both = offers(spark, [(110, t(2), "b"), (120, t(3), "c")])
    rows = P.merge_history(first, both).orderBy("valid_from_date").collect()
    assert [float(r["effective_total_usd"]) for r in rows] == [100, 110, 120] and rows[-1]["valid_to_date"] is None


def test_a_fold_of_many_batches_equals_them_in_turn(spark):
    import random
    r = random.Random(8)
    t = lambda d: dt.datetime(2025, 1, 1) + dt.timedelta(days=d)
    cols = H.KEY + H.VALUE + ["valid_from_date", "valid_to_date"]
    for _ in range(2):
        rows = [(r.choice((100, 110, 120)), t(r.randint(0, 25)), f"b{r.randint(0, 6)}") for _ in range(60)]
        all_ = offers(spark, rows).withColumn("partner_id", F.pmod(F.expr("cast(substr(offer_id, 2) as bigint)"), F.lit(4)))
        first = H.scd2_rebuild(all_.where("source_batch_id = 'b0'")) if r.random() < .7 else H.scd2_rebuild(all_.limit(0))
        turn = first
        order = sorted({b for _, _, b in rows} - {"b0"}, key=lambda b: (min(x for _, x, c in rows if c == b), b))
        for b in order:
            turn = H.scd2_apply(turn, all_.where(F.col("source_batch_id") == b))
            turn = spark.createDataFrame(turn.collect(), turn.schema)
        fold = H.scd2_fold(first, all_.where("source_batch_id != 'b0'"))
        assert sorted(map(str, fold.select(*cols).collect())) == sorted(map(str, turn.select(*cols).collect()))


def test_fact_store_keeps_other_batches(spark, tmp_path):
    path, t = str(tmp_path / "f"), dt.datetime(2025, 1, 5)
    SK.write_fact(offers(spark, [(1, t, "b1"), (2, t, "b1")]), path)
    SK.write_fact(offers(spark, [(3, t, "b2")]), path)
    SK.write_fact(offers(spark, [(4, t, "b1")]), path)
    assert sorted((r["source_batch_id"], float(r["effective_total_usd"])) for r in spark.read.parquet(path).collect()) == [("b1", 4), ("b2", 3)]


def test_drop_batch_and_its_footprint(spark):
    rows = spark.createDataFrame([("b1", "o1"), ("b2", "o2"), (None, "o3")], "source_batch_id string, offer_id string")
    assert sorted(r["offer_id"] for r in SK.drop_batch(rows, "b1").collect()) == ["o2", "o3"]
    left = SK.drop_batch_footprint({"facts": rows, "anomalies": rows.select("offer_id"), "summary": rows}, "b1")
    assert {n: d.count() for n, d in left.items()} == {"facts": 2, "anomalies": 2, "summary": 2}


def test_suppression_takes_only_events_that_apply(spark):
    anoms = spark.createDataFrame([("o1", dt.date(2025, 1, 2), "AU", "X"), ("o2", dt.date(2025, 1, 2), "NZ", None), ("o3", dt.date(2025, 3, 1), "AU", "X")],
                                  "offer_id string, crawl_date date, country_code string, category_code string")
    ev = spark.createDataFrame([(1, dt.date(2025, 1, 1), "US", None, 3, 0.1), (2, dt.date(2025, 1, 3), "AU", "X", 3, 0.4), (3, dt.date(2025, 1, 2), None, None, 1, 0.5), (4, dt.date(2025, 1, 2), "AU", None, 1, 0.4)],
                               "event_id long, event_date date, affected_country_code string, affected_category_code string, suppression_window_days int, suppression_factor double")
    got = {r["offer_id"]: (r["suppression_factor"], r["suppressing_event_id"], r["suppression_applied"]) for r in CX.suppress_events(anoms, ev).collect()}
    assert got == {"o1": (0.4, 2, True), "o2": (0.5, 3, True), "o3": (1.0, None, False)}


def test_one_resolution_per_record(spark):
    bad = spark.createDataFrame([("o1", "r1", "NEW"), ("o2", "r1", "NEW")], "offer_id string, rule_id string, status string")
    acts = spark.createDataFrame([("o1", "r1", "IGNORED", "a", dt.datetime(2025, 1, 1)), ("o1", "r1", "RESOLVED", "b", dt.datetime(2025, 1, 2)),
                                  ("o2", "r1", "DELETE", "c", dt.datetime(2025, 1, 1)), ("o9", "r1", "RESOLVED", "d", dt.datetime(2025, 1, 1))],
                                 "offer_id string, rule_id string, action string, notes string, resolved_at timestamp")
    out, unknown = RV.apply_resolutions(bad, acts)
    assert sorted((r["offer_id"], r["status"], r["resolution_notes"]) for r in out.collect()) == [("o1", "RESOLVED", "b"), ("o2", "NEW", None)]
    assert [r["offer_id"] for r in unknown.collect()] == ["o9"]


def test_empty_batch_has_rule_rows(spark):
    stg = spark.createDataFrame([], "source_batch_id string, crawl_ts_utc timestamp, country_name string, country_code string, raw_product_name string, payment_type string, "
                                "full_price decimal(12,2), monthly_amount decimal(12,2), instalment_months int, offer_id string")
    out, bad = Q.run_stage(stg, "INGEST", Q.catalog(spark), ["offer_id"], batches=spark.createDataFrame([("b0",)], "source_batch_id string"), run_id="r", run_ts="2025-01-01 00:00:00")
    rows = out.collect()
    assert len(rows) == 8 and all(r["total_records"] == 0 and r["pass_rate"] == 1.0 and r["run_id"] == "r" for r in rows) and bad.count() == 0
