"""Steps that must not shuffle, gather or repeat more than their job needs."""

import datetime

from pyspark.sql import functions as F

from pricelens.operators import baselines as B
from pricelens.operators import harmonise as HM
from pricelens.operators import quality as Q
from pricelens.sources import csv_records as C


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_lines_are_not_shuffled_to_their_split(spark, tmp_path, capsys):
    for b in (1, 2):
        (tmp_path / f"batch={b}").mkdir()
        for f in "xyz":
            (tmp_path / f"batch={b}" / f"{f}.csv").write_text("A,B\n" + "".join(f"{f}{i},{b}\n" for i in range(b * 5)) * (f != "y"))
    df = C.read_csv(spark, str(tmp_path), folder="batch")
    assert "SortMergeJoin" not in plan(df, capsys)
    got = sorted((r["batch"], r["row_num"], r["A"]) for r in df.collect())
    assert got == [(str(b), i + 1 + (b * 5 if f == "z" else 0), f"{f}{i}") for b in (1, 2) for f in "xz" for i in range(b * 5)]


def offers(spark):
    t = datetime.datetime(2024, 1, 1, 3)
    rows = [(t + datetime.timedelta(hours=i % 30), i % 2, "AU", "m", "FULL", f"{10 + i}.50") for i in range(120)]
    return spark.createDataFrame(rows, "crawl_ts_utc timestamp, partner_id int, country_code string, product_model_id string, payment_type string, usd string").withColumn(
        "effective_total_usd", F.col("usd").cast("decimal(12,2)"))


def test_groups_are_dealt_before_they_are_aggregated(spark, capsys):
    o = offers(spark)
    daily, days = B.daily_prices(o), B.rezone_daily(B.hourly_prices(o), "America/New_York")
    # one deal for both aggregations of a day, one for hours and one for days, none merged again
    for df, deals in ((daily, 1), (days, 2)):
        text = plan(df, capsys)
        assert text.count("Exchange hashpartitioning") == deals and text.count("REPARTITION_BY_NUM") == deals
    assert daily.agg(F.sum("offer_count")).first()[0] == days.agg(F.sum("offer_count")).first()[0] == 120


def test_rows_meet_matches_and_models_in_one_join(spark, capsys):
    reg = HM.build_registry(spark.createDataFrame([("iPhone", "iPhone 15 128GB", "", "1", 1), ("Mac", "MacBook Air M2", "", "2", 2)],
                                                  "category string, short_desc string, long_desc string, product_id string, ord bigint"))
    key = reg.where("canonical_name = 'iPhone 15 128GB'").first()["model_key"]
    models = spark.createDataFrame([(key, "M-1", "IPHONE")], "model_key string, product_model_id string, category_code string")
    rows = spark.createDataFrame([(1, "iPhone 15 128GB"), (2, "iPhone 15 128GB"), (3, "MacBook Air M2"), (4, None)], "id int, match_text string")
    df = HM.harmonise_batch(rows, reg, models, carry=("category_code",))
    assert plan(df, capsys).count("Join") == 1
    assert {r["id"]: (r["product_model_id"], r["category_code"]) for r in df.collect()} == {1: ("M-1", "IPHONE"), 2: ("M-1", "IPHONE"), 3: (None, None), 4: (None, None)}


def test_bad_records_carry_their_payload(spark, capsys):
    rows = spark.createDataFrame([("b", "1", {"k": "x"}, [("R1", "f", "m")]), ("b", "2", {"k": "y"}, [])],
                                 "source_batch_id string, offer_id string, raw_payload map<string,string>, _hits array<struct<rule_id:string,failed_field:string,error_message:string>>")
    cat = spark.createDataFrame([("R1", "HIGH")], "rule_id string, severity string")
    bad = Q.bad_records(rows, cat, ["offer_id"], carry=("raw_payload",))
    assert bad.columns[-1] == "raw_payload" and plan(bad, capsys).count("Join") == 1
    assert [(r["offer_id"], r["raw_payload"]) for r in bad.collect()] == [("1", {"k": "x"})]


def test_a_rerun_derives_the_offers_once(spark, monkeypatch):
    from pricelens.plans import feed_queries as FQ
    from tests.conftest import SMALL

    calls, real = [], FQ.T.offers
    monkeypatch.setattr(FQ.T, "offers", lambda *a: calls.append(1) or real(*a))
    FQ.q_store_rerun(spark, SMALL)
    assert len(calls) == 1


def test_each_batch_of_a_few_files_has_its_own_task(spark, tmp_path):
    from pricelens.plans import feed_queries as FQ
    from tests.conftest import SMALL

    few, many = tmp_path / "few", tmp_path / "many"
    FQ.write_feeds(spark, SMALL, str(few), files=2)
    FQ.write_feeds(spark, SMALL, str(many))
    files = {d.name: [f for f in d.glob("*.csv") if f.stat().st_size] for d in few.glob("source_batch_id=*")}
    assert len(files) > 2 and all(len(f) == 1 for f in files.values())
    for name, (one,) in files.items():
        ranges = [f.read_text().split("\n", 1)[1] for f in sorted((many / name).glob("*.csv")) if f.stat().st_size]
        assert one.read_text().split("\n", 1)[1] == "".join(ranges)  # the same rows in the same order
