"""Matching-block ratio against the standard library; wildcard look-ups against plain loops."""

import datetime as dt
import itertools
import random
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelens.functions import blocks as B
from pricelens.operators import context as CX
from pricelens.operators import harmonise as HM
from test_matcher import _registry


def plain(a, b):
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab c", max_size=25), st.text("ab c", max_size=25)), max_size=8))
def test_ratio_of_short_texts(pairs):
    assert B.block_ratios([p[0] for p in pairs], [p[1] for p in pairs]).tolist() == [plain(*p) for p in pairs]


@pytest.mark.parametrize("letters, size", [("ab", 400), ("abcdefghij klmnop", 90), ("abcdefghijklmnopqrstuvwxyz é😀", 650)])
def test_ratio_of_long_texts_in_small_matrices(letters, size, monkeypatch):
    r = random.Random(size)
    first = ["".join(r.choice(letters) for _ in range(r.randrange(size))) for _ in range(30)]
    second = ["".join(r.choice(letters) for _ in range(r.randrange(size))) for _ in range(30)]
    for i in range(0, 30, 3):   # parts in common, with a word put in between
        second[i] = first[i][:len(first[i]) // 2] + second[i][:9] + first[i][len(first[i]) // 2:]
    want = [plain(a, b) for a, b in zip(first, second)]
    for cells in (64, 1 << 17):
        monkeypatch.setattr(B, "CELLS", cells)
        assert B.block_ratios(first, second).tolist() == want


def test_ratio_of_nulls_empty_and_equal_texts():
    assert B.block_ratios([None, "", "a", "", "abc" * 200], ["a", "b", None, "", "abc" * 200]).tolist() == [0, 0, 0, 0, 1]
    assert B.block_ratios([], []).tolist() == []


def test_matches_with_the_exact_ratio(spark):
    """All pairs scored by the standard library's ratio give the pruned ranking."""
    names = spark.createDataFrame([("iP 17 PM 512GB",), ("iPhone 17 Pro Max 256GB",), ("AirPods 4 ANC",), ("airpod gen 4",), ("mystery",)], "name string")
    reg = _registry(spark)
    got = [(m["name"], m["rank"], m["model_key"], m["char_fuzz"], m["score"]) for m in HM.match_top_k(names, reg, 3, method="blocks").collect()]
    pairs = HM._not_cross_category(HM._partial(HM.candidate_pairs(HM.prepare_names(names, "name"), reg))).collect()
    want = []
    for name, group in itertools.groupby(sorted(pairs, key=lambda p: p["q_name"]), key=lambda p: p["q_name"]):
        scored = []
        for p in group:
            fuzz = plain(p["q_text"], p["r_text"])
            scored.append((-round(p["_s0"] + HM.config.WEIGHT_FUZZ * fuzz, 3), p["r_registry_order"], p["r_model_key"], round(fuzz, 3)))
        want += [(name, i + 1, key, fuzz, -s) for i, (s, _, key, fuzz) in enumerate(sorted(scored)[:3])]
    assert sorted(got) == sorted(want) and got
    with pytest.raises(ValueError):
        HM.match_top_k(names, reg, 1, method="other")


def _values(r, n):
    return [r.choice((None, "A", "B", "C")) for _ in range(n)]


def test_wildcard_look_up_equals_all_comparisons(spark):
    r = random.Random(3)
    keys = sorted({tuple(_values(r, 3)) + (r.randrange(2),) for _ in range(60)}, key=str)
    rules = [(i, *_values(r, 3), r.randrange(2)) for i in range(80)]
    k = spark.createDataFrame(keys, "a string, b string, c string, lvl int")
    f = spark.createDataFrame(rules, "id int, ra string, rb string, rc string, rl int")
    joined = CX.match_wildcards(k, f, {"a": "ra", "b": "rb", "c": "rc"}, {"lvl": "rl"})
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = sorted(((x["a"], x["b"], x["c"], x["lvl"], x["id"]) for x in joined.collect()), key=str)
    want = sorted(((*key, i) for key in keys for i, *w, lvl in rules if lvl == key[3] and all(v is None or v == q for v, q in zip(w, key))), key=str)
    assert got == want and got
    for empty in (CX.match_wildcards(k.limit(0), f, {"a": "ra"}), CX.match_wildcards(k, f.limit(0), {"a": "ra"})):
        assert empty.count() == 0


def test_thresholds_take_the_most_specific_row(spark):
    cfg = spark.createDataFrame([("k", 1.0, None, None), ("k", 2.0, None, "AU"), ("k", 3.0, "X", None), ("k", 4.0, "X", "AU"), ("k", 4.5, "X", "AU"), ("j", 9.0, "Y", None)],
                                "config_key string, config_value double, category_code string, country_code string")
    keys = spark.createDataFrame([("X", "AU"), ("X", "NZ"), ("Y", "AU"), (None, "AU"), ("Z", None), ("X", "AU")], "category_code string, country_code string")
    got = {(x["config_key"], x["category_code"], x["country_code"]): (x["config_value"], x["specificity"]) for x in CX.resolve_thresholds(cfg, keys).collect()}
    assert got == {("k", "X", "AU"): (4.5, 3), ("k", "X", "NZ"): (3.0, 2), ("k", "Y", "AU"): (2.0, 1), ("k", None, "AU"): (2.0, 1),
                   ("k", "Z", None): (1.0, 0), ("j", "Y", "AU"): (9.0, 2)}


def test_alert_routes_with_a_hot_scope(spark):
    """A third of all anomalies and more share one scope; NULL scopes meet open policies only."""
    r = random.Random(8)
    scopes = [("T1", "AU", "X", "HIGH")] * 60 + [(r.choice(("T1", "T2", None)), r.choice(("AU", None)), r.choice(("X", "Y", None)), r.choice(("LOW", "MEDIUM", "HIGH", None))) for _ in range(60)]
    rows = [(i, *s, dt.datetime(2025, 1, 1, i % 24)) for i, s in enumerate(scopes)]
    anoms = spark.createDataFrame(rows, "offer_id int, anomaly_type string, country_code string, category_code string, severity string, crawl_ts_utc timestamp")
    pol = [(1, "HIGH", None, None, None, 1320, 360, True), (2, "LOW", "T1", None, "X", None, None, True), (3, "MEDIUM", None, "AU", "Y", 0, 480, True), (4, "LOW", None, None, None, None, None, False)]
    policies = spark.createDataFrame([(*p[:5], "mail", "me", *p[5:]) for p in pol], "policy_id int, min_severity string, anomaly_type string, country_code string, category_code string, "
                                     "channel string, recipient string, quiet_start int, quiet_end int, is_active boolean")
    routed = CX.route_alerts(anoms, policies)
    assert routed.columns == [*anoms.columns, "policy_id", "channel", "recipient", "quiet_start", "quiet_end", "in_quiet_hours"]
    got = sorted((x["offer_id"], x["policy_id"], x["in_quiet_hours"]) for x in routed.collect())
    level = {"LOW": 1, "MEDIUM": 2, "HIGH": 3}
    want = []
    for i, t, c, g, s, ts in rows:
        for pid, least, pt, pc, pg, qs, qe, active in pol:
            if active and s and level[s] >= level[least] and all(v is None or v == q for v, q in ((pt, t), (pc, c), (pg, g))):
                m = ts.hour * 60
                want.append((i, pid, False if qs is None else qs <= m < qe if qs <= qe else m >= qs or m < qe))
    assert got == sorted(want) and got


def test_block_ratio_column(spark):
    df = spark.createDataFrame([("abcd", "bcde"), (None, "a"), ("", "a")], "a string, b string")
    assert [x[0] for x in df.select(F.round(B.block_ratio("a", "b"), 6)).collect()] == [0.75, 0.0, 0.0]
