import random
from collections import defaultdict

from pyspark.sql import functions as F

from pricelens.llm import decontam, mixing

from . import brute, corpus


def test_targets_cap_and_reshare(spark):
    r = random.Random(4)
    for _ in range(5):
        sizes = {s: r.choice([0, 1, 10, 500, 40_000]) + r.randint(0, 9) for s in [f"s{i}" for i in range(r.randint(1, 9))] + [None]}
        df = spark.createDataFrame(list(sizes.items()), "_ll_source string, _ll_source_size bigint")
        got = {x["_ll_source"]: x["_ll_target"] for x in mixing.source_targets(df).collect()}
        want = brute.targets(sizes)
        assert got.keys() == want.keys()
        assert all(brute.near(got[s], want[s], 1e-6) for s in want)


def test_mix_follows_targets(spark):
    data = corpus.rows() + [corpus.rows()[5]] * 3 + [(None, "no id here", "en", "hot", 1)]
    out = mixing.mix(corpus.docs(spark, data), weights=(5, 2, 1), seed=3)
    assert len(out.columns) == len(set(out.columns))
    got = out.collect()
    assert len(got) == len(data)
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in got:
        n = len(brute.words(r["text"]))
        assert r["size"] == n and 0 <= r["copies"] <= 2
        sizes[r["source"]] += n
        taken[r["source"]] += r["copies"] * n
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], n)
    want = brute.targets(dict(sizes))
    for s in sizes:
        assert brute.near(target[s], want[s], 1e-6)
        assert abs(taken[s] - want[s]) <= largest[s] + 1
    again = mixing.mix(corpus.docs(spark, data[::-1]).repartition(7), weights=(5, 2, 1), seed=3)
    key = lambda rows: sorted((str(r["doc_id"]), r["size"], r["copies"]) for r in rows)
    assert key(again.collect()) == key(got)


def test_copies_are_systematic(spark):
    """Copies are the floor or the ceiling of the expectation, and any run of the order has its share."""
    data = [(i, "w " * (i % 7 + 1), "en", "only", 1) for i in range(400)] + [(1000 + i, "w " * 50, "en", "other", 1) for i in range(100)]
    got = mixing.mix(corpus.docs(spark, data), weights=(1, 3), share=0.7).collect()
    mine = sorted((r for r in got if r["source"] == "only"), key=lambda r: (-r["size"], r["doc_id"] % 64, r["doc_id"]))
    rate = mine[0]["target"] / mine[0]["source_size"]
    total = 0
    for i, r in enumerate(mine, 1):
        total += r["copies"]
        assert abs(total - rate * i) < 1 + 1e-4


def test_mix_empty_and_emit(spark):
    none = corpus.docs(spark, [])
    assert mixing.mix(none).count() == 0
    out = mixing.mix(corpus.docs(spark, extra=False))
    again = mixing.emit(out, corpus.DOCS.names)
    assert again.count() == out.agg(F.sum("copies")).first()[0]
    assert again.columns == corpus.DOCS.names


ITEM = "item_id bigint, text string"


def items_of(data):
    long = data[4][1].split()
    return [(7, " ".join(long[5:40])), (3, "Two Words!"), (30, " ".join(data[8][1].split()[:10])), (9, None), (10, ""), (11, "never to be found in any of these texts at all"), (None, " ".join(long[3:20])), (7, "same same")]


def test_contamination_equals_brute_force(spark):
    data = corpus.rows() + [corpus.rows()[4]]
    items = items_of(data)
    bench = spark.createDataFrame(items, ITEM)
    out = decontam.contamination(corpus.docs(spark, data), bench)
    got = corpus.by_id(out, "n_words", "n_hit", "items", "n_items", "contaminated")
    for (d, _, *_), (n, hit, found) in zip(data, brute.hits([r[:2] for r in data], items)):
        assert all(g == (n, hit, found.split(",") if found else [], len(found.split(",")) if found else 0, hit > 0) for g in got[d]), d
    assert out.count() == len(data) and len(set(out.columns)) == len(out.columns)


def test_same_without_broadcast(spark, monkeypatch):
    data = corpus.rows()
    bench = spark.createDataFrame(items_of(data), ITEM)
    one = corpus.by_id(decontam.contamination(corpus.docs(spark, data), bench), "n_hit", "items")
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert corpus.by_id(decontam.contamination(corpus.docs(spark, data), bench), "n_hit", "items") == one


def test_removal(spark):
    data = corpus.rows()
    bench = spark.createDataFrame(items_of(data), ITEM)
    want = {r[0]: h for r, h in zip(data, brute.hits([r[:2] for r in data], items_of(data)))}
    docs = corpus.docs(spark, data)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, h in want.items() if not h[1]}
    cut = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs, bench, remove="spans").collect()}
    for d, text, *_ in data:
        if not want[d][1]:
            assert cut[d] == text
        else:
            assert len(brute.LETTERS.findall(cut[d].translate(brute.UP))) == want[d][0] - want[d][1]


def test_decontam_empty_tables(spark):
    data = corpus.rows()
    empty = spark.createDataFrame([], ITEM)
    assert decontam.contamination(corpus.docs(spark, data), empty).where("contaminated").count() == 0
    bench = spark.createDataFrame(items_of(data), ITEM)
    assert decontam.contamination(corpus.docs(spark, []), bench).count() == 0
    assert decontam.decontaminate(corpus.docs(spark, data), empty).count() == len(data)
