import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricelens.llm import quality_fm
from pricelens.llm.queries import held_out

from . import brute, corpus


def test_score_is_the_pairwise_sum():
    """The linear-time identity equals the sum over all pairs of features."""
    r = np.random.default_rng(0)
    size = (1 << quality_fm.WORD_BITS) + len(quality_fm.STATISTICS) * (quality_fm.BINS + 1)
    m = quality_fm.Machine(0.3, r.normal(size=size).astype(np.float32), r.normal(size=(size, quality_fm.FACTORS)).astype(np.float32))
    (doc, f, x), = quality_fm.features(pa.array(["some words and some more words", "", None, "x"]))
    got = m.raw(doc, f, x, 4)
    for d in range(4):
        mine = np.flatnonzero(doc == d)
        want = m.bias + sum(m.weight[f[i]] * x[i] for i in mine)
        want += sum(float(m.factor[f[i]] @ m.factor[f[j]]) * x[i] * x[j] for a, i in enumerate(mine) for j in mine[a + 1:])
        assert got[d] == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_words_are_normalised_counts():
    (doc, f, x), = quality_fm.features(pa.array(["a a b"]))
    words = f < 1 << quality_fm.WORD_BITS
    assert sorted(x[words].tolist()) == pytest.approx(sorted([2 / 5 ** .5, 1 / 5 ** .5]))


def junk_and_prose(n=240):
    r = random.Random(8)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(400)]
    out, labels = [], []
    for i in range(n):
        words = r.choices(vocabulary, k=r.randint(5, 80))
        good = i % 4 != 0
        text = " ".join(words) + "." if good else " ".join(w + "###" for w in words) if i % 8 else " ".join([words[0]] * len(words))
        out.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), 0))
    return out, labels


def test_held_out_accuracy(spark):
    rows, labels = junk_and_prose()
    rows += [(5000, None, None, None, None), (5001, "", "en", "s", 0), (None, "no id", None, None, 3)] + [rows[3]]
    docs = corpus.docs(spark, rows)
    lab = spark.createDataFrame(labels + [(None, 1, 0), (3, None, None), (999_999, 1, 0)], "doc_id bigint, quality int, toxic int")
    machine = quality_fm.train(docs, lab, ~held_out(), metadata=("n_chars",))
    got = quality_fm.score(docs, machine, keep=["doc_id"]).withColumn("out", held_out()).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    known = {d: q for d, q, _ in labels}
    tested = [r for r in got if r["out"] and r["doc_id"] in known]
    assert len(tested) > 50 and sum((r["score"] >= 0.5) == known[r["doc_id"]] for r in tested) / len(tested) > 0.95
    empty = {r["doc_id"]: r["score"] for r in got if r["doc_id"] in (5000, 5001)}
    assert len(empty) == 2
    # the labels of held-out rows, ids, languages and sources change nothing
    other = lab.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_fm.train(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")), other, ~held_out(), metadata=("n_chars",))
    assert np.array_equal(machine.weight, again.weight) and np.array_equal(machine.factor, again.factor)


def test_training_without_rows(spark):
    docs = corpus.docs(spark, [])
    lab = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    machine = quality_fm.train(docs, lab, ~held_out())
    assert quality_fm.score(docs, machine).count() == 0
    assert [r["score"] for r in quality_fm.score(corpus.docs(spark, [(1, "x", None, None, None)]), machine, keep=["doc_id"]).collect()] == [0.5]


def _fitted_on(monkeypatch, *args, **bounds):
    seen = []

    def fit(vectors, y, *_, **__):
        seen.extend(vectors)
        return quality_fm.Machine(0.0, None, None)

    monkeypatch.setattr(quality_fm, "fit", fit)
    quality_fm.train(*args, ~held_out(), **bounds)
    return seen


def test_bound_on_the_sample(spark, monkeypatch):
    rows, labels = junk_and_prose()
    docs, lab = corpus.docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert 20 <= len(_fitted_on(monkeypatch, docs, lab, max_rows=40)) <= 40
    # repeated rows of an id count once, before anything is collected
    assert len(_fitted_on(monkeypatch, docs.unionAll(docs).unionAll(docs), lab, max_rows=40)) == len(_fitted_on(monkeypatch, docs, lab, max_rows=40))
    # long texts: rows are taken while their features fit
    some = _fitted_on(monkeypatch, docs, lab, max_features=2000)
    assert 0 < sum(len(f) for f, _ in some) <= 2000 < sum(len(f) for f, _ in _fitted_on(monkeypatch, docs, lab))


def test_pipeline(spark, tmp_path):
    rows, labels = junk_and_prose(120)
    good = [r for r in rows if r[0] % 4]
    copies = [(1000 + i, good[0][1] + f" tail{i}", "en", "s", 1) for i in range(3) if len(good[0][1]) > 200]
    leaked = (2000, "before " + good[5][1] + " after it", "en", "t", 1)
    spark.createDataFrame(rows + copies + [leaked, (3000, None, None, None, None)], corpus.DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    w = brute.LETTERS.findall(good[5][1])
    spark.createDataFrame([(1, " ".join(w[:12]))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, columns = spark.read.parquet(str(tmp_path / "documents.parquet")), corpus.DOCS.names
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "tokens":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    ids = lambda name: {r["doc_id"] for r in spark.read.parquet(str(tmp_path / name)).select("doc_id").collect()}
    assert {r[0] for r in good} <= ids("quality") | {r[0] for r in good if len(r[1]) < 60}
    assert len(ids("quality") & {r[0] for r in rows if r[0] % 4 == 0}) <= 3
    assert ids("near_duplicates") <= ids("quality")
    if len(w) >= 10:
        assert good[5][0] not in ids("decontamination") and 2000 not in ids("decontamination")
    assert ids("mixture") <= ids("decontamination") and ids("tokens") == ids("mixture")
