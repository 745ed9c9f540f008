import random

import numpy as np
import pytest

from pricelens.llm import ngram_join

from . import brute, corpus


def check(spark, data, **options):
    out = ngram_join.jaccard_components(corpus.docs(spark, data), **options)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect())
    n = options.get("n", 5)
    want = brute.components([r[:2] for r in data], n, options.get("num", 80), options.get("den", 100))
    assert got == sorted((r[0], *w) for r, w in zip(data, want))
    return got


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100), (1, 1, 2), (2, 100, 100)])
def test_components_equal_brute_force(spark, n, num, den):
    got = check(spark, corpus.rows() + [corpus.rows()[4]] * 2, n=n, num=num, den=den)
    assert len({c for _, _, c in got}) < len(got)


def edits(r, base, k, words):
    w = list(base)
    for i in r.sample(range(len(w)), k):
        w[i] = r.choice(words)
    return " ".join(w)


def test_chains_and_failed_stars(spark, monkeypatch):
    """A long chain of edits, and documents that share most of a template without linking."""
    monkeypatch.setattr(ngram_join, "CELL", 4)
    r = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    base = r.choices(words, k=120)
    data, cur = [], base
    for i in range(40):
        cur = edits(r, cur, 2, words).split()
        data.append((i, " ".join(cur), "en", "s", 1))
    data += [(100 + i, " ".join(base[:100] + r.choices(words, k=20 + i % 5)), "en", "s", 1) for i in range(30)]
    data += [(200 + i, edits(r, base, i % 12, words), "en", "s", 1) for i in range(40)]
    r.shuffle(data)
    check(spark, data, n=3, num=90, den=100)
    check(spark, data, n=1, num=80, den=100)


def test_sketches_bound_the_difference():
    r = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(r.integers(0, 1 << 52, r.integers(10, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < .9], r.integers(0, 1 << 52, 9).astype(np.uint64)]))
        bands = ngram_join.Bands(80, 100)
        bands.of(np.array([len(a), len(b)]))
        parts = np.full(2, 1 + int(r.integers(1, 90)))
        first, words = ngram_join.sketch(np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b]), parts)
        x, y = words[:first[1]], words[first[1]:]
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_bands_hold_every_linked_pair():
    for num, den in ((90, 100), (80, 100), (1, 2), (99, 100)):
        bands = ngram_join.Bands(num, den)
        own = bands.of(np.arange(1, 700))
        for a in range(1, 600):
            for b in range(a, min(a * den // num, 699) + 1):
                assert own[b - 1] - own[a - 1] in (0, 1)
                least = -(-num * (a + b) // (num + den))  # smallest linked intersection
                if least <= a:
                    assert a + b - 2 * least <= bands.difference(own[b - 1:b])[0]


def test_keep_one(spark):
    data = corpus.rows() + [corpus.rows()[4]] * 2 + [(None, corpus.rows()[4][1], "en", "s", 1), (None, "alone and without any id", None, None, None)]
    docs = corpus.docs(spark, data)
    out = ngram_join.keep_one(docs, n=3, num=90, den=100)
    assert out.columns == docs.columns
    want = {r[0] for r, (n, c) in zip(data[:-2], brute.components([x[:2] for x in data[:-2]], 3)) if c == r[0]}
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == sorted(want)
    assert out.where("doc_id is null").count() == 1
    assert ngram_join.keep_one(corpus.docs(spark, [])).count() == 0
    assert ngram_join.jaccard_components(corpus.docs(spark, [])).count() == 0


def test_linked_sets_keep_a_common_signature():
    """However signatures are ranked, the sets that link still share one that neither leaves out."""
    r = np.random.default_rng(4)
    spared = 0
    for num, den in ((80, 100), (90, 100)):
        for _ in range(150):
            a = np.unique(r.integers(0, 1 << 52, r.integers(5, 500)).astype(np.uint64))
            cut = int(r.integers(0, len(a) * (den - num) // den + 1))
            b = np.unique(np.concatenate([a[cut:], r.integers(0, 1 << 52, r.integers(0, 1 + len(a) // 9)).astype(np.uint64)]))
            inter = len(np.intersect1d(a, b))
            if inter * den < (len(a) + len(b) - inter) * num:
                continue
            kept = []
            for x in (a, b):
                mine = set()
                for sig, _, send, spare in ngram_join.signed(ngram_join.Bands(num, den), np.array([0, len(x)]), x):
                    sig = sorted(sig[send].tolist(), key=lambda s: hash((s, 7)))
                    mine |= set(sig[:len(sig) - int(spare[0])])
                    spared += int(spare[0])
                kept.append(mine)
            assert kept[0] & kept[1]
    assert spared > 1000


def test_a_common_passage_compares_few_pairs(spark, monkeypatch):
    """A tenth to a third of each text is a passage that all share; none of them link."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(9000)]
    passage = r.choices(words, k=60)
    data = [(i, " ".join(passage + r.choices(words, k=120 + 5 * (i % 40))), "en", "s", 1) for i in range(300)]
    sizes = {}
    monkeypatch.setattr(ngram_join, "settle", lambda df, name, f=ngram_join.settle: sizes.setdefault(name, f(df, name)))
    check(spark, data)
    assert sizes["star-pairs"].count() < 1500 and sizes["members"].count() < 100
