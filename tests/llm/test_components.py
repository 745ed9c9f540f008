"""Connected components: rounds, plans and results of the star contraction."""

import random

from pricelens.llm import _components, ngram_join
from tests.llm import corpus


def _links(spark, pairs):
    return spark.createDataFrame(pairs, "a bigint, b bigint")


def _roots(pairs):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((top(a), top(b)))
            up[b] = a
    return {x: top(x) for x in up}


def _found(spark, pairs):
    rows = _components.components(_links(spark, pairs), "a", "b").collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["root"] for r in rows}


def test_chains_stars_and_loops_end_at_the_smallest_node(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(-6, 20)]
    rng.shuffle(chain)
    cases = [chain + [(100, 100), (201, 200), (200, 201), (201, 200)], [(rng.randrange(60), rng.randrange(60)) for _ in range(45)],
             [(7, x) for x in range(8, 60)] + [(3, 59)]]
    for pairs in cases:
        assert _found(spark, pairs) == _roots(pairs)


def test_stars_need_no_round(spark, monkeypatch):
    """A round costs several shuffles and a plan that the driver holds on to."""
    written = []
    monkeypatch.setattr(_components, "settle", lambda df, name, f=_components.settle: (written.append(name), f(df, name))[1])
    pairs = [(x, 1) for x in range(2, 30)] + [(50, 40), (40, 51)]
    assert _found(spark, pairs) == _roots(pairs)
    assert _found(spark, []) == {}
    assert written == ["links", "links"]


def test_what_is_joined_is_not_joined_again(spark, monkeypatch):
    """Where no star has failed, components are found once, and no pairs are compared again."""
    calls = []
    monkeypatch.setattr(ngram_join, "components", lambda *a, f=ngram_join.components: (calls.append(1), f(*a))[1])
    texts = [f"{w} one two three four five six seven eight nine ten" for w in ("a", "b", "a", "b")]
    out = ngram_join.jaccard_components(corpus.docs(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)]), n=3)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {0: 0, 1: 0, 2: 0, 3: 0}
    assert len(calls) == 1
