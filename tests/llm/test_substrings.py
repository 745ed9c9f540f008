import random

import numpy as np
import pytest

from pricelens.llm import _anchors, substring_dedup, suffix_dedup

from . import brute, corpus


def data_rows():
    rows = corpus.rows()
    r = random.Random(5)
    long = rows[4][1]
    rows += [(2000 + i, long[r.randint(0, 60):len(long) - r.randint(0, 60)], "en", "s", 1) for i in range(12)]  # shifted copies of a passage
    rows += [(1500, "ab" * 300, "en", "s", 1), (1501, "ab" * 40 + "x" + "ab" * 40, "en", "s", 1), (1502, long + long, "en", "s", 1), (1503, rows[8][1], "en", "s", 1)]
    return rows + [rows[8]] * 2


def test_repeated_words_equal_brute_force(spark):
    rows = data_rows()
    out = substring_dedup.remove_repeats(corpus.docs(spark, rows).repartition(3), n=12, k=5, digest=True)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out.collect())
    assert got == sorted((row[0], *w) for row, w in zip(rows, brute.repeated_words([r[:2] for r in rows], 12)))


@pytest.mark.parametrize("n,k", [(35, 8), (3, 3), (1, 1)])
def test_other_lengths(spark, n, k):
    rows = data_rows()[:60] + [(3000, None, None, None, None), (3001, "", None, None, None)]
    out = substring_dedup.remove_repeats(corpus.docs(spark, rows), n=n, k=k)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in out.collect())
    assert got == sorted((row[0], *w[:2]) for row, w in zip(rows, brute.repeated_words([r[:2] for r in rows], n)))


@pytest.mark.parametrize("n,k", [(50, 24), (20, 8), (16, 16)])
def test_earlier_bytes_equal_brute_force(spark, n, k):
    rows = data_rows()
    out = suffix_dedup.remove_earlier(corpus.docs(spark, rows).repartition(3), n=n, k=k, digest=True)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect())
    assert got == sorted((row[0], *w) for row, w in zip(rows, brute.repeated_bytes([r[:2] for r in rows], n)))


def test_hot_anchors_are_spread(spark):
    r = random.Random(8)
    passage = " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(40))
    rows = [(i, "".join(r.choices("klmnop qrst", k=150)) + passage + "".join(r.choices("klmnop qrst", k=150)), "en", "s", 1) for i in range(400)]
    docs = corpus.docs(spark, rows).repartition(3)
    least, most = [], []
    for hot_rows, hold in ((1 << 20, least), (20, most)):
        for p in suffix_dedup._dealt(docs, 50, 24, "doc_id", "text", hot_rows).collect():
            if p["key"] < suffix_dedup._WINDOWS:
                hold.append((p["key"], int(np.frombuffer(p["pack"], "<u4", 2)[1])))
    totals = [max(sum(n for k, n in hold if k == key) for key, _ in hold) for hold in (least, most)]
    assert totals[0] >= 300 and totals[1] < 60  # rows that meet in one merge
    want = sorted((row[0], *w) for row, w in zip(rows, brute.repeated_bytes([r[:2] for r in rows], 50)))
    for hot_rows in (20, 1 << 20):
        out = suffix_dedup.remove_earlier(docs, digest=True, hot_rows=hot_rows)
        assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect()) == want


def test_parts_are_dealt_evenly(spark):
    r = random.Random(9)
    texts = ["".join(r.choices("abcdefgh ", k=4000)) for _ in range(20)]
    docs = corpus.docs(spark, [(i, texts[i % 20], "en", "s", 1) for i in range(40)]).repartition(2)
    rows = {}
    for p in suffix_dedup._dealt(docs, 50, 24, "doc_id", "text", 1 << 20).collect():
        if p["key"] < suffix_dedup._WINDOWS:
            rows[p["key"]] = rows.get(p["key"], 0) + int(np.frombuffer(p["pack"], "<u4", 2)[1])
    assert len(rows) > 120 and max(rows.values()) < 3 * sum(rows.values()) / len(rows)


@pytest.mark.parametrize("hot_rows", [1, 3])
def test_windows_of_hot_anchors_equal_brute_force(spark, hot_rows):
    rows = data_rows() + [(None, data_rows()[4][1], None, None, None)]
    out = suffix_dedup.remove_earlier(corpus.docs(spark, rows).repartition(3), n=20, k=8, digest=True, hot_rows=hot_rows)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect())
    ids = [(1 << 62 if r[0] is None else r[0], r[1]) for r in rows]
    assert got == sorted((str(row[0]), *w) for row, w in zip(rows, brute.repeated_bytes(ids, 20)))


def test_null_ids_are_the_largest(spark):
    rows = [(1, "a" * 10 + "passage that is shared by both of these documents, all of it", None, None, None), (None, "passage that is shared by both of these documents, all of it", None, None, None)]
    out = {r["doc_id"]: r for r in suffix_dedup.remove_earlier(corpus.docs(spark, rows)).collect()}
    assert out[1]["n_removed"] == 0 and out[None]["n_removed"] == 60 and bytes(out[None]["kept"]) == b""


def test_empty_tables(spark):
    assert substring_dedup.remove_repeats(corpus.docs(spark, [])).count() == 0
    assert suffix_dedup.remove_earlier(corpus.docs(spark, [])).count() == 0


def test_merge_of_front_coded_runs():
    r = random.Random(3)
    for _ in range(60):
        width = r.choice([1, 5, 16, 17, 40])
        runs = [sorted(bytes(r.choices(b"ab\0", k=width)) for _ in range(r.choice([0, 1, 7, 30]))) for _ in range(r.randint(1, 9))]
        coded = []
        for run in runs:
            rows = np.frombuffer(b"".join(run), np.uint8).reshape(-1, width)
            shared, rests = suffix_dedup.front_code(rows)
            again = suffix_dedup.FrontCoded(shared.tolist(), rests, width)
            assert [again[i] for i in range(len(again))] == run
            if run:
                coded.append((suffix_dedup.FrontCoded(shared.tolist(), rests, width), shared.tolist()))
        out = [(coded[i][0].last, lcp) for i, _, lcp in suffix_dedup.merge_runs(coded)]
        assert [s for s, _ in out] == sorted(s for run in runs for s in run)
        for (a, _), (b, lcp) in zip(out, out[1:]):
            assert lcp == next((i for i in range(width) if a[i] != b[i]), width)


def test_anchors_cover_every_window():
    r = np.random.default_rng(2)
    for n, k in ((35, 8), (50, 24), (5, 5), (4, 1)):
        grams = r.integers(0, 1 << 63, 400).astype(np.uint64)
        grams[100:200] = grams[100]  # ties
        offsets = np.array([0, 0, 30, 130, 131, 399 + k, 399 + k])
        p, a, m, text = _anchors.anchors(grams, offsets, n, k)
        seen = np.concatenate([np.arange(x, x + y) for x, y in zip(a, m)])
        want = [s for t in range(len(offsets) - 1) for s in range(offsets[t], offsets[t + 1] - n + 1)]
        assert sorted(seen) == want and ((a <= p) & (p + k <= a + n)).all() and (a + m - 1 <= p).all()


def test_spans_are_joined():
    key, start, count = np.array([5, 5, 5, 2, 5, 5]), np.array([10, 0, 3, 7, 11, 30]), np.array([4, 3, 2, 1, 1, 1])
    rows = _anchors.joined_spans(key, start, count).to_pydict()
    got = {k: np.frombuffer(s, _anchors.SPAN).tolist() for k, s in zip(rows["_ll_key"], rows["spans"])}
    assert got == {2: [(7, 1)], 5: [(0, 5), (10, 4), (30, 1)]}
