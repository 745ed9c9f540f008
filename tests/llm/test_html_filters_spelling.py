"""Operators 11 to 13 against brute force."""

import itertools
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm import filter_audit, html_text, spelling
from pricelens.llm._layouts import labelled_pages

from . import corpus


@pytest.fixture(scope="module")
def weights():
    return html_text.built_in()


# ---- 11: main text

def test_region_is_the_best_run():
    r = random.Random(5)
    for _ in range(300):
        x = [r.choice((-3, -1, -0.5, 0, 1, 2)) for _ in range(r.randint(0, 12))]
        a, b = html_text.region(x)
        best = max([sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)], default=0)
        assert sum(x[a:b]) == max(best, 0)
    assert html_text.region([]) == html_text.region([-1, 0]) == (0, 0)


def test_held_out_pages_come_back_whole(weights):
    for page, text in labelled_pages(per_layout=4, assembled=150, seed=4242):
        assert html_text.main_text(page, weights) == text, page


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("<nav><a href='/'>a</a></nav>", ""),
    ("<article><h1>T</h1><p>a &amp; b&quot;\n  c<br>d</p><!-- x <p>no</p> --><p>&lt;b&gt; 1 < 2</p></article>", 'T\na & b" c d\n<b> 1 < 2'),
    ("<article><p>one <b>t</b>wo<p>three<script>var a='</p><p>x';</script><style>p{}</style></article><footer>f</footer>", "one two\nthree"),
    ("<article><p>é 日本\U0001F600</p><p> </p><p></p></article>", "é 日本\U0001F600"),
    ("<article><h1>X</h1><aside>" + "<ul><li><a href='/'>more of it</a></li></ul>" * 60 + "</aside><p>last</p></article>", "X\nlast"),
    ("<article><p>kept</p><!-- never closed <p>lost</p>", "kept"),
    ("<article><p>kept</p><script>never closed <p>lost</p>", "kept"),
    ("<article><p title='a > b'>kept</p><p class=\"unclosed>lost</p></article>", "kept\nlost"),
    ("<ARTICLE><P>Upper</P></ARTICLE><FOOTER>no</FOOTER>", "Upper"),
])
def test_awkward_pages(weights, page, text):
    assert html_text.main_text(page, weights) == text


def test_extract_keeps_rows_and_columns(spark, weights):
    schema = "page_id long, url string, html string, text string, n_chars int, _extra array<string>"
    long = "<article>" + "<p>" + "word " * 60000 + "</p>" + "<i>" * 3000 + "</article>"
    rows = [(1, "u", "<article><p>a b</p></article>", "clash", 9, ["x"]), (1, "u", "<article><p>a b</p></article>", "clash", 9, ["x"]), (None, None, None, None, None, None), (2, "v", long, "", 1, [])]
    out = html_text.extract(spark.createDataFrame(rows, schema), weights)
    assert out.columns == ["page_id", "url", "html", "_extra", "text", "n_chars"]
    got = sorted((r["page_id"] or 0, r["n_chars"], r["text"][:5]) for r in out.collect())
    assert got == [(0, 0, ""), (1, 3, "a b"), (1, 3, "a b"), (2, 299999, "word ")]
    assert html_text.extract(spark.createDataFrame([], schema), weights).count() == 0


def test_weights_from_a_table_of_labelled_pages(spark, weights):
    pages = spark.createDataFrame([*labelled_pages(4, 200, 3), (None, "x"), ("<p>x</p>", None)], "html string, text string")
    learnt = html_text.train(pages.unionAll(pages))
    page, text = labelled_pages(1, 0, 77)[0]
    assert html_text.main_text(page, learnt) == text
    assert html_text.train(pages, max_pages=0).words == {}


# ---- 12: filter audit

def brute_audit(marked, names):
    parts = sorted({m[0] for m in marked})
    out = {}
    for part in parts:
        rows = [m for m in marked if m[0] == part]
        total = Counter()
        for order in map("".join, itertools.permutations(names)):
            left = list(rows)
            for k, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                fails = [x for x in rows if f in x[1]]
                total[f] += len(gone)
                out[part, order, k] = [len(left), len(gone), len(fails) - len(gone), sum(x[1] == f for x in rows), sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(total[order[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(df):
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in cols) for r in df.collect()}


def test_audit_of_given_marks(spark):
    r = random.Random(3)
    marked = [(r.choice(("hot", "hot", "b")), "".join(f for f in "XYZW" if r.random() < .4), r.random() < .3, r.random() < .2) for _ in range(300)]
    schema = "part string, X boolean, Y boolean, Z boolean, W boolean, good boolean, toxic boolean"
    rows = [(p, *[True if f in s else r.choice((False, None)) for f in "XYZW"], g, t or None) for p, s, g, t in marked]
    df = spark.createDataFrame(rows, schema)
    filters = {f: f for f in "XYZW"}
    got = audited(filter_audit.audit(df, filters, "part", {"good_lost": "good", "toxic_lost": "toxic"}))
    assert got == brute_audit(marked, "XYZW")
    assert filter_audit.audit(df.limit(0), filters, "part").count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit(df, {}, "part")


def test_audit_of_texts(spark):
    rows = corpus.rows(4, 60) + [(7, "again", "en", "hot", 1), (7, "again", "en", "src1", 1), (8, "again", None, None, 1), (None, "again", "en", "src1", 1), (3000, "again", "en", "", 1), (3001, None, "en", "", 1),
                                (3002, "WORD " * 60, "en", "hot", 3), (3003, " ".join(f"w{i}" for i in range(60)), "en", "hot", 3)]
    labels = [(i, i % 2, 1 if i % 5 == 0 else None) for i in range(0, 60, 3)] + [(7, 0, 0), (7, 1, 1), (None, 1, 1), (3002, None, 1), (99999, 1, 1)]
    marked = []
    for i, text, _, source, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lower = [j for j, t, *_ in rows if (t or "") == text and j is not None and i is not None and j < i]
        fails = "".join(f for f, bad in zip("ABCDE", (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text)), bool(lower))) if bad)
        mine = [x for x in labels if x[0] is not None and x[0] == i]
        marked.append((source or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = corpus.docs(spark, rows).withColumn("part", F.lit("clash")).withColumn("good", F.lit(9))
    assert audited(filter_audit.audit_texts(docs.repartition(5), known)) == brute_audit(marked, "ABCDE")
    assert filter_audit.audit_texts(docs.limit(0), known).count() == 0
    none = audited(filter_audit.audit_texts(docs, known.limit(0)))
    assert len(none) == 600 * len({m[0] for m in marked}) and all(v[4] == v[5] == 0 for v in none.values())


# ---- 13: spelling variants

def test_words_are_counted_with_their_misspellings(spark):
    rows = corpus.rows(2, 60) + [(None, "Größe ÀÉÎ× abcdefg", "de", "s", 1), (5000, "straße-Straße STRASSE naïveté " * 9, "de", "s", 1), (5001, "A" * 40000 + "é", "de", "s", 2)]
    for every in (0, 3):
        want = Counter()
        for i, text, *_ in rows:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                word = "".join(c.lower() if c < "\x80" else c for c in run)
                if every and crc32(f"{'' if i is None else i}:{word}".encode()) % every == 0:
                    h = crc32(f"{'' if i is None else i}:{word}".encode()) % len(word)
                    word = word[:h] + word[h + 1:]
                want[word] += 1
        want = {w: n for w, n in want.items() if len(w) >= 4 and n >= 2}
        got = spelling.count_words(corpus.docs(spark, rows).repartition(3), min_length=4, min_count=2, typo_every=every).collect()
        assert {r["word"]: r["n"] for r in got} == want and len(got) == len(want)


def test_one_edit():
    for a, b, near in (("abc", "abd", 1), ("abc", "ab", 1), ("abc", "xabc", 1), ("abc", "abc", 0), ("abc", "acb", 0), ("", "a", 1), ("", "", 0), ("aab", "ab", 1), ("abcd", "ab", 0), ("abc", "axcd", 0)):
        assert spelling.one_edit(a, b) == spelling.one_edit(b, a) == bool(near)


def brute_groups(words, ratio=5):
    n, out = dict(words), {}
    best = {}
    for w in n:
        near = [x for x in n if abs(len(x) - len(w)) <= 1 and spelling.one_edit(w, x)]
        top = min(near, key=lambda x: (-n[x], x), default=None)
        best[w] = (top if top is not None and n[top] >= ratio * n[w] else None, len(near))
    for w in n:
        root = w
        while best[root][0] is not None:
            root = best[root][0]
        out[w] = (best[w][0], root, n[w], best[w][1], n.get(best[w][0]))
    return out


def variants(seed, size):
    """Words with many neighbours: variants of few stems, chains, ties, long words."""
    r = random.Random(seed)
    letters = "abcdeéÿÀ÷z"
    words = {"".join(r.choices(letters, k=r.randint(1, 7))): r.choice((1, 5, 5, 25, 130, 700)) for _ in range(size)}
    stem = "abcdefgh"
    for k in range(6):  # a chain of forms
        words[stem[:k] + "zzz" + stem[k:]] = 5 ** k
        words[stem + "z" * k] = 5 ** k
    long = "xy" * 400
    words |= {long: 900, long[1:]: 9, long + "z": 9, long[:300] + "q" + long[301:]: 9, "q" * 40: 50, "q" * 39: 2, "q" * 41: 2, "q" * 33: 10, "q" * 32: 50, "q" * 31: 50}
    return list(words.items())


def test_groups_equal_brute_force(spark, monkeypatch):
    words = variants(1, 1500)
    df = spark.createDataFrame(words, "word string, n long")
    want = brute_groups(words)
    cols = ["form", "root", "n", "n_near", "form_n"]
    for part, sought, leaf, depth in ((100_000, 20_000, 64, None), (40, 30, 1, 3), (100_000, 500, 4, 5)):
        monkeypatch.setattr(spelling, "PART_WORDS", part)
        monkeypatch.setattr(spelling, "SOUGHT", sought)
        monkeypatch.setattr(spelling, "LEAF", leaf)
        near = spelling.neighbours(df, depth=depth)
        assert {r["word"]: r["n_near"] for r in near.collect()} == {w: v[3] for w, v in want.items() if v[3]}
    got = spelling.group_variants(df.repartition(4)).collect()
    assert {r["word"]: tuple(r[c] for c in cols) for r in got} == want and len(got) == len(want)


def test_no_words(spark):
    none = spark.createDataFrame([], T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))
    assert spelling.group_variants(none).count() == 0
    assert spelling.count_words(corpus.docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(none, ratio=1)
