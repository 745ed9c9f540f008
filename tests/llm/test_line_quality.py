from pyspark.sql import functions as F

from pricelens.llm import line_quality

from . import brute, corpus


def check(spark, data, **limits):
    verdicts, _ = line_quality.judge(corpus.docs(spark, data), **limits)
    got = verdicts.collect()
    _, want = brute.common_lines([(r[0], r[1], r[3]) for r in data], limits.get("max_share", 0.05), limits.get("min_docs", 10))
    expected = sorted((str(r[0]), *brute.text_counts(r[1]), *w) for r, w in zip(data, want))
    assert sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["n_common_words"], r["base_failed"], r["kept"]) for r in got) == expected
    return got


def test_counts_and_verdicts_equal_brute_force(spark):
    data = corpus.rows()
    got = check(spark, data, max_share=0.1, min_docs=3)
    assert any(r["n_common_words"] for r in got) and any(not r["kept"] and not r["base_failed"] for r in got)
    check(spark, data + [corpus.rows()[7]] * 4 + [(None, "x " * 25, None, None, None)])


def test_hot_line_and_empty(spark):
    text = "shared line of a host that everyone repeats here\n"
    data = [(i, text * 1 + " ".join(f"w{i}x{j}" for j in range(40)), "en", "hot", 1) for i in range(60)] + [(100 + i, text, "en", "hot", 1) for i in range(30)]
    got = check(spark, data)
    assert {r["doc_id"] for r in got if r["kept"]} == set(range(60))
    verdicts, common = line_quality.judge(corpus.docs(spark, []))
    assert verdicts.count() == 0 and common.count() == 0


def test_clean_cuts_common_lines(spark):
    data = corpus.rows()
    docs = corpus.docs(spark, data)
    out = line_quality.clean(docs, max_share=0.1, min_docs=3)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    common, want = brute.common_lines([(r[0], r[1], r[3]) for r in data], 0.1, 3)
    assert set(got) == {r[0] for r, w in zip(data, want) if w[2]}
    for r in data:
        if r[0] in got:
            left = [x for x in r[1].split("\n") if (r[3], " ".join(brute.words(x.translate(brute.UP)))) not in common]
            assert got[r[0]] == "\n".join(left)
    assert out.select(F.max(F.length("text"))).first()[0] > 1000


def test_line_of_a_large_host_needs_no_share(spark):
    def text(i, line):
        return line + " ".join(f"w{i}x{j}" for j in range(40))

    line = "shared line that few of a large host's documents have\n"
    data = [(i, text(i, line if i < 30 else ""), "en", "large", 1) for i in range(700)]
    data += [(700 + i, line, "en", "large", 1) for i in range(5)] + [(800, line + text(800, ""), "en", "small", 1)]
    docs = corpus.docs(spark, data)
    by_share, _ = line_quality.judge(docs)
    assert by_share.where("n_common_words > 0").count() == 0  # 35 of 705 documents are under 5 %
    verdicts, common = line_quality.judge(docs, max_docs=34)
    got = {r["doc_id"]: r["n_common_words"] for r in verdicts.collect()}
    assert {i for i, n in got.items() if n} == {*range(30), *range(700, 705)} and common.count() == 1
    assert line_quality.judge(docs, max_docs=35)[1].count() == 0
    cut = {r["doc_id"]: r["text"] for r in line_quality.clean(docs, max_docs=34).collect()}
    assert cut[3] == text(3, "") and cut[800] == line + text(800, "")
