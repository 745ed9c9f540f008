"""Small tables with the awkward rows: nulls in every column, empty and very
long texts, ties, repeated rows, hot groups and clashing column names."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use for their own output columns.
CLASHING = ["size", "target", "copies", "source_size", "n_words", "n_hit", "items", "score", "kept", "start", "path", "block", "h", "ordinal", "component_id", "n_removed", "kept_text"]


def rows(seed=1, n=90):
    r = random.Random(seed)
    vocabulary = ["the", "a", "of", "wort", "été", "naïve", "日本", "x"] + ["".join(r.choices("abcdeé", k=r.randint(2, 7))) for _ in range(150)]
    def prose(k):
        return "".join(r.choice(vocabulary).capitalize() if r.random() < .1 else r.choice(vocabulary) for _ in [0]) + "".join(
            r.choice([" ", " ", " ", " ", ", ", ". ", "\n", "  ", "\t"]) + r.choice(vocabulary) for _ in range(k - 1))
    out = [(i, prose(r.randint(20, 160)), "en", f"src{r.randint(0, 3)}" if i % 3 else "hot", 10) for i in range(n)]
    passage, line = prose(60), " ".join(r.choices(vocabulary, k=9))
    for i in range(0, n, 4):  # a passage that many documents share, and copies with edits
        out[i] = (*out[i][:1], out[i][1] + "\n" + passage + "\n" + prose(15), *out[i][2:])
    for i in range(1, n, 9):
        w = out[1][1].split(" ")
        w[i % len(w)] = "edited"
        out[i] = (i, " ".join(w), *out[i][2:])
    for i in range(2, n, 5):
        out[i] = (*out[i][:1], line + "\n" + out[i][1] + "\n" + line.upper(), *out[i][2:])
    out += [
        (1000, None, None, None, None), (1001, "", "en", "hot", 0), (1002, " \t\n", "en", "src1", 3), (1003, "one", None, "src1", None), (1004, "one", "en", None, 3),
        (1005, prose(6000), "en", "hot", 1), (1006, "y" * 30000, "en", "src2", 2), (1007, "same " * 400, "en", "src2", 3), (1008, "two words", "en", "src2", 9),
        (1009, "TWO words !? it's <|endoftext|> 12ab «é» …", "fr", "src2", 9), (1010, out[3][1], "en", "hot", 1), (1011, out[3][1], "en", "hot", 1),
        (1012, "a\n\nb\nb\n a\nB \n", "en", "src1", 5), (1013, "\n".join(["é " * 12] * 30), "fr", "src1", 5), (1014, "\U0001F600 \U0001F600x" * 40, "en", "src3", 7)]
    return out


def docs(spark, data=None, extra=True):
    df = spark.createDataFrame(rows() if data is None else data, DOCS)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])
    return df


def by_id(df, *columns):
    """{doc_id: row} of the wanted columns; a repeated id keeps a list."""
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns))
    return out
