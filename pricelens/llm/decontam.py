"""Benchmark decontamination with DataFrame functions only.

Benchmark texts are cut into windows of normalised words. Each window is filed
under one of its words, the one that fewest windows hold; the hash set of these
is broadcast (its size is checked first; beyond the bound the same join is
shuffled). Every document is cut into words once; a word found in the set places
its windows over the document, each placed window is verified word by word, and
hit words or hit documents are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import join_null_safe, settle

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word with what stands before it, on text that is not lower-cased yet.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*+[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
TAIL = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows, and bytes of their words and item ids, that are sent to every executor at most.
BROADCAST_WINDOWS, BROADCAST_BYTES = 200_000, 64 << 20


def words(text: Column) -> Column:
    """Normalised words: A-Z lower-cased, runs of letters, digits and non-ASCII
    characters; a null text has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def _barrier(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` computed once per row: a one-element generator that the
    optimizer does not inline into later expressions (such as lambdas)."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def benchmark_windows(benchmark: DataFrame, n: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(_ll_m, _ll_gram, _ll_items): the distinct windows of the items.

    An item of fewer than ``n`` words, but not none, is one window. A null id
    counts as the string ``null``.
    """
    w = _barrier(benchmark, F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("_ll_item"), words(F.col(text_col)).alias("_ll_words"))
    w = w.where(F.size("_ll_words") > 0).withColumn("_ll_m", F.least(F.size("_ll_words"), F.lit(n)))
    w = w.select("_ll_item", "_ll_words", "_ll_m", F.explode(F.sequence(F.lit(1), F.size("_ll_words") - F.col("_ll_m") + 1)).alias("_ll_pos"))
    return (w.select("_ll_item", "_ll_m", F.slice("_ll_words", F.col("_ll_pos"), F.col("_ll_m")).alias("_ll_gram"))
            .groupBy("_ll_m", "_ll_gram").agg(F.collect_set("_ll_item").alias("_ll_items")))


def anchored(grams: DataFrame) -> DataFrame:
    """The windows with ``_ll_word``, the word under which each is filed, and
    ``_ll_offset``, its place in the window (from 0). The word is the one that
    fewest windows hold; of those the longest, then the first in code-point order."""
    placed = grams.select("_ll_m", "_ll_gram", F.posexplode("_ll_gram").alias("_ll_offset", "_ll_word"))
    spread = placed.groupBy("_ll_word").agg(F.count(F.lit(1)).alias("_ll_in"))
    best = F.min(F.struct("_ll_in", (-F.length("_ll_word")).alias("l"), "_ll_word", "_ll_offset"))
    chosen = placed.join(spread, "_ll_word").groupBy("_ll_m", "_ll_gram").agg(best.alias("_ll_b"))
    return grams.join(chosen, ["_ll_m", "_ll_gram"]).select("_ll_m", "_ll_gram", "_ll_items", "_ll_b._ll_word", "_ll_b._ll_offset")


def _text_key(id_col: str, text_col: str) -> list[Column]:
    """Identity of a row's content: rows alike in both have the same result."""
    return [F.col(id_col).alias("_ll_id"), F.xxhash64(F.col(text_col)).alias("_ll_text")]


KEY = ["_ll_id", "_ll_text"]


def _found(docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, item_id_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """(hits, counts) from one pass over the texts: hits as :func:`window_hits` says,
    counts (_ll_id, _ll_text, _ll_n), one or more alike a text."""
    grams = settle(anchored(benchmark_windows(benchmark, n, item_id_col, item_text_col)), "benchmark-windows")
    size = grams.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.concat_ws(" ", "_ll_gram")) + F.octet_length(F.concat_ws(" ", "_ll_items"))).alias("bytes")).first()
    small = size["n"] <= BROADCAST_WINDOWS and (size["bytes"] or 0) <= BROADCAST_BYTES
    probes = grams.select(F.col("_ll_word").alias("_ll_anchor"), "_ll_offset", "_ll_m", "_ll_gram", "_ll_items")
    d = _barrier(docs, *_text_key(id_col, text_col), words(F.col(text_col)).alias("_ll_words"))
    listed = F.col("_ll_words")
    if small:
        # the empty string, which no word is, ends each document: its place tells the number of words
        none = F.array().cast("array<string>")
        end = docs.sparkSession.range(1).select(F.lit("").alias("_ll_anchor"), F.lit(0).alias("_ll_offset"), F.lit(0).alias("_ll_m"), none.alias("_ll_gram"), none.alias("_ll_items"))
        probes, listed = F.broadcast(probes.unionByName(end)), F.concat(listed, F.array(F.lit("")))
    w = d.select(*KEY, "_ll_words", F.posexplode(listed).alias("_ll_at", "_ll_w"))
    first = F.col("_ll_at") - F.col("_ll_offset")
    hit = w.join(probes, (F.col("_ll_w") == F.col("_ll_anchor")) & (first >= 0)
                 & (F.slice("_ll_words", F.greatest(first + 1, F.lit(1)), F.col("_ll_m")) == F.col("_ll_gram")))
    found = settle(hit.select(*KEY, (first + 1).alias("_ll_pos"), "_ll_m", "_ll_items"), "window-hits")
    if small:
        counts = found.where("_ll_m = 0").select(*KEY, (F.col("_ll_pos") - 1).cast("long").alias("_ll_n"))
    else:
        counts = docs.select(*_text_key(id_col, text_col), F.size(words(F.col(text_col))).cast("long").alias("_ll_n"))
    return found.where("_ll_m > 0"), counts


def window_hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(_ll_id, _ll_text, _ll_pos, _ll_m, _ll_items): every verified hit, 1-based.

    The result is settled in the shared folder; it is as large as the
    contamination, not as the corpus, but for one short row a document.
    """
    return _found(docs, benchmark, n, id_col, text_col, item_id_col, item_text_col)[0]


def hit_words(hits: DataFrame) -> DataFrame:
    """(_ll_id, _ll_text, _ll_at): the distinct document words inside a hit."""
    return hits.select(*KEY, F.explode(F.sequence(F.col("_ll_pos"), F.col("_ll_pos") + F.col("_ll_m") - 1)).alias("_ll_at")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its columns plus n_words, n_hit, items (sorted ids as
    strings), n_items and contaminated.

    Null and empty texts have no words and no hits; repeated rows each get the
    same result; an empty benchmark hits nothing. Input columns named like an
    output column are replaced.
    """
    hits, counts = _found(docs, benchmark, n, id_col, text_col, item_id_col, item_text_col)
    n_hit = hit_words(hits).groupBy(*KEY).agg(F.count(F.lit(1)).alias("_ll_n_hit"))
    items = (hits.select(*KEY, F.explode("_ll_items").alias("_ll_item")).groupBy(*KEY)
             .agg(F.array_sort(F.collect_set("_ll_item")).alias("_ll_items")))
    kept = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "n_items", "contaminated")]
    base = docs.select(*kept, *_text_key(id_col, text_col))
    known = counts.groupBy(*KEY).agg(F.max("_ll_n").alias("n_words"))
    out = join_null_safe(join_null_safe(base, known, KEY), join_null_safe(n_hit, items, KEY), KEY, "left")
    found = F.coalesce("_ll_items", F.array().cast("array<string>"))
    hit = F.coalesce("_ll_n_hit", F.lit(0)).cast("long")
    return out.select(*kept, "n_words", hit.alias("n_hit"), found.alias("items"), F.size(found).cast("long").alias("n_items"), (hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents", id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without hit documents (``remove="documents"``), or with the hit
    words and the separators before them cut from the texts (``"spans"``).

    Rows without a hit stay as they are, null texts included.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    hits = window_hits(docs, benchmark, n, id_col, text_col, item_id_col, item_text_col)
    base = docs.select("*", *_text_key(id_col, text_col))
    if remove == "documents":
        hit_docs = hits.select(*KEY).distinct().withColumn("_ll_hit", F.lit(True))
        return join_null_safe(base, hit_docs, KEY, "left").where(F.col("_ll_hit").isNull()).select(*docs.columns)
    spans = hit_words(hits).groupBy(*KEY).agg(F.collect_set("_ll_at").alias("_ll_cut"))
    both = join_null_safe(base, spans, KEY, "left")
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(PIECE), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.array_contains("_ll_cut", i + 1))
    cut = F.concat(F.array_join(kept, ""), F.regexp_extract(F.col(text_col), TAIL, 0))
    return both.select(*[F.when(F.col("_ll_cut").isNull(), F.col(c)).otherwise(cut).alias(c) if c == text_col else c for c in docs.columns])
