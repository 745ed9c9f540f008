"""Quality rules with cross-document line frequency.

Every line is normalised (A-Z lower-cased, white space collapsed) and hashed;
for each host the distinct documents of a line are counted; a line found in
more than ``max_share`` of a host's documents (and in more than ``min_docs``),
or in more than ``max_docs`` of them whatever their share, is boilerplate and
is removed; a document is rejected when too little is left of it, or when it
fails the base rules.

One pass in numpy over the texts gives counts and line hashes; counting,
limits and verdicts are joins and aggregations over those. A line that a third
of a host shares is counted with partial aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words as W
from ._shared import join_null_safe, settle

MAX_SHARE, MIN_DOCS = 0.05, 10
MIN_LEFT_SHARE, MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 0.3, 20, 30, 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_HIGH = np.arange(256) & 0xC0 != 0x80  # the first byte of each code point


def line_hashes(low: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(line starts, line ends, first word of each line and one past its last,
    hash of its lower-cased words) of all lines."""
    new = np.flatnonzero(low == 0x0A)
    begin = np.unique(np.concatenate([offsets[:-1], new + 1]))
    text = W.text_of(begin, offsets)
    # a line may start at the end of a run, or at the place where its text ends
    keep = begin < offsets[-1]
    begin, text = begin[keep], text[keep]
    nxt = np.searchsorted(new, begin)
    stop = np.where(nxt < len(new), new[np.minimum(nxt, max(len(new) - 1, 0))] if len(new) else 0, offsets[-1])
    stop = np.minimum(stop, offsets[text + 1])
    first, last = np.searchsorted(starts, begin), np.searchsorted(starts, stop)
    word = W.hash_spans(low, starts, ends)
    return begin, stop, first, last, W.span_sums(word, first, last), text, word


def profile(texts: pa.Array, window: int = WINDOW) -> Iterator[dict[str, np.ndarray | list]]:
    """Counts and distinct lines of each text, run by run."""
    for first, end, data, offsets in W.runs(texts):
        n = end - first
        inside = ~W.BLANK[data]
        starts, ends = W.spans(inside, offsets)
        at = np.searchsorted(starts, offsets)  # words before each text
        low = W.LOWER[data]
        begin, stop, w0, w1, h, text, _ = line_hashes(low, offsets, starts, ends)
        word = W.hash_spans(data, starts, ends)
        with_words = w1 > w0
        raw = W.hash_spans(data, begin, stop)[with_words]
        line_text = text[with_words]
        dup = np.bincount(line_text, minlength=n) - _distinct(raw, line_text, n)
        win = W.windows(word, window)
        where = W.text_of(starts[:len(win)], offsets)
        whole = np.arange(len(win)) + window <= at[where + 1]
        key = (win ^ W.mix64(where.astype(np.uint64)))[whole]
        marks = np.flatnonzero(whole)[W.repeated(key)]
        # distinct normalised lines: hash, words in it, times it occurs
        hash_, words_ = h[with_words], (w1 - w0)[with_words]
        order = np.lexsort((hash_, line_text))
        t, hh, ww = line_text[order], hash_[order], words_[order]
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (hh[1:] != hh[:-1])
        begin_of = np.flatnonzero(fresh)
        times = np.diff(np.append(begin_of, len(t)))
        per = np.searchsorted(t[begin_of], np.arange(n + 1))
        yield {
            "n_words": np.diff(at), "word_chars": W.per_text(inside & _HIGH[data], offsets),
            "n_symbols": W.per_text(_SYMBOL[data], offsets), "n_dup_lines": dup,
            "n_repeat_words": W.per_text(W.covered(marks, window, len(starts)), at),
            "lines": (per, hh[begin_of].view(np.int64), ww[begin_of] * times),
        }


def _distinct(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return np.bincount(t[fresh], minlength=n)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_LINE = pa.struct([("h", pa.int64()), ("w", pa.int64())])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        parts = list(profile(batch.column(0)))
        if not parts:
            continue
        counts = [pa.array(np.concatenate([p[c] for p in parts]).astype(np.int64)) for c in _COUNTS]
        offset, offsets = 0, [np.zeros(1, np.int64)]
        for p in parts:
            offsets.append(p["lines"][0][1:] + offset)
            offset += p["lines"][0][-1]
        items = pa.StructArray.from_arrays([pa.array(np.concatenate([p["lines"][i] for p in parts]).astype(np.int64)) for i in (1, 2)], fields=list(_LINE))
        lines = pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), items)
        row = pa.array((part << 33) + seen + np.arange(len(batch), dtype=np.int64))
        seen += len(batch)
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], row, *counts, lines], names=[*batch.schema.names[1:], "_ll_row", *_COUNTS, "_ll_lines"])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, min_left_share: float = MIN_LEFT_SHARE, max_docs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(verdicts, common lines).

    Verdicts, one per row of ``docs``: the id, the host, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, n_common_words (words in removed
    lines), base_failed and kept. Common lines: (_ll_host, _ll_line).

    The bar of ``max_share`` rises with the host; ``max_docs`` is a limit that
    does not: with it a line of a large host needs no share. Without it (the
    rule that the SQL states) only the share counts. ``min_docs`` bounds the
    share alone: each line of a host's only document is in all of its documents.

    Null and empty texts have no words and fail the base rules. Null hosts are
    one host. Repeated rows are documents of their own. An empty table gives
    empty results. Other columns of ``docs`` are not read.
    """
    narrow = docs.select(F.col(text_col).alias("_ll_text"), F.col(id_col).alias("_ll_id"), F.col(host_col).alias("_ll_host"))
    types = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    schema = f"_ll_id {types['_ll_id']}, _ll_host {types['_ll_host']}, _ll_row bigint, {', '.join(f'{c} bigint' for c in _COUNTS)}, _ll_lines array<struct<h: bigint, w: bigint>>"
    prof = settle(narrow.mapInArrow(_profiles, schema), "line-profiles")
    lines = prof.select("_ll_row", "_ll_host", F.explode("_ll_lines").alias("_ll_l")).select("_ll_row", "_ll_host", F.col("_ll_l.h").alias("_ll_line"), F.col("_ll_l.w").alias("_ll_w"))
    hosts = prof.groupBy("_ll_host").agg(F.count(F.lit(1)).alias("_ll_docs"))
    found = lines.groupBy("_ll_host", "_ll_line").agg(F.count(F.lit(1)).alias("_ll_in")).where(F.col("_ll_in") > (min_docs if max_docs is None else min(min_docs, max_docs)))
    often = (F.col("_ll_in") > min_docs) & (F.col("_ll_in") > F.col("_ll_docs") * F.lit(float(max_share)))
    if max_docs is not None:
        often = often | (F.col("_ll_in") > max_docs)
    common = settle(join_null_safe(found, hosts, ["_ll_host"]).where(often).select("_ll_host", "_ll_line"), "common-lines")
    lost = (join_null_safe(lines, common.withColumn("_ll_hit", F.lit(True)), ["_ll_host", "_ll_line"])
            .groupBy("_ll_row").agg(F.sum("_ll_w").alias("_ll_lost")))
    out = prof.drop("_ll_lines").join(lost, "_ll_row", "left").withColumn("_ll_lost", F.coalesce("_ll_lost", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    left = F.col("n_words") - F.col("_ll_lost")
    depleted = (F.col("_ll_lost") > 0) & ((left < MIN_WORDS) | (left < F.col("n_words") * F.lit(float(min_left_share))))
    return out.select(F.col("_ll_id").alias(id_col), F.col("_ll_host").alias(host_col), *_COUNTS, F.col("_ll_lost").alias("n_common_words"),
                      failed.alias("base_failed"), (~failed & ~depleted).alias("kept")), common


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, cuts, out = batch.column(batch.schema.get_field_index("_ll_text")), batch.column(batch.schema.get_field_index("_ll_cut")), []
        for i, text in enumerate(texts):
            text, cut = text.as_py(), cuts[i].as_py()
            if text and cut:
                (first, end, data, offsets), = W.runs(pa.array([text]))
                starts, ends = W.spans(~W.BLANK[data], offsets)
                begin, stop, w0, w1, h, _, _ = line_hashes(W.LOWER[data], offsets, starts, ends)
                gone = (w1 > w0) & np.isin(h.view(np.int64), np.array(cut, np.int64))
                if gone.any():
                    raw = data.tobytes()
                    left = [raw[a:b] for a, b, g in zip(begin, stop, gone) if not g]
                    text = b"\n".join(left + [b""] * raw.endswith(b"\n")).decode()
            out.append(text)
        names = [n for n in batch.schema.names if n != "_ll_cut"]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == "_ll_text" else batch.column(batch.schema.get_field_index(n)) for n in names], names=names)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The kept documents, with the common lines cut from their texts."""
    key = ["_ll_id", "_ll_host", "_ll_key"]
    keyed = docs.select("*", F.col(id_col).alias("_ll_id"), F.col(host_col).alias("_ll_host"), F.xxhash64(text_col).alias("_ll_key"))
    marked = keyed.select(F.struct(*[F.col(k).alias(k) for k in key]).alias("_ll_who"), F.col(text_col).alias("_ll_t"), F.col(host_col).alias("_ll_h"))
    verdicts, common = judge(marked, "_ll_who", "_ll_t", "_ll_h", **limits)
    kept = verdicts.where("kept").select("_ll_who.*").distinct().withColumn("_ll_kept", F.lit(True))
    kept = join_null_safe(kept, common.groupBy("_ll_host").agg(F.collect_set("_ll_line").alias("_ll_cut")), ["_ll_host"], "left")
    both = join_null_safe(keyed, kept, key).drop(*key, "_ll_kept")
    names = docs.columns
    both = both.select(*[F.col(c).alias("_ll_text") if c == text_col else F.col(c) for c in names], "_ll_cut")
    schema = ", ".join(f"`{'_ll_text' if f.name == text_col else f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return both.mapInArrow(_without, schema).select(*[F.col("_ll_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in names])
