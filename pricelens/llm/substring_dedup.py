"""Substring dedup by seed and extend.

Every window of ``n`` words has a winnowed anchor of ``k`` words (the seed).
Occurrences are joined on their anchors and extended both ways: first to the
whole block of windows that choose the anchor, compared by fingerprint; where
an anchor's blocks differ, one occurrence of each different block is extended
window by window, which finds the exact ends of the common passage. Neighbouring
repeated windows make up the maximal repeats, and all of their occurrences are
removed.

Equal blocks and equal windows are combined within a batch before anything is
moved, so a passage that a third of the documents share sends one record per
batch; nothing is ever compared in pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words as W
from ._anchors import SPAN, anchors, joined_spans, of_rows
from ._exchange import SCHEMA, buckets_for, exchange, groups, open_tabled, small_batches, tabled_packs
from ._shared import release, settle

_U = np.uint64
_KEY = np.dtype("<i8")
#: flag: 1 = equal blocks in the batch, 2 = different blocks in the batch
_SEED = np.dtype([("h", "<u8"), ("block", "<u8"), ("doc", "<u2"), ("a", "<u4"), ("n", "<u2"), ("flag", "u1")])
_WINDOW = np.dtype([("h", "<u8"), ("h2", "<u8"), ("doc", "<u2"), ("a", "<u4"), ("flag", "u1")])
_TOLD = np.dtype([("key", "<i8"), ("a", "<u4"), ("n", "<u4")])
_ASIDE = 1 << 62  # keys of packs that hold results: known (even) or to be extended (odd)


def _aside(rec: np.ndarray, keys: np.ndarray, odd: int, spread: int) -> pa.RecordBatch:
    told = np.zeros(len(rec), _TOLD)
    told["key"], told["a"], told["n"] = keys[rec["doc"]], rec["a"], rec["n"] if "n" in rec.dtype.names else 1
    told = np.unique(told)
    return pa.RecordBatch.from_arrays([pa.array([_ASIDE + spread % 8191 * 2 + odd] if len(told) else [], pa.int64()), pa.array([told.tobytes()] if len(told) else [], pa.binary())], names=["key", "pack"])


def _spans(key, a, n, extend: bool) -> pa.RecordBatch:
    rows = joined_spans(key, a, n)
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(rows), extend))], names=["_ll_key", "spans", "extend"])


def _told(held: list[bytes], key: int) -> pa.RecordBatch:
    told = np.frombuffer(b"".join(held), _TOLD)
    return _spans(told["key"], told["a"], told["n"], bool(key & 1))


def _opened(held: list[bytes], dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All records of a bucket and the document key of each."""
    parts = [open_tabled(p, _KEY, dtype) for p in held]
    return np.concatenate([r for _, r in parts]), np.concatenate([t[r["doc"]] for t, r in parts])


def _words(data: np.ndarray, offsets: np.ndarray, which: int = 0):
    starts, ends = W.spans(~W.BLANK[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets), W.hash_spans(data, starts, ends, which)


def repeat_spans(docs: DataFrame, n: int = 50, k: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_ll_key, spans): for each text (by the hash of its id and text) the packed
    (first window, number of windows) of its windows of ``n`` words that also
    start anywhere else, in the same text or another."""
    if not 1 <= k <= n:
        raise ValueError("an anchor must fit into a window")
    keyed = docs.select(F.xxhash64(id_col, text_col).alias("_ll_key"), F.col(text_col).alias("_ll_text"))
    size = keyed.agg(F.sum(F.octet_length("_ll_text"))).first()[0] or 0
    buckets = buckets_for(size / 6 * 2 / (n - k + 2))

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            keys, found = b.column(0).to_numpy(), []
            for first, _, data, offsets in W.runs(b.column(1)):
                _, _, at, word = _words(data, offsets)
                gram = W.mix64(W.windows(word, k))
                p, a, m, text = anchors(gram, at, n, k)
                rec = np.zeros(len(p), _SEED)
                place = W.mix64((p - a).astype(np.uint64) << _U(32) | m.astype(np.uint64))
                rec["h"], rec["block"] = gram[p], W.span_sums(word, a, a + m - 1 + n) ^ place
                rec["doc"], rec["a"], rec["n"] = text + first, a - at[text], m
                found.append(rec)
            if not found:
                continue
            rec = np.concatenate(found)
            rec = rec[np.lexsort((rec["block"], rec["h"]))]
            first_h, of_h = groups(rec["h"])
            new = np.ones(len(rec), bool)
            new[1:] = (rec["h"][1:] != rec["h"][:-1]) | (rec["block"][1:] != rec["block"][:-1])
            of_block = np.cumsum(new) - 1
            times, kinds = np.bincount(of_block)[of_block], np.bincount(of_h[new])[of_h]
            yield _aside(rec[times > 1], keys, 0, int(keys[0]) if len(keys) else 0)
            yield _aside(rec[new & (kinds > 1)], keys, 1, int(keys[0]) if len(keys) else 0)
            send = rec[first_h].copy()
            send["flag"] = np.where(kinds[first_h] > 1, 2, times[first_h] > 1)
            yield tabled_packs(send["h"], send, buckets, keys)

    def meet(key: int, held: list[bytes]) -> Iterator[pa.RecordBatch]:
        if key >= _ASIDE:
            yield _told(held, key)
            return
        rec, doc = _opened(held, _SEED)
        order = np.lexsort((rec["block"], rec["h"]))
        rec, doc = rec[order], doc[order]
        first, group = groups(rec["h"])
        several = np.bincount(group)[group] > 1
        same = np.ones(len(rec), bool)
        same[1:] = (rec["h"][1:] != rec["h"][:-1]) | (rec["block"][1:] == rec["block"][:-1])
        equal = np.minimum.reduceat(same & (rec["flag"] < 2), first)[group]
        known, extend = several & equal & (rec["flag"] == 0), several & ~equal & (rec["flag"] < 2)
        yield _spans(doc[known], rec["a"][known], rec["n"][known], False)
        yield _spans(doc[extend], rec["a"][extend], rec["n"][extend], True)

    told = settle(exchange(keyed.mapInArrow(seeds, SCHEMA), meet, "_ll_key bigint, spans binary, extend boolean"), "seeds")
    release(docs.sparkSession)
    unclear = told.where("extend").groupBy("_ll_key").agg(F.collect_set("spans").alias("spans"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            keys, ranges, found = b.column(0).to_numpy(), list(of_rows(b.column(2), SPAN)), []
            for first, end, data, offsets in W.runs(b.column(1)):
                _, _, at, word = _words(data, offsets)
                h, h2 = W.mix64(W.windows(word, n)), W.windows(_words(data, offsets, 1)[3], n)
                mine = ranges[first:end]
                count = [len(r) for r in mine]
                flat = np.concatenate(mine)
                text = np.repeat(np.arange(end - first), count)
                begin, m = at[text] + flat["a"].astype(np.int64), flat["n"].astype(np.int64)
                at_each = np.repeat(begin - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(m.sum())
                at_each = np.unique(at_each)
                own = W.text_of(at_each, at)
                rec = np.zeros(len(at_each), _WINDOW)
                rec["h"], rec["h2"], rec["doc"], rec["a"] = h[at_each], h2[at_each], own + first, at_each - at[own]
                found.append(rec)
            if not found:
                continue
            rec = np.concatenate(found)
            rec = rec[np.lexsort((rec["h2"], rec["h"]))]
            new = np.ones(len(rec), bool)
            new[1:] = (rec["h"][1:] != rec["h"][:-1]) | (rec["h2"][1:] != rec["h2"][:-1])
            times = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1]
            yield _aside(rec[times > 1], keys, 0, int(keys[0]))
            send = rec[new].copy()
            send["flag"] = times[new] > 1
            yield tabled_packs(send["h"], send, buckets, keys)

    def meet_windows(key: int, held: list[bytes]) -> Iterator[pa.RecordBatch]:
        if key >= _ASIDE:
            yield _told(held, key)
            return
        rec, doc = _opened(held, _WINDOW)
        order = np.lexsort((rec["h2"], rec["h"]))
        rec, doc = rec[order], doc[order]
        new = np.ones(len(rec), bool)
        new[1:] = (rec["h"][1:] != rec["h"][:-1]) | (rec["h2"][1:] != rec["h2"][:-1])
        group = np.cumsum(new) - 1
        hit = (np.bincount(group)[group] > 1) & (rec["flag"] == 0)
        yield _spans(doc[hit], rec["a"][hit], np.ones(int(hit.sum()), np.int64), False)

    windows = exchange(keyed.join(unclear, "_ll_key").select("_ll_key", "_ll_text", "spans").mapInArrow(extend, SCHEMA), meet_windows, "_ll_key bigint, spans binary, extend boolean")
    windows = settle(windows, "extended")
    release(docs.sparkSession)
    return told.where("not extend").unionByName(windows).groupBy("_ll_key").agg(F.collect_set("spans").alias("spans"))


def _kept(data: np.ndarray, offsets: np.ndarray, spans: list[np.ndarray], n: int):
    """(words, removed words, kept words joined by a space) of each text of a run."""
    starts, ends = W.spans(~W.BLANK[data], offsets)
    at = np.searchsorted(starts, offsets)
    step = np.zeros(len(starts) + 1, np.int64)
    flat = np.concatenate(spans)
    text = np.repeat(np.arange(len(spans)), [len(s) for s in spans])
    begin = at[text] + flat["a"].astype(np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + flat["n"].astype(np.int64) - 1 + n, -1)
    keep = np.cumsum(step[:-1]) == 0
    left = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=left[1:])
    where = W.text_of(starts, offsets)
    more = keep & (left[1:] < left[at[where + 1]])  # a kept word of the same text follows
    out, use = data.copy(), np.zeros(len(data) + 1, np.int8)
    np.add.at(use, starts[keep], 1)
    np.add.at(use, ends[keep], -1)
    use = np.cumsum(use[:-1], dtype=np.int8) > 0
    out[ends[more]] = 0x20
    use[ends[more]] = True
    total = np.zeros(len(use) + 1, np.int64)
    np.cumsum(use, out=total[1:])
    raw, cut = out[use].tobytes(), total[offsets]
    return np.diff(at), np.diff(at) - (left[at[1:]] - left[at[:-1]]), [raw[a:b] for a, b in zip(cut[:-1], cut[1:])]


def remove_repeats(docs: DataFrame, n: int = 50, k: int = 8, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_text) for every row of ``docs``: words (runs
    without ASCII white space) that lie in a window of ``n`` words which also
    starts elsewhere are removed; the kept ones are joined by one space.

    With ``digest`` the kept text's SHA-256 (kept_sha256) comes instead of it.
    Null texts have no words; texts with fewer than ``n`` words stay whole, and
    so does a text without a repeat; of repeated rows all copies lose their
    common windows. Null ids are allowed. An empty table gives an empty result.
    Other columns are not read.
    """
    spans = repeat_spans(docs, n, k, id_col, text_col)
    keyed = docs.select(F.xxhash64(id_col, text_col).alias("_ll_key"), F.col(id_col).alias("_ll_id"), F.col(text_col).alias("_ll_text"))
    last = "kept_sha256" if digest else "kept_text"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, got = list(of_rows(b.column(2), SPAN)), ([], [], [])
            for first, end, data, offsets in W.runs(b.column(1)):
                for x, y in zip(got, _kept(data, offsets, lists[first:end], n)):
                    x.extend(y)
            kept = [hashlib.sha256(t).hexdigest() for t in got[2]] if digest else [t.decode() for t in got[2]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()), pa.array(kept, pa.string())], names=["_ll_id", "n_words", "n_removed", last])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = keyed.join(spans, "_ll_key", "left").select("_ll_id", "_ll_text", "spans").mapInArrow(cut, f"_ll_id {id_type}, n_words bigint, n_removed bigint, {last} string")
    return out.withColumnRenamed("_ll_id", id_col)
