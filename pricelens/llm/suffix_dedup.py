"""Suffix-array dedup of exact byte substrings by a distributed merge sort.

The suffixes are those at winnowed anchors: every window of ``n`` bytes has one
anchor of ``k`` bytes, equal windows have it at the same place, so the suffixes
at anchors, with what stands to their left, decide every window. (All suffixes
of the corpus would be fourteen times as many, each with up to ``n`` bytes.)

1. Anchors that occur in one document only cannot begin a shared window; a
   first exchange of 32-bit fingerprints finds the others, and those that would
   send more than ``hot_rows`` different blocks to one merge.
2. A task sorts its remaining suffixes (right context, then the left context
   backwards) and sends, for each part of the key space, one sorted run,
   front-coded: for each suffix the length that it shares with the one before
   and the rest.
3. Runs are merged with a loser tree that keeps each suffix's common prefix
   with the last output and compares from there on only. Equal neighbours are
   equal blocks of windows; in a range of suffixes that share the anchor but
   differ later, windows are told apart by left and right context.

4. Where a passage that many documents share begins or ends, the blocks reach
   into each document's own text and no two are equal. The windows of such hot
   anchors are sent one by one instead, dealt by their own 128-bit hash.

Suffixes (and windows) that are equal in a task are sent once for the smallest
document, so a passage that a third of the documents share costs one suffix per
batch, and an anchor brings at most ``hot_rows`` blocks (a millionth of all
anchors, if that is more) and their repeats within a document to a merge.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words as W
from ._anchors import SPAN, anchors, by_key, joined_spans, of_rows
from ._exchange import SCHEMA, buckets_for, exchange, groups, open_tabled, small_batches, tabled_packs
from ._shared import release, settle

_U = np.uint64
_KEY = np.dtype("<i8")
#: much: different blocks in the batch, the top bit for several documents
_FINGER = np.dtype([("h", "<u4"), ("doc", "<u2"), ("much", "<u2")])
_SEVERAL = 1 << 15
_HOT = np.dtype([("name", "<u8"), ("rows", "<i8")])
_WINDOW = np.dtype([("h", "<u8"), ("h2", "<u8"), ("doc", "<u2"), ("a", "<u4")])
_DOC = np.dtype([("key", "<i8"), ("id", "<i8")])
_REF = np.dtype([("doc", "<u2"), ("p", "<u4"), ("lcp", "u1")])
_TOLD = np.dtype([("key", "<i8"), ("a", "<u4"), ("n", "<u4")])
_SEEN = np.dtype([("key", "<i8"), ("h", "<u4")])
_WINDOWS, _ASIDE = 1 << 61, 1 << 62  # keys of packs that hold windows, and results
#: Documents whose suffixes are sorted into one run (some 5 to 10 MB of text).
BATCH_ROWS = 2048
#: Different blocks of an anchor that one merge takes, and windows sent at a time.
HOT_ROWS, SEND_WINDOWS = 2048, 1 << 20
#: Stands for a null id: larger than any other.
NO_ID = np.iinfo(np.int64).max


def byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of all runs of ``k`` bytes."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    up, down = W._POWERS[0].upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(W._BYTES[0][data] * up[:len(data)], out=total[1:])
    return W.mix64((total[k:] - total[:-k]) * down[:len(data) + 1 - k])


def _finger(h: np.ndarray, buckets: int) -> np.ndarray:
    """The 32 bits after those that name the bucket."""
    return ((h << _U(int(buckets).bit_length() - 1)) >> _U(32)).astype(np.uint32)


def _name(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bits that name the bucket, and the 32 after them."""
    return h >> _U(65 - int(buckets).bit_length()) << _U(32) | _finger(h, buckets).astype(np.uint64)


def _aside(told: np.ndarray, spread: int) -> pa.RecordBatch:
    told = np.unique(told)
    return pa.RecordBatch.from_arrays([pa.array([_ASIDE + spread % 8191] if len(told) else [], pa.int64()), pa.array([told.tobytes()] if len(told) else [], pa.binary())], names=["key", "pack"])


def _hashes(keys: np.ndarray, records: np.ndarray, hot: bool) -> pa.RecordBatch:
    rows = by_key(keys, np.ascontiguousarray(records))
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(rows), hot))], names=["_ll_key", "spans", "hot"])


def shared_anchors(keyed: DataFrame, n: int, k: int, buckets: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(_ll_key, hot, hashes): fingerprints of each document's anchors that occur
    in another document too (a few more, where fingerprints collide). Rows with
    ``hot`` are no documents: their hashes are the names of anchors that have
    more than ``hot_rows`` blocks that differ within their batches."""

    def fingers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, BATCH_ROWS):
            keys, hashes, blocks, docs = b.column(0).to_numpy(), [], [], []
            for first, _, data, offsets in W.runs(b.column(2)):
                gram = byte_grams(data, k)
                p, a, m, text = anchors(gram, offsets, n, k)
                hashes.append(W.mix64(gram[p]))  # the chosen ones are small: mixed again, they are dealt evenly
                blocks.append(W.hash_spans(data, a, a + m - 1 + n, 1) ^ W.mix64((p - a).astype(np.uint64) << _U(32) | m.astype(np.uint64)))
                docs.append(text + first)
            if not hashes:
                continue
            h, block, doc = np.concatenate(hashes), np.concatenate(blocks), np.concatenate(docs)
            order = np.lexsort((block, h))
            h, block, doc = h[order], block[order], doc[order]
            new, group = groups(h)
            if not len(h):
                continue
            many = np.maximum.reduceat(doc, new) > np.minimum.reduceat(doc, new)
            mine = many[group]
            seen = np.zeros(int(mine.sum()), _SEEN)
            seen["key"], seen["h"] = keys[doc[mine]], _finger(h[mine], buckets)
            yield _aside(seen, int(keys[0]))
            send = np.zeros(len(new), _FINGER)
            other = np.ones(len(h), np.int64)
            other[1:] = (h[1:] != h[:-1]) | (block[1:] != block[:-1])
            send["h"], send["doc"] = _finger(h[new], buckets), doc[new]
            send["much"] = np.minimum(np.add.reduceat(other, new), _SEVERAL - 1) | many * _SEVERAL
            yield tabled_packs(h[new], send, buckets, keys)

    def meet(key: int, held: list[bytes]) -> Iterator[pa.RecordBatch]:
        if key >= _ASIDE:
            seen = np.frombuffer(b"".join(held), _SEEN)
            yield _hashes(seen["key"], seen["h"], False)
            return
        parts = [open_tabled(p, _KEY, _FINGER) for p in held]
        rec, doc = np.concatenate([r for _, r in parts]), np.concatenate([t[r["doc"]] for t, r in parts])
        order = np.argsort(rec["h"], kind="stable")
        first, group = groups(rec["h"][order])
        hit = order[(np.bincount(group)[group] > 1) & (rec["much"][order] < _SEVERAL)]
        yield _hashes(doc[hit], rec["h"][hit], False)
        rows = np.add.reduceat((rec["much"][order] & (_SEVERAL - 1)).astype(np.int64), first)
        hot = np.zeros(int((rows > hot_rows).sum()), _HOT)
        hot["name"], hot["rows"] = _U(key << 32) | rec["h"][order[first[rows > hot_rows]]].astype(np.uint64), rows[rows > hot_rows]
        yield _hashes(np.full(len(hot), key), hot, True)

    found = exchange(keyed.mapInArrow(fingers, SCHEMA), meet, "_ll_key bigint, spans binary, hot boolean")
    return settle(found.groupBy("_ll_key", "hot").agg(F.collect_set("spans").alias("hashes")), "shared-anchors")


def _block_matrix(data: np.ndarray, p: np.ndarray, a: np.ndarray, m: np.ndarray, n: int, k: int) -> np.ndarray:
    """A row per anchor: the bytes from it on, those before it backwards (both as
    far as its windows reach, then zeros), and how many windows and left bytes."""
    w = n - k + 1
    out = np.zeros((len(p), n + w - 1 + 2), np.uint8)
    right, left = a + m - 1 + n - p, p - a
    at = p[:, None] + np.arange(n)
    out[:, :n] = np.where(np.arange(n) < right[:, None], data[np.minimum(at, len(data) - 1)], 0)
    at = p[:, None] - 1 - np.arange(w - 1)
    out[:, n:n + w - 1] = np.where(np.arange(w - 1) < left[:, None], data[np.maximum(at, 0)], 0)
    out[:, -2], out[:, -1] = m, left
    return out


def front_code(sorted_rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(length shared with the row before, all the rests) of sorted rows."""
    width = sorted_rows.shape[1]
    shared = np.zeros(len(sorted_rows), np.uint8)
    if len(sorted_rows) > 1:
        differ = sorted_rows[1:] != sorted_rows[:-1]
        shared[1:] = np.where(differ.any(1), differ.argmax(1), width)
    return shared, sorted_rows[np.arange(width) >= shared[:, None]].tobytes()


class FrontCoded:
    """A front-coded run that is read once from its start; ``last`` is the string
    read last, and only that one is held."""

    def __init__(self, shared: list[int], rests: bytes, width: int):
        self.shared, self.rests, self.width, self.last, self.at = shared, rests, width, b"", 0

    def __len__(self) -> int:
        return len(self.shared)

    def __getitem__(self, i: int) -> bytes:
        rest = self.width - self.shared[i]
        if rest:
            self.last = self.last[:self.width - rest] + self.rests[self.at:self.at + rest]
            self.at += rest
        return self.last


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, prefix shared with the output before) in sorted order.

    A loser tree in which each head carries its common prefix with the last
    output. The head with the longer prefix is the smaller one; only heads with
    equal prefixes are compared, from that length on.
    """
    runs = [r for r in runs if r[0]] or [([], [])]
    size = 1 << max(0, len(runs) - 1).bit_length()
    head = [r[0][0] if r[0] else None for r in runs] + [None] * (size - len(runs))
    have, place, losers = [0] * size, [0] * size, [0] * size
    width = len(head[0]) if head[0] is not None else 0

    def play(x: int, y: int) -> tuple[int, int]:
        a, b = head[x], head[y]
        if a is None:
            return y, x
        if b is None or have[x] > have[y]:
            return x, y
        if have[x] < have[y]:
            return y, x
        i = have[x]
        while i < width and a[i:i + 16] == b[i:i + 16]:
            i += 16
        if i >= width:
            have[y] = width
            return x, y
        d = int.from_bytes(a[i:i + 16], "big") ^ int.from_bytes(b[i:i + 16], "big")
        chunk = min(16, width - i)
        i += chunk - (d.bit_length() + 7) // 8
        if a[i] < b[i]:
            have[y] = i
            return x, y
        have[x] = i
        return y, x

    level = list(range(size))
    start = size
    while len(level) > 1:
        start //= 2
        nxt = []
        for i in range(0, len(level), 2):
            win, lose = play(level[i], level[i + 1])
            losers[start + i // 2] = lose
            nxt.append(win)
        level = nxt
    win = level[0]
    lists, shared, lengths = [r[0] for r in runs], [r[1] for r in runs], [len(r[0]) for r in runs]
    while head[win] is not None:
        at = place[win]
        yield win, at, have[win]
        at += 1
        place[win] = at
        if at < lengths[win]:
            head[win], have[win] = lists[win][at], shared[win][at]
        else:
            head[win], have[win] = None, 0
        node = (win + size) // 2
        while node:
            win, losers[node] = play(win, losers[node])
            node //= 2


def _smaller_windows(rows: np.ndarray, group: np.ndarray, least: np.ndarray, n: int, k: int) -> np.ndarray:
    """For each distinct block and each number of left bytes of a window: the
    smallest id of a document with the same window among the blocks of its group
    (NO_ID where the block has no such window)."""
    w = n - k + 1
    up = W._POWERS[1].upto(n + w)[0]
    value = W._BYTES[1][rows[:, :n + w - 1]]
    right = np.cumsum(value[:, :n] * up[:n], axis=1)
    left = np.zeros((len(rows), w), np.uint64)
    np.cumsum(value[:, n:] * up[:w - 1], axis=1, out=left[:, 1:])
    windows, most = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    out = np.full((len(rows), w), NO_ID)
    for j in range(w):
        row = np.flatnonzero((most >= j) & (most - windows < j))
        if not len(row):
            continue
        key = W.mix64(W.mix64(right[row, n - j - 1]) + left[row, j]) ^ W.mix64(group[row].astype(np.uint64))
        order = np.argsort(key, kind="stable")
        first, of = groups(key[order])
        out[row[order], j] = np.minimum.reduceat(least[row][order], first)[of]
    return out


def _neighbours(key: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Windows of documents as spans, neighbours joined."""
    order = np.lexsort((a, key))
    key, a = key[order], a[order].astype(np.int64)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (a[1:] != a[:-1] + 1)
    first = np.flatnonzero(new)
    told = np.zeros(len(first), _TOLD)
    told["key"], told["a"], told["n"] = key[first], a[first], np.diff(np.append(first, len(key)))
    return told


def _least_ids(h: np.ndarray, h2: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by window, and in it the smallest id of each one's window."""
    order = np.lexsort((ids, h2, h))
    h, h2, ids = h[order], h2[order], ids[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (h2[1:] != h2[:-1])
    return order, ids[np.flatnonzero(new)][np.cumsum(new) - 1]


def _send_windows(rec: np.ndarray, table: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Each window for its smallest document, and the results for the others."""
    ids = table["id"][rec["doc"]]
    order, least = _least_ids(rec["h"], rec["h2"], ids)
    later = ids[order] > least
    mine = rec[order[later]]
    yield _aside(_neighbours(table["key"][mine["doc"]], mine["a"]), int(table["key"][0]))
    send = rec[order[~later]]
    dealt = tabled_packs(send["h"], send, buckets, table)
    yield pa.RecordBatch.from_arrays([pa.array(dealt.column(0).to_numpy() + _WINDOWS), dealt.column(1)], names=["key", "pack"])


def _meet_windows(held: list[bytes]) -> pa.RecordBatch:
    parts = [open_tabled(p, _DOC, _WINDOW) for p in held]
    rec, who = np.concatenate([r for _, r in parts]), np.concatenate([t[r["doc"]] for t, r in parts])
    order, least = _least_ids(rec["h"], rec["h2"], who["id"])
    later = order[who["id"][order] > least]
    return joined_spans(who["key"][later], rec["a"][later], np.ones(len(later), np.int64))


def _dealt(docs: DataFrame, n: int, k: int, id_col: str, text_col: str, hot_rows: int) -> DataFrame:
    """(key, pack): the runs of each part of the key space, the windows of hot
    anchors and, aside, what a batch decides by itself."""
    import zstandard

    if not 1 <= k <= n or 2 * n - k + 2 > 255:
        raise ValueError("an anchor must fit into a window, and a block into 255 bytes")
    w, width = n - k + 1, 2 * n - k + 2
    keyed = docs.select(F.xxhash64(id_col, text_col).alias("_ll_key"), F.col(id_col).cast("bigint").alias("_ll_id"), F.col(text_col).alias("_ll_text"))
    size = keyed.agg(F.sum(F.octet_length("_ll_text"))).first()[0] or 0
    buckets = buckets_for(size * 2 / (w + 1)) // 2
    parts = buckets  # of the key space: a merge holds the strings of one part
    hot_rows = max(hot_rows, int(size * 2 / (w + 1)) >> 20)  # a million hot anchors at most
    shared = shared_anchors(keyed, n, k, buckets, hot_rows)
    release(docs.sparkSession)
    hot = np.concatenate([np.zeros(0, _HOT), *[np.frombuffer(x, _HOT) for r in shared.where("hot").select("hashes").collect() for x in r["hashes"]]])
    names, window_buckets = np.sort(hot["name"]), buckets_for(int(hot["rows"].sum()) * w)

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=1)
        for b in small_batches(batches, BATCH_ROWS):
            table, found, windows = np.zeros(len(b), _DOC), [], []
            table["key"], table["id"] = b.column(0).to_numpy(), b.column(1).fill_null(NO_ID).to_numpy()
            wanted = list(of_rows(b.column(3), np.dtype("<u4")))
            for first, end, data, offsets in W.runs(b.column(2)):
                gram = byte_grams(data, k)
                p, a, m, text = anchors(gram, offsets, n, k)
                gram = W.mix64(gram[p])
                want = np.concatenate([np.zeros(0, np.uint64), *[x.astype(np.uint64) | _U(i << 32) for i, x in enumerate(wanted[first:end])]])
                take = np.isin(text.astype(np.uint64) << _U(32) | _finger(gram, buckets).astype(np.uint64), want)
                p, a, m, text, gram = p[take], a[take], m[take], text[take], gram[take]
                spread = np.isin(_name(gram, buckets), names)
                if spread.any():
                    begin, count, own = a[spread], m[spread], np.repeat(text[spread], m[spread])
                    at = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                    rec = np.zeros(len(at), _WINDOW)
                    rec["h"], rec["h2"] = W.hash_spans(data, at, at + n), W.hash_spans(data, at, at + n, 1)
                    rec["doc"], rec["a"] = own + first, at - offsets[own]
                    windows.append(rec)
                    if sum(map(len, windows)) > SEND_WINDOWS:
                        yield from _send_windows(np.concatenate(windows), table, window_buckets)
                        windows = []
                    p, a, m, text, gram = p[~spread], a[~spread], m[~spread], text[~spread], gram[~spread]
                if len(p):
                    found.append((_block_matrix(data, p, a, m, n, k), gram, text + first, p - offsets[text]))
            if windows:
                yield from _send_windows(np.concatenate(windows), table, window_buckets)
            if not found:
                continue
            rows, gram, doc, p = (np.concatenate(x) for x in zip(*found))
            bucket = gram >> _U(64 - parts.bit_length() + 1)
            order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
            order = order[np.argsort(bucket[order], kind="stable")]
            rows, bucket, doc, p = rows[order], bucket[order], doc[order], p[order]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(1) | (bucket[1:] != bucket[:-1])
            first, group = np.flatnonzero(new), np.cumsum(new) - 1
            ids = table["id"][doc]
            later = ids > np.minimum.reduceat(ids, first)[group]
            told = np.zeros(int(later.sum()), _TOLD)
            told["key"], told["a"], told["n"] = table["key"][doc[later]], p[later] - rows[later, -1], rows[later, -2]
            yield _aside(told, int(table["key"][0]))
            rows, bucket, doc, p = rows[~later], bucket[~later], doc[~later], p[~later]
            begin, _ = groups(bucket)
            packs = []
            for x, y in zip(begin, np.append(begin[1:], len(rows))):
                ref = np.zeros(y - x, _REF)
                used, ref["doc"] = np.unique(doc[x:y], return_inverse=True)
                ref["p"] = p[x:y]
                ref["lcp"], rests = front_code(rows[x:y])
                packs.append(np.array([len(used), y - x], np.uint32).tobytes() + table[used].tobytes() + ref.tobytes() + coder.compress(rests))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[begin].astype(np.int64)), pa.array(packs, pa.binary())], names=["key", "pack"])

    documents = shared.where("not hot").select("_ll_key", "hashes")
    return keyed.join(documents, "_ll_key").select("_ll_key", "_ll_id", "_ll_text", "hashes").mapInArrow(sort_runs, SCHEMA)


def earlier_spans(docs: DataFrame, n: int = 50, k: int = 24, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """(_ll_key, spans): for each text the packed (first window, number of
    windows) of its windows of ``n`` bytes that also start in a document with a
    smaller id."""
    import zstandard

    width = 2 * n - k + 2

    def merge(key: int, held: list[bytes]) -> Iterator[pa.RecordBatch]:
        if key >= _ASIDE:
            told = np.frombuffer(b"".join(held), _TOLD)
            yield joined_spans(told["key"], told["a"], told["n"])
            return
        if key >= _WINDOWS:
            yield _meet_windows(held)
            return
        coder, runs, tables, refs = zstandard.ZstdDecompressor(), [], [], []
        for pack in held:
            docs_n, rows_n = np.frombuffer(pack, "<u4", 2).tolist()
            table = np.frombuffer(pack, _DOC, docs_n, 8)
            ref = np.frombuffer(pack, _REF, rows_n, 8 + docs_n * _DOC.itemsize)
            rests = coder.decompress(pack[8 + docs_n * _DOC.itemsize + rows_n * _REF.itemsize:], max_output_size=rows_n * width)
            shared = ref["lcp"].tolist()
            runs.append((FrontCoded(shared, rests, width), shared))
            tables.append(table[ref["doc"]])
            refs.append(ref["p"])
        base = np.concatenate([[0], np.cumsum([len(r) for r in refs])])
        starts, places, prefixes, strings = base.tolist(), array("q"), bytearray(), []
        for run, at, lcp in merge_runs(runs):
            places.append(starts[run] + at)
            prefixes.append(lcp)
            if lcp < width:
                strings.append(runs[run][0].last)
        order, lcp = np.frombuffer(places, np.int64), np.frombuffer(prefixes, np.uint8)
        who, p = np.concatenate(tables)[order], np.concatenate(refs)[order].astype(np.int64)
        new = lcp < width
        new[0] = True
        first, block = np.flatnonzero(new), np.cumsum(new) - 1
        least = np.minimum.reduceat(who["id"], first)
        opens = lcp < k
        opens[0] = True
        group = (np.cumsum(opens) - 1)[first]  # of each distinct block
        distinct = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, width)
        del strings, runs
        windows, left = distinct[:, -2].astype(np.int64), distinct[:, -1].astype(np.int64)
        whole = who["id"] > least[block]
        out = [(who["key"][whole], (p - left[block])[whole], windows[block][whole])]
        mixed = np.flatnonzero(np.bincount(group)[group] > 1)
        for some in _chunks(mixed, group, 20_000):
            least_of = _smaller_windows(distinct[some], group[some], least[some], n, k)
            row, j = np.nonzero(least_of < least[some][:, None])
            # the occurrences in each such block's smallest document
            member_first = np.flatnonzero(~whole)
            member_block = block[member_first]
            lo, hi = np.searchsorted(member_block, some[row]), np.searchsorted(member_block, some[row], side="right")
            count = hi - lo
            at = member_first[np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())] if len(row) else np.zeros(0, np.int64)
            out.append((who["key"][at], p[at] - np.repeat(j, count), np.ones(len(at), np.int64)))
        yield joined_spans(*(np.concatenate(x) for x in zip(*out)))

    dealt = _dealt(docs, n, k, id_col, text_col, hot_rows)
    told = settle(exchange(dealt, merge, "_ll_key bigint, spans binary"), "earlier-spans")
    release(docs.sparkSession)
    return told.groupBy("_ll_key").agg(F.collect_set("spans").alias("spans"))


def _chunks(rows: np.ndarray, group: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """``rows`` (ordered by group) in chunks of whole groups of about ``size``."""
    at = 0
    while at < len(rows):
        end = min(at + size, len(rows))
        end = at + int(np.searchsorted(group[rows[at:]], group[rows[end - 1]], side="right"))
        yield rows[at:end]
        at = end


def remove_earlier(docs: DataFrame, n: int = 50, k: int = 24, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) for every row of ``docs``: bytes of
    the UTF-8 text that lie in a string of ``n`` bytes which also starts in a
    document with a smaller id are removed; ``kept`` (binary, as cuts may part a
    character) is the rest. With ``digest`` its SHA-256 (kept_sha256) comes instead.

    Ids are integers; a null id counts as larger than any other. Rows with
    equal ids are one document here and remove nothing from each other. Null
    texts are empty; texts of fewer than ``n`` bytes stay whole. An empty table
    gives an empty result. Other columns are not read.
    """
    spans = earlier_spans(docs, n, k, id_col, text_col, hot_rows)
    keyed = docs.select(F.xxhash64(id_col, text_col).alias("_ll_key"), F.col(id_col).alias("_ll_id"), F.col(text_col).alias("_ll_text"))
    last = "kept_sha256" if digest else "kept"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, got = list(of_rows(b.column(2), SPAN)), ([], [], [], [])
            for first, end, data, offsets in W.runs(b.column(1)):
                flat = np.concatenate(lists[first:end])
                begin = np.repeat(offsets[:-1], [len(x) for x in lists[first:end]]) + flat["a"].astype(np.int64)
                step = np.zeros(len(data) + 1, np.int32)
                np.add.at(step, begin, 1)
                np.add.at(step, begin + flat["n"].astype(np.int64) - 1 + n, -1)
                gone = np.cumsum(step[:-1]) > 0
                starts, _ = W.spans(gone, offsets)
                raw = data[~gone].tobytes()
                total = np.zeros(len(gone) + 1, np.int64)
                np.cumsum(~gone, out=total[1:])
                at = total[offsets]
                got[0].extend(np.diff(offsets))
                got[1].extend(np.diff(offsets) - np.diff(at))
                got[2].extend(np.diff(np.searchsorted(starts, offsets)))
                got[3].extend(hashlib.sha256(raw[x:y]).hexdigest() if digest else raw[x:y] for x, y in zip(at[:-1], at[1:]))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, pa.int64()) for x in got[:3]], pa.array(got[3], pa.string() if digest else pa.binary())],
                                             names=["_ll_id", "n_bytes", "n_removed", "n_spans", last])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = keyed.join(spans, "_ll_key", "left").select("_ll_id", "_ll_text", "spans").mapInArrow(
        cut, f"_ll_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, {last} {'string' if digest else 'binary'}")
    return out.withColumnRenamed("_ll_id", id_col)
