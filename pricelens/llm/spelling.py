"""Grouping of spelling variants: words within one edit of a far commoner word.

Words are arranged by how often they have letters of each group: a word is a
path of successive group counts in a trie. One inserted letter raises one count
by one, a deleted one lowers one, a replaced one does both, so the neighbours
of a word lie on paths with a surplus of at most one and a deficit of at most
one. A depth-first search carries the words sought down the trie together and
drops each where its budget is spent; the words in the leaves that it reaches
are compared by their full counts, then letter by letter.

The trie is cut at its first levels into parts, one sub-trie each; a word is
sought in the parts whose path its budget allows (16 at five levels; of two
neighbours only the one with the smaller path seeks the other). A part
with many words or many words sought is divided further (salts of the words,
slices of the sought), so no task holds more than ``PART_WORDS`` words, and
nothing but letter counts passes through the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import product
from math import ceil, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _words as W
from ._shared import settle

_LOWER = {c: c + 32 for c in range(65, 91)}

#: Groups of letters (16 counts fit a packed vector); words below a node that is not
#: divided further; letters compared in rows; pairs compared at once.
GROUPS, LEAF, WIDE, PAIRS = 16, 64, 32, 1 << 18
#: Counts are capped here, to fit three bits.
TOP = 7
#: Words of a sub-trie, and words sought in one, in a task at once at most.
PART_WORDS, SOUGHT = 100_000, 20_000


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = (_CRC >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (_CRC & np.uint32(1)))


def lower(run: str) -> str:
    """A-Z lower-cased, all else as it is."""
    return run.lower() if run.isascii() else run.translate(_LOWER)


def _crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of spans that go on from a crc32 each (that of their document's id)."""
    state, last = state ^ np.uint32(0xFFFFFFFF), int((ends - starts).max(initial=0))
    by_length = np.argsort(starts - ends, kind="stable")  # long ones first, so those left are a prefix
    state, at, length = state[by_length], starts[by_length], (ends - starts)[by_length]
    for k in range(last):
        left = int(np.searchsorted(-length, -k, side="left"))  # spans of more than k bytes
        state[:left] = _CRC[(state[:left] ^ data[at[:left] + k]) & np.uint32(255)] ^ (state[:left] >> np.uint32(8))
    out = np.empty_like(state)
    out[by_length] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of Latin letters: A-Z, a-z, and C3 80 to C3 BF in UTF-8."""
    inside = _LETTER[data]
    lead = np.flatnonzero(data == 0xC3)  # in valid UTF-8 the letter's second byte follows
    inside[lead] = True
    inside[lead + 1] = True
    return W.spans(inside, offsets)


def _counted(min_length: int, typo_every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, _, data, offsets in W.runs(batch.column(1)):
                data = W.LOWER[data]
                starts, ends = _runs(data, offsets)
                wide = np.zeros(len(data) + 1, np.int64)
                np.cumsum(data & 0xC0 != 0x80, out=wide[1:])
                length = wide[ends] - wide[starts]
                long = length >= min_length
                starts, ends, length = starts[long], ends[long], length[long]
                word, text = W.hash_spans(data, starts, ends), W.text_of(starts, offsets)
                # a document's distinct words, then the distinct words of the run of texts
                order = np.lexsort((word, text)) if typo_every else np.argsort(word, kind="stable")
                w, t = word[order], text[order]
                new = np.ones(len(w), bool)
                new[1:] = (w[1:] != w[:-1]) | ((t[1:] != t[:-1]) if typo_every else False)
                at = np.flatnonzero(new)
                n, pick = np.diff(np.append(at, len(w))), order[at]
                odd: Counter = Counter()
                if typo_every and len(pick):
                    heads = np.array([crc32((("" if i is None else str(i)) + ":").encode()) for i in ids[first:first + len(offsets) - 1]], np.uint32)
                    crc = _crc_on(heads[text[pick]], data, starts[pick], ends[pick])
                    hit = crc % typo_every == 0
                    for p, c, k in zip(pick[hit], crc[hit].tolist(), n[hit].tolist()):
                        full = data[starts[p]:ends[p]].tobytes().decode()
                        c %= len(full)
                        if len(full) > min_length:
                            odd[full[:c] + full[c + 1:]] += k
                    pick, n = pick[~hit], n[~hit]
                order = np.argsort(word[pick], kind="stable")
                pick, n, w = pick[order], n[order], word[pick][order]
                new = np.ones(len(w), bool)
                new[1:] = w[1:] != w[:-1]
                at = np.flatnonzero(new)
                raw = data.tobytes()
                words = [raw[a:b] for a, b in zip(starts[pick[at]].tolist(), ends[pick[at]].tolist())]
                counts = np.add.reduceat(n, at) if len(at) else n
                yield pa.RecordBatch.from_arrays([pa.array(words + [x.encode() for x in odd], pa.binary()).cast(pa.string()), pa.array(np.append(counts, list(odd.values())).astype(np.int64))],
                                                 names=["word", "n"])

    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5, typo_every: int = 0) -> DataFrame:
    """(word, n): the words of all texts, runs of Latin letters with A-Z lower-cased.

    Words of fewer than ``min_length`` letters or ``min_count`` occurrences are
    left out. With ``typo_every`` k, the run whose crc32 of ``<id>:<run>`` divides
    by k loses one letter first (a test's misspellings). Null texts have no words,
    a null id counts as the empty string. Repeated rows count each. Other columns
    are not read. Words are told apart by 64-bit hashes within half a megabyte of
    text and as strings beyond. Tasks count before the shuffle, so a word in every
    document moves once a task.
    """
    counted = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_counted(min_length, typo_every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.bincount(np.frombuffer("".join(batch.column(0).to_pylist()).encode("latin-1"), np.uint8), minlength=256)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["letter", "n"])


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """The group of each Latin-1 letter: the commonest letters start the groups, each
    further one joins the group with the fewest so far. At most 256 counts reach
    the driver. Groups with even counts part the words best; which they are
    changes no result."""
    found = words.select("word").mapInArrow(_letters, "letter bigint, n bigint").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    group, load = np.zeros(256, np.uint8), [0] * groups
    for row in sorted(found, key=lambda r: (-r["n"], r["letter"])):
        g = load.index(min(load))
        group[row["letter"]] = g
        load[g] += row["n"]
    return group


def vectors(words: list[str], group: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Group counts of each word, at most 7: capping brings counts closer, never
    further apart, so no neighbour is lost."""
    data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    at = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.minimum(np.bincount(at * groups + group[data], minlength=len(words) * groups), TOP).astype(np.int8).reshape(-1, groups)


def _offsets(depth: int) -> list[tuple[int, ...]]:
    """The steps from a path to those within a surplus and a deficit of one each. Of
    two words the one with the smaller path seeks the other, so a surplus comes first."""
    return [o for o in product((0, 1, -1), repeat=depth) if o.count(1) <= 1 and o.count(-1) <= 1 and (*(x for x in o if x), 1)[0] == 1]


def _paths(words: list[str], group: np.ndarray, depth: int, groups: int):
    """(part of each word; (index of word, part) of every part where it is sought)."""
    head = vectors(words, group, groups)[:, :depth].astype(np.int64)
    base = (TOP + 1) ** np.arange(depth)[::-1]
    at, parts = [], []
    for o in _offsets(depth):
        moved = head + o
        ok = np.flatnonzero(((moved >= 0) & (moved <= TOP)).all(axis=1))
        at.append(ok)
        parts.append(moved[ok] @ base)
    return head @ base, np.concatenate(at), np.concatenate(parts)


def one_edit(a: str, b: str) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


_HIGH, _ONES = np.uint64(0x8888888888888888), np.uint64(0x1111111111111111)


def packed(vec: np.ndarray) -> np.ndarray:
    """The counts of up to 16 groups in four bits apiece; ordered as the vectors are."""
    return (vec.astype(np.uint64) << (np.arange(vec.shape[1], dtype=np.uint64)[::-1] * np.uint64(4))).sum(axis=1, dtype=np.uint64)


def _at_most_one(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the counts packed in ``a`` exceed those in ``b`` by one in all at most."""
    gap = (a | _HIGH) - b  # four bits a group: 8 + a - b, which borrows nothing
    over = gap & _HIGH
    over = gap & (over - (over >> np.uint64(3)))  # a - b where that is positive
    return (over & (over - np.uint64(1)) | over & ~_ONES) == 0


def letters(words: list[str], wide: int) -> np.ndarray:
    """One row of ``wide`` bytes a word: its letters, then zeros."""
    return np.array([w.encode("latin-1") for w in words], f"S{wide}").view(np.uint8).reshape(len(words), wide)


def _first_gap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


class Words:
    """Words with what comparing them takes."""

    def __init__(self, words: list[str], vec: np.ndarray, counts: list[int]):
        self.words, self.counts, self.vec, self.code = words, counts, vec, packed(vec)
        self.length = np.array([len(w) for w in words], np.int64)
        wide = int(min(WIDE, self.length.max(initial=1)))
        self.ahead, self.back = letters(words, wide), letters([w[::-1] for w in words], wide)


def edits(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one inserted, deleted or replaced letter: those
    whose common start and common end leave at most one letter of the longer."""
    wide = min(a.ahead.shape[1], b.ahead.shape[1])
    la, lb = a.length[i], b.length[j]
    longer = np.maximum(la, lb)
    # beyond the shorter width there is padding only, or the lengths differ there
    start = np.minimum(_first_gap(a.ahead[i, :wide], b.ahead[j, :wide]), np.minimum(la, lb))
    end = np.minimum(_first_gap(a.back[i, :wide], b.back[j, :wide]), np.minimum(la, lb))
    ok = (np.abs(la - lb) <= 1) & (start + end >= longer - 1) & ((start < longer) | (la != lb))
    for k in np.flatnonzero(longer > wide):  # too long for the rows of letters
        ok[k] = one_edit(a.words[i[k]], b.words[j[k]])
    return ok


class Trie:
    """Words with counts below one path; nodes are ranges of the sorted vectors."""

    def __init__(self, words: list[str], counts: list[int], group: np.ndarray, groups: int, depth: int):
        vec = vectors(words, group, groups)
        order = np.lexsort(vec.T[::-1])
        self.held = Words([words[i] for i in order], vec[order], [counts[i] for i in order])
        self.depth, self.groups = depth, groups

    def neighbours(self, sought: list[str], counts: list[int], vec: np.ndarray) -> dict[str, tuple[int, int, str]]:
        """{word: (neighbours, count of the best, the best)} of the pairs of a word
        sought and a word held whose vector is larger (or the word, if vectors are
        equal), for both words of each pair; the best has the largest count, then
        comes first in code-point order."""
        found: dict[str, tuple[int, int, str]] = {}
        if self.held.words:  # a salt may have got none
            asked = Words(sought, vec, counts)
            gap = self.held.vec[0, :self.depth] - vec[:, :self.depth]
            surplus, deficit = np.maximum(gap, 0).sum(1, dtype=np.int8), np.maximum(-gap, 0).sum(1, dtype=np.int8)
            near = np.flatnonzero((surplus <= 1) & (deficit <= surplus))
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            self._down(0, len(self.held.words), self.depth, near, surplus[near], deficit[near], asked, pairs, found)
            self._verify(asked, pairs, found)
        return found

    def _down(self, lo, hi, level, who, surplus, deficit, asked, pairs, found):
        if hi - lo <= LEAF or level == self.groups:
            return self._leaf(lo, hi, who, asked, pairs, found)
        column = self.held.vec[lo:hi, level]
        cuts = np.flatnonzero(column[1:] != column[:-1]) + 1
        theirs = asked.vec[who, level]
        for a, b in zip((0, *cuts), (*cuts, hi - lo)):
            gap = column[a] - theirs
            s, d = surplus + (gap > 0) * gap, deficit - (gap < 0) * gap
            left = np.flatnonzero((s <= 1) & (d <= s))  # a surplus comes before the deficit
            if len(left):
                self._down(lo + a, lo + b, level + 1, who[left], s[left], d[left], asked, pairs, found)

    def _leaf(self, lo, hi, who, asked, pairs, found):
        step = max(1, PAIRS // (hi - lo))
        for first in range(0, len(who), step):
            part = who[first:first + step]
            mine, theirs = self.held.code[None, lo:hi], asked.code[part, None]
            i, j = np.nonzero((mine >= theirs) & _at_most_one(mine, theirs) & _at_most_one(theirs, mine))
            pairs.append((part[i], lo + j))
            if sum(len(x) for x, _ in pairs) >= PAIRS:
                self._verify(asked, pairs, found)

    def _verify(self, asked, pairs, found):
        if not pairs:
            return
        i, j = (np.concatenate(x) for x in zip(*pairs))
        pairs.clear()
        ok = edits(asked, i, self.held, j)
        i, j = i[ok], j[ok]
        equal = self.held.code[j] == asked.code[i]
        for q, k, same in zip(i.tolist(), j.tolist(), equal.tolist()):
            one, other = asked.words[q], self.held.words[k]
            if not same or one < other:
                _better(found, one, other, self.held.counts[k])
                _better(found, other, one, asked.counts[q])


def _better(found: dict, word: str, other: str, n: int) -> None:
    near, best_n, best = found.get(word, (0, 0, ""))
    if n > best_n or n == best_n and other < best:
        best_n, best = n, other
    found[word] = (near + 1, best_n, best)


_CELL = ["_ll_part", "_ll_salt", "_ll_slice"]


def _search(group: np.ndarray, depth: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, words, counts, trie = None, [], [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)  # part, salt, slice, sought
            text, n = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip((0, *cuts), (*cuts, len(keys))):
                if tuple(keys[a, :3]) != cell:
                    cell, words, counts, trie = tuple(keys[a, :3]), [], [], None
                if not keys[a, 3]:
                    words += text[a:b]
                    counts += n[a:b]
                    continue
                if trie is None:
                    trie, words, counts = Trie(words, counts, group, groups, depth), [], []
                sought = text[a:b]
                found = trie.neighbours(sought, n[a:b], vectors(sought, group, groups))
                if found:
                    best = list(found.values())
                    yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([x[0] for x in best], pa.int64()), pa.array([x[1] for x in best], pa.int64()),
                                                      pa.array([x[2] for x in best])], names=["word", "n_near", "best_n", "best"])

    return run


def neighbours(words: DataFrame, groups: int = GROUPS, depth: int | None = None) -> DataFrame:
    """(word, n_near, best, best_n) of every word of ``words`` (word, n; one row a
    word) that another word differs from by one inserted, deleted or replaced
    letter: how many, and the one with the largest n (ties: code-point order).

    Words may hold letters up to U+00FF. ``words`` is read several times and
    should be a stored table. An empty table gives an empty result.
    """
    group = letter_groups(words, groups)
    total = words.count()
    if depth is None:  # deeper parts for larger vocabularies; a level parts words by some three
        depth = min(5, max(2, ceil(log(max(total, 1) / 10_000 + 1, 3))))

    def sizes(batches):
        for b in batches:
            own, _, sought = _paths(b.column(0).to_pylist(), group, depth, groups)
            parts, at = np.unique(np.concatenate([own, sought]), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(np.bincount(at[:len(own)], minlength=len(parts))), pa.array(np.bincount(at[len(own):], minlength=len(parts)))],
                                             names=["_ll_part", "words", "sought"])

    def spread(batches):
        for b in batches:
            own, at, parts = _paths(b.column(0).to_pylist(), group, depth, groups)
            index = pa.array(np.concatenate([np.arange(len(own)), at]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own, parts])), pa.array(np.repeat([0, 1], [len(own), len(at)])), b.column(0).take(index), b.column(1).take(index)],
                                             names=["_ll_part", "_ll_sought", "word", "n"])

    narrow = words.select("word", F.col("n").cast("long").alias("n"))
    cells = narrow.mapInArrow(sizes, "_ll_part bigint, words bigint, sought bigint").groupBy("_ll_part").agg(
        F.ceil(F.sum("words") / PART_WORDS).alias("_ll_salts"), F.ceil(F.sum("sought") / SOUGHT).alias("_ll_slices")).where("_ll_salts > 0")
    # a part without words is sought in vain: the inner join drops it
    placed = narrow.mapInArrow(spread, "_ll_part bigint, _ll_sought bigint, word string, n bigint").join(cells, "_ll_part")
    mine = lambda of: F.pmod(F.xxhash64("word"), F.col(of))
    all_of = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    held = placed.where("_ll_sought = 0").select("*", mine("_ll_salts").alias("_ll_salt"), all_of("_ll_slices").alias("_ll_slice"))
    asked = placed.where("_ll_sought = 1").select("*", all_of("_ll_salts").alias("_ll_salt"), mine("_ll_slices").alias("_ll_slice"))
    columns = [*_CELL, "_ll_sought", "word", "n"]
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(total * len(_offsets(depth)) / (4 * SOUGHT)))
    dealt = held.select(*columns).unionAll(asked.select(*columns)).repartition(tasks, *_CELL).sortWithinPartitions(*_CELL, "_ll_sought")
    found = dealt.mapInArrow(_search(group, depth, groups), "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_ll_b")).select("word", "n_near", F.col("_ll_b.best").alias("best"), (-F.col("_ll_b.k")).alias("best_n"))


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Each word of ``words`` (word, n) with ``form`` (its neighbour of largest n, if
    that is at least ``ratio`` times its own, else null), ``root`` (the end of the
    chain of forms, the word itself without one), ``n_near`` and ``form_n``.

    Counts rise along a chain by the ratio, so a chain is as long as a logarithm
    of the largest count at most and following it doubles its reach each round.
    ``ratio`` is 2 at least, so a chain ends. An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("ratio is 2 at least")
    words = settle(words.select("word", "n"), "spelling-words")
    near = settle(neighbours(words), "spelling-neighbours")
    base = words.join(near, "word", "left")
    is_form = F.col("best_n") >= F.col("n") * ratio
    base = settle(base.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = base.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most, least = base.agg(F.max("n"), F.min("n")).first()
    reach, longest = 1, int(log(max(1, (most or 1) / max(least or 1, 1)), ratio)) + 1
    while reach < longest:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("_ll_next"))
        ends = settle(ends.join(further, "root", "left").select("word", F.coalesce("_ll_next", "root").alias("root")), "spelling-roots")
        reach *= 2
    return base.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
