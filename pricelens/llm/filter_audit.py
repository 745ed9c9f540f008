"""Audit of how filters interact: who removes what, in every order.

Each row carries the set of filters that it fails. For every coalition of
filters (32 of five) and every part the rows that the coalition removes are
counted; this removal game v answers everything:

* a filter f that runs after the coalition S removes v(S+f) - v(S);
* its Shapley value is P(N) - P(N-f) with the potential of Hart and Mas-Colell,
  P(S) = (v(S) + sum of P(S-i) over i in S) / |S|, computed from the small
  coalitions upwards. Kept as n! * P(S), all of it is integers: P(S) is a sum
  of the game's dividends d(T) / |T|.

Only DataFrame functions run on the counts; one row per part holds the game, so
orders are explored on that, never on the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _words as W

MAX_FILTERS = 7

_CAPITAL, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
_MARK[list(b"#$%&*|")] = True
_HIGH = np.arange(256) & 0xC0 != 0x80  # the first byte of each code point


def coalitions(marked: DataFrame, filters: Sequence[str], part: str, flags: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """The removal game of each part: ``part``, ``total`` and the array ``v`` (by
    coalition, bit i for ``filters[i]``) of rows that the coalition removes; for
    each flag an array ``v_<flag>`` of the removed rows that have it.

    ``filters`` and ``flags`` are boolean columns (null: false). ``n`` names a
    column of row counts where rows stand for several. A part that holds most
    rows is counted by partial aggregates.
    """
    if not 0 < len(filters) <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters")
    true = lambda c: F.coalesce(F.col(c).cast("boolean"), F.lit(False))
    mask = sum((F.when(true(f), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(filters)), F.lit(0))
    weight = F.col(n) if n else F.lit(1)
    rows = marked.select(F.col(part).alias("_ll_part"), mask.alias("_ll_mask"), weight.cast("long").alias("_ll_n"), *[true(f).alias(f"_ll_f{i}") for i, f in enumerate(flags)])
    counts = rows.groupBy("_ll_part", "_ll_mask").agg(
        F.sum("_ll_n").alias("_ll_n"), *[F.sum(F.when(F.col(f"_ll_f{i}"), F.col("_ll_n")).otherwise(0)).alias(f"_ll_f{i}") for i in range(len(flags))])

    def game(c: str) -> Column:
        return F.expr(f"array({', '.join(f'sum(if(_ll_mask & {s} != 0, {c}, 0L))' for s in range(1 << len(filters)))})")

    return counts.groupBy("_ll_part").agg(F.sum("_ll_n").alias("total"), game("_ll_n").alias("v"), *[game(f"_ll_f{i}").alias(f"v_{f}") for i, f in enumerate(flags)]) \
                 .withColumnRenamed("_ll_part", part)


def potentials(games: DataFrame, filters: int, v: str = "v", out: str = "potential") -> DataFrame:
    """``games`` with the array ``out``: n! times the potential of each coalition.

    The array is built in the order of the coalitions' numbers, in which each
    comes after all that it contains."""
    without = " + ".join(f"if(s & {1 << i} != 0, p[s - {1 << i}], 0L)" for i in range(filters))
    step = f"(p, s) -> concat(p, array((`{v}`[s] * {factorial(filters)}L + {without}) div bit_count(s)))"
    return games.withColumn(out, F.expr(f"aggregate(sequence(1, {(1 << filters) - 1}), array(0L), {step})"))


def audit(marked: DataFrame, filters: Mapping[str, str], part: str, flags: Mapping[str, str] | None = None, n: str | None = None) -> DataFrame:
    """One row per part, order of all filters, and step.

    ``filters`` maps a one-letter name to its boolean column (true: fails),
    ``flags`` an output column to a boolean column whose removed rows it counts.
    Columns: ``part``, ``filter_order``, ``step`` (from 1; its filter is that
    letter of the order), ``kept`` (rows after the step), ``removed`` (here),
    ``redundant`` (fail the filter, removed earlier), ``unique_fails`` (fail this
    filter only), the flags, and ``shapley``: what the filter removes, summed over
    all orders. Parts are those of the rows, so an empty table gives no row; null
    parts are one part; a null filter or flag is false; repeated rows count each.
    """
    flags = dict(flags or {})
    names, size = list(filters), len(filters)
    grand = (1 << size) - 1
    games = potentials(coalitions(marked, [filters[f] for f in names], part, list(flags.values()), n), size)
    orders = F.array(*[F.lit("".join(o)) for o in permutations(names)])
    rows = games.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
    letter = F.col("filter_order").substr(F.col("step"), F.lit(1))
    earlier = sum((F.when(F.instr("filter_order", f) < F.col("step"), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(names)), F.lit(0))
    own = sum((F.when(letter == f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(names)), F.lit(0))
    rows = rows.withColumn("_ll_s", earlier).withColumn("_ll_f", own).withColumn("_ll_sf", F.col("_ll_s") + F.col("_ll_f"))
    gain = lambda v: F.col(v)[F.col("_ll_sf")] - F.col(v)[F.col("_ll_s")]
    return rows.select(part, "filter_order", "step", (F.col("total") - F.col("v")[F.col("_ll_sf")]).alias("kept"), gain("v").alias("removed"),
                       (F.col("v")[F.col("_ll_f")] - gain("v")).alias("redundant"), (F.col("v")[grand] - F.col("v")[F.lit(grand) - F.col("_ll_f")]).alias("unique_fails"),
                       *[gain(f"v_{c}").alias(out) for out, c in flags.items()],
                       (F.col("potential")[grand] - F.col("potential")[F.lit(grand) - F.col("_ll_f")]).alias("shapley"))


def _distinct_words(word: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Distinct word hashes of each text, from one sort: the text's number takes
    the place of the hash's lowest bits."""
    bits = max(1, n.bit_length())
    key = np.sort((text.astype(np.uint64) << np.uint64(64 - bits)) | (word >> np.uint64(bits)))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    return np.bincount((key[fresh] >> np.uint64(64 - bits)).astype(np.int64), minlength=n)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        short, repeats, capitals, symbols, digests = [], [], [], [], []
        for _, _, data, offsets in W.runs(batch.column(0)):
            n = len(offsets) - 1
            starts, ends = W.spans(~W.BLANK[data], offsets)
            words = np.diff(np.searchsorted(starts, offsets))
            distinct = _distinct_words(W.hash_spans(data, starts, ends), W.text_of(starts, offsets), n)
            short.append(words < 50)
            repeats.append(100 * distinct < 65 * words)
            capitals.append(100 * W.per_text(_CAPITAL[data], offsets) > 5 * W.per_text(_HIGH[data], offsets))
            symbols.append(W.per_text(_MARK[data], offsets) > 0)
            raw = data.tobytes()
            digests += [hashlib.sha256(raw[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
        if digests:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[pa.array(np.concatenate(x)) for x in (short, repeats, capitals, symbols)], pa.array(digests, pa.binary())],
                                             names=[*batch.schema.names[1:], "A", "B", "C", "D", "_ll_text"])


def mark_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Counted classes of documents: ``part``, five filters ``A`` to ``E`` (true:
    fails), ``good``, ``toxic`` and their number ``n``.

    A: under 50 words; B: distinct words under 65 % of the words; C: A-Z over 5 %
    of the code points; D: any of ``#$%&*|``; E: a smaller id has the same text.
    A null text is an empty one, a null part the empty string. A null id is no
    smaller id and has none below it. Rows that repeat the smallest id of a text
    pass E. An id with several label rows has a flag if any row says 1. Other
    columns are not read; empty tables give no row.

    Documents travel as digests. Equal texts pass or fail A to D together, so a
    large group of copies is reduced by partial aggregates to one row per
    combination of part and labels before its smallest id is sought.
    """
    narrow = docs.select(F.col(text_col).alias("_ll_raw"), F.col(id_col).alias("_ll_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"))
    kind = narrow.schema["_ll_id"].dataType.simpleString()
    marked = narrow.mapInArrow(_marks, f"_ll_id {kind}, part string, A boolean, B boolean, C boolean, D boolean, _ll_text binary")
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_ll_key")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1)).alias("good"), F.max((F.coalesce("toxic", F.lit(0)) == 1)).alias("toxic"))
    flagged = marked.join(known, F.col("_ll_id") == F.col("_ll_key"), "left").withColumns({f: F.coalesce(f, F.lit(False)) for f in ("good", "toxic")}).drop("_ll_key")
    group = ["_ll_text", "part", "A", "B", "C", "D", "good", "toxic"]
    by_id = flagged.groupBy(*group, "_ll_id").agg(F.count(F.lit(1)).alias("_ll_n"))
    classes = by_id.groupBy(*group).agg(F.sum("_ll_n").alias("_ll_n"), F.min("_ll_id").alias("_ll_first"), F.min_by("_ll_n", "_ll_id").alias("_ll_at_first"),
                                        F.coalesce(F.sum(F.when(F.col("_ll_id").isNull(), F.col("_ll_n"))), F.lit(0)).alias("_ll_no_id"))
    least = F.min("_ll_first").over(Window.partitionBy("_ll_text"))
    kept = F.when(F.col("_ll_first") == least, F.col("_ll_at_first")).otherwise(F.lit(0)) + F.col("_ll_no_id")
    parted = classes.withColumn("_ll_kept", F.coalesce(kept, F.col("_ll_n")))
    both = F.array(F.struct(F.lit(False).alias("E"), F.col("_ll_kept").alias("n")), F.struct(F.lit(True).alias("E"), (F.col("_ll_n") - F.col("_ll_kept")).alias("n")))
    return parted.select("part", "A", "B", "C", "D", F.explode(both).alias("_ll_e"), "good", "toxic") \
                 .select("part", "A", "B", "C", "D", "_ll_e.E", "good", "toxic", "_ll_e.n").where("n > 0")


def audit_texts(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """:func:`audit` of the five filters of :func:`mark_texts` per part."""
    return audit(mark_texts(docs, labels, **columns), {f: f for f in "ABCDE"}, "part", {"good_lost": "good", "toxic_lost": "toxic"}, "n")
