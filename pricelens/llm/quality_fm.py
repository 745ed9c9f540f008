"""Quality classifier: a factorisation machine.

A text is a sparse vector of hashed words (L2-normalised counts), binned
structure statistics and binned numeric metadata. The machine adds a bias, a
weight per feature and low-rank pairwise interactions, scored in time linear in
the features by the identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]``.

It is fitted on the driver on at most ``max_rows`` labelled rows with at most
``max_features`` features in all (some 200 MB, whatever the corpus and however
long its texts), and scores every whole text on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _words as W
from ._shared import settle

#: Labelled rows that the machine is fitted on at most.
MAX_ROWS = 12_000
#: Features (eight bytes each) of all rows that are fitted on.
MAX_FEATURES = 24_000_000
WORD_BITS, FACTORS, BINS = 14, 6, 12

_UPPER, _DIGIT, _SYMBOL, _PUNCT, _BANG, _HIGH = (np.zeros(256, bool) for _ in range(6))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[list(b"#*$%&|<>@^~=+_\\{}[]")] = True
_PUNCT[list(b".,;:?'\"()-")] = True
_BANG[33] = True
_HIGH[0x80:] = True
STATISTICS = ("words", "word length", "upper case", "digits", "symbols", "punctuation", "exclamation", "non-ASCII", "blanks",
              "line length", "repeated words", "same word again", "repeated lines", "short words", "long words", "sentence ends", "repeated runs")


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def statistics(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, word: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """A row for each text with its statistics, each from 0 to 1."""
    at = np.searchsorted(starts, offsets)
    n, size = np.diff(at).astype(float), np.diff(offsets).astype(float)
    per = lambda table: W.per_text(table[data], offsets)
    by_word = lambda marks: W.per_text(marks, at)
    length = ends - starts
    where = W.text_of(starts, offsets)
    again = np.zeros(len(word), bool)
    if len(word):
        again[1:] = (word[1:] == word[:-1]) & (where[1:] == where[:-1])
    lines = per(_NEWLINE) + 1
    win = W.windows(word, 4)
    whole = np.arange(len(win)) + 4 <= at[where[:len(win)] + 1]
    key = (win ^ W.mix64(where[:len(win)].astype(np.uint64)))[whole]
    runs = W.covered(np.flatnonzero(whole)[W.repeated(key)], 4, len(word))
    breaks = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 0x0A) + 1]))
    breaks = breaks[breaks < len(data)]
    stop = np.append(breaks[1:], len(data))
    line, line_text = W.hash_spans(data, breaks, stop), W.text_of(breaks, offsets)
    same = np.bincount(line_text[W.repeated(line ^ W.mix64(line_text.astype(np.uint64)))], minlength=len(n))
    stop_byte = np.isin(data[ends - 1], list(b".!?")) if len(ends) else np.zeros(0, bool)
    return np.clip(np.stack([
        np.log1p(n) / 12, _ratio(by_word(length), n) / 24, _ratio(per(_UPPER), size), _ratio(per(_DIGIT), size), _ratio(per(_SYMBOL), size) * 2,
        _ratio(per(_PUNCT), size) * 4, _ratio(per(_BANG), size) * 4, _ratio(per(_HIGH), size), _ratio(per(W.BLANK), size) * 2,
        np.log1p(_ratio(n, lines)) / 8, 1 - _ratio(distinct, n), _ratio(by_word(again), n), _ratio(same, lines), _ratio(by_word(length <= 3), n),
        _ratio(by_word(length > 14), n), _ratio(by_word(stop_byte), n) * 4, _ratio(by_word(runs), n)], 1), 0, 1)


_NEWLINE = np.zeros(256, bool)
_NEWLINE[0x0A] = True


def features(texts: pa.Array, metadata: Sequence[pa.Array] = ()) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Run by run: (text, feature, value) of every feature, ordered by text.

    Null texts are empty; a null number of metadata has a bin of its own.
    """
    width = 1 << WORD_BITS
    for first, end, data, offsets in W.runs(texts):
        n = end - first
        low = W.LOWER[data]
        starts, ends = W.spans(~W.BLANK[data], offsets)
        word = W.hash_spans(low, starts, ends)
        where = W.text_of(starts, offsets)
        key, count = np.unique(where * width + (word >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
        doc, feature, value = key // width, key % width, count.astype(np.float32)
        value /= np.sqrt(np.bincount(doc, value * value, n))[doc]
        stats = statistics(data, offsets, starts, ends, word, np.bincount(doc, minlength=n))
        for m in metadata:
            x = m.slice(first, n).cast(pa.float64()).to_numpy(zero_copy_only=False)
            stats = np.concatenate([stats, np.where(np.isfinite(x), np.log1p(np.abs(np.nan_to_num(x))) / 20, -1)[:, None]], 1)
        k = stats.shape[1]
        # roots spread the many small ratios over the bins
        binned = np.where(stats < 0, BINS, np.minimum(np.floor(np.sqrt(np.clip(stats, 0, 1)) * BINS), BINS - 1)).astype(np.int64)
        bins = width + np.arange(k) * (BINS + 1) + binned
        order = np.argsort(np.concatenate([doc, np.repeat(np.arange(n), k)]), kind="stable")
        yield (np.concatenate([doc, np.repeat(np.arange(n), k)])[order] + first, np.concatenate([feature, bins.ravel()])[order],
               np.concatenate([value, np.full(n * k, 0.5, np.float32)])[order])


@dataclass
class Machine:
    """Bias, weights and factors; ``metadata`` names the numeric columns it reads."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    metadata: tuple[str, ...] = ()

    def raw(self, doc: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` rows before the logistic function; every row has features."""
        at = np.searchsorted(doc, np.arange(n))
        v = self.factor[feature] * value[:, None]
        pairs = np.add.reduceat(v, at) ** 2 - np.add.reduceat(v * v, at)
        return self.bias + np.add.reduceat(self.weight[feature] * value, at) + 0.5 * pairs.sum(1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_metadata: int = 0, metadata: tuple[str, ...] = (),
        epochs: int = 12, batch: int = 256, rate: float = 0.02, decay: float = 1e-5, seed: int = 0) -> Machine:
    """Fit by Adam on the logistic loss. Without rows of both labels the machine
    is constant: the share of label 1 (0.5 without any row)."""
    rng = np.random.default_rng(seed)
    size = (1 << WORD_BITS) + (len(STATISTICS) + n_metadata) * (BINS + 1)
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size, np.float32), rng.normal(0, 0.02, (size, FACTORS)).astype(np.float32), metadata)
    if len(set(labels.tolist())) < 2:
        m.factor[:] = 0
        return m
    params = [np.array([m.bias], np.float32), m.weight, m.factor]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            take = order[i:i + batch]
            lengths = np.array([len(rows[j][0]) for j in take])
            doc = np.repeat(np.arange(len(take)), lengths)
            f = np.concatenate([rows[j][0] for j in take])
            x = np.concatenate([rows[j][1] for j in take]).astype(np.float32)
            at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            v = m.factor[f] * x[:, None]
            s = np.add.reduceat(v, at)
            y = params[0][0] + np.add.reduceat(m.weight[f] * x, at) + 0.5 * (s * s - np.add.reduceat(v * v, at)).sum(1)
            g = ((_logistic(y) - labels[take]) / len(take)).astype(np.float32)
            used, back = np.unique(f, return_inverse=True)
            gx = g[doc] * x
            gw = np.bincount(back, gx, len(used)).astype(np.float32) + decay * m.weight[used]
            gv = np.stack([np.bincount(back, gx * (s[doc, k] - v[:, k]), len(used)) for k in range(FACTORS)], 1).astype(np.float32) + decay * m.factor[used]
            t += 1
            for p, a, b, grad, rows_of in zip(params, first, second, [np.array([g.sum()]), gw, gv], [slice(None), used, used]):
                a[rows_of] = 0.9 * a[rows_of] + 0.1 * grad
                b[rows_of] = 0.99 * b[rows_of] + 0.01 * grad * grad
                p[rows_of] -= rate * (a[rows_of] / (1 - 0.9 ** t)) / (np.sqrt(b[rows_of] / (1 - 0.99 ** t)) + 1e-6)
    m.bias = float(params[0][0])
    return m


def _with_metadata(batch: pa.RecordBatch, k: int) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(f"_ll_m{i}")) for i in range(k)]


def _inputs(text_col: str, metadata: Sequence[str]) -> list[Column]:
    return [F.col(text_col).alias("_ll_text"), *[F.col(c).cast("double").alias(f"_ll_m{i}") for i, c in enumerate(metadata)]]


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          metadata: Sequence[str] = (), max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES, **options) -> Machine:
    """A machine fitted on the labelled rows for which ``learn`` (a condition on
    the id) holds; where there are more than ``max_rows`` of them, on those with
    the smallest hashes of their ids.

    Rows without an id or a label are not learnt from; of several labels of one
    id the largest counts, of several rows that with the smallest hash. Rows are
    taken in the order of their ids' hashes as long as they have ``max_features``
    features in all; both cuts come before anything is sent to the driver.
    """
    known = (labels.select(F.col(id_col).alias("_ll_id"), F.col(label_col).cast("double").alias("_ll_y")).na.drop().groupBy("_ll_id").agg(F.max("_ll_y").alias("_ll_y"))
             .withColumnRenamed("_ll_id", id_col).where(learn).withColumnRenamed(id_col, "_ll_id"))
    # a share by hash first, so that the exact cut sorts little more than it keeps
    share = min(1.0, 1.1 * max_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("_ll_id"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("_ll_id"), "_ll_id").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("_ll_id"), *_inputs(text_col, metadata)).join(chosen, "_ll_id")
    # one row per id, found by partial aggregation, so that repeats cost nothing further on
    parts = [c for c in rows.columns if c not in ("_ll_id", "_ll_y")]
    rows = (rows.groupBy("_ll_id").agg(F.max("_ll_y").alias("_ll_y"), F.min_by(F.struct(*parts), F.xxhash64(*parts)).alias("_ll_row"))
            .select("_ll_id", "_ll_y", "_ll_row.*"))
    k = len(metadata)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column(b.schema.get_field_index("_ll_y"))
            for doc, f, x in features(b.column(b.schema.get_field_index("_ll_text")), _with_metadata(b, k)):
                first, n = int(doc[0]), int(doc[-1] - doc[0]) + 1
                at = pa.array(np.searchsorted(doc, np.arange(first, first + n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("_ll_id")).slice(first, n).cast(pa.string()), y.slice(first, n), pa.ListArray.from_arrays(at, pa.array(f.astype(np.int32))),
                                                  pa.ListArray.from_arrays(at, pa.array(x))], names=["i", "y", "f", "x"])

    made = settle(rows.mapInArrow(vectors, "i string, y double, f array<int>, x array<float>"), "fm-rows")
    sizes = made.select("i", F.size("f").cast("long").alias("n"))
    # at most max_rows rows are left, so this window is a small one
    fits = sizes.withColumn("upto", F.sum("n").over(Window.orderBy(F.xxhash64("i"), "i"))).where(F.col("upto") <= max_features).select("i")
    got = made.join(fits, "i").select("i", "y", "f", "x").toArrow().sort_by([("i", "ascending")])
    f, x, y = got["f"], got["x"], got["y"].to_numpy()
    vec = [(f[i].values.to_numpy(), x[i].values.to_numpy()) for i in range(len(y))]
    return fit(vec, (y >= 0.5).astype(np.float32), k, tuple(metadata), **options)


def score(docs: DataFrame, machine: Machine, text_col: str = "text", keep: Sequence[str] | None = None, out: str = "score") -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) and the score of each
    text, from 0 to 1. Null and empty texts get the score of an empty text; a
    column named like ``out`` is replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    k = len(machine.metadata)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for doc, f, x in features(b.column(len(keep)), _with_metadata(b, k)):
                n = int(doc[-1] - doc[0]) + 1
                found.append(_logistic(machine.raw(doc - doc[0], f, x, n)))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())], names=[*keep, out])

    rows = docs.select(*keep, *_inputs(text_col, machine.metadata))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields), f"`{out}` double"])
    return rows.mapInArrow(scores, schema)
