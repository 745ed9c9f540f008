"""Words, lines and their fingerprints of many texts at once, with numpy.

Texts come as Arrow string arrays; their UTF-8 bytes are worked on in place,
in runs of whole texts of about ``RUN_BYTES`` (a longer text is a run of its
own), so memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 19

#: ASCII white space parts words: U+0020 and U+0009 to U+000D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Maps A-Z to a-z and every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit integers (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, longer on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(size, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up, self.down


_POWERS = [Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95)]
#: A random 64-bit value for each byte value; two independent sets.
_BYTES = [mix64(np.arange(1, 257, dtype=np.uint64) * _U(k)) for k in (0xA24BAED4963EE407, 0x9FB21C651E98DF25)]


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Polynomial fingerprints of ``values[start:end]``; equal spans have equal ones."""
    up, down = _POWERS[which].upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit fingerprints of the byte spans ``data[start:end]``."""
    return span_sums(_BYTES[which][data], starts, ends, which)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of ``n`` neighbours in ``h`` (fewer by ``n - 1``)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, have, step, length = None, 0, h, 1
    while True:
        if n & length:
            if out is None:
                out = step
            else:
                m = min(len(out), len(step) - have)
                out = out[:m] * _U(pow(0xF1357AEA2E62A9C5, length, 1 << 64)) + step[have:have + m]
            have += length
        if have == n:
            return out[:len(h) - n + 1]
        m = len(step) - length
        step = step[:m] * _U(pow(0xF1357AEA2E62A9C5, length, 1 << 64)) + step[length:length + m]
        length *= 2


def runs(texts: pa.Array, limit: int = RUN_BYTES, max_texts: int = 1 << 16) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, bytes, offsets into them) of runs of whole texts.

    Null texts are empty ones.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        end = min(end, first + max_texts)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def spans(is_in: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that cross no offset."""
    if not len(is_in):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(len(is_in) + 1, bool)
    before[1:] = is_in
    after = np.zeros(len(is_in) + 1, bool)
    after[:-1] = is_in
    cut = offsets[(offsets > 0) & (offsets < len(is_in))]
    opens, closes = is_in & ~before[:-1], is_in & ~after[1:]
    opens[cut] |= is_in[cut]
    closes[cut - 1] |= is_in[cut - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` (one per byte, or per word with word offsets) in each text."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text in which each start lies."""
    return np.searchsorted(offsets, starts, side="right") - 1


def covered(marks: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` items lie in a window of ``n`` that starts at a mark."""
    step = np.zeros(total + 1, np.int32)
    np.add.at(step, marks, 1)
    np.add.at(step, np.minimum(marks + n, total), -1)
    return np.cumsum(step[:-1]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur more than once."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    twice = np.zeros(len(k), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.empty(len(k), bool)
    out[order] = twice
    return out
