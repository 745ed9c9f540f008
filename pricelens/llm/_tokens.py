"""Encoding many texts with a tokenizer file of the ``tokenizers`` library.

A byte-level BPE encodes each piece of its pre-tokenizer by itself, so texts
are cut with numpy at places that are certainly piece boundaries (between
ASCII letters, digits, punctuation, white space and Latin letters; doubtful
places are not cut), and each distinct piece is encoded once per worker. The
ids are those of encoding whole texts. Texts that hold a special token's
string, and all texts of other kinds of tokenizer, are encoded whole.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import _words as W

#: Pieces that a worker remembers at most (some 200 MB).
MAX_PIECES = 1_000_000

_U, _A, _D, _P, _S, _W, _X, _L, _Q = range(9)  # unknown, letter, digit, punctuation, space, line or tab, two-byte, Latin letter, apostrophe
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = _A
_CLASS[48:58] = _D
_CLASS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = _P
_CLASS[0x27] = _Q
_CLASS[0x20] = _S
_CLASS[0x09:0x0E] = _W
_CLASS[0xC6:0xE0] = _X
_CLASS[0xC3:0xC6] = _L
_CUT = np.zeros((16, 16), bool)  # [before, after]
for _seen in (_A, _D, _P, _X, _L, _Q):
    _CUT[_seen, _S] = _CUT[_seen, _W] = _CUT[_W, _seen] = True
for _word in (_A, _D, _L):
    _CUT[_word, _P] = _CUT[_word, _Q] = _CUT[_P, _word] = True
_CUT = _CUT.ravel()


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions inside texts where a piece of the pre-tokenizer certainly starts."""
    c = _CLASS[data]
    if len(c) > 1:
        after = (data[1:] & 0xC0 == 0x80) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        at = np.flatnonzero(after)
        sign = (data[at] == 0xC3) & ((data[at + 1] == 0x97) | (data[at + 1] == 0xB7))  # × and ÷
        c[at[sign]] = _X
        c[at + 1] = c[at]
    cut = _CUT[c[:-1] * 16 + c[1:]]
    cut[offsets[(offsets > 0) & (offsets < len(data))] - 1] = False
    # the last character of a longer run of white space is a piece of its own
    ends = np.flatnonzero(cut & (c[:-1] == _W))
    ends = ends[ends > 0]
    cut[ends[c[ends - 1] == _U]] = False
    cut[ends[(c[ends - 1] == _S) | (c[ends - 1] == _W)] - 1] = True
    return np.flatnonzero(cut) + 1


class _Known(dict):
    """Ids by piece; pieces asked for in vain are noted, so that a batch of known
    pieces costs one look-up each."""

    def __init__(self):
        super().__init__()
        self.missed: list[bytes] = []

    def __missing__(self, piece: bytes) -> None:
        self.missed.append(piece)


class Encoder:
    """Token ids of texts, little-endian in ``dtype`` (16 bits if they fit)."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        pre = told.get("pre_tokenizer") or {}
        self.by_piece = (told["model"]["type"] == "BPE" and not told.get("normalizer") and pre.get("type") == "ByteLevel"
                         and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not told["model"].get("dropout"))
        self.special = [] if special_as_text else [t["content"].encode() for t in told.get("added_tokens", [])]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known = _Known()

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, in order; a null text has none."""
        for first, end, data, offsets in W.runs(texts):
            raw = data.tobytes()
            if not self.by_piece:
                yield from self.whole([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])
                continue
            begins = np.zeros(len(data) + 1, bool)
            begins[offsets] = True
            begins[piece_starts(data, offsets)] = True
            starts = np.flatnonzero(begins[:-1])
            pieces = np.insert(data, starts[1:], 0xFF).tobytes().split(b"\xff") if len(data) else []
            ids = list(map(self.known.__getitem__, pieces))
            if self.known.missed:
                new = list(set(self.known.missed))
                self.known.missed.clear()
                if len(self.known) + len(new) > MAX_PIECES:
                    self.known.clear()
                    new = list(set(pieces))
                self.known.update(zip(new, self.whole([p.decode() for p in new])))
                ids = list(map(self.known.__getitem__, pieces))
            at = np.searchsorted(starts, offsets)
            special = any(s in raw for s in self.special)
            for i in range(end - first):
                if special and any(s in raw[offsets[i]:offsets[i + 1]] for s in self.special):
                    yield from self.whole([raw[offsets[i]:offsets[i + 1]].decode()])
                else:
                    yield b"".join(ids[at[i]:at[i + 1]])


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder per worker process and file."""
    key = (path, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, special_as_text)
    return _ENCODERS[key]
