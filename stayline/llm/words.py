"""Words of texts as 64-bit hashes, computed over whole Arrow columns with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = x.astype(U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U64(shift)
        x *= U64(factor)
    return x ^ (x >> U64(31))


_BYTE = mixed(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[:1] = 1
    return np.cumprod(out, dtype=U64)


@dataclass
class Words:
    """Words of all texts of a column in order: their hashes, byte ranges in ``data`` and the text each is in."""

    data: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    n_texts: int

    def bounds(self) -> np.ndarray:
        """Index of the first word of every text, and the number of words."""
        return np.searchsorted(self.text, np.arange(self.n_texts + 1))


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a column of texts, with A-Z in lower case if asked; a null has none."""
    texts = pa.compute.fill_null(texts, "")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(data, np.empty(0, U64), none, none, none, n)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    before = np.concatenate(([True], space[:-1])) | breaks[:-1]
    after = np.concatenate((space[1:], [True])) | breaks[1:]
    start, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    total = np.concatenate((np.zeros(1, U64), np.cumsum(_BYTE[data] * powers(_BASE, len(data)), dtype=U64)))
    value = (total[end] - total[start]) * powers(_BACK, len(data))[start]
    return Words(data, mixed(value + (end - start).astype(U64)), start, end, np.searchsorted(offsets, start, "right") - 1, n)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive hashes; the caller leaves out those that cross a text's end."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out = mixed(out * _BASE + hashes[j : j + n]) if k <= 4 else out * _BASE + hashes[j : j + n]
    return mixed(out)
