"""Hashed features of distinct words, and a bounded table of words and their scores in each worker."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from stayline.llm.words import U64, mixed

#: Words are runs of letters, case folded.
WORD = re.compile(r"[^\W\d_]+")
BITS = 18


def letters(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def word_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and where each word starts and ends."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    return codes, ends - sizes, ends


def features(words: list[str], affix: int, grams: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (below 2**BITS) of every word and the word each belongs to: prefixes and suffixes of up to
    ``affix`` letters, inner n-grams of the given lengths and the whole word."""
    codes, starts, ends = word_codes(words)
    sizes, n = ends - starts, len(words)
    owner = np.repeat(np.arange(n), sizes)
    out, of = [], []

    def add(kind: int, value: np.ndarray, word: np.ndarray) -> None:
        out.append(mixed(value * U64(64) + U64(kind)) >> U64(64 - BITS))
        of.append(word)

    for k in range(1, affix + 1):
        long = np.flatnonzero(sizes >= k)
        first, last = np.zeros(len(long), U64), np.zeros(len(long), U64)
        for j in range(k):
            first = mixed(first + codes[starts[long] + j] + U64(1))
            last = mixed(last + codes[ends[long] - k + j] + U64(1))
        add(k, first, long)
        add(16 + k, last, long)
    for k in grams:
        at = np.arange(len(codes) - k + 1)
        at = at[owner[at] == owner[at + k - 1]] if len(at) else at
        value = np.zeros(len(at), U64)
        for j in range(k):
            value = mixed(value + codes[at + j] + U64(1))
        add(32 + k, value, owner[at])
    add(0, whole(words), np.arange(n))
    number, word = np.concatenate(out).astype(np.int64), np.concatenate(of)
    order = np.argsort(word, kind="stable")
    return number[order], word[order]


def whole(words: list[str]) -> np.ndarray:
    """A hash of each word as a whole."""
    codes, starts, ends = word_codes(words)
    value = np.zeros(len(words), U64)
    sizes = ends - starts
    left = np.flatnonzero(sizes > 0)
    for j in range(int(sizes.max()) if len(words) else 0):
        left = left[sizes[left] > j]
        value[left] = mixed(value[left] * U64(31) + codes[starts[left] + j] + U64(1))
    return value


def summed(values: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of ``values`` of each word; ``word`` ascends and has every word."""
    return np.add.reduceat(values, np.searchsorted(word, np.arange(n)), axis=0)


class WordTable:
    """Scores of the words met so far, as rows of a matrix. Starts anew when it is full, which only costs time."""

    def __init__(self, score: Callable[[list[str]], np.ndarray], limit: int):
        self.score, self.limit, self.index, self.values = score, limit, {}, None

    def rows(self, words: list[str]) -> np.ndarray:
        """The scores of a list of words, in order."""
        new = list(set(words) - self.index.keys())
        if len(self.index) + len(new) > self.limit and self.index:
            self.index, self.values = {}, None
            new = list(set(words))
        if new:
            fresh = self.score(new)
            base = len(self.index)
            self.index.update(zip(new, range(base, base + len(new)), strict=True))
            if self.values is None or base + len(new) > len(self.values):
                grown = np.empty((max(2 * (base + len(new)), 1024), *fresh.shape[1:]), fresh.dtype)
                if base:
                    grown[:base] = self.values[:base]
                self.values = grown
            self.values[base : base + len(new)] = fresh
        return self.values[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))]
