"""FM-index over the words of a shard of texts: suffix order, wavelet matrix, sampled suffix positions.

Everything is an array operation over a shard, whose size the caller bounds.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 32  # every so many words a suffix position is kept
LOCATE_ROWS = 1 << 17  # occurrences followed at a time


def suffix_order(symbols: np.ndarray, size: int) -> np.ndarray:
    """Start positions of all suffixes in order, ``symbols`` being below ``size`` and the last one unlike all others.

    Suffixes are sorted by as many symbols as fit a key and then by doubled prefixes; only those that
    are still equal to a neighbour are sorted again.
    """
    n, bits = len(symbols), max(1, (size - 1).bit_length())
    packed, depth = symbols.astype(np.int64), 1
    for i in range(1, 62 // bits):
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - i)] = symbols[i:]
        packed, depth = (packed << bits) | ahead, depth + 1
    order = np.argsort(packed)
    rank, at = np.empty(n, np.int64), np.arange(n)
    key = packed[order]
    while True:
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(new)
        rank[order[at]] = at[heads][np.cumsum(new) - 1]
        alone = new.copy()
        alone[:-1] &= new[1:]
        at = at[~alone]  # places in the order whose suffix is not settled
        if not len(at):
            return order
        open_ = order[at]
        follow = open_ + depth
        key = rank[open_] * (n + 1) + np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        by = np.argsort(key)
        order[at], key, depth = open_[by], key[by], depth * 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector per binary digit, with counts per 64 bits."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, self.words, self.counts, self.zeros = max(1, (size - 1).bit_length()), [], [], []
        rest, n = symbols.astype(np.uint32), len(symbols)
        for level in reversed(range(self.levels)):
            bit = ((rest >> np.uint32(level)) & np.uint32(1)).astype(bool)
            room = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed = np.packbits(bit, bitorder="little")
            room[: len(packed)] = packed
            words = room.view(np.uint64)
            counts = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=counts[1:])
            self.words.append(words)
            self.counts.append(counts)
            self.zeros.append(n - int(np.count_nonzero(bit)))
            rest = np.concatenate([rest[~bit], rest[bit]])
        self.first = self._descend(np.arange(size), np.zeros(size, np.int64))  # where each symbol's block starts

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & below)

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            ones = self._ones(level, at)
            one = (symbols >> (self.levels - 1 - level)) & 1 == 1
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place ``at``."""
        return self._descend(symbols, at) - self.first[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        symbols = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            one = (self.words[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(level, at)
            at = np.where(one, self.zeros[level] + ones, at - ones)
            symbols = symbols << 1 | one
        return symbols, at - self.first[symbols]


class FMIndex:
    """Finds phrases among texts of 64-bit word hashes.

    A text ends in a symbol of its own, so no match runs over its end and equal texts are told apart.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        """``words`` of all texts one after the other, ``lengths`` in words."""
        self.vocabulary, symbol = np.unique(words, return_inverse=True)
        texts, n = len(lengths), len(words) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        self.starts = ends - lengths  # of the texts among the positions
        is_word = np.ones(n, bool)
        is_word[ends] = False
        ranks = np.empty(n, np.int64)
        ranks[ends], ranks[is_word] = np.arange(texts), symbol + texts
        order = suffix_order(ranks, texts + len(self.vocabulary))
        symbols = np.maximum(ranks - (texts - 1), 0)  # ends become one symbol, as no phrase holds them
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=len(self.vocabulary) + 1))])
        self.last = WaveletMatrix(symbols[order - 1], len(self.vocabulary) + 1)
        kept = np.zeros(n, bool)
        kept[::SAMPLE] = True
        kept[self.starts] = True  # no step ever goes back over a text's start
        self.kept = kept[order]
        self.sampled = order[self.kept]
        self.kept_before = np.cumsum(self.kept) - self.kept

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of phrases of one length, a row each: the range of suffixes that start with it."""
        lo, hi = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        if not len(self.vocabulary) or not len(phrases):
            return lo, hi
        symbol = np.searchsorted(self.vocabulary, phrases)
        known = (symbol < len(self.vocabulary)) & (self.vocabulary[np.minimum(symbol, len(self.vocabulary) - 1)] == phrases)
        open_ = np.flatnonzero(known.all(1))
        symbol = symbol + 1
        hi[open_] = self.below[-1]
        for column in reversed(range(phrases.shape[1])):
            c = symbol[open_, column]
            lo[open_] = self.below[c] + self.last.rank(c, lo[open_])
            hi[open_] = self.below[c] + self.last.rank(c, hi[open_])
            open_ = open_[lo[open_] < hi[open_]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: steps back through the texts to the next sampled one."""
        found = np.empty(len(rows), np.int64)
        for start in range(0, len(rows), LOCATE_ROWS):
            row = rows[start : start + LOCATE_ROWS].copy()
            steps = np.zeros(len(row), np.int64)
            open_ = np.flatnonzero(~self.kept[row])
            while len(open_):
                symbol, before = self.last.access(row[open_])
                row[open_] = self.below[symbol] + before
                steps[open_] += 1
                open_ = open_[~self.kept[row[open_]]]
            found[start : start + LOCATE_ROWS] = self.sampled[self.kept_before[row]] + steps
        return found

    def text_of(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and place within it of each position."""
        text = np.searchsorted(self.starts, positions, "right") - 1
        return text, positions - self.starts[text]
