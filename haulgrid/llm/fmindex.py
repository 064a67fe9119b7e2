"""A compressed full-text index over words: Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np
import pandas as pd


class WaveletMatrix:
    """Ranks of symbols in a sequence, one packed bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, number: int):
        self.levels = max(1, int(number - 1).bit_length())
        self.words, self.ones, self.zeros = [], [], []
        rest = symbols
        for level in range(self.levels - 1, -1, -1):
            bits = (rest >> level) & 1
            packed = np.packbits(
                np.append(bits.astype(np.uint8), np.zeros(64 + -len(bits) % 64, np.uint8)),
                bitorder="little",
            ).view("<u8")
            counts = np.cumsum(np.bitwise_count(packed), dtype=np.int64)
            self.words.append(packed)
            self.ones.append(np.concatenate(([0], counts[:-1])))
            self.zeros.append(len(bits) - int(counts[-1]))
            rest = np.concatenate((rest[bits == 0], rest[bits == 1]))
        every = np.arange(number)
        self.first = self._down(every, np.zeros(number, np.int64))

    def _down(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        for row in range(self.levels):
            block = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.ones[row][block] + np.bitwise_count(self.words[row][block] & below)
            one = (symbols >> (self.levels - 1 - row)) & 1 == 1
            place = np.where(one, self.zeros[row] + ones, place - ones)
        return place

    def rank(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, place) - self.first[symbols]


def _ranks(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Rank of each pair among the distinct pairs."""
    return np.unique(one * (int(other.max()) + 1) + other, return_inverse=True)[1].reshape(-1)


def _from(values: np.ndarray, shift: int) -> np.ndarray:
    """The value ``shift`` places on; past the end, that of the last place, a separator."""
    return np.append(values[shift:], np.full(min(shift, len(values)), values[-1]))


class WordIndex:
    """FM-index of texts, sorted by their next ``depth`` words, that knows each text's document.

    ``texts`` are words joined by single spaces. As suffixes are sorted by ``depth`` words alone,
    patterns of up to so many words can be searched.
    """

    def __init__(self, texts: list[bytes], documents: np.ndarray, depth: int):
        if depth < 2:
            raise ValueError("the depth must be two words at least")
        self.depth = depth
        words = [text.split() for text in texts]
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.empty(int(self.sizes.sum()), object)
        flat[:] = [word for text in words for word in text]
        codes, names = pd.factorize(flat)
        # Symbol 0 ends each text, and the whole with one more.
        self.begins = np.concatenate(([0], np.cumsum(self.sizes + 1)[:-1]))
        self.text = np.zeros(len(flat) + len(texts) + 1, np.int64)
        where = np.arange(len(flat)) + np.repeat(np.arange(len(texts)), self.sizes)
        self.text[where] = codes + 1
        owner = np.append(np.repeat(documents, self.sizes + 1), documents[-1])

        length, rank = 1, self.text
        while 2 * length <= depth - 1:
            rank, length = _ranks(rank, _from(rank, length)), 2 * length
        longer = _ranks(rank, _from(rank, depth - length))
        shorter = _ranks(rank, _from(rank, depth - 1 - length))
        order = np.argsort(longer, kind="stable")
        self.bwt = WaveletMatrix(self.text[order - 1], len(names) + 1)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(self.text, minlength=len(names) + 1))))
        # In sorted order: the run of suffixes alike in depth - 1 words, and the least document
        # among those alike in depth words.
        self.run_begin, self.run_end = _runs(shorter[order])
        begin, end = _runs(longer[order])
        starts = np.flatnonzero(begin == np.arange(len(begin)))
        self.least = np.repeat(np.minimum.reduceat(owner[order], starts), (end - begin)[starts])

    def extend(self, low: np.ndarray, high: np.ndarray, word: np.ndarray):
        """One step of backward search: the suffixes that begin with the word and go on as before."""
        both = self.bwt.rank(np.concatenate((word, word)), np.concatenate((low, high)))
        first = self.before[word]
        return first + both[: len(low)], first + both[len(low):]

    def least_documents(self) -> list[np.ndarray]:
        """For each text and each of its windows of ``depth`` words, the least document that has it.

        All texts are streamed from their last words to their first, side by side. The match
        statistic grows with each step of backward search up to ``depth`` words; from there on the
        interval is first widened to the match without its last word. A text of the index matches
        itself, so a match never breaks off, and what is asked is which documents share it.
        """
        found = np.zeros(len(self.text), np.int64)
        lane = np.argsort(-self.sizes, kind="stable")
        low = np.zeros(len(lane), np.int64)
        high = np.full(len(lane), len(self.text))
        for step in range(int(self.sizes.max())):
            active = int(np.searchsorted(-self.sizes[lane], -step, side="left"))
            lane, low, high = lane[:active], low[:active], high[:active]
            if step >= self.depth:
                low, high = self.run_begin[low], self.run_end[low]
            place = self.begins[lane] + self.sizes[lane] - 1 - step
            low, high = self.extend(low, high, self.text[place])
            if step >= self.depth - 1:
                found[place] = self.least[low]
        many = np.maximum(self.sizes - self.depth + 1, 0)
        return [found[begin: begin + number] for begin, number in zip(self.begins, many)]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the run of equal values that each place is in."""
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    sizes = np.diff(np.append(starts, len(values)))
    return np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
