"""A succinct index of one shard of words: it counts and locates phrases without the text.

The shard is a sequence of pieces (documents, or parts of very long ones), each closed by a separator. Suffixes are
sorted by prefix doubling in which every separator is a symbol of its own, so no comparison runs past the end of a
piece. What is kept is the Burrows-Wheeler transform as a wavelet matrix (one bit vector for each bit of a symbol), the
number of smaller symbols, and the text position of every `SAMPLED`-th suffix and of each piece's first word. Backward
search narrows the interval of suffixes that start with the phrase, word by word from its end, by two ranks a step;
an occurrence is located by stepping back through the text until a sampled suffix is met. Both work on arrays of
phrases and occurrences at once.
"""

from __future__ import annotations

import numpy as np

SAMPLED = 16
_CHUNK = 1 << 18  # occurrences located at a time


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of `text`, which holds 0 at separators (each unlike any other) and ends with one."""
    n = len(text)
    ends = text == 0
    symbols = text.astype(np.int64) + int(ends.sum())
    symbols[ends] = np.arange(int(ends.sum()))
    bits = max(1, int(symbols.max()).bit_length())
    width = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for i in range(width):
        key <<= bits
        key[: max(0, n - i)] |= symbols[i:]
    order = np.argsort(key)
    opens = _opens(key[order])
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, slots, 0))
    slots = slots[_several(opens)]
    while len(slots):
        at = order[slots]
        key = rank[at] * n + rank[at + width]  # a suffix without its own separator so far goes on for `width` at least
        by = np.argsort(key)
        at, opens = at[by], _opens(key[by])
        order[slots] = at
        rank[at] = np.maximum.accumulate(np.where(opens, slots, 0))
        slots = slots[_several(opens)]
        width *= 2
    return order


def _opens(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], keys[1:] != keys[:-1]])


def _several(opens: np.ndarray) -> np.ndarray:
    """Members of groups of two or more, by which members open a group."""
    return ~(opens & np.append(opens[1:], True))


class FMIndex:
    def __init__(self, bits: np.ndarray, less: np.ndarray, marks: np.ndarray, places: np.ndarray):
        self.bits, self.less, self.marks, self.places = bits, less, marks, places
        self.before = [_before(level) for level in bits]
        self.zeros = [int(less[-1] - before[-1]) for before in self.before]
        self.marked = _before(marks)
        self.first = self._down(np.arange(len(less) - 1), np.zeros(len(less) - 1, np.int64))

    @classmethod
    def of(cls, text: np.ndarray, symbols: int) -> FMIndex:
        """Of a text of words 1 to `symbols` - 1, with separators 0, one of them last."""
        order = suffix_array(text)
        previous = text[order - 1].astype(np.int32)
        levels = []
        for level in reversed(range(max(1, (symbols - 1).bit_length()))):
            ones = (previous >> level & 1).astype(bool)
            levels.append(_packed(ones))
            previous = np.concatenate([previous[~ones], previous[ones]])
        less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        kept = (order % SAMPLED == 0) | (text[order - 1] == 0)
        return cls(np.array(levels), less, _packed(kept), order[kept].astype(np.uint32))

    def to_columns(self) -> dict[str, bytes]:
        return {
            "bits": self.bits.tobytes(), "less": self.less.astype("<i8").tobytes(),
            "marks": self.marks.tobytes(), "places": self.places.tobytes(),
        }

    @classmethod
    def from_columns(cls, bits: bytes, less: bytes, marks: bytes, places: bytes) -> FMIndex:
        flags = np.frombuffer(marks, np.uint64)
        levels = np.frombuffer(bits, np.uint64).reshape(-1, len(flags))
        return cls(levels, np.frombuffer(less, "<i8"), flags, np.frombuffer(places, np.uint32))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the positions `at` of the transform lie after the levels that lead to each symbol."""
        top = len(self.bits) - 1
        for i, (level, before) in enumerate(zip(self.bits, self.before)):
            ones = _rank(level, before, at)
            at = np.where(symbols >> (top - i) & 1, self.zeros[i] + ones, at - ones)
        return at

    def _step(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The suffixes that start with `symbols`, before which lie the first `at` of the transform."""
        return self.less[symbols] + self._down(symbols, at) - self.first[symbols]

    def intervals(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For phrases of one length (rows) the interval of suffixes that start with each, empty if none does."""
        low, high = self.less[phrases[:, -1]].copy(), self.less[phrases[:, -1] + 1].copy()
        live = np.flatnonzero(low < high)
        for column in reversed(range(phrases.shape[1] - 1)):
            words = phrases[live, column]
            low[live], high[live] = self._step(words, low[live]), self._step(words, high[live])
            live = live[low[live] < high[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in these rows of the order."""
        found = np.empty(len(rows), np.int64)
        for start in range(0, len(rows), _CHUNK):
            found[start : start + _CHUNK] = self._locate(rows[start : start + _CHUNK].copy())
        return found

    def _locate(self, rows: np.ndarray) -> np.ndarray:
        found, live, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(live):
            here = rows[live]
            known = _bit(self.marks, here)
            found[live[known]] = self.places[_rank(self.marks, self.marked, here[known])] + np.int64(steps)
            live, here = live[~known], here[~known]
            rows[live] = self._back(here)
            steps += 1
        return found

    def _back(self, at: np.ndarray) -> np.ndarray:
        """The suffix that starts one word earlier (its word is not a separator, since firsts are sampled)."""
        symbols, down = np.zeros(len(at), np.int64), at
        for i, (level, before) in enumerate(zip(self.bits, self.before)):
            one, ones = _bit(level, down), _rank(level, before, down)
            symbols = symbols << 1 | one
            down = np.where(one, self.zeros[i] + ones, down - ones)
        return self.less[symbols] + down - self.first[symbols]


def _packed(flags: np.ndarray) -> np.ndarray:
    """Bits in words of 64, with one word more so that a rank at the end needs no exception."""
    packed = np.packbits(flags, bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view("<u8")


def _before(words: np.ndarray) -> np.ndarray:
    """The number of ones before each word, and of all."""
    return np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])


def _rank(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of ones before each position."""
    word = at >> 6
    mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return before[word] + np.bitwise_count(words[word] & mask)


def _bit(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
