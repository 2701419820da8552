"""Bidirectional FM-index over words between delimiters, searched for many words at once.

The text is all words in order, a delimiter before each and after the last. An index of the words and one of the
reversed words are kept in step: a state is the rank interval of a pattern in the first, the start of the interval of
the reversed pattern in the second, and their common size. A step to the left counts symbols in the first index's
transform and moves both starts; a step to the right does the same in the second. Counting is by wavelet matrices.

States are arrays, so a step costs a few numpy operations for all searches together.
"""

from __future__ import annotations

import numpy as np

#: Codes of the symbol before the text, and of the delimiter; letters follow.
BEFORE, DELIMITER, LETTERS = 0, 1, 2
#: Searches that run together, and rows whose symbols are read rather than trying the alphabet.
TOGETHER, READ = 8192, 48


class Wavelet:
    """Counts of symbols, and of smaller ones, before any place of a sequence."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, (size - 1).bit_length())
        self.levels = []
        #: Where a symbol's path begins on each level.
        start, known = np.zeros(size, np.int64), np.arange(size)
        for bit in reversed(range(self.bits)):
            one = (symbols >> bit & 1).astype(np.uint8)
            words = np.zeros(len(one) // 64 + 1, np.uint64)
            packed = np.packbits(one, bitorder="little")
            words.view(np.uint8)[: len(packed)] = packed
            ahead = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
            zeros = len(one) - int(one.sum())
            level = (words, ahead, zeros)
            self.levels.append((bit, *level, start))
            ones = self._ones(words, ahead, start)
            start = np.where(known >> bit & 1, zeros + ones, start - ones)
            symbols = np.concatenate([symbols[one == 0], symbols[one == 1]])

    @staticmethod
    def _ones(words: np.ndarray, ahead: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return ahead[word] + np.bitwise_count(words[word] & mask)

    def before(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the symbol, and how many smaller symbols, stand before a place."""
        smaller = np.zeros(len(at), np.int64)
        for bit, words, ahead, zeros, start in self.levels:
            begin = start[symbol]
            ones, first = self._ones(words, ahead, at), self._ones(words, ahead, begin)
            set_ = (symbol >> bit & 1).astype(bool)
            smaller += np.where(set_, (at - ones) - (begin - first), 0)
            at = np.where(set_, zeros + ones, at - ones)
            end = np.where(set_, zeros + first, begin - first)
        return at - end, smaller


class Side:
    """The transform of sorted words: of every suffix in order, the symbol before it."""

    def __init__(self, words: list[np.ndarray], size: int):
        length = np.fromiter(map(len, words), np.int64, len(words))
        delimiters = np.concatenate([[0], np.cumsum(length + 1)])
        text = np.full(delimiters[-1] + 1, DELIMITER, np.int64)
        inside = np.ones(len(text), bool)
        inside[delimiters] = False
        text[inside] = np.concatenate(words) if words else []
        # Every delimiter is a symbol of its own, in order, so words end all comparisons.
        rank = text + len(words)
        rank[delimiters] = np.arange(len(delimiters))
        width, distinct = 1, 0
        while distinct < len(text):
            second = np.concatenate([rank[width:], np.zeros(min(width, len(text)), np.int64)])[: len(text)]
            found, rank = np.unique(rank * (len(text) + size + 1) + second, return_inverse=True)
            distinct, width = len(found), 2 * width
        order = np.empty(len(text), np.int64)
        order[rank] = np.arange(len(text))
        self.symbols = np.where(order > 0, text[order - 1], BEFORE)
        self.wavelet = Wavelet(self.symbols, size)
        #: First rows of suffixes that begin with a symbol.
        counts = np.bincount(text, minlength=size + 1)
        self.first = np.cumsum(counts) - counts

    def step(self, symbol, own, other, size):
        """States with the symbol put before: starts in this index and the other one, and sizes."""
        n, smaller = self.wavelet.before(np.concatenate([symbol, symbol]), np.concatenate([own, own + size]))
        low, high = n[: len(own)], n[len(own):]
        return self.first[symbol] + low, other + smaller[len(own):] - smaller[: len(own)], high - low


class Index:
    """Both sides of a list of words, sorted and without repeats, and searches in it."""

    def __init__(self, words: list[str]):
        if any(a >= b for a, b in zip(words, words[1:])) or "" in words:
            raise ValueError("words must be sorted, without repeats and not empty")
        self.words = words
        self.letters = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"))
        size = len(self.letters) + LETTERS
        codes = [self.codes(w) for w in words]
        self.size = size
        self.plain = Side(codes, size)
        turned = sorted(range(len(words)), key=lambda i: words[i][::-1])
        self.reversed = Side([codes[i][::-1] for i in turned], size)

    def codes(self, word: str) -> np.ndarray:
        """Codes of a word's letters; ``size`` (no symbol of the text) for letters that no word has."""
        points = np.frombuffer(word.encode("utf-32-le"), "<u4")
        at = np.searchsorted(self.letters, points)
        known = np.take(self.letters, at, mode="clip") == points if len(self.letters) else np.zeros(len(points), bool)
        return np.where(known, at + LETTERS, len(self.letters) + LETTERS).astype(np.int64)

    def near(self, queries: list[str], left_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of words at exactly one edit of a query that keep its left half (or its right half)
        at their own left (right) end."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if self.words:
            for at in range(0, len(queries), TOGETHER):
                part = [self.codes(q) for q in queries[at: at + TOGETHER]]
                q, w = self._left(part) if left_half else self._right(part)
                found.append((q + at, w))
        return tuple(map(np.concatenate, zip(*found)))

    def _left(self, codes):
        query, own, _ = _search(self.plain, self.reversed, codes, [len(c) // 2 for c in codes], self.size)
        return _distinct(query, own, len(self.words) + 1)

    def _right(self, codes):
        """The same on the mirrored index: the row among plain words is the other side's."""
        query, _, own = _search(
            self.reversed, self.plain, [c[::-1] for c in codes], [len(c) - len(c) // 2 for c in codes], self.size)
        return _distinct(query, own, len(self.words) + 1)


def _distinct(query, word, size):
    key = np.unique(query * size + word)
    return key // size, key % size


def _search(left: Side, right: Side, codes: list[np.ndarray], halves: list[int], size: int):
    """Matches of each query's first ``halves`` symbols without an edit and of the rest with one, between delimiters:
    (query, row in ``left``, row in ``right``); a row of a whole match is the number of the word."""
    length = np.fromiter(map(len, codes), np.int64, len(codes))
    start = np.cumsum(length) - length
    flat = np.append(np.concatenate(codes) if codes else np.empty(0, np.int64), DELIMITER)
    half = np.array(halves, np.int64)

    # The exact half, from its middle to the delimiter on its outer side.
    query = np.flatnonzero((half > 0) & (half <= length))
    symbol = flat[start[query] + half[query] - 1]
    query, symbol = query[symbol < size], symbol[symbol < size]
    own = left.first[symbol]
    state = [query, half[query] - 2, own, own.copy(), left.first[symbol + 1] - own]
    done = []
    while len(state[0]):
        query, at, own, other, n = state
        symbol = np.where(at >= 0, flat[start[query] + np.maximum(at, 0)], DELIMITER)
        alive = symbol < size
        query, at, symbol, own, other, n = (x[alive] for x in (query, at, symbol, own, other, n))
        own, other, n = left.step(symbol, own, other, n)
        ended = (at < 0) & (n > 0)
        done.append([x[ended] for x in (query, own, other, n)])
        state = [x[(n > 0) & (at >= 0)] for x in (query, at - 1, own, other, n)]
    query, own, other, n = (np.concatenate(x) for x in zip(*done)) if done else [np.empty(0, np.int64)] * 4

    def extended(query, symbol, own, other, n):
        """States with a symbol put behind; those that no word has are gone. Returns what stays, and the states."""
        alive = np.flatnonzero(symbol < size)
        b, a, m = right.step(symbol[alive], other[alive], own[alive], n[alive])
        held = m > 0
        return alive[held], a[held], b[held], m[held]

    found = []
    exact = [query, half[query], own, other, n]  # nothing wrong yet, up to a place in the query
    edited = [[np.empty(0, np.int64)] * 5]
    while len(exact[0]) or sum(len(e[0]) for e in edited):
        # After its edit, a match goes on without another one, and ends at the delimiter.
        query, at, own, other, n = (np.concatenate(x) for x in zip(*edited))
        last = at == length[query]
        symbol = np.where(last, DELIMITER, flat[start[query] + np.where(last, 0, at)])
        kept, own, other, n = extended(query, symbol, own, other, n)
        query, at, last = query[kept], at[kept], last[kept]
        found.append((query[last], own[last], other[last]))
        edited = [[x[~last] for x in (query, at + 1, own, other, n)]]

        query, at, own, other, n = exact
        if not len(query):
            continue
        inner = at < length[query]
        # A symbol of the query that the word lacks.
        edited.append([x[inner] for x in (query, at + 1, own, other, n)])
        # Another symbol, or one more.
        of, symbol = _letters_after(right, other, n, size)
        kept, a, b, m = extended(query[of], symbol, own[of], other[of], n[of])
        of, symbol = of[kept], symbol[kept]
        edited.append([query[of], at[of], a, b, m])
        wrong = inner[of] & (symbol != flat[start[query[of]] + np.where(inner[of], at[of], 0)])
        edited.append([x[wrong] for x in (query[of], at[of] + 1, a, b, m)])
        # The same symbol.
        query, at, own, other, n = (x[inner] for x in exact)
        kept, own, other, n = extended(query, flat[start[query] + at], own, other, n)
        exact = [query[kept], at[kept] + 1, own, other, n]
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(map(np.concatenate, zip(*found)))


def _letters_after(right: Side, other: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(state, letter) that may follow: read from the rows of small intervals, the whole alphabet for large ones."""
    small = np.flatnonzero(n <= READ)
    rows = n[small]
    ramp = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
    key = np.unique(np.repeat(small, rows) * size + right.symbols[np.repeat(other[small], rows) + ramp])
    key = key[key % size >= LETTERS]
    large = np.flatnonzero(n > READ)
    letters = np.arange(LETTERS, size)
    return (np.concatenate([key // size, np.repeat(large, len(letters))]),
            np.concatenate([key % size, np.tile(letters, len(large))]))
