"""A bidirectional FM-index over a delimited list of words, and its one-error search.

The words stand in one text with a delimiter before, between and after them. The index holds the
Burrows-Wheeler transforms of the text and of the text reversed; a pattern is a pair of intervals of
suffix ranks, one in each, of equal width. Adding a letter at the pattern's left end moves the
interval in the first by rank counts and the other with it, and the other way round, so a search can
begin in the middle of a pattern and change direction. All patterns are searched at once: a step is a
handful of array operations over the live states.
"""

from __future__ import annotations

import numpy as np

DELIMITER = "\x01"
_STRIDE = 32
#: Patterns searched together; bounds the memory of a step.
_TOGETHER = 4096
#: Up to this width the letters that follow are read off the interval, above it every letter is tried.
_NARROW = 64


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the last code must be the smallest and stand nowhere else."""
    n = len(codes)
    bits = max(1, int(codes.max()).bit_length())
    k = max(1, 62 // bits)
    padded = np.concatenate([codes.astype(np.int64), np.zeros(k, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(k):  # the first k letters in one number
        key = (key << bits) | padded[i:i + n]
    while True:
        order = np.argsort(key, kind="stable")
        step = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], step[1:] != step[:-1]]))
        if rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[:n - k if k < n else 0] = rank[k:] + 1
        key = rank * (n + 1) + after
        k *= 2


class Transform:
    """Burrows-Wheeler transform of a code sequence with rank counts."""

    def __init__(self, codes: np.ndarray, sigma: int):
        self.order = suffix_order(codes)
        bwt = codes[self.order - 1].astype(np.uint8)
        self.bwt, self.n, self.sigma = bwt, len(bwt), sigma
        self.first = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=sigma))]).astype(np.int64)
        blocks = -(-(self.n + 1) // _STRIDE)
        full = np.full(blocks * _STRIDE, 255, np.uint8)
        full[:self.n] = bwt
        self.rows = full.reshape(blocks, _STRIDE)
        counts = np.zeros((blocks + 1, sigma), np.int32)
        block = np.arange(self.n) // _STRIDE
        np.add.at(counts, (block + 1, bwt), 1)
        self.before = np.cumsum(counts, axis=0, dtype=np.int32)
        self.less_before = np.concatenate([np.zeros((blocks + 1, 1), np.int32), np.cumsum(self.before, axis=1, dtype=np.int32)], axis=1)

    def _inside(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.rows[i // _STRIDE], np.arange(_STRIDE)[None, :] < (i % _STRIDE)[:, None]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often code c stands before place i of the transform."""
        row, here = self._inside(i)
        return self.before[i // _STRIDE, c] + ((row == c[:, None]) & here).sum(axis=1)

    def less(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How many codes smaller than c stand before place i."""
        row, here = self._inside(i)
        return self.less_before[i // _STRIDE, c] + ((row < c[:, None]) & here).sum(axis=1)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first[c] + self.rank(c, lo), self.first[c] + self.rank(c, hi)


class WordIndex:
    """Bidirectional index of distinct, non-empty words that do not hold the delimiter."""

    def __init__(self, words: list[str]):
        points = np.frombuffer((DELIMITER + DELIMITER.join(words) + DELIMITER).encode("utf-32-le"), "<u4")
        self.letters, codes = np.unique(points, return_inverse=True)
        codes = codes + 1  # 0 is the end of the text, 1 the delimiter
        if len(self.letters) > 253:
            raise ValueError("more than 252 different letters")
        sigma = len(self.letters) + 1
        self.sigma = sigma
        self.left = Transform(np.append(codes, 0), sigma)
        self.right = Transform(np.append(codes[::-1], 0), sigma)
        # a suffix of the reversed text that begins with the delimiter after a word names the word
        ends = self.right.order[self.right.first[1]:self.right.first[2]]
        self.word_at = np.cumsum(codes == 1)[len(codes) - 1 - ends] - 2

    def codes(self, patterns: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The patterns' codes in one row each, the delimiter after the last; -1 for letters that the
        text does not hold."""
        size = np.array([len(p) for p in patterns])
        points = np.frombuffer("".join(patterns).encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        known = np.where(self.letters[at] == points, at + 1, -1)
        out = np.ones((len(patterns), int(size.max()) + 1), np.int64)
        out[np.arange(out.shape[1])[None, :] < size[:, None]] = known
        return out, size

    def _half(self, p: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Delimiter and the first ``exact`` letters, matched leftwards from the border between the
        halves. (pattern, lo, hi) with the interval in the reversed text."""
        q = np.arange(len(p))
        lo, hi = np.zeros(len(p), np.int64), np.full(len(p), self.left.n, np.int64)
        other = lo.copy()
        done = []
        for t in range(int(exact.max()) + 1 if len(p) else 0):
            last = t == exact[q]
            c = np.where(last, 1, p[q, np.maximum(exact[q] - 1 - t, 0)])
            ok = c > 0
            q, lo, hi, other, c, last = q[ok], lo[ok], hi[ok], other[ok], c[ok], last[ok]
            shift = self.left.less(c, hi) - self.left.less(c, lo)
            lo, hi = self.left.extend(c, lo, hi)
            other = other + shift
            ok = hi > lo
            end = ok & last
            done.append((q[end], other[end], (other + hi - lo)[end]))
            ok &= ~last
            q, lo, hi, other = q[ok], lo[ok], hi[ok], other[ok]
        return tuple(np.concatenate(x) for x in zip(*done))

    def _children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter) for every letter that can follow each state to the right."""
        width = hi - lo
        narrow = np.flatnonzero(width <= _NARROW)
        w = width[narrow]
        state = np.repeat(narrow, w)
        row = np.repeat(lo[narrow] - np.concatenate([[0], np.cumsum(w)[:-1]]), w) + np.arange(w.sum()) if len(w) else np.empty(0, np.int64)
        pairs = np.unique(state * 256 + self.right.bwt[row])
        wide = np.flatnonzero(width > _NARROW)
        every = (wide[:, None] * 256 + np.arange(2, self.sigma)[None, :]).ravel()
        pairs = np.concatenate([pairs, every])
        return pairs >> 8, pairs & 255

    def _one_error(self, p: np.ndarray, size: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q, lo, hi = self._half(p, exact)                       # states without an error yet
        xq, xlo, xhi = (np.empty(0, np.int64) for _ in range(3))  # states with their error made
        found = []
        for t in range(int((size - exact).max()) + 1 if len(size) else 0):
            c = p[q, exact[q] + t]
            state, letter = self._children(lo, hi)
            ok = (letter > 1) & (letter != c[state])
            state, letter = state[ok], letter[ok]
            clo, chi = self.right.extend(letter, lo[state], hi[state])
            ok = chi > clo
            state, clo, chi = state[ok], clo[ok], chi[ok]
            # inserted: the letter c is still to come
            xq, xlo, xhi = np.append(xq, q[state]), np.append(xlo, clo), np.append(xhi, chi)
            xc = p[xq, exact[xq] + t]
            ok = xc > 0
            xq, xlo, xhi, xc = xq[ok], xlo[ok], xhi[ok], xc[ok]
            xlo, xhi = self.right.extend(xc, xlo, xhi)
            ok, end = xhi > xlo, xc == 1
            found.append((xq[ok & end], xlo[ok & end]))
            ok &= ~end
            xq, xlo, xhi = xq[ok], xlo[ok], xhi[ok]
            # replaced (the letter instead of c) or deleted (nothing instead of c); c is not the delimiter
            inner = c != 1
            ok = inner[state]
            xq = np.concatenate([xq, q[state][ok], q[inner]])
            xlo, xhi = np.concatenate([xlo, clo[ok], lo[inner]]), np.concatenate([xhi, chi[ok], hi[inner]])
            ok = c > 1
            q, lo, hi, c = q[ok], lo[ok], hi[ok], c[ok]
            lo, hi = self.right.extend(c, lo, hi)
            ok = hi > lo
            q, lo, hi = q[ok], lo[ok], hi[ok]
        a, at = (np.concatenate(x) for x in zip(*found))
        pairs = np.unique(a * (len(self.word_at) + 1) + self.word_at[at - self.right.first[1]])
        return pairs // (len(self.word_at) + 1), pairs % (len(self.word_at) + 1)

    def search(self, patterns: list[str], exact: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, word number) of all pairs that differ by exactly one inserted, deleted or
        replaced letter after the first ``exact`` letters of the pattern, which are equal."""
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        by_size = np.argsort([len(p) for p in patterns], kind="stable")
        for start in range(0, len(patterns), _TOGETHER):
            some = by_size[start:start + _TOGETHER]
            p, size = self.codes([patterns[i] for i in some])
            x, y = self._one_error(p, size, np.array([exact[i] for i in some]))
            a.append(some[x])
            b.append(y)
        return np.concatenate(a), np.concatenate(b)
