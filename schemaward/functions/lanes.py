"""Common subsequences of many pairs of texts at once, one pair per lane of a numpy array.

Texts become rows of code points, padded with marks that equal nothing, so a padded
row or column changes no length. A lane holds the bits of the first text in words of
64; pairs beyond ``WORDS`` words go one by one over a big integer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WORDS = 8
_ROWS = 4096
_CELLS = 1 << 21  # numbers of one array held at once


def one_lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence of one pair, by carry propagation."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for ch in b:
        hit = free & where.get(ch, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


class _Texts:
    """Texts as one run of letter numbers; 0 stands for no letter and is what rows are padded with."""

    def __init__(self, texts: Sequence[str]):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        number = np.zeros(int(points.max(initial=0)) + 1, dtype=np.int32)
        number[points] = 1
        letters = np.flatnonzero(number)
        number[letters] = np.arange(1, len(letters) + 1)
        self.letters, self.run = len(letters), np.append(number[points], np.int32(0))
        self.size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.start = np.cumsum(self.size) - self.size

    def rows(self, which: np.ndarray, width: int) -> np.ndarray:
        """Letter numbers of some texts, one column per text."""
        at = np.arange(width)[:, None]
        return self.run.take(np.where(at < self.size[which], self.start[which] + at, len(self.run) - 1))


def _groups(left: np.ndarray, right: np.ndarray, letters: int = 0) -> Iterator[np.ndarray]:
    """Pairs of similar lengths together, so that little is padded; ``left`` and ``right`` are lengths."""
    order = np.lexsort((right, left))
    at = 0
    while at < len(order):
        some = order[at:at + _ROWS]
        while len(some) > 1 and len(some) * max(int(left[some].max()) + int(right[some].max()), letters * -(-int(left[some].max()) // 64)) > _CELLS:
            some = some[:len(some) // 2]
        yield some
        at += len(some)


def lcs_lengths(lefts: Sequence[str], rights: Sequence[str]) -> np.ndarray:
    """Longest common subsequence of every pair; the shorter text is the one held in bits."""
    count = len(lefts)
    texts = _Texts([*lefts, *rights])
    mine, other = texts.size[:count], texts.size[count:]
    index = np.arange(count)
    short, long = np.where(mine <= other, index, index + count), np.where(mine <= other, index + count, index)
    sizes = texts.size[short]
    out = np.zeros(count, dtype=np.int64)
    for i in np.flatnonzero(sizes > 64 * WORDS):
        out[i] = one_lcs(lefts[i], rights[i])
    lanes = np.flatnonzero((sizes > 0) & (sizes <= 64 * WORDS))
    for some in _groups(sizes[lanes], texts.size[long[lanes]], texts.letters + 1):
        at = lanes[some]
        out[at] = _lane_lengths(texts, short[at], long[at])
    return out


def _lane_lengths(texts: _Texts, shorts: np.ndarray, longs: np.ndarray) -> np.ndarray:
    m, n, rows = int(texts.size[shorts].max()), int(texts.size[longs].max()), len(shorts)
    words = -(-m // 64)
    base = np.arange(rows) * (texts.letters + 1)
    left, right = texts.rows(shorts, m), texts.rows(longs, n)
    table = np.zeros((words, rows * (texts.letters + 1)), dtype=np.uint64)
    for i in range(m):
        table[i // 64, base + left[i]] |= np.uint64(1 << i % 64)
    table[:, base] = 0
    free = np.full((words, rows), np.iinfo(np.uint64).max, dtype=np.uint64)
    for letter in right:
        at, carry = base + letter, None
        for w in range(words):
            old = free[w]
            hit = old & table[w].take(at)
            total = old + hit
            if words > 1:
                over = total < old
                if carry is not None:
                    total = total + carry
                    over |= (total == 0) & (carry == 1)
                carry = over.astype(np.uint64)
            free[w] = total | (old ^ hit)
    return 64 * words - np.bitwise_count(free).sum(axis=0).astype(np.int64)


def window_ratios(shorts: Sequence[str], longs: Sequence[str]) -> np.ndarray:
    """Best ratio (0-100) of each short text to a window of its length in the long one, windows clipped at both ends.

    One pass over a pair combs its strands: a strand that enters at the top of column s and
    leaves at the bottom of column c is a letter missed by every window that holds s to c. So
    the subsequence length of all windows follows from the strands, in |short| x |long| steps,
    taken along the diagonals of all pairs together. Texts must not be empty.
    """
    out = np.zeros(len(shorts))
    texts = _Texts([*shorts, *longs])
    left, right = texts.size[:len(shorts)], texts.size[len(shorts):]
    for some in _groups(left, right):
        out[some] = _combed(texts, some, some + len(shorts))
    return out


def _combed(texts: _Texts, shorts: np.ndarray, longs: np.ndarray) -> np.ndarray:
    k, size, rows = texts.size[shorts], texts.size[longs], len(shorts)
    m, n = int(k.max()), int(size.max())
    # lanes are the last axis: slices along a diagonal stay contiguous; the padding of the two sides is not equal
    a, b = texts.rows(shorts, m)[::-1], texts.rows(longs, n)
    b = np.where(b == 0, -1, b)
    across = np.repeat(np.arange(m, dtype=np.int32)[:, None], rows, axis=1)
    down = np.repeat(np.arange(m, m + n, dtype=np.int32)[:, None], rows, axis=1)
    for d in range(m + n - 1):
        # cells (i, d - i) of one diagonal; row i of the grid is row m - 1 - i of the reversed text
        low, high = max(0, d - n + 1), min(m - 1, d)
        rs, cs = slice(m - 1 - high, m - low), slice(d - high, d - low + 1)
        h, v = across[rs], down[cs]
        swap = (a[rs] == b[cs]) | (h > v)
        across[rs], down[cs] = np.where(swap, v, h), np.where(swap, h, v)
    start = down.astype(np.int64) - m  # where the strand leaving at column c came in, below 0: from the side
    column = np.arange(n)[:, None]
    first = column - k + 1
    missed = (start >= 0) & (first <= start) & (column < size)
    # window i begins at column i, from 1 - k on; its count is a running sum over the ranges of strands
    lanes = np.broadcast_to(np.arange(rows), (n, rows))
    change = np.zeros((n + m + 1, rows), dtype=np.int64)
    np.add.at(change, ((first + m - 1)[missed], lanes[missed]), 1)
    np.add.at(change, ((start + m)[missed], lanes[missed]), -1)
    begin = np.arange(1 - m, n + 2)[:, None]
    width = np.minimum(begin + k, size) - np.maximum(begin, 0)
    length = width - np.cumsum(change, axis=0)
    valid = (begin > -k) & (begin < size)
    return np.where(valid, 200.0 * length / np.where(valid, k + width, 1), 0.0).max(axis=0)
