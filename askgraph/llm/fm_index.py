"""A compressed full-text index over words, for many searches at a time.

The Burrows-Wheeler transform of a text lies in a wavelet matrix of four bits of a
word number a level: one bit vector per value of these, with counts every 64 bits.
A step of backward search takes a pattern's range to the range of the pattern with
one more word in front. All searches move in step, so that a step is a few array
operations. An index is stored as the digits of its transform.
"""

from __future__ import annotations

import io

import numpy as np

#: Suffixes are ordered by so many words unless said otherwise, and patterns are at most so long.
ORDER = 128
#: Bits of a digit, and the values it takes.
DIGIT, SIZE = 4, 16
#: The bits below each of a block's 64 places.
BELOW = (np.uint64(1) << np.arange(64, dtype="u8")) - np.uint64(1)


def suffix_order(text: np.ndarray, words: int = ORDER) -> np.ndarray:
    """Starts of suffixes by their first ``words`` words, by doubling the compared length."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, reach, order = rank.astype("i8") + 1, 1, None
    while True:
        second = np.zeros(n, "i8")
        second[: max(0, n - reach)] = rank[reach:]
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        rank[order] = new
        reach *= 2
        if reach >= words or new[-1] == n:
            return order


class WaveletMatrix:
    """A level per digit of the symbols, the upper digits first, each in the order of those above.

    A level has a bit vector per value of its digit. Counts go on from one value
    to the next, so that a count is a place in the level below.
    """

    def __init__(self, digits: np.ndarray):
        self.digits = digits  # (levels, places)
        places = digits.shape[1]
        self.blocks = places // 64 + 1
        padded = np.full(self.blocks * 64, SIZE, "u1")
        self.levels = []
        for level in digits:
            padded[:places] = level
            bits = [np.packbits(padded == value, bitorder="little").view("<u8") for value in range(SIZE)]
            bits = np.concatenate(bits)
            ones = np.bitwise_count(bits)
            self.levels.append((bits, (np.cumsum(ones, dtype="i4") - ones).astype("i4")))

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        levels = []
        for place in range(-(-bits // DIGIT))[::-1]:
            digit = ((values >> (DIGIT * place)) & (SIZE - 1)).astype("u1")
            levels.append(digit)
            values = values[np.argsort(digit, kind="stable")]
        return cls(np.stack(levels))

    def place(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the ends come to lie below the last level, by the symbol's digits.

        For a symbol this grows by its number before an end.
        """
        at = ends
        for level, (bits, counts) in enumerate(self.levels, 1):
            digit = (symbols >> (DIGIT * (len(self.levels) - level))) & (SIZE - 1)
            block = digit * self.blocks + (at >> 6)
            at = counts[block] + np.bitwise_count(bits[block] & BELOW[at & 63])
        return at


def _paired(digits: np.ndarray) -> np.ndarray:
    """Two digits of a level in a byte."""
    even = np.pad(digits, ((0, 0), (0, digits.shape[1] % 2)))
    return even[:, ::2] << DIGIT | even[:, 1::2]


class FMIndex:
    """Index of segments of words. Numbers from 1 stand for words, 0 parts segments."""

    def __init__(
        self, vocabulary: dict[bytes, int], first: np.ndarray, matrix: WaveletMatrix, order: int = ORDER
    ):
        self.vocabulary, self.first, self.matrix, self.order = vocabulary, first, matrix, order
        self.size = int(first[-1])
        symbols = np.arange(len(first) - 1)
        #: what leads from a symbol's places in the matrix to those of its suffixes
        self.shift = first[:-1] - matrix.place(symbols, np.zeros_like(symbols))

    @classmethod
    def build(cls, text: np.ndarray, vocabulary: dict[bytes, int], order: int = ORDER) -> FMIndex:
        transform = text[suffix_order(text, order) - 1]
        symbols = len(vocabulary) + 1
        first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        bits = max(1, int(symbols).bit_length())
        return cls(vocabulary, first.astype("i8"), WaveletMatrix.build(transform, bits), order)

    def extend(self, words: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Ranges of the patterns with a word in front; unknown words (below 0) give none."""
        known = words >= 0
        symbol = np.where(known, words, 0)
        both = self.matrix.place(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        shift = self.shift[symbol]
        low, high = shift + both[: len(words)], shift + both[len(words) :]
        return low, np.where(known, high, low)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out,
            words=np.frombuffer(b" ".join(self.vocabulary), "u1"),
            first=self.first.astype("i4"),
            digits=_paired(self.matrix.digits),
            order=np.array(self.order),
        )
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> FMIndex:
        with np.load(io.BytesIO(data)) as x:
            words = x["words"].tobytes().split()
            digits = x["digits"]
            digits = np.stack([digits >> DIGIT, digits & (SIZE - 1)], 2).reshape(len(digits), -1)
            matrix = WaveletMatrix(digits[:, : x["first"][-1]])
            vocabulary = {w: i + 1 for i, w in enumerate(words)}
            return cls(vocabulary, x["first"].astype("i8"), matrix, int(x["order"]))


def matched_windows(
    index: FMIndex,
    text: np.ndarray,
    first: np.ndarray,
    last: np.ndarray,
    window: int,
    least: int,
    probe: int = 5,
) -> np.ndarray:
    """Which windows of ``text`` occur at least ``least`` times in the index.

    Lane k covers the windows that start at first[k] .. last[k], from the last
    to the first. A pattern grows to the left while it occurs often enough, and
    each word in front of ``window`` words or more is the start of a match: the
    matching statistic of that position is long enough. Where a pattern ends,
    no window around it can match, and the next window that might is tried by a
    few words at its left end, which most windows without a match fail.
    """
    if window > index.order:
        raise ValueError(f"the index orders suffixes by {index.order} words; a window has {window}")
    hit = np.zeros(len(text) + 1, bool)
    wanted = last.astype("i8").copy()  # the next window to decide
    left = wanted + probe
    right = left.copy()
    probing = np.ones(len(first), bool)
    low, high = np.zeros(len(first), "i8"), np.full(len(first), index.size)
    live = np.flatnonzero(wanted >= first)
    while len(live):
        at = left[live] - 1
        new_low, new_high = index.extend(text[at], low[live], high[live])
        fine = new_high - new_low >= least
        good, bad = live[fine], live[~fine]
        left[good] -= 1
        low[good], high[good] = new_low[fine], new_high[fine]
        # a probe that reaches its window's start: try the window itself
        probed = good[probing[good] & (left[good] == wanted[good])]
        restart = [probed]
        running = good[~probing[good]]
        full = running[right[running] - left[running] >= window]
        hit[left[full]] = True
        wanted[full] = left[full] - 1
        long = full[right[full] - left[full] >= index.order]
        restart.append(long)
        for some in restart:
            probing[some] = False
            left[some] = right[some] = wanted[some] + window
            low[some], high[some] = 0, index.size
        # [at, right) is too rare: windows around it are decided
        stop = at[~fine]
        was_probe = probing[bad]
        wanted[bad] = np.where(
            was_probe,
            np.minimum(wanted[bad], right[bad] - window - 1),
            np.minimum(stop, right[bad] - window - 1),
        )
        probing[bad] = True
        left[bad] = right[bad] = wanted[bad] + probe
        low[bad], high[bad] = 0, index.size
        live = live[wanted[live] >= first[live]]
    return hit[:-1]
