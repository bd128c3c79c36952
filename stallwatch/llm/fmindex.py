"""A compressed FM-index over words: Burrows-Wheeler transform in a wavelet matrix of packed bits."""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. The end of the array sorts below every symbol."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        step = np.ones(n, np.int64)
        step[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        width *= 2
        if rank[order[-1]] == n or width >= n:
            return order


class Bits:
    """A bit vector, packed, with counts before each 64-bit block."""

    def __init__(self, bits: np.ndarray):
        blocks = -(-len(bits) // 64) + 1
        padded = np.zeros(blocks * 64, np.uint8)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view("<u8").astype(U64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)])[:-1].astype(np.int32)
        self.zeros = len(bits) - int(bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """How many of the first i bits are set."""
        block = i >> 6
        mask = (U64(1) << (i & 63).astype(U64)) - U64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)


class FMIndex:
    """Counts and intervals of word sequences in a set of segments.

    Segments are arrays of 64-bit word hashes; no match reaches over the end of a segment.
    """

    def __init__(self, segments: list[np.ndarray]):
        lengths = np.array([len(s) for s in segments])
        words, number = np.unique(np.concatenate(segments), return_inverse=True)
        self.words = words
        m = len(segments)
        text = np.empty(len(number) + m, np.int64)
        ends = np.cumsum(lengths + 1) - 1
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = number + m
        text[ends] = np.arange(m)  # each end its own symbol while sorting
        order = suffix_order(text)
        last = text[order - 1]
        last = np.where(last < m, 0, last - m + 1)
        self.size = len(text)
        counts = np.bincount(np.where(text < m, 0, text - m + 1), minlength=len(words) + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.levels: list[tuple[int, Bits]] = []
        for shift in range(max(1, int(len(words)).bit_length()) - 1, -1, -1):
            bit = ((last >> shift) & 1).astype(np.uint8)
            self.levels.append((shift, Bits(bit)))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        symbols = np.arange(len(words) + 1)
        self.base = self._down(symbols, np.zeros(len(symbols), np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(i)
            i = np.where((symbol >> shift) & 1, bits.zeros + ones, i - ones)
        return i

    def number(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words that are in the index."""
        return np.searchsorted(self.words, words) + 1

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search step: intervals of symbol + pattern from those of pattern."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        start = self.first[symbol] - self.base[symbol]
        n = len(symbol)
        return both[:n] + start, both[n:] + start

    def repeated(self, segments: list[np.ndarray], width: int, least: int = 2) -> list[list[tuple[int, int]]]:
        """Per segment the spans of words covered by a window of ``width`` words found ``least`` times or more.

        All segments are streamed side by side, one backward step at a time. The matching statistic of a
        window's end tells how far it can be skipped: if only its last n words are found often enough, no
        window that starts before the last n + 1 of them and reaches its end can be.
        """
        lengths = np.array([len(s) for s in segments])
        begin = np.cumsum(lengths) - lengths
        text = self.number(np.concatenate(segments))
        final = lengths - width  # start of the last window
        spans: list[list[tuple[int, int]]] = [[] for _ in segments]
        lane = np.flatnonzero(final >= 0)
        at = np.zeros(len(lane), np.int64)  # window on trial
        found = np.full(len(lane), -1)  # last window found
        forward = np.zeros(len(lane), np.int64)  # where to go on if the trials back from there fail; 0: moving forward
        matched = np.zeros(len(lane), np.int64)
        low, high = np.zeros(len(lane), np.int64), np.full(len(lane), self.size)
        while len(lane):
            symbol = text[begin[lane] + at + width - 1 - matched]
            low, high = self.extend(symbol, low, high)
            ok = high - low >= least
            matched += ok
            hit = ok & (matched == width)
            ended = hit | ~ok
            if ended.any():
                e = np.flatnonzero(ended)
                for k in e[hit[e]]:
                    spans[lane[k]].append((int(at[k]), int(at[k]) + width))
                h, a, f, fw, end = hit[e], at[e], found[e], forward[e], final[lane[e]]
                back = fw > 0
                # forward hit: on to the next window without overlap, or the last one; forward miss: skip, but first look back
                skip = a + width - matched[e]
                gap = ~h & ~back & (f >= 0) & (f + 1 < a) & (a - f <= width)
                ahead = np.where(h, np.where(a < end, np.minimum(a + width, end), end + 1), np.where(f + 1 < a, skip, skip))
                next_at = np.where(back, np.where(h | (a - 1 <= f), fw, a - 1), np.where(gap, a - 1, ahead))
                next_forward = np.where(back, np.where(h | (a - 1 <= f), 0, fw), np.where(gap, skip, 0))
                next_found = np.where(h, a, f)
                at[e], forward[e], found[e] = next_at, next_forward, next_found
                matched[e], low[e], high[e] = 0, 0, self.size
                keep = np.ones(len(lane), bool)
                keep[e] = next_at <= end
                if not keep.all():
                    lane, at, found, forward, matched, low, high = (x[keep] for x in (lane, at, found, forward, matched, low, high))
        return [_joined(s) for s in spans]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out
