"""Word arrays over Arrow text columns: numpy on the UTF-8 bytes, no Python loop over words.

A word is a maximal run of bytes of one class. Both classes used here hold every byte of a
non-ASCII character or none, so runs of bytes and runs of characters are the same thing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text bytes worked on at once; a longer single document is one chunk of its own.
CHUNK_BYTES = 1 << 20


def byte_class(separators: str) -> np.ndarray:
    """Table of 256 flags: False for the ASCII separators, True for all other bytes."""
    table = np.ones(256, dtype=bool)
    table[[ord(c) for c in separators]] = False
    return table


#: Words are runs of anything but space, tab, newline, vertical tab, form feed and carriage return.
SPACED = byte_class(" \t\n\v\f\r")
#: Words are runs of ASCII letters and digits and of all non-ASCII characters.
ALNUM = byte_class("".join(chr(i) for i in range(128) if not chr(i).isalnum()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the splitmix64 finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x2545F4914F6CDD1D
_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n at least."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        up, down = np.full(size, U64(_BASE)), np.full(size, U64(pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS[0], _POWERS[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order. fold_case: A-Z count as a-z."""
    out = np.empty(len(starts), dtype=U64)
    values = _FOLDED if fold_case else _VALUES
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK_BYTES)))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(hi - lo)
        total = np.zeros(hi - lo + 1, dtype=U64)
        np.cumsum(values[data[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64))
        i = j
    return out


class Words:
    """The words of some documents: byte spans, and for each document its range of words."""

    def __init__(self, text: pa.Array, table: np.ndarray):
        text = text.fill_null("")
        buffers = text.buffers()
        wide = pa.types.is_large_string(text.type)
        offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        raw = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        self.data = raw[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        n = len(self.data)
        inside = table[self.data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        before[edges] = False
        after[edges - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self, fold_case: bool = False) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends, fold_case)

    def left(self) -> np.ndarray:
        """For each word, how many words its document has from there on."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def rolling(values: np.ndarray, k: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of values[i:i+k] for every i, as a polynomial modulo 2**64; shorter tails are dropped."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out, done = np.zeros(n, dtype=U64), 0
    block, width = values.astype(U64, copy=False), 1
    while True:
        if k & width:
            out += block[done : done + n] * U64(pow(base, done, 1 << 64))
            done += width
        if done == k:
            return mix(out)
        block = block[:-width] + block[width:] * U64(pow(base, width, 1 << 64))
        width *= 2


def chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about ``size`` bytes of text, or one longer document."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = column.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(lengths.buffers()[1], dtype=np.int64)[lengths.offset : lengths.offset + len(lengths) + 1]
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def spans_union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as disjoint spans in order; spans that touch are joined."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], ends[last]
