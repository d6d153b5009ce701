"""Words and word hashes of whole Arrow batches, computed in numpy without a loop over words.

A word is ``[^\\x20\\x09-\\x0D]+``, unchanged. Texts are handled as UTF-8 bytes: the separators are
ASCII, so byte masks find the same words as code points would.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass handles; a longer single text is a pass of its own.
CHUNK = 1 << 21

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
_BASE = [0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1]
_GRAM = np.array([0xA0761D6478BD642F | 1, 0xE7037ED1A0B428DB | 1], np.uint64)
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; kept, and made anew only for a longer text."""
    key = (base, 0)
    have = _POWERS.get(key)
    if have is None or len(have) < n + 1:
        size = max(n + 1, CHUNK + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * CHUNK:
            _POWERS[key] = have
    return have[: n + 1]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0, one more than rows) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.dtype(np.int64 if wide else np.int32)
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, at = utf8(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(at, at[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


@dataclass
class Words:
    """Words of some texts, in order. ``first`` has the index of each text's first word, then the total."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, separator: np.ndarray = SEPARATOR, fold: np.ndarray | None = None) -> Words:
        """``separator`` tells the bytes between words, ``fold`` what each byte is read as."""
        data, at = utf8(column)
        if fold is not None:
            data = fold[data]
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = ~separator[data]
        starts = word[1:] & ~word[:-1]
        ends = word[:-1] & ~word[1:]
        cuts = at[(at > 0) & (at < len(data))]
        both = cuts[word[cuts] & word[cuts + 1]]
        starts[both] = True
        ends[both] = True
        start = np.flatnonzero(starts)
        return cls(data, at, start, np.flatnonzero(ends), np.searchsorted(start, at))

    @property
    def count(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        return hash_spans(self.data, self.start, self.end, seed)

    def chars(self) -> np.ndarray:
        """Code points in the words of each text."""
        lead = (self.data & 0xC0) != 0x80
        lead &= ~SEPARATOR[self.data]
        return np.diff(np.concatenate(([0], np.cumsum(lead)))[self.at])


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    n, base = len(data), _BASE[seed]
    run = np.zeros(n + 1, np.uint64)
    np.multiply(_BYTE[seed][data], _powers(base, n)[:n], out=run[1:])
    np.cumsum(run, out=run)
    inverse = _powers(pow(base, -1, 1 << 64), n)
    return mix((run[end] - run[start]) * inverse[start] + (end - start).astype(np.uint64))


def grams(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of each k words in a row; k - 1 fewer than words, across the borders of texts."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    total, power, size, scale = None, words, 1, int(_GRAM[seed])
    # Doubling: hashes of 1, 2, 4, ... words, of which those in the binary form of k are joined.
    while True:
        if k & size:
            if total is None:
                total, width = power, size
            else:
                n = len(words) - width - size + 1
                total = total[:n] * np.uint64(scale) + power[width : width + n]
                width += size
        size *= 2
        if size > k:
            break
        n = len(words) - size + 1
        power = power[:n] * np.uint64(scale) + power[size // 2 : size // 2 + n]
        scale = scale * scale % (1 << 64)
    return mix(total + np.uint64(k))


def inside(first: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of the n windows of k words lie in one text; ``first`` as in Words."""
    ok = np.ones(n, bool)
    for border in range(1, k):
        cut = first[1:-1] - border
        ok[cut[(cut >= 0) & (cut < n)]] = False
    return ok


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true flags."""
    padded = np.zeros(len(flags) + 2, np.int8)
    padded[1:-1] = flags
    step = np.diff(padded)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)
