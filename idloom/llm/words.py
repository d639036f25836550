"""Words of many texts at once, as numpy arrays over the bytes of an Arrow
string column. A word is a run of bytes that are not separators; separators are
ASCII, so the bytes of a UTF-8 character never fall apart."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Space and U+0009 to U+000D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: White space, other ASCII control characters and ASCII punctuation.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(2**62, 2**63, dtype=np.uint64)) | 1
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
#: A second, independent hash, for keys of 128 bits.
_BYTE2 = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << max(6, (n - 1).bit_length())
        _powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, _BASE, np.uint64))))
    return _powers


@dataclass
class Words:
    """``starts``/``ends``: byte spans in ``data``; ``first[i]:first[i + 1]``:
    the words of text i; ``hashes``: 64 bits for each word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold=SAME, second: bool = False) -> np.ndarray:
    """64 bits for the bytes of each span; spans are in order, not empty, and
    do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    low, high = int(starts[0]), int(ends[-1])
    length = ends - starts
    powers = _power_table(int(length.max()))
    reach = np.diff(np.append(starts, high))
    place = np.arange(low, high) - np.repeat(starts, reach)
    values = (_BYTE2 if second else _BYTE)[fold[data[low:high]]] * powers[np.minimum(place, len(powers) - 1)]
    values[place >= np.repeat(length, reach)] = 0
    return mix(np.add.reduceat(values, starts - low) + length.astype(np.uint64))


def split(data: np.ndarray, offsets: np.ndarray, separators=WHITE, fold=SAME) -> Words:
    inside = np.zeros(len(data) + 2, bool)  # one place before and after
    inside[1:-1] = ~separators[data]
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # words end with their text
    opens[edges] = inside[1:-1][edges]
    closes[edges - 1] = inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hash_spans(data, starts, ends, fold))


def ngrams(words: Words, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each word on, and which of them lie in one
    text (the others are to be left out)."""
    h, total = words.hashes, len(words.hashes)
    valid = np.zeros(total, bool)
    if total < n:
        return np.zeros(total, np.uint64), valid
    out = np.zeros(total, np.uint64)
    m = total - n + 1
    for k in range(n):
        out[:m] += h[k : k + m] * _PLACE[(k + 31 * salt) % 64]
    last = np.repeat(words.first[1:], words.counts)  # end of each word's text
    valid[:m] = np.arange(n, total + 1) <= last[:m]
    return mix(out + np.uint64(n + 1000003 * salt)), valid


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of text, so that the
    arrays over bytes stay small. A longer text is a run of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
