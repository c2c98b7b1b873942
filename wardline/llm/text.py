"""Words, lines and byte windows of whole texts as NumPy arrays.

A slice is a run of rows whose texts lie end to end in one byte array. All positions are byte
positions in that array. Byte classes are enough for the word patterns used here: every byte
of a character beyond ASCII is 0x80 or more, and such bytes always belong to words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Some 50 bytes of arrays stand for each byte of a slice.
SLICE_BYTES = 1 << 18
#: Bytes of rows that a task hands over at once.
BATCH_BYTES = 4 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base in _powers and len(_powers[base]) >= n:
        return _powers[base][:n]
    p = np.full(max(n, SLICE_BYTES) + 64, base, dtype=_U)
    p[0] = 1
    p = np.multiply.accumulate(p)
    if n <= SLICE_BYTES + 64:  # those of a longer text aren't kept
        _powers[base] = p
    return p[:n]


class Hasher:
    """64-bit hashes of any byte ranges of one array, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=self.sums[1:])
        self.back = _power(_INVERSE, len(data) + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))

    def windows(self, k: int) -> np.ndarray:
        n = max(len(self.sums) - k, 0)
        return mix((self.sums[k:] - self.sums[:n]) * self.back[:n])


def _give_back() -> None:
    """Free memory goes back to the system, since workers outlive their tasks and share a machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` over batches of at most BATCH_BYTES, or of one row.

    The bound is a setting of the session, which a smaller one of the user's replaces.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    size = conf.get(name).rstrip("b")
    if not size.isdigit() or int(size) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return df.mapInArrow(bounded, schema)


class Slice(NamedTuple):
    first: int  # row of the batch the slice begins with
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than rows

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in runs of at most ``most`` bytes, or of one row; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def byte_class(separators: bytes) -> np.ndarray:
    """True for each byte that belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: words [^\x20\x09-\x0D]+
SPACED = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of texts with A-Z lower-cased
ALNUM = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Runs(NamedTuple):
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


def runs(s: Slice, inside: np.ndarray) -> Runs:
    """Maximal runs of true bytes, cut at the ends of rows."""
    n = len(s.data)
    breaks = s.offsets[:-1][s.offsets[:-1] < n]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[breaks] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    ends = s.offsets[1:][s.offsets[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Runs(np.searchsorted(s.offsets, start, side="right") - 1, start, end)


def pieces(s: Slice, table: np.ndarray, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """A slice as it is, or one long text cut where words end, so that no word is in two pieces."""
    if s.rows != 1:
        yield s
        return
    at, n = 0, len(s.data)
    while at < n or at == 0:
        gap = np.flatnonzero(~table[s.data[at + most : at + 2 * most]]) if n - at > most else []
        # a word that is longer than a piece ends the cutting
        end = at + most + int(gap[0]) if len(gap) else n
        yield Slice(s.first, s.data[at:end], np.array([0, end - at]))
        at = max(end, 1)


def word_array(s: Slice, table: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The row and the bytes of each word, in order."""
    inside = table[s.data]
    found = runs(s, inside)
    ends = np.zeros(len(found.row) + 1, dtype=np.int64)
    np.cumsum(found.end - found.start, out=ends[1:])
    return found.row, pa.Array.from_buffers(pa.large_binary(), len(found.row), [None, pa.py_buffer(ends), pa.py_buffer(s.data[inside])])


def lines(s: Slice) -> Runs:
    r"""The \n-split lines of each row; a row has one more line than line ends, an empty one too."""
    ends = np.flatnonzero(s.data == 10)
    row = np.concatenate([np.searchsorted(s.offsets, ends, side="right") - 1, np.arange(s.rows)])
    end = np.concatenate([ends, s.offsets[1:]])
    # the row's last line ends where the row does, after every line end in it
    order = np.lexsort((end, row))
    row, end = row[order], end[order]
    start = np.empty_like(end)
    start[1:] = end[:-1] + 1
    first = np.flatnonzero(np.diff(row, prepend=-1))
    start[first] = s.offsets[:-1]
    return Runs(row, start, end)


def grams(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of each run of ``n`` consecutive hashes inside a row."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U)
    h = np.zeros(m, dtype=_U)
    for i in range(n):
        h = mix(h * _U(_BASE) + hashes[i : i + m] + _U(i + 1))
    at = np.flatnonzero(row[:m] == row[n - 1 :])
    return at, h[at]


def run_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of any ranges of consecutive hashes."""
    sums = np.zeros(len(hashes) + 1, dtype=_U)
    np.cumsum(mix(hashes) * _power(_BASE, len(hashes)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power(_INVERSE, len(hashes) + 1)[start] + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


def per_row(rows: int, row: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, weight, minlength=rows).astype(np.int64)
