"""Words, lines and hashes of many texts at once, on the bytes of an Arrow column.

Spark deals out the rows; inside a task these helpers turn a slice of a batch into numpy arrays of
word borders and 64-bit hashes. A slice holds about ``SLICE_BYTES`` of text (one longer text makes a
slice of its own), so memory does not follow the size of a batch.

``Hashes`` are sums of mixed byte values times powers of an odd base, modulo 2**64: the hash of any span
comes from two prefix sums. Different texts can be built that agree in it, so it only finds candidates.
``span_hashes`` decide equality: they mix eight bytes at a time into two lanes, and longer spans go
through BLAKE2b, so that no pattern of bytes makes two texts agree for every base.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
LONG_SPAN = 256  # bytes; longer spans are hashed one by one
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value scrambled (the splitmix64 finaliser)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUE = mixed(np.arange(1, 257, dtype=_U) * _U(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.empty(max(n, SLICE_BYTES + 1), _U)
        table[0] = 1
        done = 1
        while done < len(table):  # doubling: the next block is this one times base**done
            step = _U(pow(base, done, 1 << 64))
            more = min(done, len(table) - done)
            table[done : done + more] = table[:more] * step
            done += more
        _powers[base] = table
    return table[:n]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true inside the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words as [^\x20\x09-\x0D]+ and as [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing).
SPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))
ALNUM = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Slice:
    """Texts first..last-1 of a batch: their bytes, and where each text begins and ends."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in slices; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(first, last, flat[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


@dataclass
class Spans:
    """Parts of the texts of a slice, in order: borders, and the first part of each text."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, bounds: np.ndarray, word_byte: np.ndarray) -> Spans:
    """Maximal runs of word bytes; none crosses a text's border."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word_byte[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] |= inside[1:-1][edges]
    ends[edges - 1] |= inside[1:-1][edges - 1]
    starts = np.flatnonzero(starts)
    return Spans(starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds))


def lines(data: np.ndarray, bounds: np.ndarray) -> Spans:
    r"""The \n-split lines of each text, without the line end; an empty text has one empty line."""
    cuts = np.flatnonzero(data == 10)
    starts = np.concatenate([bounds[:-1], cuts + 1])
    ends = np.concatenate([cuts, bounds[1:]])
    row_of_cut = np.searchsorted(bounds, cuts, side="right") - 1
    n = len(bounds) - 1
    order = np.lexsort((starts, np.concatenate([np.arange(n), row_of_cut])))
    order_e = np.lexsort((ends, np.concatenate([row_of_cut, np.arange(n)])))
    counts = np.bincount(row_of_cut, minlength=n) + 1
    return Spans(starts[order], ends[order_e], np.concatenate([[0], np.cumsum(counts)]))


class Hashes:
    """Hashes of any spans of some bytes."""

    def __init__(self, data: np.ndarray):
        self._sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_BYTE_VALUE[data] * _power_table(_BASE, len(data)), out=self._sums[1:])
        self._inverse = _power_table(_BASE_INVERSE, len(data) + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mixed(raw + (ends - starts).astype(_U))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span data[starts[i]:ends[i]]; equal spans have equal ones."""
    n = np.asarray(ends - starts, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))  # the eight bytes from each place on
    a, b = mixed(n.astype(_U) + _U(_BASE)), mixed(n.astype(_U) * _U(_BASE) + _U(1))
    left = np.flatnonzero((n > 0) & (n <= LONG_SPAN))
    at, rest = starts[left], n[left]
    while len(left):
        short = np.minimum(rest, 8)
        word = eight[at] & (~_U(0) >> (_U(64) - _U(8) * short.astype(_U)))
        a[left] = mixed(a[left] ^ word)
        b[left] = mixed(b[left] + word * _U(_BASE_INVERSE))
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    for i in np.flatnonzero(n > LONG_SPAN):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        a[i], b[i] = np.frombuffer(digest, "<u8")
    return mixed(a + ((b << _U(32)) | (b >> _U(32))))


def runs_of(hashes: np.ndarray, spans: Spans, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For every run of n words inside a text: index of its first word, and the run's hash."""
    last = np.repeat(spans.first[1:], spans.counts)
    at = np.flatnonzero(np.arange(len(hashes)) + n <= last)
    out = np.zeros(len(at), _U)
    for k in range(n):
        out = mixed(out * _U(31) + hashes[at + k] + _U(k + 1))
    return at, out


def sums_by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i+1]] for every i (exact for integers)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return x.view(np.int64)
