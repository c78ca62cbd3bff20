"""Words of whole texts as numpy arrays: where they start and end, and 64-bit hashes of runs of them.

Texts arrive as Arrow columns. They are handled a block of about a megabyte at a time, so memory
does not depend on the number of rows; one longer text is a block of its own. All separators used
here are ASCII bytes, so UTF-8 can be cut byte by byte.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BLOCK_BYTES = 1 << 20
#: Bytes of the batches in which Spark hands rows to Python, whatever their number.
BATCH_BYTES = 8 << 20
#: Bytes whose words are hashed at once; one longer word is a part of its own.
HASHED_BYTES = 1 << 18
#: Words whose runs are hashed at once.
HASHED_WORDS = 1 << 15

_rng = np.random.default_rng(20240229)
_BYTE_VALUES = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Separators are space and 0x09 to 0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Words are ASCII letters and digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
ALNUM[0x80:] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n of each."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)

        def table(b: int) -> np.ndarray:
            out = np.full(size, b, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        known = table(base), table(pow(base, -1, 2**64))
        if size <= 2 * HASHED_BYTES:
            _powers[base] = known
    return known


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scatter the bits of 64-bit values; other salts give other orders."""
    x = x ^ np.uint64((salt * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) % 2**64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _runs(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, from one running sum."""
    power, inverse = _power_tables(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def give_back() -> None:
    """Hand freed memory to the system: workers live on, and the others of an executor would miss it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them) of consecutive rows; null texts are empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop
    give_back()


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the bytes of a batch, so that long texts do not fill a worker; one longer row is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


class Words:
    """Words of one block. ``first[r]:first[r + 1]`` are the words of row r."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, lower: bool = False):
        self.data, self.lower = data, lower
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = letters[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        here, before = inside[1:], inside[:-1]
        self.starts = np.flatnonzero(here & (~before | edge))
        self.ends = np.flatnonzero(before & (~here | edge))
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word. Running sums take many times the text's bytes, so they run over a part of it at a time."""
        values = _BYTE_VALUES[_LOWER] if self.lower else _BYTE_VALUES
        out, word = np.empty(len(self.starts), np.uint64), 0
        while word < len(out):
            begin = self.starts[word]
            stop = max(word + 1, int(np.searchsorted(self.ends, begin + HASHED_BYTES, "right")))
            part = self.data[begin : self.ends[stop - 1]]
            out[word:stop] = _runs(values[part], _BASE, self.starts[word:stop] - begin, self.ends[word:stop] - begin)
            word = stop
        return mix(out)

    def text(self, first: int, stop: int) -> bytes:
        """Words first to stop joined by one space."""
        raw = self.data.tobytes() if not hasattr(self, "_raw") else self._raw
        self._raw = raw
        starts, ends = self.starts, self.ends
        joined = b" ".join([raw[starts[i] : ends[i]] for i in range(first, stop)])
        return joined.lower() if self.lower else joined


def grams(hashes: np.ndarray, first: np.ndarray, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of k words within one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(k, n + k) <= last)
    out, i = np.empty(len(at), np.uint64), 0
    while i < len(at):  # as in Words.hashes
        stop = int(np.searchsorted(at, at[i] + HASHED_WORDS))
        starts = at[i:stop] - at[i]
        out[i:stop] = _runs(hashes[at[i] : at[stop - 1] + k], _BASE ^ 0xABCDE0, starts, starts + k)
        i = stop
    return at, mix(out, salt * 1000 + k)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with their words joined by one space (a space may be left at a row's end)."""
    inside = SPACED[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    keep[starts] &= inside[starts]
    if keep.all():
        out = data.copy()
        out[~inside] = 0x20
        return out, offsets
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    out = np.where(inside, data, np.uint8(0x20))[keep]
    return out, total[offsets]
