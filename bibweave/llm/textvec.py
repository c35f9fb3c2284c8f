"""Vectorised words and hashes over Arrow string columns.

All functions work on one slice of a column at a time (``slices``), so memory follows
the slice and not the batch. Hashes are functions of the bytes alone: they do not
depend on the process, the batch or the position in the text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 2 << 20
#: Rows and bytes of an Arrow batch; texts are long, so fewer rows than Spark's 10,000. A longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

_U = np.uint64


def _table(test) -> np.ndarray:
    return np.array([bool(test(i)) for i in range(256)])


#: ASCII white space: space and 09-0D.
SPACE = _table(lambda i: i == 32 or 9 <= i <= 13)
#: Bytes of words of ASCII letters and digits and any other script.
ALNUM = _table(lambda i: 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80)
#: A-Z to a-z, every other byte to itself.
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x.astype(_U, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


_GOLDEN = _U(0x9E3779B97F4A7C15)
_ODD = _U(0xD6E8FEB86659FD93)
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=_U)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes.

    Yields (first row, row after the last, bytes, offsets into them). Nulls are empty.
    A single longer text forms a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` in batches of bounded rows and bytes, whose worker gives memory back when a task ends.

    Workers live on from task to task, beside the executor's heap. Both bounds are settings of the
    session, read when the frame runs, and are only lowered.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if not 0 < _size(conf.get(key)) <= most:
            conf.set(key, str(most))

    @wraps(run)
    def bounded(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(bounded, schema)


def _size(value: str) -> int:
    """A setting as a number; one that is not written in digits alone counts as none."""
    digits = value.lower().removesuffix("b")
    return int(digits) if digits.isdigit() else 0


def give_back() -> None:
    """Return freed memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class Words:
    """Words of the rows of a slice: byte bounds, row numbers and hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        n = len(data)
        self.rows = len(offsets) - 1
        self.data = data
        first = np.zeros(n + 1, dtype=bool)
        first[offsets[:-1]] = True
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = is_word[:-1]
        self.start = np.flatnonzero(is_word & (~before | first[:-1]))
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = is_word[1:]
        self.end = np.flatnonzero(is_word & (~after | first[1:])) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        #: words of row i are bounds[i]:bounds[i + 1]
        self.bounds = np.searchsorted(self.row, np.arange(self.rows + 1))

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word, read eight bytes at a time."""
        data = self.data if data is None else data
        size = self.end - self.start
        h = size.astype(_U) * _GOLDEN
        if not len(h):
            return h
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        block = np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,))
        at, left, who = self.start, size, None
        with np.errstate(over="ignore"):
            while True:
                x = block[at] & _MASK[np.minimum(left, 8)]
                if who is None:
                    h = mix(h ^ (x * _ODD))
                else:
                    h[who] = mix((h[who] + _GOLDEN) ^ (x * _ODD))
                more = np.flatnonzero(left > 8)
                if not len(more):
                    return h
                who = more if who is None else who[more]
                at, left = at[more] + 8, left[more] - 8


def spaced_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Words between ASCII white space; A-Z lower-cased if ``lower``."""
    data = LOWER[data] if lower else data
    return Words(data, offsets, ~SPACE[data])


def alnum_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-cased words of ASCII letters, digits and bytes of other scripts."""
    data = LOWER[data]
    return Words(data, offsets, ALNUM[data])


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive hashes (across rows too; mask those out)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    with np.errstate(over="ignore"):
        total = np.full(n, k, dtype=_U)
        for j in range(k):
            total = (total ^ hashes[j : j + n]) * _GOLDEN
            total ^= total >> _U(29)
    return mix(total)


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """For each row its sorted distinct shingle hashes.

    A row with fewer than ``k`` words gives its whole sequence as one shingle, a row
    without words none.
    """
    h = words.hashes()
    full = runs(h, k)
    for lo, hi in zip(words.bounds[:-1], words.bounds[1:]):
        if hi - lo >= k:
            yield np.unique(full[lo : hi - k + 1])
        elif hi > lo:
            yield runs(h[lo:hi], int(hi - lo))
        else:
            yield h[:0]
