"""Texts in blocks, and counts that blocks exchange by ranges of hashed keys.

A block holds some megabytes of texts as numbers into its own list of distinct words, so only a word's first occurrence in
a block takes part in a shuffle. What a block counts goes out in a few packed rows, one for each range of keys; a range
sees every block's share of its keys once and can answer each. Ranges are as many as the number of keys calls for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

from bibweave.llm.textvec import mix

#: Bytes of text of a block, and of the texts that a task holds back to fill blocks of several groups.
BLOCK_BYTES, HELD_BYTES = 8 << 20, 24 << 20

_U = np.uint64
_CODEC = "zstd"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, compressed byte plane by byte plane."""
    width = 8 if len(values) and int(values.max()) >> 32 else 4
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), _CODEC, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], width * n, _CODEC, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").reshape(-1).astype(np.int64)


def in_blocks(batches: Iterator[pa.RecordBatch], group: int | None = None, text: int = 0) -> Iterator[tuple[str | None, pa.Table]]:
    """Rows of Arrow batches in tables of some ``BLOCK_BYTES`` of text each, those of one value of column ``group`` together.

    Yields (value, table). A longer text makes a block of its own; no text is cut.
    """
    held: dict[str | None, list] = {}
    size: dict[str | None, int] = {}

    def take(value) -> tuple[str | None, pa.Table]:
        size.pop(value)
        return value, pa.Table.from_batches(held.pop(value)).combine_chunks()

    for batch in batches:
        parts = [(None, batch)]
        if group is not None and batch.num_rows:
            column = batch.column(group)
            parts = [(v.as_py(), batch.filter(pc.equal(column, v))) for v in pc.unique(column)]
        for value, part in parts:
            if not part.num_rows:
                continue
            held.setdefault(value, []).append(part)
            size[value] = size.get(value, 0) + part.column(text).nbytes
            if size[value] >= BLOCK_BYTES:
                yield take(value)
        while sum(size.values()) > HELD_BYTES:
            yield take(max(size, key=size.get))
    for value in list(held):
        yield take(value)


def block_numbers() -> Iterator[int]:
    """Numbers for the blocks of this task that no other task uses."""
    at = TaskContext.get().partitionId() << 32
    while True:
        yield at
        at += 1


def fresh(keys: np.ndarray) -> np.ndarray:
    """Keys as they are, but for 0, which stands for none."""
    return np.where(keys == 0, _U(1), keys)


def joined_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A key of pairs of keys."""
    with np.errstate(over="ignore"):
        return fresh(mix(a * _U(0x9E3779B97F4A7C15) + mix(b)))


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each key; ranges follow the order of keys."""
    return ((keys >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)


def dealt(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """Ranges of sorted keys and where their keys stand."""
    r = range_of(keys, ranges)
    first = np.flatnonzero(np.diff(r, prepend=-1))
    for lo, hi in zip(first, np.append(first[1:], len(r))):
        yield int(r[lo]), slice(int(lo), int(hi))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of each one's counts, and for every key given its place among the distinct ones."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, counts, minlength=len(distinct)).astype(np.int64), place


def longs(column) -> list[np.ndarray]:
    """Packed 64-bit keys of every row of a binary column."""
    return [np.frombuffer(x.as_py(), _U) for x in column]
