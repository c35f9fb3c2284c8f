"""Packing documents into fixed windows by best-fit decreasing.

Overlong documents are cut into full windows first; what is left of each is shorter
than a window. Pieces are dealt by a hash into shards of a bounded
number of documents, and each shard is packed alone: pieces in falling length, each
into the tightest open window that has room. Open windows stand under their remaining
capacity at the leaves of a segment tree, whose inner nodes tell whether a window
lies below; the search for the smallest capacity that is large enough takes one walk
up and one down.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.textvec import map_batches
from bibweave.llm.tokens import encoder

WINDOW = 2048
#: Documents of a shard, about; its pieces (three numbers each) are packed in one task.
SHARD_DOCS = 20_000


class OpenWindows:
    """Windows by remaining capacity, in a segment tree over capacities 0..size."""

    def __init__(self, size: int):
        self.leaves = 1 << int(size).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.stacks[capacity].append(window)
        node = capacity + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove a window of the smallest capacity that is at least ``least``: (capacity, window)."""
        node = least + self.leaves
        while not self.count[node]:
            while node & 1:  # a right child: go up until there is a right neighbour
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:  # past the last leaf of this level
                return None
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        up = node
        while up:
            self.count[up] -= 1
            up >>= 1
        return capacity, self.stacks[capacity].pop()


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; ``lengths`` are 1..size and are packed longest first."""
    window = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    tree, made = OpenWindows(size), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n) if n < size else None
        if found is None:
            capacity, w = size, made
            made += 1
        else:
            capacity, w = found
        window[i], offset[i] = w, size - capacity
        if capacity > n:
            tree.add(capacity - n, w)
    return window, offset


def _pieces(path: str, end_id: int, size: int):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            ids_of = batch.column(0).to_pylist()
            for doc, ids in zip(ids_of, enc.rows(batch.column(1))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for lo in range(0, len(ids), size):
                    part = ids[lo : lo + size]
                    for col, x in zip(out, (doc, lo, len(part), zlib.crc32(part.tobytes()), len(ids), part.tobytes())):
                        col.append(x)
            kinds = [pa.int64()] * 5 + [pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return run


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, size: int = WINDOW) -> DataFrame:
    """Tokenised documents with their end id, cut into full windows and a rest.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, ids`` (little-endian
    32-bit). A null or empty text is the end id alone; a null id is kept as null. Rows
    that share an id are packed as separate documents.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    return map_batches(base, _pieces(tokenizer, end_id, size), schema)


def pack(cut: DataFrame, shards: int, size: int = WINDOW) -> DataFrame:
    """Place pieces (``doc_id, start, length`` and others but ``ids``) in windows.

    Adds ``sequence_id`` (unique; shard in the high bits) and ``offset``. Every piece is placed once and
    windows have no gaps before their last piece. Full pieces take a window each. Pieces are dealt by
    their values and their place in the table, so repeated rows and rows without an id spread over all
    shards; a task that runs again deals them alike. Within a shard they are ordered by doc_id and start.
    """
    cols = [c for c in cut.columns if c != "ids"]
    schema = cut.select(*cols).schema

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending"), ("length", "ascending")])
        shard = table.column("shard")[0].as_py()
        window, offset = best_fit(table.column("length").to_numpy(), size)
        table = table.drop_columns(["shard"])
        return table.append_column("sequence_id", pa.array(window + (shard << 32))).append_column("offset", pa.array(offset))

    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    dealt = cut.select(*cols, F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)).cast("long").alias("shard"))
    return dealt.groupBy("shard").applyInArrow(place, f"{full}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, shard_docs: int = SHARD_DOCS, size: int = WINDOW, **columns) -> DataFrame:
    """Pieces of ``docs`` with their windows; shards are as many as ``shard_docs`` documents each call for.

    Null and empty texts are packed as their end id alone, null ids are kept as null, rows that share an id
    are documents of their own, an empty table gives no pieces; other columns are ignored.
    """
    shards = max(1, -(-docs.count() // shard_docs))
    return pack(pieces(docs, tokenizer, size=size, **columns).drop("ids"), shards, size)
