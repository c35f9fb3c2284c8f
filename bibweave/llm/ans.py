"""Token files coded by a static range asymmetric numeral system.

One frequency table is shared by all blocks of a file set. A block holds whole documents
and is coded alone. Within it, token i belongs to lane i mod ``LANES``; lanes have a state
each and share one stream of 32-bit words. Every ``SEGMENT`` tokens a checkpoint
stores all states and the place in the stream, so any segment can be decoded alone
(:class:`Block`, :func:`read_span`), each under its own checksum.

Block, little-endian:
    magic "RANS" | version u32 | table crc32 u32 | documents u32 | tokens u64 | first token in its shard u64 |
    lanes u32 | segment tokens u32 | header crc32 u32 (of all before it) |
    doc ids i64[documents] | document tokens u32[documents] | u8[documents], 1 where the id is null |
    per segment: words u32, crc32 of its token ids u32 | per segment: states u64[lanes] | words u32[...]
Blocks are rows of Parquet files (``shard, block, tokens, payload``), which any Hadoop store can
hold and split; the table is a Parquet file beside them. Shards follow each other in the
order of their numbers, so their token totals give the place of each shard's first token.
"""

from __future__ import annotations

import functools
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.llm.textvec import map_batches
from bibweave.llm.tokens import encoder
from bibweave.plans.scratch import discard, materialize

LANES, SEGMENT = 1024, 1 << 18
#: Tokens of a block, about: a block is closed by the document that reaches them.
BLOCK_TOKENS = 1 << 20
#: log2 of the sum of frequencies; states lie in [LOW, LOW << 32).
SCALE, LOW = 22, 1 << 31
_HEAD = struct.Struct("<4sIIIQQII")
_U = np.uint64


def scaled_frequencies(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Whole frequencies with the sum 2^scale; every symbol that occurs gets at least 1."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), dtype=np.uint32)
    freq = np.where(counts > 0, np.maximum(1, counts * ((1 << scale) / total)), 0).astype(np.int64)
    over = int(freq.sum()) - (1 << scale)
    order = np.argsort(-freq, kind="stable")
    for i in order:  # the largest give or take what rounding left
        give = min(over, int(freq[i]) - 1) if over > 0 else over
        freq[i] -= give
        over -= give
        if not over:
            break
    return freq.astype(np.uint32)


class Table:
    """Frequencies, cumulative frequencies and the symbol of every slot."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(_U)
        self.low = np.concatenate([[0], np.cumsum(self.freq)])[:-1].astype(_U)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())


@functools.lru_cache(maxsize=2)
def _table(raw: bytes) -> Table:
    return Table(np.frombuffer(raw, dtype="<u4"))


def encode_segment(ids: np.ndarray, table: Table, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
    """States before the first token, and the stream of words in reading order."""
    state = np.full(lanes, LOW, dtype=_U)
    parts = []
    for t in range(-(-len(ids) // lanes) - 1, -1, -1):
        row = ids[t * lanes : (t + 1) * lanes]
        n = len(row)
        f, x = table.freq[row], state[:n]
        full = x >= (f << _U(63 - SCALE))
        if full.any():
            parts.append(x[full].astype("<u4"))
            x = np.where(full, x >> _U(32), x)
        q = x // f
        state[:n] = (q << _U(SCALE)) + (x - q * f) + table.low[row]
    return state, np.concatenate(parts[::-1]) if parts else np.zeros(0, "<u4")


def decode_segment(state: np.ndarray, words: np.ndarray, count: int, table: Table) -> np.ndarray:
    lanes, at = len(state), 0
    state = state.astype(_U, copy=True)
    out = np.empty(count, dtype=np.uint32)
    for lo in range(0, count, lanes):
        n = min(lanes, count - lo)
        x = state[:n]
        slot = x & _U((1 << SCALE) - 1)
        sym = table.slot[slot]
        out[lo : lo + n] = sym
        x = table.freq[sym] * (x >> _U(SCALE)) + slot - table.low[sym]
        need = np.flatnonzero(x < LOW)
        if len(need):
            x[need] = (x[need] << _U(32)) | words[at : at + len(need)]
            at += len(need)
        state[:n] = x
    if at != len(words) or (state != LOW).any():
        raise ValueError("a segment's stream does not end in the first state")
    return out


def encode_block(docs: list, sizes: list[int], ids: np.ndarray, start: int, table: Table, lanes: int = LANES, segment: int = SEGMENT) -> bytes:
    """A block of whole documents; ``start`` is the number of tokens before it."""
    head = _HEAD.pack(b"RANS", 2, table.crc, len(docs), len(ids), start, lanes, segment)
    marks, states, words = [], [], []
    for lo in range(0, len(ids), segment):
        part = ids[lo : lo + segment]
        state, stream = encode_segment(part, table, lanes)
        marks += [len(stream), zlib.crc32(part.astype("<u4").tobytes())]
        states.append(state.astype("<u8").tobytes())
        words.append(stream.tobytes())
    ids_of = np.array([d or 0 for d in docs], "<i8"), np.array(sizes, "<u4"), np.array([d is None for d in docs], "u1")
    fields = [head, struct.pack("<I", zlib.crc32(head)), *(a.tobytes() for a in ids_of), np.array(marks, "<u4").tobytes()]
    return b"".join(fields + states + words)


class Block:
    """A block's documents, and its tokens from any checkpoint on."""

    def __init__(self, raw: bytes, table: Table):
        size = _HEAD.size
        magic, version, crc, n_docs, self.count, self.start, lanes, self.size = _HEAD.unpack_from(raw)
        if magic != b"RANS" or version != 2 or struct.unpack_from("<I", raw, size)[0] != zlib.crc32(raw[:size]):
            raise ValueError("not a block, or its header is damaged")
        if crc != table.crc:
            raise ValueError("the block was coded with another table")
        self.raw, self.table = raw, table
        at = size + 4
        self.docs = np.frombuffer(raw, "<i8", n_docs, at)
        self.sizes = np.frombuffer(raw, "<u4", n_docs, at + 8 * n_docs)
        self.null = np.frombuffer(raw, "u1", n_docs, at + 12 * n_docs).astype(bool)
        at += 13 * n_docs
        self.segments = -(-self.count // self.size)
        marks = np.frombuffer(raw, "<u4", 2 * self.segments, at).reshape(self.segments, 2)
        self.words, self.crcs = marks[:, 0].astype(np.int64), marks[:, 1]
        at += 8 * self.segments
        self.states = np.frombuffer(raw, "<u8", self.segments * lanes, at).reshape(self.segments, lanes)
        #: where the words of each segment begin
        self.at = at + 8 * self.segments * lanes + 4 * (np.cumsum(self.words) - self.words)

    def segment(self, i: int) -> np.ndarray:
        """Token ids from checkpoint ``i`` to the next one, under their checksum."""
        words = np.frombuffer(self.raw, "<u4", int(self.words[i]), int(self.at[i]))
        ids = decode_segment(self.states[i], words, min(self.size, self.count - i * self.size), self.table)
        if zlib.crc32(ids.astype("<u4").tobytes()) != self.crcs[i]:
            raise ValueError("a segment does not match its checksum")
        return ids

    def tokens(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Token ids ``lo`` to ``hi`` of the block; only segments that hold some of them are decoded."""
        hi = self.count if hi is None else min(hi, self.count)
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first = lo // self.size
        parts = [self.segment(i) for i in range(first, -(-hi // self.size))]
        return np.concatenate(parts)[lo - first * self.size : hi - first * self.size]


def decode_block(raw: bytes, table: Table) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """(document ids, document tokens, first token, token ids); checks every checksum."""
    block = Block(raw, table)
    return block.docs, block.sizes, block.start, block.tokens()


def _width(path: str) -> str:
    """Bytes that ids take between the two passes."""
    return "<u2" if encoder(path).library.get_vocab_size() <= 1 << 16 else "<u4"


def _tokens(path: str, end_id: int):
    def run(batches):
        enc, width = encoder(path), _width(path)
        for batch in batches:
            raw = [np.append(ids, np.uint32(end_id)).astype(width).tobytes() for ids in enc.rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "ids"])

    return run


def _count(width: str):
    def run(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0):
                got = np.frombuffer(raw.as_py(), dtype=width)
                if int(got.max()) >= len(total):
                    total = np.concatenate([total, np.zeros(int(got.max()) + 1 - len(total), np.int64)])
                np.add.at(total, got, 1) if len(got) < 2000 else np.add(total, np.bincount(got, minlength=len(total)), out=total)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return run


def _blocks(freq: bytes, width: str, block_tokens: int):
    def run(batches):
        table = _table(freq)
        shard, block, at, full, held = 0, 0, 0, 0, [[], [], []]

        def close():
            docs, sizes, parts = held
            payload = encode_block(docs, sizes, np.concatenate(parts), at, table)
            cols = [pa.array([x], pa.int64()) for x in (shard, block, sum(sizes))] + [pa.array([payload], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["shard", "block", "tokens", "payload"])

        for batch in batches:
            for doc, raw, shard in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids = np.frombuffer(raw.as_py(), dtype=width)
                for col, x in zip(held, (doc, len(ids), ids)):
                    col.append(x)
                full += len(ids)
                if full >= block_tokens:
                    yield close()
                    block, at, full, held = block + 1, at + full, 0, [[], [], []]
        if held[0]:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode all texts in ascending id order and write ``path/blocks`` and ``path/table``.

    Texts are tokenised once and counted; then ids are dealt into ranges by sampled
    splitters and sorted within them, and each range becomes a shard of blocks. Null texts are
    the end id alone. Rows with a null id stand before all others, rows that share an id (or
    have none) side by side in an order that a run fixes. Other columns are ignored and an empty
    table gives files without documents. To the driver go the counts of the vocabulary only.
    """
    spark, width = docs.sparkSession, _width(tokenizer)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = materialize(map_batches(base, _tokens(tokenizer, end_id), "doc_id long, ids binary"), "ids", compression="zstd")
    counted = map_batches(held.select("ids"), _count(width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=0) + 1, dtype=np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    raw = scaled_frequencies(counts).astype("<u4").tobytes()
    spark.createDataFrame([(SCALE, bytearray(raw))], "scale int, frequencies binary").coalesce(1).write.parquet(f"{path}/table")
    # rows of one id, or of none, can be many: they are dealt on by a hash and their place in the table
    tie = F.xxhash64("ids", F.monotonically_increasing_id())
    ranged = held.withColumn("tie", tie).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie").withColumn("shard", F.spark_partition_id().cast("long"))
    coded = map_batches(ranged, _blocks(raw, width, block_tokens), "shard long, block long, tokens long, payload binary")
    coded.write.option("compression", "none").parquet(f"{path}/blocks")
    discard(held)


def _written(spark: SparkSession, path: str) -> tuple[bytes, DataFrame, dict[int, int]]:
    """The table, the blocks and the number of tokens before each shard."""
    raw = bytes(spark.read.parquet(f"{path}/table").first()["frequencies"])
    blocks = spark.read.parquet(f"{path}/blocks")
    places, at = {}, 0
    for shard, n in sorted(blocks.groupBy("shard").agg(F.sum("tokens")).collect()):
        places[shard] = at
        at += n
    return raw, blocks, places


def read_span(spark: SparkSession, path: str, start: int, count: int) -> DataFrame:
    """``start, ids``: the tokens from ``start`` on, ``count`` at most, as a row per block that holds some.

    Blocks are picked by their headers and decoded from the checkpoints around the span only.
    """
    raw, blocks, places = _written(spark, path)

    def run(batches):
        table = _table(raw)
        for batch in batches:
            for shard, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(payload.as_py(), table)
                at = places[shard] + block.start
                lo, hi = max(start, at), min(start + count, at + block.count)
                if lo < hi:
                    ids = block.tokens(lo - at, hi - at).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([ids], pa.list_(pa.int32()))], names=["start", "ids"])

    ends = sorted([*places.values(), 1 << 62])
    some = [k for k, at in places.items() if at < start + count and ends[ends.index(at) + 1] > start]
    return map_batches(blocks.where(F.col("shard").isin(some)).select("shard", "payload"), run, "start long, ids array<int>")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of written blocks: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    One total per shard goes to the driver.
    """
    raw, blocks, places = _written(spark, path)

    def run(batches):
        table = _table(raw)
        for batch in batches:
            for shard, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = Block(payload.as_py(), table)
                sizes, start, ids = block.sizes, block.start, block.tokens()
                ends = np.cumsum(sizes.astype(np.int64))
                starts = ends - sizes
                data = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(data[4 * lo : 4 * hi]) for lo, hi in zip(starts.tolist(), ends.tolist())]
                cols = [pa.array(block.docs, mask=block.null), pa.array(starts + start + places[shard]), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return map_batches(blocks.select("shard", "payload"), run, schema)
