"""Hard negatives by a vector-approximation file, with exact results.

Vectors of whole numbers are kept in chunks of rows, each row with its components and with one cell number per
dimension. A dimension's cells lie between quantiles of a bounded sample; the outer ones end at the chunk's
own smallest and largest component, so the bounds hold for every row whatever the sample was. For an anchor a table
per dimension holds the least and the greatest product with any number of a cell; sums of looked-up entries are a lower
and an upper bound of the score. Only rows whose bounds leave room for a place among the wanted ones are scored exactly.

Anchors are a share of all rows, so they too can be many: blocks of anchors meet chunks of rows in a grid of bounded
cells, and blocks are broadcast only if all of them are few. What a chunk gives for one anchor is at most as many rows as are wanted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.llm.textvec import map_batches
from bibweave.plans.scratch import discard, materialize

#: Rows of a chunk, anchors of a block, cells of a dimension and rows of the sample that the cells' marks come from.
CHUNK_ROWS, BLOCK_ANCHORS, CELLS, SAMPLE_ROWS = 4096, 256, 64, 10_000
#: Chunks and blocks that meet in one cell of the grid, and blocks that may be broadcast (some 64 MB at 128 dimensions).
GRID, BROADCAST_BLOCKS = 64, 256
#: Scores and bounds of rows whose length (times the scale) is below this are certain to be 64-bit numbers.
LONGEST = 2.0**28

_CHUNK = "part long, n int, dims int, ids binary, labels binary, cells binary, vectors binary"


def whole_vectors(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, label, v``: components times ``scale``, rounded down; rows that take part only."""
    x = F.col(vector_col)
    squares = F.aggregate(x, F.lit(0.0), lambda a, b: a + b.cast("double") * b.cast("double") * float(scale * scale))
    base = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (squares < LONGEST**2))
    return base.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.transform(x, lambda b: F.floor(b.cast("double") * scale)).alias("v"))


def _dense(column) -> np.ndarray:
    """Rows of an Arrow list column as one matrix; shorter rows end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
    size = np.diff(column.offsets.to_numpy()).astype(np.int64)
    dims = int(size.max(initial=0))
    if (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    dims = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, dims - p.shape[1]))) for p in parts])


def marks_of(sample: DataFrame, cells: int = CELLS) -> list[np.ndarray]:
    """Between which numbers each dimension is cut: its quantiles over a sample."""
    table = sample.select("v").toArrow()
    if not table.num_rows:
        return []
    found = np.quantile(_dense(table.column("v")), np.linspace(0, 1, cells + 1)[1:-1], axis=0, method="higher")
    return [np.unique(column.astype(np.int64)) for column in found.T]


def _cells(v: np.ndarray, marks: list[np.ndarray]) -> np.ndarray:
    """The cell of every component, dimension by dimension; dimensions that no mark is known of have one cell."""
    out = np.zeros(v.T.shape, np.uint8)
    for d, m in enumerate(marks[: v.shape[1]]):
        out[d] = np.searchsorted(m, v[:, d], side="right")
    return out


def _pack(marks: list[np.ndarray], rows: int):
    def run(batches):
        task, made = TaskContext.get().partitionId() << 32, 0
        ids, labels, parts, held = [], [], [], 0

        def packed():
            v, i, c = _joined(parts), np.concatenate(ids), np.concatenate(labels)
            for lo in range(0, len(i), rows):
                order = lo + np.argsort(c[lo : lo + rows], kind="stable")
                own = v[order]
                out = [task + made + lo // rows, len(order), own.shape[1], i[order].tobytes(), c[order].tobytes(), _cells(own, marks).tobytes(), own.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(out, (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4))], names=[x.split()[0] for x in _CHUNK.split(", ")])

        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False))
            labels.append(batch.column(1).to_numpy(zero_copy_only=False))
            parts.append(_dense(batch.column(2)))
            held += batch.num_rows
            if held >= rows:
                yield from packed()
                made += -(-held // rows)
                ids, labels, parts, held = [], [], [], 0
        if held:
            yield from packed()

    return run


class _Chunk:
    """Rows of one chunk or block; with marks, the cells of the first ``dims`` dimensions too."""

    def __init__(self, row: dict, marks: list[np.ndarray] | None = None, dims: int | None = None):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.v = np.frombuffer(row["vectors"], np.int64).reshape(row["n"], row["dims"])[:, :dims]
        self.dims = self.v.shape[1]
        self.size = row["n"]
        if marks is not None:
            cells = np.frombuffer(row["cells"], np.uint8).reshape(row["dims"], row["n"])[: self.dims]
            self.low, self.high, width = self._edges(marks)
            self.at = cells.T.astype(np.int64) + np.arange(self.dims) * width

    def _edges(self, marks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        """Least and greatest number of every cell of every dimension."""
        width = max((len(m) for m in marks), default=0) + 1
        low, high = np.zeros((self.dims, width), np.int64), np.zeros((self.dims, width), np.int64)
        for d in range(self.dims):
            m = marks[d] if d < len(marks) else np.zeros(0, np.int64)
            least, most = (self.v[:, d].min(), self.v[:, d].max()) if self.size else (0, 0)
            low[d, : len(m) + 1] = np.clip(np.concatenate([[least], m]), least, most)
            high[d, : len(m) + 1] = np.clip(np.concatenate([m - 1, [most]]), least, most)
        return low, high, width

    def bounds(self, q: np.ndarray, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of some rows with an anchor."""
        a, b = q[:, None] * self.low, q[:, None] * self.high
        at = self.at[rows]
        return np.minimum(a, b).ravel()[at].sum(axis=1), np.maximum(a, b).ravel()[at].sum(axis=1)


def _top(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:most]


def _least_sure(lower: np.ndarray, most: int) -> int | None:
    """The lower bound that ``most`` rows reach for certain."""
    return np.partition(lower, len(lower) - most)[len(lower) - most] if len(lower) >= most else None


def _positives(marks, most: int):
    """Of every pair of a chunk and a block the first rows of each anchor's label, by score."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for row in batch.to_pylist():
                block = _Chunk({k[2:]: row[k] for k in row if k.startswith("q_")})
                dims = min(block.dims, row["dims"])
                chunk = _Chunk(row, marks, dims)
                for i in range(block.size):
                    lo, hi = np.searchsorted(chunk.labels, block.labels[i], "left"), np.searchsorted(chunk.labels, block.labels[i], "right")
                    other = np.flatnonzero(chunk.ids[lo:hi] != block.ids[i])
                    if not len(other):
                        continue
                    q = block.v[i, :dims]
                    lower, upper = (x[other] for x in chunk.bounds(q, slice(lo, hi)))
                    sure = _least_sure(lower, most)
                    some = lo + (other if sure is None else other[upper >= sure])
                    score = chunk.v[some] @ q
                    for k in _top(score, chunk.ids[some], most):
                        for col, x in zip(out, (row["q_part"], i, block.ids[i], chunk.ids[some[k]], score[k])):
                            col.append(int(x))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["q_part", "i", "anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(marks, most: int, window: tuple[int, int]):
    """Of every pair of a chunk and a block the first rows of other labels in the window of each positive, by score."""
    least, greatest = window

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for row in batch.to_pylist():
                block = _Chunk({k[2:]: row[k] for k in row if k.startswith("q_")})
                dims = min(block.dims, row["dims"])
                chunk = _Chunk(row, marks, dims)
                asked: dict[int, list] = {}
                for p in row["positives"]:
                    asked.setdefault(p["i"], []).append(p)
                for i, wanted in asked.items():
                    q = block.v[i, :dims]
                    lower, upper = chunk.bounds(q, slice(0, chunk.size))
                    other = chunk.labels != block.labels[i]
                    scores: dict[int, tuple] = {}
                    for p in wanted:
                        s = p["positive_score"]
                        if s not in scores:
                            bottom, top = -(-least * s // 100), greatest * s // 100
                            sure = _least_sure(lower[other & (lower >= bottom) & (upper <= top)], most)
                            some = np.flatnonzero(other & (upper >= (bottom if sure is None else sure)) & (lower <= top))
                            score = chunk.v[some] @ q
                            some, score = some[inside := (score >= bottom) & (score <= top)], score[inside]
                            first = _top(score, chunk.ids[some], most)
                            scores[s] = chunk.ids[some[first]], score[first]
                        for negative, score in zip(*scores[s]):
                            for col, x in zip(out, (row["q_part"], i, p["place"], block.ids[i], p["positive_id"], s, negative, score)):
                                col.append(int(x))
            names = ["q_part", "i", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return run


def _meet(chunks: DataFrame, blocks: DataFrame, n_chunks: int, n_blocks: int) -> DataFrame:
    """Every chunk with every block of anchors, by the cells of a grid."""
    few = n_blocks <= BROADCAST_BLOCKS
    across, down = -(-n_blocks // GRID) if not few else 1, -(-n_chunks // GRID) if not few else 1
    left = chunks.withColumn("g", F.pmod(F.xxhash64("part"), F.lit(down))).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = blocks.withColumn("b", F.pmod(F.xxhash64("q_part"), F.lit(across)).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))))
    return left.join(F.broadcast(right) if few else right, ["g", "b"]).drop("g", "b")


def hard_negatives(
    vectors: DataFrame, anchor, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100),
) -> DataFrame:
    """For the rows for which ``anchor`` (a condition on the id column) holds: positives and the hardest rows of other labels.

    A score is the inner product of vectors whose components are scaled and rounded down. An anchor's positives are the first
    rows of its label with another id, by score, ties by id; for each, the first rows of other labels whose score in
    hundredths of the positive's lies within ``window`` are returned: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``. The result is exact.

    Rows with a null id, label or vector, a null or non-finite component, or a length (times ``scale``) of 2^28 or more,
    whose scores need not be 64-bit numbers, take no part. A shorter vector ends in zeros. Equal rows are anchors once;
    as positives and negatives every row counts. An anchor without another row of its label gives no rows, nor does an
    empty table; other columns are ignored.
    """
    base = whole_vectors(vectors, id_col, label_col, vector_col, scale)
    marks = marks_of(base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS))
    chunks = materialize(map_batches(base, _pack(marks, CHUNK_ROWS), _CHUNK), "chunks")
    own = materialize(whole_vectors(vectors.where(anchor), id_col, label_col, vector_col, scale).distinct(), "own")
    blocks = map_batches(own.coalesce(-(-own.count() // (4 * BLOCK_ANCHORS)) or 1), _pack([], BLOCK_ANCHORS), _CHUNK)
    blocks = materialize(blocks.drop("cells").withColumnsRenamed({c: f"q_{c}" for c in ("part", "n", "dims", "ids", "labels", "vectors")}), "anchors")
    n_chunks, n_blocks = chunks.count(), blocks.count()
    near = map_batches(_meet(chunks, blocks, n_chunks, n_blocks), _positives(marks, positives), "q_part long, i long, anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("q_part", "i").orderBy(F.desc("positive_score"), "positive_id"))
    near = near.withColumn("place", place).where(F.col("place") <= positives)
    told = near.groupBy("q_part").agg(F.collect_list(F.struct("i", "place", "positive_id", "positive_score")).alias("positives"))
    asked = materialize(blocks.join(told, "q_part"), "asked")
    schema = "q_part long, i long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    far = map_batches(_meet(chunks, asked, n_chunks, n_blocks), _negatives(marks, negatives, window), schema)
    rank = F.row_number().over(Window.partitionBy("q_part", "i", "place").orderBy(F.desc("negative_score"), "negative_id"))
    found = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    found = materialize(found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "negatives")
    discard(chunks, own, blocks, asked)
    return found
