from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from bibweave.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, anchors, first=5, window=(80, 100)):
    """All scores of all anchors, ranked and cut in the open."""
    whole = []
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for i, label, q in {r for r in whole if anchors(r[0])}:
        scored = [(-sum(a * b for a, b in zip(q, v)), j, other) for j, other, v in whole]
        for s, j, _ in sorted(x for x in scored if x[2] == label and x[1] != i)[:first]:
            inside = sorted(x for x in scored if x[2] != label and window[0] * -s <= 100 * -x[0] <= window[1] * -s)
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(inside[:first], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(seed, n, dims, labels=4, spread=0.4):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(3, dims))
    v = centre[r.integers(0, 3, n)] + spread * r.normal(size=(n, dims))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, int(r.integers(0, labels)), [float(np.float32(x)) for x in row]) for i, row in enumerate(v)]


def test_negatives_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 64)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 8)
    rows = vectors(1, 900, 24)
    rows += [(1000 + i, i % 3, rows[40][2]) for i in range(200)]  # one large group of equal vectors
    random.Random(2).shuffle(rows)
    want = plain(rows, lambda i: i % 20 == 0)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(negatives.hard_negatives(df, F.col("vec_id") % 20 == 0)) == want and len(want) > 500
    monkeypatch.setattr(negatives, "BROADCAST_BLOCKS", 0)  # the grid of chunks and blocks
    monkeypatch.setattr(negatives, "GRID", 3)
    assert rows_of(negatives.hard_negatives(df, F.col("vec_id") % 20 == 0)) == want


def test_cells_bound_every_score(spark):
    rows = vectors(3, 300, 16)
    base = negatives.whole_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "label", "embedding", 256)
    marks = negatives.marks_of(base.limit(50), cells=8)  # a poor sample
    chunk = negatives._Chunk(base.coalesce(1).mapInArrow(negatives._pack(marks, 1000), negatives._CHUNK).collect()[0].asDict(), marks)
    skipped = 0
    for q in chunk.v[:40]:
        lower, upper = chunk.bounds(q, slice(0, chunk.size))
        score = chunk.v @ q
        assert (lower <= score).all() and (score <= upper).all()
        skipped += (upper < np.sort(lower)[-5]).sum()
    assert skipped > 40 * 100  # and they leave most rows out


def test_negatives_of_odd_rows(spark):
    v = [0.5, 0.25, -0.5]
    rows = [(0, 1, v), (0, 1, v), (1, 1, v), (2, 2, v), (2, 2, v), (3, None, v), (None, 2, v), (4, 2, None), (5, 2, [0.1, None, 0.2]), (6, 2, [float("nan"), 1.0, 1.0])]
    rows += [(7, 2, [float("inf"), 1.0, 1.0]), (8, 2, [3e38, 1.0, 1.0]), (9, 2, [0.5]), (100, 3, []), (101, 3, [0.0, 0.0, 0.0]), (102, 4, [0.0]), (200, 5, v), (300, 1, [-x for x in v])]
    got = rows_of(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("rank", F.lit("x")), F.col("vec_id") % 100 == 0))
    assert got == plain([r for r in rows if r[0] != 8], lambda i: i % 100 == 0)
    assert {r[0] for r in got} == {0, 100}
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []
