"""Near-duplicate groups by HyperMinHash, banding and exact verification.

A text's shingle hashes fall into buckets; of every bucket's smallest hash a register
keeps the count of leading zeros (6 bits) and the next bits (10 bits). Bands of
registers are join keys. Texts that share a band are compared: first by the Jaccard
estimate of their registers, corrected for chance collisions, then on their full
shingle sets.

Two layouts of the registers keep bands selective at every length: one permutation
over all buckets for long texts, many permutations of few buckets for short ones, so
that no register hangs on a single frequent shingle. Texts of a length between get
both, and any two texts that are similar enough share one layout.

A bucket of N texts is not expanded into N * N pairs. Each text is compared with the one
leader that it shares most buckets with, and the groups found are merged; then with the leaders of
all its other buckets, unless they are in its group by then. Documents in buckets whose members (but the leader) still belong
to different groups are then compared exactly: each is entered under the rarest of its
shingles (as many as a partner must share one of), and pairs of different groups under
one shingle are made only if its position leaves room for enough shared shingles. There
too members meet a few leaders at a time (8, 64, ...), from the smallest groups first, until
every remaining pair has been compared or is in one group. Nothing is capped.

The chance that two texts at exactly the threshold 0.8 share no band is
(1 - 0.8^4)^32 = 5e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.llm.rows import bounded_broadcast
from bibweave.llm.textvec import map_batches, mix, shingle_sets, slices, spaced_words
from bibweave.plans.components import connected_components
from bibweave.plans.scratch import discard, materialize

BUCKETS, MANTISSA = 128, 10
#: Permutations of the layout for short texts, and the set size at which the layouts meet.
SHORT_PERMUTATIONS, MEET = 64, 256
#: Chance that the registers of two unequal minima agree, for 10 mantissa bits.
COLLISION = 0.1694 / (1 << MANTISSA)

_U = np.uint64
_SEEDS = mix(np.arange(1, SHORT_PERMUTATIONS + 1, dtype=_U))
_FULL = _U((1 << 64) - 1)


def _registers(value: np.ndarray, bits: int) -> np.ndarray:
    """Registers of minima below 2^bits; 0 stands for an empty bucket (all ones)."""
    size = np.frexp(value.astype(np.float64))[1].astype(np.int64)
    shift = size - 1 - MANTISSA
    right = value >> np.maximum(shift, 0).astype(_U)
    part = (right << np.maximum(-shift, 0).astype(_U)) & _U((1 << MANTISSA) - 1)
    zeros = np.clip(bits - size, 0, 61).astype(_U)
    return np.where(value == _FULL, 0, ((zeros << _U(MANTISSA)) | part) + _U(1)).astype(np.uint16)


def long_registers(shingles: np.ndarray) -> np.ndarray:
    """One permutation, 128 buckets; ``shingles`` are sorted and distinct."""
    bucket = (shingles >> _U(57)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    low = np.full(BUCKETS, _FULL, dtype=_U)
    low[bucket[first]] = shingles[first] & _U((1 << 57) - 1)
    return _registers(low, 57)


def short_registers(shingles: np.ndarray) -> np.ndarray:
    """64 permutations of two buckets each."""
    h = mix(shingles[None, :] ^ _SEEDS[:, None])
    odd = (h & _U(1)).astype(bool)
    h >>= _U(1)
    low = np.stack([np.where(odd, _FULL, h).min(axis=1), np.where(odd, h, _FULL).min(axis=1)], axis=1)
    return _registers(low.reshape(-1), 63)


def registers(shingles: np.ndarray, threshold: float) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Registers in the layout for short and in the one for long texts, where it has them."""
    n = len(shingles)
    short = short_registers(shingles) if 0 < n <= MEET / threshold else None
    return short, long_registers(shingles) if n >= MEET * threshold else None


def band_keys(shingles: np.ndarray, threshold: float, rows: int = 4) -> np.ndarray:
    keys = []
    for layout, regs in enumerate(registers(shingles, threshold)):
        if regs is not None:
            lanes = np.zeros((BUCKETS // rows, 4 * -(-rows // 4)), dtype=np.uint16)
            lanes[:, :rows] = regs.reshape(-1, rows)
            words = lanes.view(_U)
            key = np.arange(len(words), dtype=_U) * _U(2) + _U(layout)
            for column in words.T:
                key = mix(key ^ mix(column + _U(1)))
            keys.append(key[words.any(axis=1)])
    return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[float, int]:
    """Jaccard estimate from two texts' registers without chance collisions, and buckets used."""
    used = int(np.count_nonzero(a | b))
    if not used:
        return 1.0, 0
    same = np.count_nonzero((a == b) & (a != 0)) / used
    return max(0.0, (same - COLLISION) / (1 - COLLISION)), used


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    row = 0
    for _, _, data, offsets in slices(batch.column(1)):
        for found in shingle_sets(spaced_words(data, offsets), k):
            yield row, found
            row += 1


def _sign(k: int, threshold: float, rows: int):
    def run(batches):
        for batch in batches:
            size, digest, keys = [], [], []
            for _, s in _sets(batch, k):
                size.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                keys.append(band_keys(s, threshold, rows))
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)],
                names=["doc_id", "n", "digest", "bands"],
            )

    return run


def _keep_sets(k: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for part, rows in _grouped(_sets(batch, k)):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), _lists(part)], names=["doc_id", "shingles"])

    return run


def _lists(sets: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))


def _grouped(found, limit: int = 1 << 20):
    """Runs of sets of about ``limit`` hashes, with their rows."""
    part, rows, size = [], [], 0
    for row, s in found:
        part.append(s)
        rows.append(row)
        size += len(s)
        if size > limit:
            yield part, rows
            part, rows, size = [], [], 0
    if part:
        yield part, rows


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """100 * intersection >= 100 * threshold * union of two sorted distinct sets, in whole numbers."""
    percent = round(100 * threshold)
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(threshold: float):
    def run(batches):
        known: dict = {}
        for batch in batches:
            keep = []
            sets = batch.column(2), batch.column(3)
            for i, ids in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                got = []
                for x, c in zip(ids, sets):
                    s = c[i].values.to_numpy(zero_copy_only=False).view(_U)
                    tag = (x, len(s))
                    if tag not in known:
                        if len(known) > 2000:
                            known.clear()
                        known[tag] = registers(s, threshold)
                    got.append((s, known[tag]))
                (a, ra), (b, rb) = got
                guess = [estimate(x, y) for x, y in zip(ra, rb) if x is not None and y is not None]
                sure = all(e < threshold - 6 * (threshold * (1 - threshold) / max(n, 1)) ** 0.5 for e, n in guess)
                if guess and not sure and similar(a, b, threshold):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(j).take(pa.array(keep, pa.int32())) for j in (0, 1)], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8, rows: int = 4
) -> DataFrame:
    """Groups of texts linked by a Jaccard similarity of at least ``threshold``.

    Words are split at ASCII white space, A-Z lower-cased; the set of a text are its
    distinct shingles of ``words`` words (with fewer words, the whole sequence).
    Links are confirmed on full sets in whole percents of the threshold.

    Returns one row per input row: ``doc_id``, ``n_shingles`` (set size),
    ``component_id`` (smallest id reachable over links) and ``kept`` (it is that id).
    Null and empty texts have an empty set, are linked with nothing and kept. Rows
    with a null id are returned with a null component and ``kept`` true; they link with
    nothing. Rows that share an id count as one document. Other columns of ``docs`` are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sig = materialize(map_batches(base, _sign(words, threshold, rows), "doc_id long, n long, digest binary, bands array<long>"), "signatures")
    classes = (
        sig.where("n > 0 and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    )
    classes = materialize(classes, "classes")
    entries = classes.select("rep", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("leader")).where("lo < leader")
    shared = shared.select("key", F.col("lo").alias("leader"))
    # the leader of each shared band, and the members still to be compared with others
    rest = materialize(entries.join(shared, "key").where("rep <> leader"), "members")
    labels = _link(base, rest, words, threshold)
    home = classes.select("digest", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("rep"))
    out = sig.select("doc_id", "n", F.when(F.expr("n > 0 and doc_id is not null"), F.col("digest")).alias("digest")).join(home, "digest", "left")
    component = F.coalesce("rep", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _link(base: DataFrame, rest: DataFrame, words: int, threshold: float) -> DataFrame:
    """Components over confirmed links; ``rest``: members of shared bands with their first leader."""
    made = [rest]

    def table(df: DataFrame, name: str, **options) -> DataFrame:
        made.append(materialize(df, name, **options))
        return made[-1]

    def done(labels: DataFrame) -> DataFrame:
        discard(*(t for t in made if t is not labels))
        return labels

    # each member first meets the leader that it shares most bands with
    bound = rest.count()
    met = table(rest.groupBy("rep", "leader").agg(F.count("*").alias("c")), "met", rows=bound)
    often = met.groupBy("rep").agg(F.max(F.struct("c", (-F.col("leader")).alias("m"))).alias("x")).select("rep", (-F.col("x.m")).alias("leader"))
    pairs = often.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"))
    ids = rest.select(F.explode(F.array("rep", "leader")).alias("doc_id")).distinct()
    ids = table(ids, "candidates", rows=bound)
    sets = table(
        map_batches(base.join(bounded_broadcast(ids), "doc_id", "left_semi").select("doc_id", "text"), _keep_sets(words), "doc_id long, shingles array<long>"), "sets"
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
        right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
        return map_batches(both, _verify(threshold), "a long, b long")

    def settled(links: DataFrame) -> DataFrame:
        found = connected_components(links, "a", "b")
        labels = table(found, "labels", rows=bound)
        discard(found)
        return labels

    def merged(labels: DataFrame, pairs: DataFrame) -> DataFrame:
        fresh = table(confirmed(pairs), "links")
        if fresh.isEmpty():
            return labels
        return settled(fresh.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    labels = settled(table(confirmed(pairs), "links"))
    # then the leaders of its other bands, so that no band's leader is left uncompared
    left = met.join(often, ["rep", "leader"], "left_anti").join(labels.select(F.col("node").alias("rep"), F.col("component").alias("x")), "rep", "left")
    left = left.join(labels.select(F.col("node").alias("leader"), F.col("component").alias("y")), "leader", "left")
    left = left.where(F.coalesce("x", "rep") != F.coalesce("y", "leader"))
    labels = merged(labels, left.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")))
    percent = round(100 * threshold)
    placed = rest.select("key", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    open_ids = table(placed.join(split, "key").select(F.col("rep").alias("doc_id")).distinct(), "open", rows=bound)
    if open_ids.isEmpty():
        return done(labels)
    rest = table(_prefixes(sets.join(open_ids, "doc_id", "left_semi"), percent), "prefixes")
    bound, leaders = max(bound, rest.count()), 8
    while True:
        size = labels.groupBy("component").agg(F.count("*").alias("size"))
        known = labels.join(size, "component").withColumnRenamed("node", "rep")
        now = rest.join(known, "rep", "left").withColumns({"component": F.coalesce("component", "rep"), "size": F.coalesce("size", F.lit(1))})
        stats = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("least")).where("lo < hi")
        # a partner has at least `least` and at least threshold * n shingles
        alive = (F.col("n") - F.col("at")) * (100 + percent) >= percent * (F.col("n") + F.greatest("least", F.ceil(F.col("n") * percent / 100)))
        now = table(now.join(stats.select("key", "least"), "key").where(alive).drop("least"), "open", rows=bound)
        if now.isEmpty():
            return done(labels)
        order = Window.partitionBy("key").orderBy("size", "rep")
        lead = now.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= leaders)
        lead = lead.select("key", F.col("rep").alias("leader"), F.col("component").alias("other"), F.col("n").alias("m"), F.col("at").alias("by"))
        lead = table(lead, "leaders", rows=bound)
        fits = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("by")) * (100 + percent) >= percent * (F.col("n") + F.col("m"))
        pairs = now.join(lead, "key").where((F.col("component") != F.col("other")) & fits)
        pairs = pairs.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
        labels = merged(labels, pairs)
        used = lead.select("key", F.col("leader").alias("rep"))
        rest = now.join(used, ["key", "rep"], "left_anti").select("key", "rep", "n", "at")
        leaders = min(leaders * 8, 1000)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Members under each of their rarest shingles: ``key, rep, n, at`` (place in order of rarity).

    Two sets with a Jaccard similarity of the threshold share one of the first
    n - ceil(threshold * n) + 1 shingles of each, and behind the first shared one there
    must be room for all others.
    """
    rows = sets.select(F.col("doc_id").alias("rep"), F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("key"))
    often = rows.groupBy("key").agg(F.count("*").alias("often"))
    order = Window.partitionBy("rep", "n").orderBy("often", "key")
    placed = rows.join(often, "key").withColumn("at", F.row_number().over(order) - 1)
    return placed.where((F.col("often") > 1) & (F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100))).select("key", "rep", "n", "at")
