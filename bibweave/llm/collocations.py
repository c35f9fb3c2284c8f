"""Phrases whose words stand together more often than their parts do, by merged count tries.

Texts are split at punctuation and line ends into pieces and those into words. Blocks of texts of one language first exchange
counts of words and of pairs of words by ranges of hashed keys. A phrase can only be frequent if all its pairs are, so
each block then builds a trie of depth four over runs of frequent pairs alone. A block's trie is written level by level in
sorted order and cut at prefixes of up to three words, which no hot pair can make one-sided; a range merges the sorted
tries of all blocks. Walks down a merged trie give the counts of a phrase's left parts. Its right parts are reached by suffix
links, a join of every node with those that lack its first words, as one step for each cut.

Words are known by 64-bit hashes with their language; only what is reported gets its words back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.llm.blocks import block_numbers, dealt, fresh, in_blocks, joined_key, longs, pack, range_of, summed, unpack
from bibweave.llm.textvec import LOWER, Words, map_batches, mix, slices
from bibweave.plans.scratch import discard, materialize

#: Keys of a range, words of a phrase, and the language of texts without one.
RANGE_KEYS, DEPTH, NO_LANG = 1 << 21, 4, "und"

_U = np.uint64
_STOP = np.array([chr(i) in ".,;:!?\n\x0b\x0c\r" for i in range(256)])
_WORD = ~_STOP & ~np.isin(np.arange(256), [0x20, 0x09])
_BLOCK = "block long, lang string, n_words long, tokens binary, keys binary, counts binary, sizes binary, words binary, n_keys long"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _rows(schema: str, columns: list[list]) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


def _table(schema: str, columns: list[list]) -> pa.Table:
    return pa.Table.from_batches([_rows(schema, columns)])


def _cut_out(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> bytes:
    """Some stretches of bytes, one after another."""
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return data[shift + np.arange(len(shift))].tobytes()


def _blocks(batches):
    """Words of the texts of one language as numbers from 1 into the block's list, 0 between pieces."""
    number = block_numbers()
    for lang, table in in_blocks(batches, group=0, text=1):
        salt = _U(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
        for _, _, data, offsets in slices(table.column("text"), 1 << 62):
            data = LOWER[data]
            words = Words(data, offsets, _WORD[data])
            keys, first, place, often = np.unique(fresh(mix(words.hashes() ^ salt)), return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            stops = np.searchsorted(np.flatnonzero(_STOP[data]), words.start)
            new = np.flatnonzero((np.diff(stops) > 0) | (np.diff(words.row) > 0)) + 1
            tokens = np.insert(rank[place] + 1, new, 0)
            start, size = words.start[first[order]], (words.end - words.start)[first[order]]
            yield _rows(_BLOCK, [[x] for x in (next(number), lang, len(words.start), pack(tokens), keys[order].tobytes(), pack(often[order]), pack(size), _cut_out(data, start, size), len(order))])


_WORDS = "r int, lang string, keys binary, counts binary, sizes binary, words binary"


def _word_shares(ranges: int):
    """Every block's words with their counts, dealt to the ranges of their keys."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts, size = np.frombuffer(row["keys"], _U), unpack(row["counts"]), unpack(row["sizes"])
                data, start, order = np.frombuffer(row["words"], np.uint8), np.cumsum(size) - size, np.argsort(keys)
                for r, at in dealt(keys[order], ranges):
                    i = order[at]
                    yield _rows(_WORDS, [[x] for x in (r, row["lang"], keys[i].tobytes(), pack(counts[i]), pack(size[i]), _cut_out(data, start[i], size[i]))])

    return run


_DICTIONARY = "key long, lang string, word string, c long"


def _dictionary(least: int):
    """The frequent words of a range."""

    def run(table: pa.Table) -> pa.Table:
        keys, sizes = longs(table.column("keys")), np.concatenate([unpack(x.as_py()) for x in table.column("sizes")])
        distinct, total, place = summed(np.concatenate(keys), np.concatenate([unpack(x.as_py()) for x in table.column("counts")]))
        at = np.empty(len(distinct), np.int64)
        at[place] = np.arange(len(place))  # one place of each
        often = np.flatnonzero(total >= least)
        words, ends, row = b"".join(table.column("words").to_pylist()), np.cumsum(sizes), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        langs = table.column("lang").to_pylist()
        found = at[often]
        return _table(_DICTIONARY, [distinct[often].view(np.int64), [langs[i] for i in row[found]], [words[ends[i] - sizes[i] : ends[i]].decode() for i in found], total[often]])

    return run


_PAIRS = "r int, block long, keys binary, counts binary"


def _pair_shares(ranges: int):
    """Every block's pairs of neighbouring words with their counts, dealt to the ranges of their keys."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, tokens = np.frombuffer(row["keys"], _U), unpack(row["tokens"])
                a, b = tokens[:-1], tokens[1:]
                both = (a > 0) & (b > 0)
                codes, counts = np.unique((a[both] - 1) * len(words) + b[both] - 1, return_counts=True)
                keys = joined_key(words[codes // max(1, len(words))], words[codes % max(1, len(words))])
                order = np.argsort(keys)
                for r, at in dealt(keys[order], ranges):
                    yield _rows(_PAIRS, [[x] for x in (r, row["block"], keys[order[at]].tobytes(), pack(counts[order[at]]))])

    return run


_ANSWERS = "block long, keys binary, totals binary"


def _frequent(least: int):
    """For every block its pairs of a range that are frequent among all blocks, with their counts there."""

    def run(table: pa.Table) -> pa.Table:
        keys = longs(table.column("keys"))
        _, total, place = summed(np.concatenate(keys), np.concatenate([unpack(x.as_py()) for x in table.column("counts")]))
        out: list[list] = [[], [], []]
        for block, own, at in zip(table.column("block").to_pylist(), keys, np.split(place, np.cumsum([len(k) for k in keys])[:-1])):
            often = total[at] >= least
            if often.any():
                for col, x in zip(out, (block, own[often].tobytes(), pack(total[at[often]]))):
                    col.append(x)
        return _table(_ANSWERS, out)

    return run


_TRIE = "r int, w1 binary, kids1 binary, w2 binary, kids2 binary, f2 binary, w3 binary, kids3 binary, w4 binary, n binary"


def to_trie(paths: np.ndarray, f2: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A trie of sorted distinct paths (four keys each, 0 behind the end), level by level: keys, and children of each node.

    ``f2`` belongs to the nodes of the second level, ``n`` to the leaves.
    """
    new = np.ones(len(paths), bool)
    starts = []
    for level in range(3):
        changed = np.ones(len(paths), bool)
        changed[1:] = paths[1:, level] != paths[:-1, level]
        new = changed if level == 0 else new | changed
        starts.append(np.flatnonzero(new))
    leaves = np.arange(len(paths))
    kids = [np.diff(np.searchsorted(below, own), append=len(below)) for own, below in zip(starts, [*starts[1:], leaves])]
    keys = [paths[at, level].tobytes() for level, at in enumerate([*starts, leaves])]
    return [keys[0], pack(kids[0]), keys[1], pack(kids[1]), pack(f2[starts[1]]), keys[2], pack(kids[2]), keys[3], pack(n)]


def from_trie(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Paths, ``f2`` and ``n`` of a trie's leaves."""
    w = [np.frombuffer(row[f"w{i}"], _U) for i in range(1, DEPTH + 1)]
    kids = [unpack(row[f"kids{i}"]) for i in range(1, DEPTH)]
    f2 = unpack(row["f2"])
    paths = np.empty((len(w[3]), DEPTH), _U)
    paths[:, 3] = w[3]
    below = np.ones(len(w[3]), np.int64)  # leaves of each node, from the bottom up
    spread = []
    for level in (2, 1, 0):
        below = np.add.reduceat(below, np.cumsum(kids[level]) - kids[level]) if len(kids[level]) else below
        spread.append(below)
        paths[:, level] = np.repeat(w[level], below)
    return paths, np.repeat(f2, spread[1]), unpack(row["n"])


def _in_order(paths: np.ndarray, *first: np.ndarray) -> np.ndarray:
    """The order of paths; sorted runs are merged as they are."""
    return np.lexsort((*(paths[:, i] for i in range(DEPTH - 1, -1, -1)), *first))


def _tries(ranges: int):
    """A block's trie of runs of frequent pairs, cut by prefix ranges."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        if not block.num_rows or not told.num_rows:
            return _table(_TRIE, [[] for _ in _TRIE.split(", ")])
        row = block.to_pylist()[0]
        words, tokens = np.concatenate([[_U(0)], np.frombuffer(row["keys"], _U)]), unpack(row["tokens"])
        known, total = np.concatenate(longs(told.column("keys"))), np.concatenate([unpack(x.as_py()) for x in told.column("totals")])
        order = np.argsort(known)
        known, total = known[order], total[order]
        tokens = np.append(tokens, [0, 0, 0])
        a = np.flatnonzero((tokens[:-1] > 0) & (tokens[1:] > 0))
        pair = joined_key(words[tokens[a]], words[tokens[a + 1]])
        at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
        hit = known[at] == pair
        f2 = np.zeros(len(tokens), np.int64)
        f2[a[hit]] = total[at[hit]]
        two = a[hit]
        three = two[f2[two + 1] > 0]
        # one path for each frequent pair, with its count among all blocks, and one for each run of more, with its count here
        pairs, one = np.unique(tokens[two] * len(words) + tokens[two + 1], return_index=True)
        fourth = np.where(f2[three + 2] > 0, tokens[np.minimum(three + 3, len(tokens) - 1)], 0)
        head = np.searchsorted(pairs, tokens[three] * len(words) + tokens[three + 1])
        tails, tail = np.unique(tokens[three + 2] * len(words) + fourth, return_inverse=True)
        codes, n = np.unique(head * max(1, len(tails)) + tail, return_counts=True)
        head, tail = pairs[codes // max(1, len(tails))], tails[codes % max(1, len(tails))] if len(codes) else codes
        paths = np.zeros((len(pairs) + len(codes), DEPTH), _U)
        paths[: len(pairs), 0], paths[: len(pairs), 1] = words[pairs // len(words)], words[pairs % len(words)]
        for level, x in enumerate((head // len(words), head % len(words), tail // len(words), tail % len(words))):
            paths[len(pairs) :, level] = words[x]
        n, f2 = np.concatenate([np.zeros(len(pairs), np.int64), n]), np.concatenate([f2[two[one]], f2[two[one]][codes // max(1, len(tails))]])
        r = range_of(joined_key(joined_key(paths[:, 0], paths[:, 1]), paths[:, 2]), ranges)
        order = _in_order(paths, r)
        paths, n, f2, r = paths[order], n[order], f2[order], r[order]
        first = np.flatnonzero(np.diff(r, prepend=-1))
        parts = [[int(r[lo]), *to_trie(paths[lo:hi], f2[lo:hi], n[lo:hi])] for lo, hi in zip(first, np.append(first[1:], len(r)))]
        return _table(_TRIE, [list(c) for c in zip(*parts)])

    return run


_NODES = "p array<bigint>, a long, l2 long, l3 long"


def _merged(least: int):
    """Frequent nodes of a prefix range with the counts of their left parts of two and three words."""

    def run(table: pa.Table) -> pa.Table:
        paths, f2, n = (np.concatenate(x) for x in zip(*(from_trie(row) for row in table.to_pylist())))
        order = _in_order(paths)
        paths, f2, n = paths[order], f2[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (paths[1:] != paths[:-1]).any(axis=1)]))
        paths, f2, n = paths[first], f2[first], np.add.reduceat(n, first)
        parent = np.flatnonzero(np.concatenate([[True], (paths[1:, :3] != paths[:-1, :3]).any(axis=1)]))
        third = np.add.reduceat(n, parent)
        l3 = np.repeat(third, np.diff(parent, append=len(paths)))
        out: list[list] = [[], [], [], []]
        none = np.zeros(0, np.int64)
        two = np.flatnonzero(paths[:, 2] == 0)
        three = parent[(paths[parent, 2] != 0) & (third >= least)]
        four = np.flatnonzero((paths[:, 3] != 0) & (n >= least))
        for size, at, a, left in ((2, two, f2, none), (3, three, l3, f2), (4, four, n, f2)):
            out[0] += paths[at, :size].view(np.int64).tolist()
            out[1] += a[at].tolist()
            out[2] += left[at].tolist() if len(left) else [None] * len(at)
            out[3] += l3[at].tolist() if size == 4 else [None] * len(at)
        return _table(_NODES, out)

    return run


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of two to four words of every language, by how much of its parts' occurrences a phrase makes up.

    Candidates occur at least ``least`` times within pieces, overlaps included. A phrase's score is the smallest, over all cuts in
    two, of 2,000,000 times its count by the sum of its parts' counts, rounded down; of equal ones the first cut counts.
    A candidate goes if a longer one that holds it has at least ``covered`` hundredths of its occurrences.

    Returns ``lang, rank, phrase, a`` (count), ``l, r`` (of the parts), ``n`` (words of the language) and ``score``; ties of score and count go by the
    phrase's bytes. Products are decimals, so nothing overflows. A null language is ``und``, a null text is empty, repeated rows count as often
    as they stand there; other columns are ignored, and an empty table gives no rows.
    """
    base = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text")).where("text <> ''")
    blocks = materialize(map_batches(base, _blocks, _BLOCK), "phrase-blocks")
    size = blocks.agg(F.coalesce(F.sum("n_keys"), F.lit(0)).alias("keys"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words")).first()
    few, many = (max(1, -(-size[k] // RANGE_KEYS)) for k in ("keys", "words"))
    shares = map_batches(blocks.select("lang", "keys", "counts", "sizes", "words"), _word_shares(few), _WORDS)
    words = materialize(shares.groupBy("r").applyInArrow(_dictionary(least), _DICTIONARY), "phrase-words")
    pairs = map_batches(blocks.select("block", "tokens", "keys"), _pair_shares(many), _PAIRS)
    answers = materialize(pairs.groupBy("r").applyInArrow(_frequent(least), _ANSWERS), "phrase-pairs")
    tries = blocks.select("block", "tokens", "keys").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_tries(many), _TRIE)
    nodes = materialize(tries.groupBy("r").applyInArrow(_merged(least), _NODES), "phrase-nodes")
    totals = materialize(blocks.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-totals")
    discard(blocks, answers)
    long = F.size("p")
    # the first level of the tries is the list of words
    cuts = nodes.join(words.select(F.col("key").alias("w1"), "lang", F.col("c").alias("l1")), F.col("p")[0] == F.col("w1"))
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), long - 1))).withColumn("q", F.slice("p", F.col("k") + 1, long))
    cuts = cuts.withColumn("l", F.when(F.col("k") == 1, F.col("l1")).when(F.col("k") == 2, F.col("l2")).otherwise(F.col("l3")))
    suffixes = nodes.select(F.col("p").alias("q"), F.col("a").alias("r")).unionByName(words.select(F.array("key").alias("q"), F.col("c").alias("r")))
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0))) div cast(cast(l as decimal(20, 0)) + r as decimal(21, 0))")
    best = cuts.join(suffixes, "q").groupBy("lang", "p", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b")).select("lang", "p", "a", "b.*")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), long - 1), lambda s: F.transform(F.sequence(F.lit(1), long - s + 1), lambda i: F.slice("p", i, s))))
    longer = nodes.where(long > 2).select(F.explode(inner).alias("p"), F.col("a").alias("held")).groupBy("p").agg(F.max("held").alias("held"))
    over = F.col("held").cast("decimal(20, 0)") * 100 >= F.col("a").cast("decimal(20, 0)") * covered
    kept = best.join(longer, "p", "left").where(F.col("held").isNull() | ~over)
    order = [F.desc("score"), F.desc("a")]
    some = kept.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    told = some.select("lang", "p", "a", "score", "l", "r", F.posexplode("p").alias("at", "key")).join(words.select("key", "word"), "key")
    told = told.groupBy("lang", "p", "a", "score", "l", "r").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    told = told.withColumn("phrase", F.array_join("w.word", " "))
    last = told.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))).where(F.col("rank") <= top)
    return last.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
