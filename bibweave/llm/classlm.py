"""Log probabilities of texts by a class-based bigram model with exchange clustering.

Words are dealt into classes such that the classes of neighbours tell most of each other: a word moves to the class where
the likelihood of all training tokens under class transitions grows most. The exchange runs in sweeps. In each, every block of
texts counts which classes stand before and after its words; the counts are summed over all blocks in a tree of
bounded groups, and the words of one half move at once while the other half stays. All words that training texts have ``LEAST`` times
take part, however many there are; rarer words, and words never seen, are one more class, and the end of a text is the last one.

Words that take part are numbered in the order of their keys. Blocks are told the numbers of their own words once, so what all
tasks and the driver hold is a byte for each word, its class; keys and counts stay in ranges.

A token's probability is that of its class after the class before it, smoothed by the class's share, times that of the word
in its class. The counts of all words, frequent or not, are exact and cover all training texts; blocks get those of their own words only.

Words are known by 64-bit hashes; among 10^9 distinct words some 0.03 pairs are expected to share one.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.blocks import block_numbers, dealt, fresh, in_blocks, longs, pack, summed, unpack
from bibweave.llm.textvec import map_batches, mix, slices, spaced_words
from bibweave.plans.scratch import discard, materialize

#: Classes of frequent words, sweeps (each moves half of the words) and the least count of a frequent word.
CLASSES, SWEEPS, LEAST = 32, 4, 3
#: Added to a word's count, and weight of a class's share against the transitions seen.
ADD, WEIGHT = 0.1, 10.0
#: Keys of a range, words of a range of the exchange (more where there were over ``MOST_RANGES`` of them), and blocks whose counts are summed in one group.
RANGE_KEYS, RANGE_WORDS, MOST_RANGES, FAN_IN = 1 << 21, 1 << 12, 1 << 10, 32

_U = np.uint64
#: The key of the end of a text.
END = _U(0x2545F4914F6CDD1D)
_BLOCK = "block long, doc_ids array<bigint>, held_out array<boolean>, n_tokens array<bigint>, tokens binary, keys binary, counts binary, n_train long, n_keys long"


def held_out(id_col) -> F.Column:
    """One id in ten, by the crc32 of its decimal text; never a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _blocks(batches):
    """Tokens of every text and its end as numbers into the block's keys, most frequent first."""
    number = block_numbers()
    for _, table in in_blocks(batches, text=2):
        for _, _, data, offsets in slices(table.column("text"), 1 << 62):
            words = spaced_words(data, offsets)
            rows = words.rows
            ends = words.bounds[1:] + np.arange(rows)
            keys = np.empty(len(words.start) + rows, _U)
            keys[ends] = END
            inside = np.ones(len(keys), bool)
            inside[ends] = False
            keys[inside] = fresh(words.hashes())
            sizes = np.diff(words.bounds) + 1
            distinct, place, often = np.unique(keys, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            tokens = rank[place]
            out = table.column("held_out").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
            counts = np.bincount(tokens[np.repeat(~out, sizes)], minlength=len(order))
            columns = [
                pa.array([next(number)], pa.int64()), pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([out.tolist()], pa.list_(pa.bool_())),
                pa.array([sizes.tolist()], pa.list_(pa.int64())), pa.array([pack(tokens)], pa.binary()), pa.array([distinct[order].tobytes()], pa.binary()), pa.array([pack(counts)], pa.binary()),
                pa.array([int(counts.sum())], pa.int64()), pa.array([len(order)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "held_out", "n_tokens", "tokens", "keys", "counts", "n_train", "n_keys"])


def _shares(ranges: int):
    """Every block's counts, dealt to the ranges of its keys."""

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for block, keys, counts in zip(batch.column(0).to_pylist(), longs(batch.column(1)), batch.column(2)):
                counts, order = unpack(counts.as_py()), np.argsort(keys)
                for r, at in dealt(keys[order], ranges):
                    for col, x in zip(out, (r, block, keys[order[at]].tobytes(), pack(counts[order[at]]))):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["r", "block", "keys", "counts"])

    return run


def _totals(table: pa.Table) -> pa.Table:
    """What all blocks have counted of a range's keys: for each block the totals and codes (0 of a rare word, 1 of the end, from 2 on
    frequent words in order), and (without a block) the frequent keys and how many occur."""
    keys = longs(table.column("keys"))
    distinct, total, place = summed(np.concatenate(keys), np.concatenate([unpack(x.as_py()) for x in table.column("counts")]))
    ends = np.cumsum([len(k) for k in keys])
    often = (total >= LEAST) & (distinct != END)
    codes = np.where(often, np.cumsum(often) + 1, distinct == END)
    places = np.split(place, ends[:-1])
    columns = [
        pa.array([*table.column("block").to_pylist(), None], pa.int64()),
        pa.array([table.column("r")[0].as_py()] * (len(keys) + 1), pa.int32()),
        pa.array([*(pack(total[p]) for p in places), pack(total[often])], pa.binary()),
        pa.array([*(pack(codes[p]) for p in places), None], pa.binary()),
        pa.array([None] * len(keys) + [distinct[often].tobytes()], pa.binary()),
        pa.array([None] * len(keys) + [int((total > 0).sum())], pa.int64()),
    ]
    return pa.table(columns, names=["block", "r", "totals", "codes", "frequent", "seen"])


_PLACED = "block long, doc_ids array<bigint>, held_out array<boolean>, n_tokens array<bigint>, tokens binary, totals binary, codes binary"


def _placed(offsets: np.ndarray):
    """Every block with the totals and codes of its own keys; ``offsets`` are the frequent words before each range."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        keys = longs(block.column("keys"))
        block, found = block.drop_columns(["keys"]), [[], []]
        for own in keys:  # one row
            parts = sorted(zip(told.column("r").to_pylist(), told.column("totals").to_pylist(), told.column("codes").to_pylist()))
            order, total, codes = np.argsort(own), np.empty(len(own), np.int64), np.empty(len(own), np.int64)
            total[order] = np.concatenate([unpack(x) for _, x, _ in parts])
            within = [(r, unpack(x)) for r, _, x in parts]
            codes[order] = np.concatenate([np.where(x > 1, x + offsets[r], x) for r, x in within])
            found[0].append(pack(total))
            found[1].append(pack(codes))
        return block.append_column("totals", pa.array(found[0], pa.binary())).append_column("codes", pa.array(found[1], pa.binary()))

    return run


@dataclass(frozen=True)
class Model:
    """``tokens`` and ``seen`` (distinct ones) of the training texts; the class of every code; transitions between classes; ranges of keys of frequent words."""

    tokens: int
    seen: int
    by_code: np.ndarray
    moves: np.ndarray
    n_classes: int
    words: DataFrame

    @property
    def classes(self) -> np.ndarray:
        """Classes of the frequent words, in order of their keys."""
        return self.by_code[2:]

    @property
    def keys(self) -> np.ndarray:
        """Keys of the frequent words, in order; they are collected, and only asked for to look into a model."""
        found = [np.frombuffer(row["frequent"], _U) for row in self.words.select("r", "frequent").orderBy("r").toLocalIterator()]
        return np.concatenate([np.zeros(0, _U), *found])

    def transitions(self) -> np.ndarray:
        """log10 of the chance of a class (column) after a class (row)."""
        n = len(self.moves)
        share = (self.moves.sum(axis=0) + ADD) / (self.moves.sum() + ADD * n)
        return np.log10((self.moves + WEIGHT * share) / (self.moves.sum(axis=1, keepdims=True) + WEIGHT))

    def sizes(self) -> np.ndarray:
        """What a chance in each class but the end is divided by: its tokens, as each is stepped to once, and its words."""
        kinds = np.zeros(self.n_classes + 1, np.int64)
        for lo in range(0, len(self.classes), RANGE_KEYS):
            kinds += np.bincount(self.classes[lo : lo + RANGE_KEYS], minlength=len(kinds))
        kinds[-1] = max(0, self.seen - len(self.classes) - 1) + 1
        return self.moves.sum(axis=0)[:-1] + ADD * kinds


def _x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(moves: np.ndarray) -> float:
    """What the classes add to the log likelihood of the tokens, up to a constant of the words alone."""
    return float(_x_log_x(moves).sum() - _x_log_x(moves.sum(axis=0)).sum() - _x_log_x(moves.sum(axis=1)).sum())


def best_classes(after: np.ndarray, before: np.ndarray, count: np.ndarray, own: np.ndarray, moves: np.ndarray, n_classes: int) -> np.ndarray:
    """The class of ``n_classes`` that each word fits best, all others as they are; of equal ones its own.

    ``after`` and ``before`` have how often each class follows and precedes a word, ``moves`` all transitions.
    """
    k, i = np.arange(n_classes), np.arange(len(own))
    left = np.repeat(moves[None].astype(np.float64), len(own), axis=0)  # transitions without the word
    left[i, own] -= after
    left[i, :, own] -= before
    np.maximum(left, 0, out=left)
    rows, columns, both = left[:, :n_classes], left[:, :, :n_classes], left[:, k, k]
    gain = (_x_log_x(rows + after[:, None]) - _x_log_x(rows)).sum(axis=2) + (_x_log_x(columns + before[:, :, None]) - _x_log_x(columns)).sum(axis=1)
    a, b = after[:, :n_classes], before[:, :n_classes]
    gain += _x_log_x(both + a + b) - _x_log_x(both + a) - _x_log_x(both + b) + _x_log_x(both)
    gone = count[:, None] * (own[:, None] == k)
    for side in (0, 1):
        size = np.maximum(moves.sum(axis=side)[:n_classes] - gone, 0)
        gain -= _x_log_x(size + count[:, None]) - _x_log_x(size)
    best = gain.argmax(axis=1)
    return np.where(gain[i, own] >= gain[i, best] - 1e-9, own, best)


_CONTEXTS = "r int, block long, codes binary, counts binary, moves array<bigint>"


def _moving(places: np.ndarray, sweep: int) -> np.ndarray:
    """Which of some frequent words a sweep moves: one half, and the next sweep the other."""
    return (mix(places.astype(_U) ^ _U((sweep // 2 + 1) << 40)) >> _U(63)) == sweep % 2


def _range_words(by_code: np.ndarray) -> int:
    return max(RANGE_WORDS, -(-(len(by_code) - 2) // MOST_RANGES))


def _contexts(by_code: np.ndarray, n_classes: int, sweep: int | None):
    """For every block the classes around each word that moves, and for every task its transitions between classes."""
    wide, per = n_classes + 2, _range_words(by_code) * 2 * (n_classes + 2)
    kind = np.uint32 if len(by_code) * 2 * wide < 1 << 32 else _U

    def run(batches):
        sums = np.zeros(wide * wide, np.int64)
        names, kinds = [x.split()[0] for x in _CONTEXTS.split(", ")], (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        for batch in batches:
            for row in batch.to_pylist():
                tokens, codes = unpack(row["tokens"]), unpack(row["codes"])
                train = np.repeat(~np.array(row["held_out"], bool), row["n_tokens"])
                own = by_code[codes].astype(np.int64)[tokens]
                before = np.concatenate([[wide - 1], own[:-1]])
                sums += np.bincount((before * wide + own)[train], minlength=wide * wide)
                if sweep is None:
                    continue
                mobile = (codes > 1) & _moving(codes - 2, sweep)
                some = np.flatnonzero(train & mobile[tokens])
                if not len(some):
                    continue
                word = (codes - 2)[tokens[some]] * 2 * wide
                around, counts = np.unique(np.concatenate([word + own[some + 1], word + wide + before[some]]).astype(kind), return_counts=True)
                around = around.astype(np.int64)
                r = around // per
                first = np.flatnonzero(np.diff(r, prepend=-1))
                bounds = list(zip(first, np.append(first[1:], len(r))))
                values = r[first], [row["block"]] * len(first), [pack(np.diff(around[lo:hi], prepend=0)) for lo, hi in bounds], [pack(counts[lo:hi]) for lo, hi in bounds], [None] * len(first)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(values, kinds)], names=names)
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((-1, 0, None, None, sums.tolist()), kinds)], names=names)

    return run


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Codes of some rows in order, with sums of their counts."""
    codes = np.concatenate([np.cumsum(unpack(x.as_py())) for x in table.column("codes")])
    return summed(codes, np.concatenate([unpack(x.as_py()) for x in table.column("counts")]))[:2]


def _add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    codes, counts = _added(table)
    columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([pack(np.diff(codes, prepend=0))], pa.binary()), pa.array([pack(counts)], pa.binary())]
    return pa.table(columns, names=["r", "block", "codes", "counts"])


def _moved(by_code: np.ndarray, moves: np.ndarray, n_classes: int, sweep: int):
    """The classes of a range's words after a sweep."""
    wide, per = n_classes + 2, _range_words(by_code)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        codes, counts = _added(table)
        r = key[0].as_py()
        lo = r * per
        classes = by_code[2 + lo : 2 + lo + per].astype(np.int64)
        around = np.zeros((len(classes), 2, wide), np.int64)
        around.reshape(-1)[codes - lo * 2 * wide] = counts
        words = np.flatnonzero(_moving(np.arange(lo, lo + len(classes)), sweep))
        for w in np.array_split(words, len(words) // 128 + 1):
            after, before = around[w, 0].astype(np.float64), around[w, 1].astype(np.float64)
            classes[w] = best_classes(after, before, before.sum(axis=1), classes[w], moves, n_classes)
        return pa.table([pa.array([r], pa.int32()), pa.array([classes.astype(np.uint8).tobytes()], pa.binary())], names=["r", "classes"])

    return run


def _transitions(parts: DataFrame, wide: int) -> np.ndarray:
    told = parts.where("r = -1").select(F.posexplode("moves")).groupBy("pos").agg(F.sum("col").alias("n")).collect()  # one row a pair of classes
    out = np.zeros(wide * wide, np.int64)
    for row in told:
        out[row["pos"]] = row["n"]
    return out.reshape(wide, wide)


def _sweep(blocks: DataFrame, n_blocks: int, model: Model, sweep: int) -> Model:
    """One half of the frequent words in the classes they fit best."""
    n_classes, per = model.n_classes, _range_words(model.by_code)
    parts = materialize(map_batches(blocks.select("block", "held_out", "n_tokens", "tokens", "codes"), _contexts(model.by_code, n_classes, sweep), _CONTEXTS), "contexts")
    moves = _transitions(parts, n_classes + 2)
    tree, n = parts.where("r >= 0").drop("moves"), n_blocks
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        tree = tree.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(n))).groupBy("r", "block").applyInArrow(_add_up, "r int, block long, codes binary, counts binary")
    by_code = model.by_code.copy()
    moved = tree.groupBy("r").applyInArrow(_moved(model.by_code, moves, n_classes, sweep), "r int, classes binary")
    for row in moved.collect():  # a byte for each frequent word; an iterator would make one part after another
        own = np.frombuffer(row["classes"], np.uint8)
        by_code[2 + row["r"] * per : 2 + row["r"] * per + len(own)] = own
    discard(parts)
    return replace(model, by_code=by_code, moves=moves)


def _score(model: Model):
    """Scores of the texts of blocks."""
    by_code, tokens_, seen, n = model.by_code, model.tokens, model.seen, model.n_classes
    transitions, sizes = model.transitions(), model.sizes()

    def run(batches):
        names, kinds = [x.split()[0] for x in _SCORES.split(", ")], (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        for batch in batches:
            for row in batch.to_pylist():
                total, tokens, length = unpack(row["totals"]), unpack(row["tokens"]), np.array(row["n_tokens"])
                cls = by_code[unpack(row["codes"])].astype(np.int64)
                emission = np.where(cls > n, 0.0, np.log10((total + ADD) / sizes[np.minimum(cls, n)]))
                base, own = np.log10((total + ADD) / (tokens_ + ADD * (seen + 1))), cls[tokens]
                chance = emission[tokens] + transitions[np.concatenate([[n + 1], own[:-1]]), own]
                first = np.cumsum(length) - length
                columns = row["doc_ids"], row["held_out"], length, np.add.reduceat((total > 0)[tokens].astype(np.int64), first), np.add.reduceat(base[tokens], first), np.add.reduceat(chance, first)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _dealt_out(words: DataFrame, classes: int) -> tuple[np.ndarray, int]:
    """First classes by code: frequent words are dealt out by count, of equal ones by key; and how many words occur.

    Ranges are read one at a time, once for how many words have each count and once for the ranks.
    """
    often: dict[int, int] = {}
    seen = total = 0
    for row in words.select("totals", "seen").toLocalIterator():
        counts, times = np.unique(unpack(row["totals"]), return_counts=True)
        seen, total = seen + row["seen"], total + int(times.sum())
        for c, t in zip(counts.tolist(), times.tolist()):
            often[c] = often.get(c, 0) + t
    levels = np.array(sorted(often), np.int64)
    at_level = np.array([often[c] for c in levels.tolist()], np.int64)
    rank = at_level[::-1].cumsum()[::-1] - at_level  # words of greater counts
    by_code = np.empty(total + 2, np.uint8)
    by_code[:2], lo = (classes, classes + 1), 2
    for row in words.select("r", "totals").orderBy("r").toLocalIterator():
        level = np.searchsorted(levels, unpack(row["totals"]))
        order = np.argsort(level, kind="stable")
        held = level[order]
        first = np.searchsorted(held, held)
        by_code[lo + order] = (rank[held] + np.arange(len(held)) - first) % classes
        rank += np.bincount(level, minlength=len(rank))
        lo += len(level)
    return by_code, seen


def fit(docs: DataFrame, id_col: str, text_col: str, classes: int, sweeps: int) -> tuple[Model, DataFrame, DataFrame]:
    """The model of all texts that are not held out, the blocks of all texts with totals and codes of their keys, and the frequent words by range."""
    id_ = F.col(id_col).cast("long")
    base = docs.select(id_.alias("doc_id"), held_out(id_).alias("held_out"), F.col(text_col).alias("text"))
    texts = materialize(map_batches(base, _blocks, _BLOCK), "lm-blocks")
    size = texts.agg(F.count("*").alias("blocks"), F.coalesce(F.sum("n_keys"), F.lit(0)).alias("keys"), F.coalesce(F.sum("n_train"), F.lit(0)).alias("tokens")).first()
    ranges = max(1, -(-size["keys"] // RANGE_KEYS))
    shares = map_batches(texts.select("block", "keys", "counts"), _shares(ranges), "r int, block long, keys binary, counts binary")
    totals = materialize(shares.groupBy("r").applyInArrow(_totals, "block long, r int, totals binary, codes binary, frequent binary, seen long"), "lm-totals")
    words = materialize(totals.where("block is null").select("r", "totals", "frequent", "seen", F.expr("length(frequent) div 8").alias("n")), "lm-words")
    n_words = np.zeros(ranges, np.int64)
    for row in words.select("r", "n").collect():  # a row a range
        n_words[row["r"]] = row["n"]
    told = totals.where("block is not null").select("block", "r", "totals", "codes")
    own = texts.select("block", "doc_ids", "held_out", "n_tokens", "tokens", "keys")
    blocks = materialize(own.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_placed(np.cumsum(n_words) - n_words), _PLACED), "lm-placed")
    discard(texts, totals)
    by_code, seen = _dealt_out(words, classes)
    model = Model(size["tokens"], seen, by_code, np.zeros((classes + 2, classes + 2), np.int64), classes, words)
    for sweep in range(sweeps if len(model.classes) else 0):
        model = _sweep(blocks, size["blocks"], model, sweep)
    parts = materialize(map_batches(blocks.select("block", "held_out", "n_tokens", "tokens", "codes"), _contexts(model.by_code, classes, None), _CONTEXTS), "transitions")
    moves = _transitions(parts, classes + 2)
    discard(parts)
    return replace(model, moves=moves), blocks, words


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, sweeps: int = SWEEPS) -> DataFrame:
    """The log10 probability of every text, learned from the texts that are not held out.

    Words lie between ASCII white space, A-Z is lower-cased; every text ends with one more token. Returns ``doc_id, held_out,
    n_tokens, n_known`` (tokens that training texts have), ``train_tokens``, ``base_score`` (of the words alone, each count with
    0.1 added), ``score`` (of the class model) and ``perplexity`` (per token, by the class model). A null or empty text is its end alone. Every row is
    scored and, if not held out, learned from, repeated rows and rows with a null id too (those are not held out). Without
    training texts all classes and words are alike. Other columns are ignored; an empty table gives no rows.
    """
    model, blocks, _ = fit(docs, id_col, text_col, classes, sweeps)
    found = map_batches(blocks.select("doc_ids", "held_out", "n_tokens", "tokens", "totals", "codes"), _score(model), _SCORES)
    found = found.withColumn("train_tokens", F.lit(model.tokens).cast("long")).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
