from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bibweave.llm import classlm
from bibweave.llm.blocks import pack, unpack
from bibweave.llm.textvec import spaced_words

SCHEMA = "doc_id long, text string"


def tokens_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def learned(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 != 0


def sentences(seed, n):
    """Texts in which classes of words follow each other in a fixed order."""
    r = random.Random(seed)
    kinds = [[f"{k}{i}é" for i in range(30)] for k in "abc"]
    return [" ".join(kinds[j % 3][min(29, int(r.expovariate(0.2)))] for j in range(r.randrange(1, 40))) for _ in range(n)]


def key_of(word):
    if word is None:
        return int(classlm.END)
    data = np.frombuffer(word.encode(), np.uint8)
    return int(spaced_words(data, np.array([0, len(data)])).hashes()[0])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_scores_match_a_plain_model(spark):
    texts = dict(enumerate(sentences(1, 300) + ["", None, "Once NEVER\tseen\n", "  "]))
    df = spark.createDataFrame(list(texts.items()), SCHEMA).repartition(3)
    model, _, _ = classlm.fit(df, "doc_id", "text", 4, 3)
    got = {r["doc_id"]: r for r in classlm.score_texts(df, classes=4, sweeps=3).collect()}
    train = [tokens_of(t) for i, t in texts.items() if learned(i)]
    count = Counter(w for t in train for w in t)
    total, kinds = sum(count.values()), len(count)
    frequent = dict(zip(model.keys.tolist(), model.classes.tolist()))
    cls = {w: 5 if w is None else frequent.get(key_of(w), 4) for i in texts for w in tokens_of(texts[i])}
    assert {w for w, c in count.items() if c >= 3 and w is not None} == {w for w, k in cls.items() if k < 4}
    size, different, moves = Counter(), Counter(), Counter()
    for t in train:
        for a, b in zip([None, *t], t):
            moves[cls[a], cls[b]] += 1
            size[cls[b]] += 1
    for w in count:
        different[cls[w]] += 1
    different[4] += 1  # a word never seen
    before = Counter()
    for (a, _), n in moves.items():
        before[a] += n

    def chance(a, b):
        share = (size[cls[b]] + 0.1) / (total + 0.1 * 6)
        move = (moves[cls[a], cls[b]] + 10 * share) / (before[cls[a]] + 10)
        return move * (1 if b is None else (count[b] + 0.1) / (size[cls[b]] + 0.1 * different[cls[b]]))

    for i, text in texts.items():
        t, r = tokens_of(text), got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(t), sum(count[w] > 0 for w in t), total, not learned(i))
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in t))
        assert r["score"] == pytest.approx(sum(math.log10(chance(a, b)) for a, b in zip([None, *t], t)))
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / len(t)))


def test_classes_tell_neighbours_apart(spark):
    df = spark.createDataFrame(list(enumerate(sentences(2, 600))), SCHEMA)
    held = {}
    for sweeps in (0, 6):
        model, _, _ = classlm.fit(df, "doc_id", "text", 3, sweeps)
        held[sweeps] = classlm.likelihood(model.moves), classlm.score_texts(df, classes=3, sweeps=sweeps).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[6][0] > held[0][0]
    assert held[6][1][0] > held[0][1][0] and held[6][1][0] > held[6][1][1] + 0.2 * abs(held[6][1][1])
    frequent = dict(zip(model.keys.tolist(), model.classes.tolist()))
    kinds = {k: {frequent[key_of(f"{k}{i}é")] for i in range(8)} for k in "abc"}
    assert all(len(x) == 1 for x in kinds.values()) and len(set.union(*kinds.values())) == 3


def test_exchange_finds_the_best_class():
    r = np.random.default_rng(3)
    words, k = 40, 4
    pairs = r.integers(0, 6, (words, words)) * (r.random((words, words)) < 0.4)
    np.fill_diagonal(pairs, 0)
    cls = r.integers(0, k + 2, words)
    one = np.eye(k + 2, dtype=np.int64)[cls]
    mine = np.flatnonzero(cls < k)
    # each word has as many tokens before as after it, as in texts that begin and end with the end token
    pairs[:, -1] = np.maximum(0, pairs.sum(axis=0) - pairs.sum(axis=1) + pairs[:, -1])
    balanced = [w for w in mine if w != words - 1 and pairs[w].sum() == pairs[:, w].sum()]
    assert len(balanced) > 5
    moves = one.T @ pairs @ one
    best = classlm.best_classes(pairs[balanced] @ one, (one.T @ pairs[:, balanced]).T, pairs[balanced].sum(axis=1), cls[balanced], moves, k)
    for w, found in zip(balanced, best):
        value = []
        for c in range(k):
            other = one.copy()
            other[w] = np.eye(k + 2, dtype=np.int64)[c]
            value.append(classlm.likelihood(other.T @ pairs @ other))
        assert value[found] == pytest.approx(max(value))


def test_counts_are_summed_in_a_tree(spark, monkeypatch):
    texts = sentences(4, 200)
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    want = rows_of(classlm.score_texts(df.coalesce(1), classes=3).drop("perplexity"))
    for name, value in (("FAN_IN", 2), ("RANGE_WORDS", 16), ("RANGE_KEYS", 20)):
        monkeypatch.setattr(classlm, name, value)
    got = rows_of(classlm.score_texts(df.repartition(7), classes=3).drop("perplexity"))
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5:] for x in got], [x[5:] for x in want])


def test_scores_of_odd_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a c"), (None, None), (2, ""), (3, "x" * 300_000 + " y"), (4, "word " * 50_000), (10, "\x00   \U0001f600")]
    df = spark.createDataFrame([(*r, "k", 1.5) for r in rows], "doc_id long, text string, keys string, score double")
    got = rows_of(classlm.score_texts(df).select("doc_id", "n_tokens", "score"))
    assert [(x[0], x[1]) for x in got] == sorted([(i, len(tokens_of(t))) for i, t in rows], key=repr)
    assert all(math.isfinite(x[2]) for x in got)
    assert classlm.score_texts(df.where("false")).collect() == []
    only = df.where("doc_id = 7").unionByName(spark.createDataFrame([(i, "a b") for i in range(2000) if not learned(i)], SCHEMA), allowMissingColumns=True)
    some = classlm.score_texts(only).first()
    assert some["train_tokens"] == 0 and some["n_known"] == 0 and some["base_score"] == pytest.approx(0) and math.isfinite(some["score"])


def test_packed_numbers():
    for x in ([], [0], [1, 2**32 - 1], [2**32, 5, 2**62]):
        assert unpack(pack(np.array(x, np.int64))).tolist() == x
