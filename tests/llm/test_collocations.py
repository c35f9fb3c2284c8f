from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from bibweave.llm import collocations
from bibweave.llm.collocations import from_trie, phrases, to_trie

SCHEMA = "lang string, text string"


def plain(rows, least=30, covered=80, top=2000):
    total, count = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in (1, 2, 3, 4):
                count[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        hidden = {p[i : i + s] for p, a in found.items() for s in range(2, len(p)) for i in range(len(p) - s + 1) if 100 * a >= covered * f[p[i : i + s]]}
        best = []
        for p, a in found.items():
            if p not in hidden:
                score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    stock = [f"{a}{b}" for a in "abcé" for b in "xyzŒ"]
    idioms = [" ".join(r.choice(stock) for _ in range(r.randrange(2, 7))) for _ in range(12)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(r.randrange(0, 30)):
            parts.append(r.choice(idioms) if r.random() < 0.4 else f"w{r.randrange(400)}" if r.random() < 0.2 else r.choice(stock).upper())
            parts.append(r.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "   ", "?!"]))
        rows.append((r.choice(["en", "en", "en", "fr", None]), "".join(parts)))
    return rows


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_phrases_match_brute_force(spark):
    rows = corpus(1, 500) + [("en", "Same words again and again. ")] * 60
    want = plain(rows)
    assert len(want) > 60 and {len(x[2].split(" ")) for x in want} == {2, 3, 4}
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(phrases(df.repartition(6))) == want
    assert rows_of(phrases(df.coalesce(1), least=12, covered=60, top=25)) == plain(rows, 12, 60, 25)


def test_phrases_over_many_ranges(spark, monkeypatch):
    rows = corpus(2, 300) + [("fr", "hot pair " + w) for w in ("one", "two", "three") for _ in range(150)]
    monkeypatch.setattr(collocations, "RANGE_KEYS", 40)
    assert rows_of(phrases(spark.createDataFrame(rows, SCHEMA).repartition(5))) == plain(rows)


def test_phrases_of_odd_rows(spark):
    rows = [("en", None), ("en", ""), (None, "a b" + " a b" * 200_000), ("und", "a b c;"), ("", "x\x00y z. " * 40), ("de fr", "..\n,, "), ("en", "y" * 100_000 + " z")] + [("en", "p q r s t")] * 31
    df = spark.createDataFrame([(*x, "k", 3, [1]) for x in rows], SCHEMA + ", key string, n int, p array<int>")
    assert rows_of(phrases(df)) == plain(rows)
    assert phrases(df.where("false")).collect() == [] and phrases(df.where("lang = 'de fr'")).collect() == []


def test_trie_round_trip():
    r = np.random.default_rng(5)
    paths = np.unique(r.integers(0, 4, (200, 4)).astype(np.uint64), axis=0)
    f2 = (paths[:, 0] * 10 + paths[:, 1]).astype(np.int64)
    n = r.integers(0, 9, len(paths))
    names = [x.split()[0] for x in collocations._TRIE.split(", ")[1:]]
    for got, want in zip(from_trie(dict(zip(names, to_trie(paths, f2, n)))), (paths, f2, n)):
        assert np.array_equal(got, want)
