from __future__ import annotations

from collections import Counter

from bibweave.llm import classlm
from tests.llm.test_classlm import SCHEMA, key_of, learned, rows_of, sentences, tokens_of


def test_all_words_of_the_least_count_take_part_however_many_tokens_there_are(spark, monkeypatch):
    texts = dict(enumerate(sentences(5, 200)))
    df = spark.createDataFrame(list(texts.items()), SCHEMA).repartition(3)
    want = rows_of(classlm.score_texts(df, classes=3))
    monkeypatch.setattr(classlm, "MOST_WORDS", 8, raising=False)
    monkeypatch.setattr(classlm, "RANGE_KEYS", 20)
    monkeypatch.setattr(classlm, "RANGE_WORDS", 2)
    model, _, _ = classlm.fit(df, "doc_id", "text", 3, 4)
    count = Counter(w for i, t in texts.items() if learned(i) for w in tokens_of(t))
    frequent = sorted(key_of(w) for w, c in count.items() if c >= 3 and w is not None)
    assert model.keys.tolist() == frequent and len(model.classes) == len(frequent) > 8
    assert rows_of(classlm.score_texts(df, classes=3)) == want


def test_first_classes_go_by_count_and_key_over_all_ranges(spark, monkeypatch):
    texts = dict(enumerate(sentences(6, 150)))
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    monkeypatch.setattr(classlm, "RANGE_KEYS", 20)
    model, _, _ = classlm.fit(df, "doc_id", "text", 5, 0)
    count = Counter(w for i, t in texts.items() if learned(i) for w in tokens_of(t))
    order = sorted((-c, key_of(w)) for w, c in count.items() if c >= 3 and w is not None)
    assert dict(zip(model.keys.tolist(), model.classes.tolist())) == {k: n % 5 for n, (_, k) in enumerate(order)}
