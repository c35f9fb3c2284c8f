"""Removal of repeated passages by hashed runs of consecutive sentences.

A sentence ends at ``.``, ``!`` or ``?`` before white space, at a line break and, so that text
without punctuation is covered too, after words picked by their hash (1 in 16). From
every sentence the shortest run with at least ``sentences`` sentences and ``words`` words is hashed;
equal passages give equal runs wherever they stand. A stretch of 2 * ``words`` + 2 words that
holds no whole run (long sentences, lists, no punctuation) gives windows of ``words`` words
instead: of every ``SPREAD`` neighbouring ones the one with the smallest hash. Whether it does
is a matter of its own words alone, so of two equal such stretches, at any offset, the same run or
window is hashed. Runs and windows are joined over the whole
corpus; the first place of a run (smallest id, then position) stays and the sentences
of every other place go.

The shuffles carry a hash, an id and a position per sentence, never text. Runs are made once and
written. A run that a third of all texts share is one row per task after partial aggregation; runs with over
1 / ``HOT_SHARE`` of all places are joined by broadcast, so their places stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.rows import BROADCAST_ROWS
from bibweave.llm.textvec import map_batches, mix, slices, spaced_words
from bibweave.llm.textvec import runs as hashed_runs
from bibweave.plans.scratch import discard, materialize

SENTENCES, WORDS, CUT = 3, 24, 15
#: Windows of which one is hashed, in stretches without a run.
SPREAD = 8
#: A run with over 1 / HOT_SHARE of all places is hot, so at most HOT_SHARE of them are.
HOT_SHARE = 1000

_U = np.uint64
_STOP = np.array([chr(i) in ".!?" for i in range(256)])
_CLOSE = np.array([chr(i) in "\"')]}" for i in range(256)])


def sentence_runs(data: np.ndarray, offsets: np.ndarray, sentences: int = SENTENCES, words: int = WORDS) -> tuple[np.ndarray, ...]:
    """(row, first word, words, hash) of every run and window of a slice; words count from 0 in their row."""
    w = spaced_words(data, offsets)
    n = len(w.start)
    if not n:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),)
    h = w.hashes()
    last = w.data[w.end - 1]
    before = w.data[np.maximum(w.end - 2, w.start)]
    breaks = np.concatenate([[0], np.cumsum(w.data == 10)])
    gap = np.append(w.start[1:], len(data))
    ends = _STOP[last] | (_CLOSE[last] & _STOP[before]) | (breaks[gap] > breaks[w.end]) | ((h & _U(CUT)) == 0)
    ends |= np.append(w.row[1:] != w.row[:-1], True)
    to = np.flatnonzero(ends) + 1
    start = np.concatenate([[0], to[:-1]])
    at = np.arange(n) - np.repeat(start, to - start)
    with np.errstate(over="ignore"):
        unit = mix(np.add.reduceat(mix(h + at.astype(_U) * _U(0x9E3779B97F4A7C15)), start) + (to - start).astype(_U))
    i = np.arange(len(to))
    j = np.maximum(i + sentences - 1, np.searchsorted(to, start + words))
    i = i[j < len(to)]
    j = j[j < len(to)]
    same = w.row[start[i]] == w.row[start[j]]
    i, j = i[same], j[same]
    out = (j - i + 1).astype(_U)
    live = np.arange(len(i))
    k = 0
    while len(live):
        out[live] = mix(out[live] ^ unit[i[live] + k])
        k += 1
        live = live[i[live] + k <= j[live]]
    first, size = start[i], to[j] - start[i]
    alone = _windows(h, w.row, first, to[j], words)
    if len(alone):
        first = np.concatenate([first, alone])
        size = np.concatenate([size, np.full(len(alone), words)])
        out = np.concatenate([out, hashed_runs(h, words)[alone]])
    row = w.row[first]
    return row, first - w.bounds[row], size, out


def _windows(h: np.ndarray, row: np.ndarray, first: np.ndarray, end: np.ndarray, words: int) -> np.ndarray:
    """First words of the windows that are hashed where stretches hold no run; ``first, end``: the runs in order."""
    span = 2 * words + 2
    spread = min(SPREAD, span - words + 1)
    at = np.arange(len(h) - span + 1)
    if not len(at):
        return at
    # a run counts if the words before it and after it are in the stretch too, since they can tell where it begins and ends
    ends = np.append(end, len(h) + span)[np.searchsorted(first, at + 1)]
    bare = (row[at] == row[at + span - 1]) & (ends >= at + span)
    total = np.concatenate([[0], np.cumsum(bare)])
    # groups of windows that lie within such a stretch
    q = np.arange(len(h) - words - spread + 2)
    low = np.maximum(q - (span - words - spread + 1), 0)
    q = q[total[np.minimum(q + 1, len(at))] > total[np.minimum(low, len(at))]]
    if not len(q):
        return q
    groups = np.lib.stride_tricks.sliding_window_view(hashed_runs(h, words), spread)
    return np.unique(q + groups[q].argmin(axis=1))


def _runs(sentences: int, words: int):
    def run(batches):
        for batch in batches:
            ids, versions = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for lo, _, data, offsets in slices(batch.column(1)):
                row, first, size, h = sentence_runs(data, offsets, sentences, words)
                cols = [h.view(np.int64), ids[lo + row], versions[lo + row], first.astype(np.int32), size.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "doc_id", "version", "first", "size"])

    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = SENTENCES, words: int = WORDS, hot_share: int = HOT_SHARE) -> DataFrame:
    """Maximal stretches of words covered by non-first places of repeated runs.

    Returns ``doc_id, version`` (a hash of the text, for rows that share an id), ``first_doc_id`` (the
    text that keeps the stretch's first run), ``first_word`` (from 0) and ``n_words``. Repeats within a text count too. Null and short
    texts have no runs. Rows with a null id take no part. Of rows that share an
    id and hold the same text, none is marked against the other. Other columns are ignored, an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.hash(F.col(text_col)).alias("version")).where("doc_id is not null")
    runs = materialize(map_batches(base, _runs(sentences, words), "h long, doc_id long, version int, first int, size int"), "runs", compression="zstd")
    places = runs.groupBy("h").agg(F.min(F.struct("doc_id", "first", "version")).alias("kept"), F.count("*").alias("n")).where("n > 1")
    places = materialize(places.select("h", "n", "kept"), "places", compression="zstd")
    limit = runs.count() // hot_share
    hot = F.broadcast(places.where(F.col("n") > limit))
    near = runs.join(hot, "h")
    far = runs.join(hot.select("h"), "h", "left_anti").join(places.where(F.col("n") <= limit), "h")
    others = near.unionByName(far).where(F.struct("doc_id", "first", "version") != F.col("kept"))
    # a text has at most one entry per word, so its list is bounded by its length
    spans = others.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set(F.struct("first", "size", F.col("kept.doc_id").alias("other")))).alias("spans"))
    out = map_batches(spans, _merge, "doc_id long, version int, first_doc_id long, first_word long, n_words long")
    out._bibweave_parts = (runs, places)
    return out


def _merge(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list[int]] = [[], [], [], [], []]
        for doc, version, spans in zip(*(batch.column(k).to_pylist() for k in range(3))):
            lo = hi = other = None
            for s in [*spans, None]:
                if s is None or hi is None or s["first"] > hi:
                    if hi is not None:
                        for col, x in zip(out, (doc, version, other, lo, hi - lo)):
                            col.append(x)
                    if s is None:
                        break
                    lo, hi, other = s["first"], s["first"] + s["size"], s["other"]
                hi = max(hi, s["first"] + s["size"])
        kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "version", "first_doc_id", "first_word", "n_words"])


def _cut(batches):
    for batch in batches:
        texts = []
        for lo, hi, data, offsets in slices(batch.column("text")):
            w = spaced_words(data, offsets, lower=False)
            raw = data.tobytes()
            for row in range(hi - lo):
                if not batch.column("text")[lo + row].is_valid:
                    texts.append(None)
                    continue
                at, parts, base, stop = int(offsets[row]), [], w.bounds[row], w.bounds[row + 1]
                for s in batch.column("spans")[lo + row].as_py() or []:
                    first, end = base + s["first_word"], base + s["first_word"] + s["n_words"]
                    parts.append(raw[at : w.start[first]])
                    at = int(w.start[end]) if end < stop else int(offsets[row + 1])
                texts.append(b"".join([*parts, raw[at : offsets[row + 1]]]).decode())
        keep = [n for n in batch.schema.names if n not in ("text", "spans")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(texts, pa.string())], names=[*keep, "text"])


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", only_changed: bool = False, **params) -> DataFrame:
    """``docs`` with repeated passages cut from their texts, one row per row (or per changed row).

    Returns ``doc_id, first_doc_id`` (the text that keeps the first cut passage), ``n_passages`` and ``n_words`` (cut;
    0 and null for unchanged rows) and ``text`` (what is left). The white space after a cut passage goes with it. Null
    texts stay null, rows with a null id stay as they are, rows that share an id are told apart by their texts.
    """
    found = repeated_passages(docs, id_col, text_col, **params)
    place = F.struct("first_word", "n_words", "first_doc_id")
    cuts = found.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(place)).alias("spans"))
    cuts = materialize(cuts.select(F.col("doc_id").alias("of"), "version", "spans"), "cuts")
    discard(found)
    # the lists are of any length, so their entries are counted and not their rows
    if (cuts.agg(F.sum(F.size("spans"))).first()[0] or 0) <= BROADCAST_ROWS:
        cuts = F.broadcast(cuts)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    both = base.join(cuts, (F.col("doc_id") == F.col("of")) & (F.hash("text") == F.col("version")), "inner" if only_changed else "left")
    counted = both.select(
        "doc_id", F.get("spans", F.lit(0))["first_doc_id"].alias("first_doc_id"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_passages"),
        F.aggregate(F.coalesce("spans.n_words", F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, x: a + x).alias("n_words"), "text", "spans",
    )
    return map_batches(counted, _cut, "doc_id long, first_doc_id long, n_passages long, n_words long, text string")
