"""Text quality by regularised quadratic discriminant analysis.

Every text gives a vector of transformed statistics. Each class has a mean and a
covariance that is shrunk towards the pooled covariance and a multiple of the
identity. A score is the difference of the Gaussian log densities (Mahalanobis distances
through Cholesky factors made once) and log priors, passed through a logistic curve.

Training sums counts, vectors and outer products over all labelled rows on the
executors; the driver gets one sum per class and entry.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.textvec import map_batches, slices, spaced_words
from bibweave.plans.scratch import materialize

FEATURES = (
    "log_words", "mean_word", "spread_word", "distinct", "top_word", "upper", "upper_words", "digit", "wide",
    "stop", "comma", "loud", "mark", "bar", "marked_words", "line", "letterless",
)
#: Weight of the pooled covariance and of the identity in a class covariance; divisor of log density differences.
POOLED, RIDGE, SOFTEN = 0.1, 0.01, 4.0


def _is(chars: str) -> np.ndarray:
    return np.array([chr(i) in chars for i in range(256)])


_UPPER = np.array([65 <= i <= 90 for i in range(256)])
_LETTER = np.array([65 <= i <= 90 or 97 <= i <= 122 or i >= 128 for i in range(256)])
_DIGIT = _is("0123456789")
_KINDS = {"stop": _is("."), "comma": _is(","), "loud": _is("!?"), "mark": _is("#$%&*@^~=+<>\\/_{}[]"), "bar": _is("|")}


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of :data:`FEATURES` for each text of a slice; texts without words get zeros in most."""
    w = spaced_words(data, offsets, lower=False)
    rows = len(offsets) - 1
    n = np.diff(w.bounds).astype(float)
    some = np.maximum(n, 1)
    size = (w.end - w.start).astype(float)

    def per_word(values):
        return np.bincount(w.row, values, rows) / some

    sums: dict[str, np.ndarray] = {}

    def within(table) -> np.ndarray:
        """Bytes of a kind in each word."""
        total = np.concatenate([[0], np.cumsum(table[data])])
        sums["row"] = (total[offsets[1:]] - total[offsets[:-1]]).astype(float)
        return total[w.end] - total[w.start]

    h = w.hashes()
    order = np.lexsort((h, w.row))
    first = np.flatnonzero(np.append(True, (h[order][1:] != h[order][:-1]) | (w.row[order][1:] != w.row[order][:-1]))) if len(h) else np.zeros(0, int)
    often = np.diff(np.append(first, len(h)))
    owner = w.row[order][first]
    top = np.zeros(rows)
    np.maximum.at(top, owner, often)
    mean = per_word(size)
    letters = within(_LETTER)
    n_letters = np.maximum(sums["row"], 1)
    upper = within(_UPPER)
    n_upper = sums["row"]
    marks = within(_KINDS["mark"] | _KINDS["loud"] | _KINDS["bar"])
    digits = within(_DIGIT)
    n_digits = sums["row"]
    within(np.arange(256) >= 128)
    n_wide = sums["row"]

    def share(x):
        return np.log(x + 0.003) - np.log(0.003)

    out = {
        "log_words": np.log1p(n), "mean_word": np.log1p(mean), "spread_word": np.log1p(np.sqrt(np.maximum(per_word(size**2) - mean**2, 0))),
        "distinct": np.bincount(owner, minlength=rows) / some, "top_word": share(top / some), "upper": share(n_upper / n_letters),
        "upper_words": share(per_word((upper == letters) & (letters > 1))), "digit": share(n_digits / n_letters), "wide": share(n_wide / n_letters),
        "marked_words": share(per_word(marks > 0)), "letterless": share(per_word((letters == 0) & (digits == 0))),
    }
    for name, table in _KINDS.items():
        within(table)
        out[name] = share(sums["row"] / some)
    within(_is("\n"))
    out["line"] = share(sums["row"] / some)
    return np.stack([out[name] for name in FEATURES], axis=1)


@dataclass
class Model:
    """Class means, inverse Cholesky factors, half log determinants and log priors of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    half_logs: np.ndarray
    priors: np.ndarray
    soften: float = SOFTEN

    def score(self, x: np.ndarray) -> np.ndarray:
        logs = [
            self.priors[c] - self.half_logs[c] - 0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) for c in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip((logs[0] - logs[1]) / self.soften, -500, 500)))


def fit(sums: dict[int, np.ndarray], pooled: float = POOLED, ridge: float = RIDGE) -> Model:
    """A model of per-class sums ``[count, vector sum, outer product sum]``, flattened.

    Without rows of one class the score is that of the priors: 0.5 for no rows at all.
    """
    d = len(FEATURES)
    empty = np.zeros(1 + d + d * d)
    counts = np.array([sums.get(c, empty)[0] for c in (0, 1)])
    means, covs = [], []
    for c in (0, 1):
        s = sums.get(c, empty)
        n = max(s[0], 1)
        mean = s[1 : 1 + d] / n
        means.append(mean)
        covs.append(s[1 + d :].reshape(d, d) / n - np.outer(mean, mean))
    total = max(counts.sum(), 1)
    both = (counts[0] * covs[0] + counts[1] * covs[1]) / total
    if not counts.all():
        means = [np.zeros(d)] * 2
    factors, logs = [], []
    for c in (0, 1):
        cov = (1 - pooled) * covs[c] + pooled * both if counts.all() else np.zeros((d, d))
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        logs.append(np.log(np.diag(low)).sum())
    return Model(np.array(means), np.array(factors), np.array(logs), np.log((counts + 1) / (total + 2)))


def _features(batches):
    for batch in batches:
        parts = [features(data, offsets) for _, _, data, offsets in slices(batch.column(1))]
        x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
        bounds = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(bounds, pa.array(x.reshape(-1)))], names=["doc_id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


def _sums(batches):
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        for c in (0, 1):
            part = x[y == c]
            total[c] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).reshape(-1)])
    at = np.tile(np.arange(total.shape[1]), 2)
    label = np.repeat([0, 1], total.shape[1])
    yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(at), pa.array(total.reshape(-1))], names=["label", "at", "value"])


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the feature vector ``x`` of every row; null texts are empty texts."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(base, _features, "doc_id long, x array<double>")


def held_out(id_col) -> F.Column:
    """One id in five, by the crc32 of its decimal text."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(vectors: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """A model of all labelled rows that are not held out; labels other than 0 and 1 are ignored."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("long").alias("y")).where(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    rows = map_batches(vectors.join(known, "doc_id").select("x", "y"), _sums, "label long, at long, value double")
    sums: dict[int, np.ndarray] = {}
    for r in rows.groupBy("label", "at").agg(F.sum("value").alias("value")).collect():
        sums.setdefault(r["label"], np.zeros(1 + len(FEATURES) + len(FEATURES) ** 2))[r["at"]] = r["value"]
    return fit(sums)


def _scores(model: Model):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], names=["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: label 1 likelier) of every row of ``docs``.

    The model is trained on the labelled rows that are not held out. Null and empty
    texts are scored by their (empty) statistics, without labelled rows all scores are 0.5. Rows that share an
    id are scored apart and each counts in training; null ids are scored and never trained on. Labels that
    contradict each other count for both classes. Other columns are ignored, an empty table gives no rows.
    """
    vectors = materialize(text_features(docs, id_col, text_col), "features")
    model = train(vectors, labels, label_col)
    return map_batches(vectors, _scores(model), "doc_id long, score double")
