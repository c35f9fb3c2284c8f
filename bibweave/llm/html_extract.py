"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Every block has features of its ancestors' tags and attributes and of its text. The field
has a weight for each feature and label and one for each pair of neighbouring labels; it is
trained on labelled pages by gradient steps on the regularised log likelihood and
decoded by Viterbi. Training takes a bounded number of pages (``PAGES``) on the driver;
its weights, a few hundred numbers, go to the executors with the function.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.html_blocks import NAMES, Block, blocks, features
from bibweave.llm.html_pages import labelled_pages
from bibweave.llm.textvec import map_batches

#: Labelled pages used for training, gradient steps, their size and the weight of the penalty.
PAGES, STEPS, RATE, PENALTY = 500, 90, 0.2, 0.002


@dataclass
class Field:
    """Weights: ``unary[feature, label]`` and ``pair[label, next label]``."""

    unary: np.ndarray
    pair: np.ndarray

    def decode(self, lines: list[list[int]]) -> list[int]:
        """The likeliest labels of a page's blocks."""
        if not lines:
            return []
        unary = self._unary
        (aa, ab), (ba, bb) = self._pair
        back = []
        s0 = s1 = 0.0
        for k, f in enumerate(lines):
            u0 = u1 = 0.0
            for i in f:
                x = unary[i]
                u0 += x[0]
                u1 += x[1]
            if k:
                p0, p1 = s0 + aa, s1 + ba
                q0, q1 = s0 + ab, s1 + bb
                back.append((p1 > p0, q1 > q0))
                s0, s1 = max(p0, p1) + u0, max(q0, q1) + u1
            else:
                s0, s1 = u0, u1
        y = int(s1 > s0)
        out = [y]
        for b in reversed(back):
            y = int(b[y])
            out.append(y)
        return out[::-1]

    def __post_init__(self):
        self._unary = self.unary.tolist()
        self._pair = self.pair.tolist()


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[list[list[int]], list[int]]], steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Field:
    """Fit a field to pages of (features, labels) by Adam steps on the mean log likelihood."""
    pages = [p for p in pages if p[0]]
    n, t = len(pages), max(len(f) for f, _ in pages)
    flat = np.zeros((sum(len(f) for f, _ in pages), len(NAMES)))
    y = np.zeros((n, t), dtype=np.int64)
    on = np.zeros((n, t))
    for k, (lines, labels) in enumerate(pages):
        for j, f in enumerate(lines, int(on.sum())):
            flat[j, f] = 1
        y[k, : len(labels)] = labels
        on[k, : len(labels)] = 1
    both = on[:, 1:] * on[:, :-1]
    there = on > 0
    truth = np.eye(2)[y] * on[..., None]
    seen_u = flat.T @ truth[there]
    seen_p = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
    w = [np.zeros((len(NAMES), 2)), np.zeros((2, 2))]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for step in range(1, steps + 1):
        u = np.zeros((n, t, 2))
        u[there] = flat @ w[0]
        ahead, behind = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        ahead[:, 0] = u[:, 0]
        for j in range(1, t):
            ahead[:, j] = np.where(on[:, j, None] > 0, _lse(ahead[:, j - 1, :, None] + w[1], 1) + u[:, j], ahead[:, j - 1])
        for j in range(t - 2, -1, -1):
            behind[:, j] = np.where(on[:, j + 1, None] > 0, _lse(w[1] + (u[:, j + 1] + behind[:, j + 1])[:, None, :], 2), 0)
        z = _lse(ahead[:, -1], 1)[:, None, None]
        one = np.exp(ahead + behind - z) * on[..., None]
        two = np.exp(ahead[:, :-1, :, None] + w[1] + (u[:, 1:] + behind[:, 1:])[:, :, None, :] - z[..., None]) * both[..., None, None]
        grads = [(seen_u - flat.T @ one[there]) / n - penalty * w[0], (seen_p - two.sum(axis=(0, 1))) / n - penalty * w[1]]
        for a, g, mm, vv in zip(w, grads, m, v):
            mm += 0.1 * (g - mm)
            vv += 0.001 * (g * g - vv)
            a += rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    return Field(*w)


def label_blocks(found: list[Block], truth: list[tuple[str, int]]) -> list[int]:
    """Labels of parsed blocks from the texts of a labelled page, matched in page order."""
    labels, at = [], 0
    for b in found:
        hit = next((k for k in range(at, len(truth)) if " ".join(truth[k][0].split()) == b.text), None)
        labels.append(truth[hit][1] if hit is not None else 0)
        at = at if hit is None else hit + 1
    return labels


@cache
def default_field(count: int = PAGES) -> Field:
    """The field trained on ``count`` labelled pages."""
    pages = []
    for page, truth in labelled_pages(count):
        found = blocks(page)
        pages.append((features(found), label_blocks(found, truth)))
    return train(pages)


def main_text(page: str, field: Field) -> str:
    found = blocks(page)
    return " ".join(b.text for b, y in zip(found, field.decode(features(found))) if y)


def extract_text(pages: DataFrame, html_col: str = "html", field: Field | None = None) -> DataFrame:
    """``pages`` with ``text`` in place of the HTML: the article's blocks in page order, joined by a space.

    Null and empty pages, and pages without an article, give an empty text. All other columns
    stay (one of the name ``text`` is replaced). Repeated rows are extracted alike.
    """
    field = field or default_field()
    rest = [c for c in pages.columns if c not in (html_col, "text")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*rest).schema)

    def run(batches):
        for batch in batches:
            texts = [main_text(s.as_py() or "", field) for s in batch.column(len(rest))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest))), pa.array(texts, pa.string())], names=[*rest, "text"])

    return map_batches(pages.select(*rest, F.col(html_col)), run, (schema + ", " if schema else "") + "text string")
