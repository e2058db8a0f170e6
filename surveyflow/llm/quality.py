"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins, and the model is one lookup table per feature and per chosen pair of
features. Tables grow by boosting in turn: every round visits all features and adds a small step of a
shallow tree over the feature's bins; then the pairs that explain most of what is left get tables of
their own in the same way. A score is the logistic function of a sum of table entries.

Edge cases: a null text is scored like an empty one; features of texts without words are zero; with
no learning rows all scores are 1/2, with one class only the share seen, smoothed; repeated rows are
scored each; an empty table gives an empty result. Only the named columns are read, so further
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from surveyflow.llm.common import held, in_batches, learning_rows, slices, texts

#: Bound of the learning rows.
MOST_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
#: Cuts of a tree over one feature, rows a leaf needs, and the ridge on leaf values.
CUTS, LEAF, RIDGE = 2, 10, 1.0
THRESHOLD = 0.3

NAMES = (
    "words", "word_bytes", "distinct", "repeated", "lines", "line_words", "repeated_lines",
    "upper", "digits", "symbols", "bangs", "stops", "other_marks", "beyond_ascii", "controls",
)
#: Class of every byte: 1 upper case, 2 digit, 3 symbol, 4 ! or ?, 5 . or , 6 other marks, 7 beyond ASCII, 8 controls.
CLASS = np.zeros(256, "u1")
CLASS[:32], CLASS[127] = 8, 8
CLASS[[9, 10, 11, 12, 13]] = 0
for marks, number in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b"#*$%&|<>", 3), (b"!?", 4), (b".,", 5), (b"\"'()-/:;=@[\\]^_`{}~+", 6)):
    CLASS[list(marks)] = number
CLASS[128:] = 7


def describe(text: str | None) -> list[float]:
    """The features of a text, in the order of NAMES: sizes as logarithms, the rest as shares."""
    raw = (text or "").encode("utf-8", "replace")
    words, lines = raw.split(), [line for line in raw.split(b"\n") if line.strip()]
    n, size = max(1, len(words)), max(1, len(raw))
    marks = np.bincount(CLASS[np.frombuffer(raw, "u1")], minlength=9) / size
    again = sum(map(eq, words, words[1:]))
    return [
        np.log1p(len(words)), np.log1p(size / n), len(set(words)) / n, again / n,
        np.log1p(len(lines)), np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
        *marks[1:],
    ]


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of up to ``bins`` bins of about equal numbers."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="lower")) if len(x) else np.empty(0)


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, cuts: int = CUTS) -> np.ndarray:
    """Leaf value per bin of the tree with the best ``cuts`` successive cuts of ordered bins."""
    edges = [0, len(g)]
    sums = [np.r_[0, np.cumsum(v)] for v in (g, h, n)]
    for _ in range(cuts):
        best = (1e-9, None)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            at = np.arange(a + 1, b)
            left, right = ([s[at] - s[a] for s in sums], [s[b] - s[at] for s in sums])
            gain = _gain(*left[:2]) + _gain(*right[:2]) - _gain(sums[0][b] - sums[0][a], sums[1][b] - sums[1][a])
            gain = np.where((left[2] >= LEAF) & (right[2] >= LEAF), gain, -np.inf)
            if len(at) and gain.max() > best[0]:
                best = (float(gain.max()), int(at[gain.argmax()]))
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[a:b] = -(sums[0][b] - sums[0][a]) / (sums[1][b] - sums[1][a] + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values of the best tree that cuts both features of a pair once, and its gain."""
    sums = [np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h)]
    inner = [s[1:-1, 1:-1] for s in sums]
    if not inner[0].size:
        return np.zeros_like(g), 0.0
    total = [s[-1, -1] for s in sums]
    top = [s[1:-1, -1:] for s in sums]
    side = [s[-1:, 1:-1] for s in sums]
    leaves = [[i, t - i, s - i, a - t - s + i] for i, t, s, a in zip(inner, top, side, total, strict=True)]
    gain = sum(_gain(a, b) for a, b in zip(*leaves, strict=True))
    r, c = np.unravel_index(gain.argmax(), gain.shape)
    values = [-a[r, c] / (b[r, c] + RIDGE) for a, b in zip(*leaves, strict=True)]
    out = np.empty_like(g)
    out[: r + 1, : c + 1], out[: r + 1, c + 1 :], out[r + 1 :, : c + 1], out[r + 1 :, c + 1 :] = values
    return out, float(gain[r, c] - _gain(*total))


@dataclass
class Additive:
    """Cuts and tables of features and pairs, and the intercept."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.tables and len(x):
            fine, rough = _bins(x, self.cuts), _bins(x, self.coarse)
            for j, values in enumerate(self.tables):
                total += values[fine[:, j]]
            for (j, k), values in self.pairs.items():
                total += values[rough[:, j], rough[:, k]]
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Boosts tables for labels ``y`` (0 or 1)."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Additive(float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return model
    d = x.shape[1]
    model.cuts = [_cuts(x[:, j], BINS) for j in range(d)]
    model.coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(d)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    fine, rough = _bins(x, model.cuts), _bins(x, model.coarse)
    total = np.full(len(y), model.base)
    counts = [np.bincount(fine[:, j], minlength=len(t)) for j, t in enumerate(model.tables)]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -60, 60)))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for j, values in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(*(np.bincount(fine[:, j], w, minlength=len(values)) for w in (g, h)), counts[j])
            values += step
            total += step[fine[:, j]]

    def grid(j: int, k: int, w: np.ndarray) -> np.ndarray:
        shape = (len(model.coarse[j]) + 1, len(model.coarse[k]) + 1)
        return np.bincount(rough[:, j] * shape[1] + rough[:, k], w, minlength=shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = {(j, k): _pair_tree(grid(j, k, g), grid(j, k, h))[1] for j, k in combinations(range(d), 2)}
    chosen = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    model.pairs = {(j, k): np.zeros((len(model.coarse[j]) + 1, len(model.coarse[k]) + 1)) for j, k in chosen}
    for _ in range(PAIR_ROUNDS):
        for (j, k), values in model.pairs.items():
            g, h = slopes()
            step = RATE * _pair_tree(grid(j, k, g), grid(j, k, h))[0]
            values += step
            total += step[rough[:, j], rough[:, k]]
    return model


def _described(rows: DataFrame, extra: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("quality", dict)
        for batch in slices(batches):
            found = [describe(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in extra), pa.array(found, pa.list_(pa.float64()))], [*extra, "x"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in extra)
    return in_batches(rows.select(*extra, "text")).mapInArrow(run, f"{kinds}, x array<double>")


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = MOST_ROWS) -> Additive:
    """Fits on the features of a bounded number of labelled rows; label 1 is good, others are not."""
    sample = sorted(_described(learning_rows(docs, labels, label, most, key, text), ["doc_id", "label"]).collect())
    if not sample:
        return Additive(0.0)
    return fit(np.array([r.x for r in sample]), np.array([float(r.label == 1) for r in sample]))


def score(docs: DataFrame, model: Additive, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (chance of label 1) and predicted (1 from ``threshold``) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("quality", dict)
        for batch in slices(batches, 1024):
            x = np.array([describe(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(NAMES))
            chance = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance), pa.array((chance >= threshold).astype("i4"))], ["doc_id", "score", "predicted"])

    rows = texts(docs, key, text)
    return in_batches(rows).mapInArrow(run, StructType([rows.schema["doc_id"], StructField("score", DoubleType()), StructField("predicted", IntegerType())]))
