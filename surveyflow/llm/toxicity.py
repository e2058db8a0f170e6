"""Toxicity as ordered severity grades: cumulative-link regression on sparse text features.

Features are a document's lower-cased words and the first letters of longer ones, hashed; a feature's
value is log(1 + occurrences). The most telling features of the learning rows are kept. One weight
vector serves all thresholds: P(grade <= k) = logistic(threshold_k - x . w), thresholds in order.

Labels say toxic or not. Toxic learning rows are graded by how much of the text is telling: those
whose share of toxic-only features per word is at or above the median are severe (2), others mild (1).

Edge cases: a null text or one without words has the grade of an empty one; with no learning rows,
or one class only, all documents get the class that was seen (0 if none); repeated rows are scored
each; an empty table gives an empty result. Only the named columns are read, so further columns
cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from surveyflow.llm.bpe import Memo
from surveyflow.llm.common import held, in_batches, learning_rows, texts

#: Bound of the learning rows, and of the features of the model.
MOST_ROWS, MOST_FEATURES = 20_000, 4096
BUCKETS = 1 << 20
#: First letters that are features of longer words, and toxic documents a feature must occur in.
PREFIXES, SUPPORT = (4, 5), 4
PENALTY, ROUNDS = 1e-4, 400
WORD = re.compile(r"\w+")
MOST_WORDS, LONGEST_WORD = 300_000, 40


def _hashed(word: str) -> tuple[int, ...]:
    parts = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    return tuple(zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts)


def features(text: str | None, memo) -> tuple[Counter, int]:
    """Occurrences of every feature that ``memo`` gives for the words, and the number of words."""
    words = WORD.findall((text or "").lower())
    found: Counter = Counter()
    for part in filter(None, map(memo.__getitem__, words)):
        found.update(part)
    return found, len(words)


@dataclass
class Severity:
    """Weights of the kept features and ordered thresholds between grades 0, 1, ..."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def chances(self, x: np.ndarray) -> np.ndarray:
        """P(grade = k), a column each, for scores x . w."""
        below = 1 / (1 + np.exp(np.clip(x[:, None] - self.thresholds[None, :], -60, 60)))
        return np.diff(np.c_[np.zeros(len(x)), below, np.ones(len(x))], axis=1)


def fit(rows: list[dict[int, float]], grades: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> Severity:
    """Maximum likelihood with an L2 penalty, by accelerated gradient steps. Grades: 0 to the highest seen."""
    names = sorted({f for row in rows for f in row})
    at = {f: i for i, f in enumerate(names)}
    row_of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([at[f] for r in rows for f in r], "i8")
    value = np.array([v for r in rows for v in r.values()], "f8")
    levels = int(grades.max()) + 1
    share = np.array([(grades <= k).mean() for k in range(levels - 1)])
    theta = np.log(np.clip(share, 1e-4, 1 - 1e-4)) - np.log1p(-np.clip(share, 1e-4, 1 - 1e-4))
    raw = np.r_[theta[0], np.log(np.maximum(np.diff(theta), 1e-3))]
    params = np.r_[raw, np.zeros(len(names))]
    first, second = np.zeros_like(params), np.zeros_like(params)
    n = len(rows)
    for step in range(1, rounds + 1):
        gaps = np.exp(params[1 : levels - 1])
        theta = params[0] + np.r_[0, np.cumsum(gaps)]
        w = params[levels - 1 :]
        x = np.bincount(row_of, value * w[column], minlength=n)
        s = 1 / (1 + np.exp(np.clip(x[:, None] - theta[None, :], -60, 60)))
        s = np.c_[np.zeros(n), s, np.ones(n)]
        slope = s * (1 - s)
        rows_ = np.arange(n)
        high, low = s[rows_, grades + 1], s[rows_, grades]
        p = np.maximum(high - low, 1e-12)
        up, down = slope[rows_, grades + 1] / p, slope[rows_, grades] / p
        to_x = (up - down) / n
        to_theta = np.array([-(up[grades == k].sum() - down[grades == k + 1].sum()) / n for k in range(levels - 1)])
        back = to_theta[::-1].cumsum()[::-1]
        gradient = np.r_[back[0], back[1:] * gaps, np.bincount(column, to_x[row_of] * value, minlength=len(names)) + penalty * w]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    theta = params[0] + np.r_[0, np.cumsum(np.exp(params[1 : levels - 1]))]
    return Severity({f: float(params[levels - 1 + i]) for f, i in at.items()}, theta)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MOST_ROWS) -> Severity:
    """Grades and fits a bounded number of learning rows; only sparse rows of kept features are collected."""
    rows = learning_rows(docs, labels, label, most, key, text)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity", dict)
        memo = Memo(_hashed, MOST_WORDS, LONGEST_WORD)
        for batch in batches:
            found = [list(features(t, memo)[0]) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["label", "found"])

    seen = in_batches(rows.select("doc_id", "text", "label")).mapInArrow(counted, "label int, found array<int>")
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = sum(n for k, n in sizes.items() if k > 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Severity({}, np.array([-60.0] if toxic else [60.0]))
    odds = seen.select((F.col("label") > 0).alias("toxic"), F.explode("found").alias("feature")).groupBy("feature")
    odds = odds.agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b")).filter(F.col("a") >= SUPPORT)
    lift = F.log(((F.col("a") + 0.5) / toxic) / ((F.col("b") + 0.5) / clean))
    gain = F.col("a") * lift
    best = odds.filter(lift > 0.5).orderBy(F.desc(gain), "feature").limit(MOST_FEATURES).collect()
    kept = {r.feature for r in best}
    telling = {r.feature for r in best if (r.a / toxic) > 20 * ((r.b + 0.5) / clean)}

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity", dict)
        memo = Memo(lambda word: tuple(f for f in _hashed(word) if f in kept), MOST_WORDS, LONGEST_WORD)
        for batch in batches:
            ids, names, values, words = batch.column(0), [], [], []
            for t in batch.column(1).to_pylist():
                found, n = features(t, memo)
                names.append(sorted(found))
                values.append([found[f] for f in names[-1]])
                words.append(n)
            columns = [ids, batch.column(2), pa.array(names, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.int32())), pa.array(words, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "names", "counts", "words"])

    schema = StructType([rows.schema["doc_id"], *(StructField("label", IntegerType()),)])
    text_schema = f"doc_id {schema['doc_id'].dataType.simpleString()}, label int, names array<int>, counts array<int>, words int"
    sample = sorted(in_batches(rows.select("doc_id", "text", "label")).mapInArrow(chosen, text_schema).collect())
    density = np.array([sum(c for f, c in zip(r.names, r.counts, strict=True) if f in telling) / max(1, r.words) for r in sample])
    is_toxic = np.array([r.label > 0 for r in sample])
    middle = np.median(density[is_toxic]) if is_toxic.any() else 0.0
    grades = np.where(is_toxic, np.where(density >= middle, 2, 1), 0)
    if len(set(grades.tolist())) < 3:
        grades = is_toxic.astype(int)
    vectors = [{f: float(np.log1p(c)) for f, c in zip(r.names, r.counts, strict=True)} for r in sample]
    return fit(vectors, grades)


def score(docs: DataFrame, model: Severity, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, expected_severity, grade (the likeliest), score (P(grade > 0)) and toxic (score >= 1/2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity", dict)
        memo = Memo(lambda word: tuple(f for f in _hashed(word) if f in model.weights), MOST_WORDS, LONGEST_WORD)
        for batch in batches:
            x = np.zeros(batch.num_rows)
            for i, t in enumerate(batch.column(1).to_pylist()):
                found, _ = features(t, memo)
                x[i] = sum(model.weights[f] * np.log1p(found[f]) for f in sorted(found))
            p = model.chances(x)
            risk = 1 - p[:, 0]
            columns = [batch.column(0), pa.array(p @ np.arange(p.shape[1])), pa.array(p.argmax(1).astype("i4")), pa.array(risk), pa.array(risk >= 0.5)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_severity", "grade", "score", "toxic"])

    rows = texts(docs, key, text)
    fields = [("expected_severity", DoubleType()), ("grade", IntegerType()), ("score", DoubleType()), ("toxic", BooleanType())]
    return in_batches(rows).mapInArrow(run, StructType([rows.schema["doc_id"], *(StructField(n, t) for n, t in fields)]))
